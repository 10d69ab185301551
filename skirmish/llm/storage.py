"""Tables that cut a lineage: written to the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skirmish.session import scratch_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back,
    so that what follows neither recomputes it nor depends on an executor."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
