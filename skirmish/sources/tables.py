"""Driver tables: parquet files under one scale-factor folder.

Reads never infer more than the parquet footer says, and never select
columns eagerly: Catalyst prunes the scan to the columns a plan uses and
pushes filters into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy reader for the driver's parquet tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]

    def put(self, name: str, df: DataFrame) -> None:
        """Use ``df`` as the table ``name``."""
        self._cache[name] = df

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            return self.read(name)
        raise AttributeError(name)
