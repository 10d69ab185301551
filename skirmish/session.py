"""Session helpers: one place for the configuration every job relies on.

On a cluster the session is created by the platform; ``get_session`` only
fills in settings that are unset, so a cluster's own values win.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job assumes. Only applied when the key is not set already.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcasts happen only through explicit, size-checked hints (see
    # operators.joins.bounded_broadcast); never by a statistics guess that
    # can be wrong for derived frames.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # AQE may still turn a join into a broadcast join, but only after the
    # shuffle stage has run and its real size is known (a measured bound).
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Let a join on (match_id, map_id, ...) reuse a partitioning on match_id
    # alone, so facts co-partitioned by match are joined without a shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # HotSpot does not JIT-compile methods over 8000 bytecodes; wide feature
    # projections would otherwise run as interpreted code inside codegen.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "skirmish") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("SKIRMISH_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    # The one knob above that matters for oracle equality is forced.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    _ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``skirmish`` importable in the Python workers (pandas UDF stages
    pickle their functions by reference): zip the package once per
    SparkContext and ``addPyFile`` it, which Spark distributes to every
    executor. The zip is written next to the checkpoints when that folder is
    a local path, else to the driver's temp folder (the driver serves it)."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    base = sc.getCheckpointDir() or ""
    base = base[len("file:"):] if base.startswith("file:") else base
    folder = base if base.startswith("/") else tempfile.mkdtemp(prefix="skirmish-pyfiles-")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"skirmish-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    _SHIPPED.add(key)


def _ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; a fresh folder under
    /tmp is taken only where it is unset and the master is local, so that all
    tasks share this machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="skirmish-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (never machine-local on a cluster)."""
    base = _ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def lineage_cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut a long lineage with a reliable checkpoint in the shared folder.

    Survives executor loss (the data is written to the shared store), unlike a
    local checkpoint.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
