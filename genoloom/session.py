"""Session defaults and the shared folder used for checkpoints and written intermediates."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Calls and loci shrink to a tenth or less in a shuffle, and a task of a join sorts or groups the rows of both
# sides. With Spark's 64 MB a task it held over 1 GB of them.
TASK_SIZE = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}

# Adaptive execution re-plans joins from measured sizes and splits skewed partitions; the
# forced variant keeps splitting even when the next grouping could have reused the exchange.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    **TASK_SIZE,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "genoloom", **conf: str) -> SparkSession:
    """Create (or reuse) a session with the defaults above; keyword pairs override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_tasks(spark: SparkSession) -> None:
    """Set ``TASK_SIZE`` where the session leaves it unset."""
    for key, value in TASK_SIZE.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that every executor can read and write, below ``spark.checkpoint.dir``.

    On a cluster a missing setting is an error, because no other folder is known to be shared. In a
    local session the executors are threads of the driver, so the warehouse folder serves as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse').rstrip('/')}/_settled"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and go on from the written table.

    For a frame that feeds several branches and is dear to work out: it is computed once, later
    stages do not depend on its lineage, and a lost executor costs a re-read only.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
