"""A result table with versions: appends and removals (SNK-5, SNK-6) that rewrite no other rows.

Below its root a store has ``data`` (one folder per batch and key values), ``live`` (per version
the folders that count) and ``commits`` (one row per finished version). Every change writes its own
new files and then its version number, so a job that fails leaves the last version as it was and a
reader sees whole versions only. One writer at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _slot(keys: Sequence[str]) -> Column:
    """Folder name of the key values; a null differs from every text."""
    return F.concat(F.lit("s"), F.sha2(F.to_json(F.struct(*keys)), 256))


def _commit(live: DataFrame, root: str, version: int) -> int:
    """Finish a version; its list may be left over from a job that failed before its commit."""
    live.coalesce(1).write.mode("overwrite").parquet(f"{root}/live/version={version}")
    live.sparkSession.range(version, version + 1, 1, 1).select(F.col("id").alias("version")).write.mode("append").parquet(
        f"{root}/commits")
    return version


def current_version(spark: SparkSession, root: str) -> int:
    """The last finished version."""
    return spark.read.parquet(f"{root}/commits").agg(F.max("version")).first()[0]


def _live(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The folders of a version: key columns, ``batch`` and ``slot``; one row a folder."""
    return spark.read.parquet(f"{root}/live/version={version}")


def create_store(spark: SparkSession, root: str, schema: StructType, keys: Sequence[str]) -> int:
    """An empty store of rows of ``schema``; removals go by ``keys``. Returns version 0."""
    none = spark.createDataFrame([], schema)
    none.coalesce(1).write.parquet(f"{root}/schema")
    return _commit(none.select(*keys, F.lit("").alias("batch"), F.lit("").alias("slot")), root, 0)


def append_rows(df: DataFrame, root: str, order: Sequence[str] = ()) -> int:
    """SNK-5: append a batch of rows and return the new version.

    Rows are range-partitioned by the keys and ``order``, so name columns there that cut a key
    holding many rows. An empty batch gives a version of its own without new folders.
    """
    spark = df.sparkSession
    version = current_version(spark, root)
    live = _live(spark, root, version)
    keys = live.columns[:-2]
    columns = spark.read.parquet(f"{root}/schema").columns
    batch = f"b{uuid.uuid4().hex}"
    path = f"{root}/data/batch={batch}"
    rows = df.select(*columns).withColumn("_slot", _slot(keys))
    rows.repartitionByRange("_slot", *order).sortWithinPartitions("_slot", *order).withColumnRenamed("_slot", "slot").write.partitionBy(
        "slot").parquet(path)
    written = spark.read.schema(rows.withColumnRenamed("_slot", "slot").schema).parquet(path)
    return _commit(live.unionByName(written.select(*keys, F.lit(batch).alias("batch"), "slot").distinct()), root, version + 1)


def remove_rows(spark: SparkSession, root: str, values: Mapping[str, object]) -> int:
    """SNK-6: leave out the rows whose keys have these values, and return the new version.

    Only the list of folders is written anew. No file of the table is touched, and earlier
    versions can still be read.
    """
    version = current_version(spark, root)
    live = _live(spark, root, version)
    unknown = set(values) - set(live.columns[:-2])
    if unknown or not values:
        raise ValueError(f"removal needs key columns of the store, got {sorted(values)}")
    gone = F.lit(True)
    for key, value in values.items():
        gone = gone & F.col(key).eqNullSafe(F.lit(value))
    return _commit(live.where(~gone), root, version + 1)


def read_store(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the last one by default.

    The join with the list prunes folders at run time, so removed ones are not opened.
    """
    schema = spark.read.parquet(f"{root}/schema").schema
    version = current_version(spark, root) if version is None else version
    if version == 0:  # no batch was written yet
        return spark.createDataFrame([], schema)
    live = _live(spark, root, version)
    placed = StructType([*schema.fields]).add("batch", "string").add("slot", "string")
    names = [F.col(f"d.`{c}`") for c in schema.names]
    rows = spark.read.schema(placed).parquet(f"{root}/data").alias("d")
    # Every slot begins so; without a filter on the list the optimizer does not prune by it.
    listed = live.where(F.col("slot").startswith("s")).select("batch", "slot")
    return rows.join(listed, ["batch", "slot"], "left_semi").select(*names)
