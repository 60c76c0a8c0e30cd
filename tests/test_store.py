"""The result table with versions."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from genoloom.sources import store

SCHEMA = "run_id long, filter_name string, id long"


def _files(root):
    return {str(p): p.stat().st_mtime_ns for p in Path(root, "data").rglob("*.parquet")}


def _rows(df):
    return sorted(map(str, df.collect()))


def test_removal_touches_no_file_and_keeps_versions(spark, tmp_path):
    root = str(tmp_path / "store")
    first = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (3, "b", 3), (3, None, 4), (None, "b", 5), (3, "b", 3)], SCHEMA)
    second = spark.createDataFrame([(3, "b", 6), (4, "001", 7)], SCHEMA)
    assert store.create_store(spark, root, first.schema, ["run_id", "filter_name"]) == 0
    assert store.read_store(spark, root).collect() == []
    assert store.append_rows(first, root, ["id"]) == 1
    assert _rows(store.read_store(spark, root)) == _rows(first)
    assert store.append_rows(second, root, ["id"]) == 2
    before = _files(root)
    assert store.remove_rows(spark, root, {"run_id": 3, "filter_name": "b"}) == 3
    assert _files(root) == before
    both = first.union(second)
    assert _rows(store.read_store(spark, root)) == _rows(both.where("NOT (run_id <=> 3 AND filter_name <=> 'b')"))
    assert _rows(store.read_store(spark, root, 2)) == _rows(both) and _rows(store.read_store(spark, root, 1)) == _rows(first)
    assert store.remove_rows(spark, root, {"filter_name": None}) == 4
    assert _rows(store.read_store(spark, root).select("id")) == _rows(both.where("id IN (1, 2, 5, 7)").select("id"))
    assert store.read_store(spark, root).schema["filter_name"].dataType.typeName() == "string"
    with pytest.raises(ValueError):
        store.remove_rows(spark, root, {"id": 3})


def test_failed_append_leaves_the_last_version(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    store.create_store(spark, root, rows.schema, ["run_id", "filter_name"])
    store.append_rows(rows, root)
    broken = rows.withColumn("id", F.when(F.col("id") > 0, F.raise_error(F.lit("lost"))).cast("long"))
    with pytest.raises(Exception, match="lost"):
        store.append_rows(broken, root)
    assert store.current_version(spark, root) == 1 and _rows(store.read_store(spark, root)) == _rows(rows)
    assert store.append_rows(rows.limit(0), root) == 2
    assert store.append_rows(rows, root) == 3 and store.read_store(spark, root).count() == 2


def test_removed_folders_are_pruned(spark, tmp_path):
    root = str(tmp_path / "store")
    rows = spark.range(200).selectExpr("id % 20 AS run_id", "'f' || id % 2 AS filter_name", "id")
    store.create_store(spark, root, rows.schema, ["run_id", "filter_name"])
    store.append_rows(rows, root)
    store.remove_rows(spark, root, {"run_id": 3})
    kept = store.read_store(spark, root)
    assert "dynamicpruning" in kept._jdf.queryExecution().executedPlan().toString().lower()
    assert {r.run_id for r in kept.collect()} == set(range(20)) - {3} and kept.count() == 190
