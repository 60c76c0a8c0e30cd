"""Set operations on keys (SET-*). Sets travel as one long frame: ``set_id`` plus key columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load_sets(df: DataFrame, set_col: str, keys: Sequence[str]) -> DataFrame:
    """SET-1: distinct composite keys per set; a row lacking part of its key is skipped."""
    whole = df.dropna(subset=list(keys))
    return whole.select(F.col(set_col).alias("set_id"), *keys).distinct()


def read_key_sets(spark: SparkSession, paths: dict[str, str], key_columns: Sequence[int] = (0, 1),
                  sep: str = r"\s+") -> DataFrame:
    """SET-1 from text files: chosen columns joined by ``:`` form the key, short lines are skipped."""
    def one(set_id: str, path: str) -> DataFrame:
        cells = F.split("value", sep)
        return (
            spark.read.text(path).where(F.size(cells) > max(key_columns))
            .select(F.lit(set_id).alias("set_id"), F.concat_ws(":", *[cells[i] for i in key_columns]).alias("key"))
            .distinct()
        )

    frames = [one(k, p) for k, p in paths.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _chosen(sets: DataFrame, only: Sequence[str] | None) -> DataFrame:
    return sets if only is None else sets.where(F.col("set_id").isin(*only))


def membership(sets: DataFrame, keys: Sequence[str], only: Sequence[str] | None = None) -> DataFrame:
    """Keys with the number of sets that hold them; one grouping instead of set combinations."""
    return _chosen(sets, only).groupBy(*keys).agg(F.count_distinct("set_id").alias("n_sets"))


def _set_count(sets: DataFrame, only: Sequence[str] | None) -> Column:
    if only is not None:
        return F.lit(len(set(only)))
    return sets.agg(F.count_distinct("set_id")).scalar()


def intersect(sets: DataFrame, keys: Sequence[str], only: Sequence[str] | None = None) -> DataFrame:
    """SET-2."""
    return membership(sets, keys, only).where(F.col("n_sets") == _set_count(sets, only)).drop("n_sets")


def union(sets: DataFrame, keys: Sequence[str], only: Sequence[str] | None = None) -> DataFrame:
    """SET-3."""
    return _chosen(sets, only).select(*keys).distinct()


def in_at_least(sets: DataFrame, keys: Sequence[str], k: int, only: Sequence[str] | None = None) -> DataFrame:
    """SET-4."""
    return membership(sets, keys, only).where(F.col("n_sets") >= k).drop("n_sets")


def in_at_most(sets: DataFrame, keys: Sequence[str], k: int, only: Sequence[str] | None = None) -> DataFrame:
    """SET-5."""
    return membership(sets, keys, only).where(F.col("n_sets") <= k).drop("n_sets")


def exclude(result: DataFrame, sets: DataFrame, keys: Sequence[str], drop: Sequence[str]) -> DataFrame:
    """SET-6: remove the keys of the listed sets from an earlier result."""
    return result.join(union(sets, keys, drop), list(keys), "left_anti")


def region_counts(sets: DataFrame, keys: Sequence[str], only: Sequence[str] | None = None) -> DataFrame:
    """SET-7: number of keys per exact combination of the chosen sets, or of all."""
    per_key = _chosen(sets, only).groupBy(*keys).agg(
        F.array_join(F.array_sort(F.collect_set("set_id")), "&").alias("region"))
    return per_key.groupBy("region").agg(F.count("*").alias("n"))


def cohort_unique(sets: DataFrame, keys: Sequence[str], background: Sequence[str] = ()) -> DataFrame:
    """SET-8: keys of exactly one set, less those of the background sets."""
    fore = sets.where(~F.col("set_id").isin(*background)) if background else sets
    lone = in_at_most(fore, keys, 1)
    return exclude(lone, sets, keys, background) if background else lone
