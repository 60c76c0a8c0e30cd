"""Comparison with a truth set and between callers (ACC-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoloom.functions.stats import ratio
from genoloom.operators import sets
from genoloom.operators.sweep import tag_overlaps


def truth_comparison(calls: DataFrame, regions: DataFrame, truth: DataFrame, by: str = "caller",
                     shared: bool | None = None) -> DataFrame:
    """ACC-1: calls in confident regions, matches with the truth of their type, false rates in percent.

    Matching is by overlap within a variant type; the false negative rate is relative to the
    number of truth variants of the type. With ``shared`` (ACC-2) only calls count whose place and
    type another caller also reports (True) or one caller alone reports (False). Calls are read
    once, reduced to counted loci, and one sweep marks both regions and truth.
    """
    at = ["chrom", "var_type", "start", "end"]
    loci = calls.groupBy(by, *at).agg(F.count("*").alias("_n"))
    if shared is not None:
        # One entry a caller, so the list is bounded by the callers.
        places = loci.groupBy(*at).agg(F.collect_list(F.struct(by, "_n")).alias("_callers"))
        named = F.size(F.filter("_callers", lambda x: x[by].isNotNull()))
        loci = places.where(named > 1 if shared else named == 1).select(*at, F.inline("_callers"))
    tagged = tag_overlaps(loci, {"_inside": (regions, ()), "_true": (truth, ("var_type",))})
    per = tagged.where("_inside").groupBy(by, "var_type").agg(
        F.sum("_n").alias("in_regions"), F.sum(F.when(F.col("_true"), F.col("_n")).otherwise(0)).alias("in_truth"))
    totals = truth.groupBy("var_type").agg(F.count("*").alias("truth_total"))
    return per.join(totals, "var_type", "left").withColumn(
        "false_positive", 100 - F.col("in_truth") / F.col("in_regions") * 100).withColumn(
        "false_negative", 100 - ratio(F.col("in_truth"), F.coalesce("truth_total", F.lit(0)), 100.0))


def split_by_sharing(calls: DataFrame, shared: bool, by: str = "caller") -> DataFrame:
    """ACC-2: calls at a place and type that another caller also reports, or those only one reports.

    One grouping of places gives the number of callers, instead of a join per pair of callers.
    """
    at = ["chrom", "var_type", "start", "end"]
    n = calls.groupBy(*at).agg(F.count_distinct(by).alias("_n"))
    keep = n.where(F.col("_n") > 1 if shared else F.col("_n") == 1).select(*at)
    return calls.join(keep, at, "left_semi")


def concordance(calls: DataFrame, callers: list[str], by: str = "caller") -> DataFrame:
    """ACC-3: number of variants per combination of callers."""
    keys = ["chrom", "start", "end", "bases"]
    return sets.region_counts(sets.load_sets(calls, by, keys), keys, callers)


def hit_rate(calls: DataFrame, hits: DataFrame, background: float, by: str = "sample") -> DataFrame:
    """ACC-4: observed share of calls with a hit, and its ratio to the background rate (both percent)."""
    marked = calls.join(hits.select("chrom", "pos", F.lit(1).alias("_h")).distinct(), ["chrom", "pos"], "left")
    per = marked.groupBy(by).agg(F.count("*").alias("calls"), F.count("_h").alias("hits"))
    return per.withColumn("percent", F.col("hits") / F.col("calls") * 100).withColumn(
        "enrichment", F.col("percent") / F.lit(background))
