"""Depth over exons, genes and genomes, and alignment statistics (COV-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoloom.functions.stats import count_if, ratio, sorted_text
from genoloom.operators.chunks import merged
from genoloom.operators.intervals import locus_pairs, overlap_any, widen

# Sizes used by the run sheet (fixed values, bases).
GENOME_SIZE = 2_897_310_462
EXOME_SIZE = 33_363_981
PANEL_SIZE = 3_344_125


def exon_ranges(exons: DataFrame, name: str = "exon") -> DataFrame:
    """Distinct exon ranges with their comma-joined names."""
    return exons.groupBy("chrom", "start", "end").agg(sorted_text(F.col(name)).alias("exons"))


def _covered(exons: DataFrame, depth: DataFrame) -> DataFrame:
    """(range, pos, depth) rows: every measured position inside an exon range."""
    points = depth.select("chrom", F.col("pos").alias("start"), F.col("pos").alias("end"), "depth")
    hits = locus_pairs(points, exon_ranges(exons).select("chrom", "start", "end"), longest=0)
    return hits.select("chrom", F.col("c_start").alias("start"), F.col("c_end").alias("end"),
                       F.col("start").alias("pos"), "depth")


def exon_depth(exons: DataFrame, depth: DataFrame) -> DataFrame:
    """COV-1: median, smallest and largest measured depth per exon range; null without depth rows."""
    per = _covered(exons, depth).groupBy("chrom", "start", "end").agg(
        F.median("depth").alias("median"), F.min("depth").alias("min"), F.max("depth").alias("max"))
    return exon_ranges(exons).join(merged(per), ["chrom", "start", "end"], "left")


def exon_status(exons: DataFrame, depth: DataFrame, min_depth: int = 1) -> DataFrame:
    """COV-2: FULL_COVER, the uncovered runs, ONLY_LOW_COVER or NO_COVER, and missing bases per range.

    Uncovered runs are the gaps between neighbouring covered positions, so bases are never
    listed one by one; the window is bounded by the exon length. Missing bases follow the
    reported rule: a gap counts inclusively, a wholly uncovered range counts ``end - start``.
    """
    at = ["chrom", "start", "end"]
    ranges = exon_ranges(exons)
    measured = _covered(exons, depth)
    covered = measured.where(F.col("depth") >= min_depth).select(*at, "pos").distinct()
    edges = ranges.select(*at, F.explode(F.array(F.col("start") - 1, F.col("end") + 1)).alias("pos"))
    marked = covered.select(*at, "pos", F.lit(1).alias("real")).unionByName(edges.withColumn("real", F.lit(0)))
    nxt = F.lead("pos").over(Window.partitionBy(*at).orderBy("pos"))
    gaps = marked.withColumn("next", nxt).withColumn("lo", F.col("pos") + 1).withColumn("hi", F.col("next") - 1)
    run = F.when(F.col("hi") > F.col("lo"), F.concat_ws("-", "lo", "hi")).when(
        F.col("hi") == F.col("lo"), F.col("lo").cast("string"))
    per = gaps.groupBy(*at).agg(
        F.array_sort(F.collect_list(F.when(run.isNotNull(), F.struct("lo", run.alias("text"))))).alias("_runs"),
        F.sum("real").alias("_covered"),
        F.sum(F.when(F.col("hi") >= F.col("lo"), F.col("hi") - F.col("lo") + 1).otherwise(0)).alias("_gap"))
    any_depth = measured.select(*at, F.lit(True).alias("_any")).distinct()
    length = F.col("end") - F.col("start")
    full = F.col("_gap") == 0
    return (
        ranges.join(per, at).join(any_depth, at, "left")
        .withColumn("status", F.when(F.col("_any").isNull(), "NO_COVER").when(full, "FULL_COVER")
                    .when(F.col("_covered") > 0, F.array_join(F.transform("_runs", lambda r: r["text"]), ","))
                    .otherwise("ONLY_LOW_COVER"))
        .withColumn("missing_bases", F.when(F.col("_any").isNull(), length).when(full, F.lit(0))
                    .when(F.col("_covered") > 0, F.col("_gap")).otherwise(length))
        .drop("_runs", "_covered", "_gap", "_any")
    )


def missing_bases(status: DataFrame, by: Sequence[str] = ("chrom",)) -> DataFrame:
    """COV-3: missing and total bases and their percentage, per chromosome or over all (``by=()``)."""
    per = status.groupBy(*by).agg(
        F.sum("missing_bases").alias("missing_bases"), F.sum(F.col("end") - F.col("start")).alias("total_bases"))
    return per.withColumn("missing_percent", ratio(F.col("missing_bases"), F.col("total_bases"), 100.0))


def breadth(depth: DataFrame, by: Sequence[str] = ("sample",), panel_size: int = PANEL_SIZE,
            cutoffs: Sequence[int] = (1, 15)) -> DataFrame:
    """COV-4: share of the panel deeper than each cutoff, and the mean depth."""
    per = depth.groupBy(*by).agg(
        *[count_if(F.col("depth") > c).alias(f"bases_over_{c}") for c in cutoffs], F.avg("depth").alias("mean_depth"))
    return per.withColumns({f"percent_over_{c}": F.col(f"bases_over_{c}") / panel_size * 100 for c in cutoffs})


def gene_depth(genes: DataFrame, depth: DataFrame, margin: int = 100_000, gene: str = "gene",
               block: int = 1000) -> DataFrame:
    """COV-5: positions, total and mean depth per gene widened on both sides.

    Widened genes overlap each other many times, so positions are first summed per block of the
    genome. A gene takes the sums of the blocks inside it, and single positions only from the
    two blocks at its ends; no position is paired with every gene around it.
    """
    points = depth.groupBy("chrom", "pos").agg(F.sum("depth").alias("depth")).withColumn(
        "_block", F.floor(F.col("pos") / block))
    sums = points.groupBy("chrom", "_block").agg(F.count("*").alias("n"), F.sum("depth").alias("s"))
    wide = widen(genes.select("chrom", "start", "end", gene), margin).withColumn(
        "_block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor(F.col("end") / block))))
    inside = (F.col("_block") * block >= F.col("start")) & ((F.col("_block") + 1) * block - 1 <= F.col("end"))
    whole = wide.where(inside).join(merged(sums), ["chrom", "_block"]).select(gene, "n", "s")
    edge = wide.where(~inside).join(merged(points), ["chrom", "_block"]).where(F.col("pos").between(F.col("start"), F.col("end")))
    parts = whole.unionByName(edge.select(gene, F.lit(1).cast("bigint").alias("n"), F.col("depth").alias("s")))
    return parts.groupBy(gene).agg(F.sum("n").alias("positions"), F.sum("s").alias("total_depth")).withColumn(
        "mean_depth", F.col("total_depth") / F.col("positions"))


def _bit(mask: int):
    return F.col("flag").bitwiseAND(mask) != 0


def alignment_stats(reads: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """COV-6: total, aligned, unaligned, paired, singleton and mis-paired reads from the flag column.

    Pair figures leave out secondary and supplementary records.
    """
    primary = ~_bit(0x100) & ~_bit(0x800)
    aligned, mate_aligned, in_pair = ~_bit(0x4), ~_bit(0x8), _bit(0x1) & primary
    return reads.groupBy(*by).agg(
        F.count("*").alias("total"), count_if(aligned).alias("aligned"), count_if(~aligned).alias("unaligned"),
        count_if(in_pair & aligned & mate_aligned).alias("paired"),
        count_if(in_pair & aligned & ~mate_aligned).alias("singletons"),
        count_if(in_pair & aligned & mate_aligned & (F.col("mate_chrom") != F.col("chrom"))).alias("mispaired"))


def reads_on_target(reads: DataFrame, exons: DataFrame, by: str = "sample") -> DataFrame:
    """COV-7: distinct (chrom, pos) of aligned reads that overlap an exon, as percent of paired else aligned."""
    aligned = reads.where(~_bit(0x4)).select(
        by, "chrom", F.col("pos").alias("start"), (F.col("pos") + F.col("read_length") - 1).alias("end")).distinct()
    hits = overlap_any(aligned, exons).select(by, "chrom", "start").distinct().groupBy(by).agg(
        F.count("*").alias("exon_positions"))
    stats = alignment_stats(reads, [by])
    base = F.when(F.col("paired") > 0, F.col("paired")).otherwise(F.col("aligned"))
    return stats.join(hits, by, "left").select(
        by, F.coalesce("exon_positions", F.lit(0)).alias("exon_positions"), "paired", "aligned",
    ).withColumn("percent_on_target", ratio(F.col("exon_positions"), base, 100.0))


def run_sheet(reads: DataFrame, status: DataFrame, read_length: int, size: int = GENOME_SIZE,
              by: str = "sample") -> DataFrame:
    """COV-8: percent aligned and estimated coverage per run, and exon ranges with missing bases.

    ``status`` is the output of ``exon_status``; its incomplete ranges are counted once for the sheet.
    """
    stats = alignment_stats(reads, [by])
    incomplete = status.where("missing_bases > 0").agg(F.count("*")).scalar()
    return stats.select(
        by, "total", "aligned", ratio(F.col("aligned"), F.col("total"), 100.0).alias("percent_aligned"),
        (F.lit(read_length) * F.col("aligned") / size).alias("estimated_coverage"), incomplete.alias("incomplete_exons"))
