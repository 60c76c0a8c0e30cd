"""Closed-interval joins (OVL-*), interval merging and extents (AGG-9, AGG-10, AGG-19).

Frames carry ``chrom, start, end`` with ``start <= end``; the annotation side also carries a
name column. Catalyst has no range join, so pairs are found by an equi-join on bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoloom.functions.stats import sorted_text
from genoloom.operators.chunks import CHUNK, merged, run_ids, with_totals
from genoloom.operators.sweep import tag_overlaps

BIN = 1000
LEVELS = 6
FANOUT = 16
MODES = ("any", "full", "full_rev", "exact", "fifty_pct")


def validate_intervals(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-6: (good, rejected) frames; a missing coordinate or ``end < start`` is rejected."""
    bad = F.col("chrom").isNull() | F.col("start").isNull() | F.col("end").isNull() | (F.col("end") < F.col("start"))
    return df.where(~bad), df.where(bad)


def require_valid(df: DataFrame) -> DataFrame:
    """SRC-6 as an assertion: the job fails on the first interval that ends before it starts."""
    return df.withColumn(
        "end",
        F.when(F.col("end") < F.col("start"), F.raise_error(F.lit("end coordinate less than start")))
        .otherwise(F.col("end")),
    )


def widen(df: DataFrame, n: int) -> DataFrame:
    """OVL-18: add ``n`` bases on both sides, the start not going below zero."""
    return df.withColumn("start", F.greatest(F.col("start") - n, F.lit(0))).withColumn("end", F.col("end") + n)


def _level(width: int) -> str:
    """Coarseness of an interval: the first level whose bins are at least as long as it."""
    steps = " ".join(f"WHEN `end` - start <= {width * FANOUT**lv} THEN {lv}" for lv in range(LEVELS - 1))
    return f"CASE {steps} ELSE {LEVELS - 1} END"


def _widths(width: int, code: str) -> str:
    """Bin width of a slot code; codes 0.. and 10.. stand for the two match directions."""
    sizes = ", ".join(f"{width * FANOUT**lv}L" for lv in range(LEVELS))
    return f"element_at(array({sizes}), {code} % 10 + 1)"


def _spread(df: DataFrame, codes: str, width: int) -> DataFrame:
    """One row per slot code of the interval and per bin it touches there (two at most)."""
    coded = df.selectExpr("*", f"explode({codes}) AS _code")
    w = _widths(width, "_code")
    return coded.selectExpr("*", f"explode(sequence(start div {w}, `end` div {w})) AS _bin")


def _residual(mode: str, max_distance: int | None) -> Column:
    s, e, cs, ce = F.col("start"), F.col("end"), F.col("c_start"), F.col("c_end")
    hit = (cs <= e) & (ce >= s)
    if mode == "full":
        hit &= (cs <= s) & (ce >= e)
    elif mode == "full_rev":
        hit &= (cs >= s) & (ce <= e)
    elif mode == "fifty_pct":
        hit &= (F.least(e, ce) - F.greatest(s, cs)) * 2 >= e - s
    elif mode == "fifty_pct_strict":
        span = e - s
        shared = F.least(span, F.greatest(ce - s, e - cs))
        hit &= shared * 2 > span
    if max_distance is not None:
        near = (F.abs(s - cs) <= max_distance) & (F.abs(e - ce) <= max_distance)
        hit &= near
        if mode == "any":
            hit |= (F.abs(s - cs) < max_distance) & (F.abs(e - ce) < max_distance)
    return hit


def locus_pairs(loci: DataFrame, coord: DataFrame, mode: str = "any", max_distance: int | None = None,
                keys: Sequence[str] = ("chrom",), bin_width: int = BIN, longest: int | None = None) -> DataFrame:
    """Pairs of a locus (``keys, start, end``) and an annotation interval (``c_start, c_end`` + rest).

    Both sides should be distinct. Without a distance, each interval is listed in the bins of
    its own level and of the coarser levels the other side uses, two bins per level at most,
    so neither long nor short intervals multiply. Codes 0.. pair a locus with annotation of its
    own or a coarser level, codes 10.. pair it with finer annotation. A pair meets in several
    bins only when both cross a border; it is emitted in the bin of the larger start. The levels
    in use are found by one-row aggregates; ``longest``, an upper bound of ``end - start`` over
    the loci (0 for points, checked at run time), spares that pass over the larger side. With a distance, cells of
    (start, end) are joined with their neighbours, which keeps a hot start position apart by
    end position.
    """
    keys = list(keys)
    right = coord.withColumnRenamed("start", "c_start").withColumnRenamed("end", "c_end")
    if mode == "exact":
        hit = right.withColumn("start", F.col("c_start")).withColumn("end", F.col("c_end"))
        return loci.join(merged(hit), [*keys, "start", "end"])
    if max_distance is not None and mode == "any":
        d = max(max_distance, 1)
        near = [F.lit(-1), F.lit(0), F.lit(1)]
        left = loci.withColumn("_sb", F.floor(F.col("start") / d)).withColumn("_eb", F.floor(F.col("end") / d))
        spread = (
            right.withColumn("_ds", F.explode(F.array(*near)))
            .withColumn("_de", F.explode(F.array(*near)))
            .withColumn("_sb", F.floor(F.col("c_start") / d) + F.col("_ds"))
            .withColumn("_eb", F.floor(F.col("c_end") / d) + F.col("_de"))
            .drop("_ds", "_de")
        )
        both = left.join(merged(spread), [*keys, "_sb", "_eb"]).drop("_sb", "_eb")
        return both.where(_residual(mode, max_distance))

    # Levels in use on each side: one-row aggregates read as scalar subqueries.
    level = _level(bin_width)
    used = F.expr(f"collect_set({level})")
    theirs_l = coord.agg(used).scalar()
    if longest is None:
        theirs_r = loci.agg(used).scalar()
    else:
        theirs_r = F.array(*[F.lit(lv) for lv in range(LEVELS) if lv == 0 or longest > bin_width * FANOUT ** (lv - 1)])
        # A filter, not a new column, so that the loci keep the partitioning of their distinct.
        too_long = F.raise_error(F.lit(f"locus longer than the declared {longest}")).cast("boolean")
        loci = loci.where(F.when(F.col("end") - F.col("start") <= longest, F.lit(True)).otherwise(too_long))
    left = _spread(
        loci.withColumns({"_own": F.expr(level), "_theirs": theirs_l}),
        "concat(filter(_theirs, v -> v >= _own), if(exists(_theirs, v -> v < _own), array(_own + 10), array()))",
        bin_width,
    ).drop("_own", "_theirs")
    spread = _spread(
        coord.withColumns({"_own": F.expr(level), "_theirs": theirs_r}),
        "concat(array(_own), transform(filter(_theirs, v -> v > _own), v -> v + 10))",
        bin_width,
    ).drop("_own", "_theirs").withColumnsRenamed({"start": "c_start", "end": "c_end"})
    home = F.expr(f"greatest(start, c_start) div {_widths(bin_width, '_code')}")
    return (
        left.join(merged(spread), [*keys, "_code", "_bin"])
        .where(_residual(mode, max_distance) & (F.col("_bin") == home))
        .drop("_code", "_bin")
    )


def overlap_pairs(ref: DataFrame, coord: DataFrame, mode: str = "any", max_distance: int | None = None,
                  keys: Sequence[str] = ("chrom",), bin_width: int = BIN, longest: int | None = None) -> DataFrame:
    """OVL-1..6, OVL-10: one row per ref row and matching annotation interval."""
    keys = list(keys)
    loci = ref.select(*keys, "start", "end").distinct()
    pairs = locus_pairs(loci, coord, mode, max_distance, keys, bin_width, longest)
    return ref.join(merged(pairs), [*keys, "start", "end"])


def mark_duplicates(coord: DataFrame, name: str = "name") -> DataFrame:
    """OVL-11: flag ``dup`` for descriptions that stand on more than one annotation line."""
    return with_totals(coord, [name], _lines=F.count("*")).withColumn("dup", F.col("_lines") > 1).drop("_lines")


def ignore_names(coord: DataFrame, ignore: Sequence[str], name: str = "name") -> DataFrame:
    """OVL-12: one entry drops whole descriptions; several entries leave comma lists token by token."""
    if not ignore:
        return coord
    if len(ignore) == 1:
        return coord.where(F.col(name) != ignore[0])
    kept = F.filter(F.split(F.col(name), ","), lambda x: ~x.isin(*ignore))
    return coord.withColumn("_kept", kept).where(F.size("_kept") > 0).withColumn(
        name, F.array_join("_kept", ",")).drop("_kept")


def underscore_names(coord: DataFrame, name: str = "name") -> DataFrame:
    """OVL-13."""
    return coord.withColumn(name, F.regexp_replace(name, " ", "_"))


def number_duplicates(coord: DataFrame, name: str = "name") -> DataFrame:
    """OVL-15: keep repeated descriptions apart as ``name``, ``name-DUPKEY1``, ``name-DUPKEY2``...

    The number follows (chrom, start, end) within the description, counted in chunks.
    """
    lone = coord.select("chrom", "start", "end", name).distinct()
    ranked = run_ids(lone, [name], ["chrom", "start", "end"], ["chrom", "start", "end"],
                     F.struct("chrom", F.floor(F.col("start") / CHUNK)),
                     lambda prev, cur: F.lit(True), out="_n")
    return ranked.withColumn(
        name, F.when(F.col("_n") > 1, F.concat(F.col(name), F.lit("-DUPKEY"), (F.col("_n") - 1).cast("string")))
        .otherwise(F.col(name))).drop("_n")


def overlap_matches(ref: DataFrame, coord: DataFrame, name: str = "name", mode: str = "any",
                    max_distance: int | None = None, keep_unmatched: str | None = None,
                    ignore: Sequence[str] = (), underscore: bool = False, flag_dups: bool = False,
                    group_by_name: bool = True, keys: Sequence[str] = ("chrom",), bin_width: int = BIN,
                    sep: str = "^^^", longest: int | None = None) -> DataFrame:
    """OVL-7, OVL-9, OVL-11..15: ``matches`` text and ``n_matches`` per ref row.

    Matching works on distinct loci, so any number of calls at one place costs one lookup; the
    collapsed result has one row per locus and is joined back. ``keep_unmatched`` keeps ref
    rows without a match and writes that marker.
    """
    keys = list(keys)
    if underscore:
        coord = underscore_names(coord, name)
    if not group_by_name:
        coord = number_duplicates(coord, name)
    elif flag_dups:
        coord = mark_duplicates(coord, name)
    coord = ignore_names(coord, ignore, name)
    if flag_dups and group_by_name:
        coord = coord.withColumn(name, F.when(F.col("dup"), F.concat(F.col(name), F.lit("-DUP")))
                                 .otherwise(F.col(name)))
    intervals = coord.select(*keys, "start", "end", F.col(name).cast("string").alias("_name")).distinct()
    loci = ref.select(*keys, "start", "end").distinct()
    pairs = locus_pairs(loci, intervals, mode, max_distance, keys, bin_width, longest)
    per_locus = pairs.groupBy(*keys, "start", "end").agg(F.collect_set("_name").alias("_names")).select(
        *keys, "start", "end", F.array_join(F.array_sort("_names"), sep).alias("matches"),
        F.size("_names").cast("bigint").alias("n_matches"))
    if keep_unmatched is None:
        return ref.join(merged(per_locus), [*keys, "start", "end"])
    return (
        ref.join(merged(per_locus), [*keys, "start", "end"], "left")
        .withColumn("matches", F.coalesce("matches", F.lit(keep_unmatched)))
        .withColumn("n_matches", F.coalesce("n_matches", F.lit(0)))
    )


def overlap_any(ref: DataFrame, coord: DataFrame, mode: str = "any", max_distance: int | None = None,
                keys: Sequence[str] = ("chrom",), bin_width: int = BIN, how: str = "left_semi",
                longest: int | None = None) -> DataFrame:
    """Ref rows with (``left_semi``) or without (``left_anti``, OVL-8) any match.

    Plain overlap is a sweep over the distinct loci, so neither long intervals nor a stack of
    annotation at one place multiplies rows; the other modes look at pairs.
    """
    keys = list(keys)
    loci = ref.select(*keys, "start", "end").distinct()
    if mode == "any" and max_distance is None:
        hit = tag_overlaps(loci, {"_hit": (coord, ())}, keys).where("_hit").drop("_hit")
    else:
        spans = coord.select(*keys, "start", "end").distinct()
        hit = locus_pairs(loci, spans, mode, max_distance, keys, bin_width, longest).select(*keys, "start", "end").distinct()
    return ref.join(merged(hit), [*keys, "start", "end"], how)


def overlap_unmatched(ref: DataFrame, coord: DataFrame, **kw) -> DataFrame:
    """OVL-8."""
    return overlap_any(ref, coord, how="left_anti", **kw)


def overlap_counts(ref: DataFrame, coord: DataFrame, set_col: str, **kw) -> DataFrame:
    """OVL-16: matched and unmatched ref rows per annotation set."""
    sets = coord.select(set_col).distinct()
    loci = ref.groupBy("chrom", "start", "end").agg(F.count("*").alias("_rows"))
    spans = coord.select("chrom", "start", "end", set_col).distinct()
    hit = locus_pairs(loci.select("chrom", "start", "end"), spans, **kw)
    matched = (
        hit.select("chrom", "start", "end", set_col).distinct()
        .join(loci, ["chrom", "start", "end"])
        .groupBy(set_col).agg(F.sum("_rows").alias("matched"))
    )
    total = ref.agg(F.count("*").alias("n")).scalar()
    return sets.join(matched, set_col, "left").withColumn("matched", F.coalesce("matched", F.lit(0))).withColumn(
        "unmatched", total - F.col("matched"))


def genes_at_points(points: DataFrame, exons: DataFrame, splice: int = 10, columns: Sequence[str] = ("gene",),
                    gene: str = "gene") -> DataFrame:
    """OVL-17: gene extents widened by the splice buffer, every gene at a point, columns collected."""
    extents = widen(gene_extents(exons, gene), splice)
    extra = [c for c in columns if c != gene]
    if extra:
        extents = extents.join(exons.select(gene, *extra).distinct(), gene)
    loci = points.select("chrom", "start", "end").distinct()
    pairs = locus_pairs(loci, extents, longest=0)
    per_locus = pairs.groupBy("chrom", "start", "end").agg(*[sorted_text(F.col(c)).alias(c) for c in columns])
    return points.join(merged(per_locus), ["chrom", "start", "end"], "left")


def tool_comparison(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """OVL-20: each distinct key labelled ``both``, ``a_only`` or ``b_only`` in one grouping."""
    tagged = a.select(*keys, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*keys, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    return (
        tagged.groupBy(*keys).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
        .withColumn("found_in", F.when((F.col("_a") == 1) & (F.col("_b") == 1), "both")
                    .when(F.col("_a") == 1, "a_only").otherwise("b_only"))
        .drop("_a", "_b")
    )


def merge_intervals(df: DataFrame, part: Sequence[str] = ("chrom",), gap: int = 1) -> DataFrame:
    """AGG-9: union of overlapping or adjacent intervals (``gap`` = 1 joins touching ones).

    Equal starts are reduced first, which also removes hot positions. The running maximum of
    the ends is scanned in chunks and carried between them.
    """
    part = list(part)
    lone = df.groupBy(*part, "start").agg(F.max("end").alias("end"))
    cut = lone.withColumn("_chunk", F.floor(F.col("start") / CHUNK)).repartition(*part, "_chunk")
    within = Window.partitionBy(*part, "_chunk").orderBy("start")
    chunks = Window.partitionBy(*part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    reach = (
        cut.groupBy(*part, "_chunk").agg(F.max("end").alias("_m"))
        .withColumn("_carry", F.max("_m").over(chunks)).drop("_m")
    )
    before = F.max("end").over(within.rowsBetween(Window.unboundedPreceding, -1))
    flagged = (
        cut.join(reach, [*part, "_chunk"])
        .withColumn("_prev", F.greatest(before, F.col("_carry")))
        .withColumn("_head", F.when(F.col("_prev").isNull() | (F.col("start") > F.col("_prev") + gap),
                                    F.col("start")))
        .drop("_prev", "_carry")
    )
    heads = (
        flagged.groupBy(*part, "_chunk").agg(F.max("_head").alias("_h"))
        .withColumn("_open", F.max("_h").over(chunks)).drop("_h")
    )
    island = F.coalesce(
        F.max("_head").over(within.rowsBetween(Window.unboundedPreceding, 0)), F.col("_open"))
    return (
        flagged.join(heads, [*part, "_chunk"])
        .withColumn("_island", island)
        .groupBy(*part, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .drop("_island")
    )


def gene_extents(exons: DataFrame, gene: str = "gene") -> DataFrame:
    """AGG-10: smallest start and largest end per gene."""
    return exons.groupBy("chrom", gene).agg(F.min("start").alias("start"), F.max("end").alias("end"))


def gene_runs(exons: DataFrame, gene: str = "gene") -> DataFrame:
    """AGG-10, run form: one row per consecutive run of a gene along the chromosome."""
    lone = exons.groupBy("chrom", "start", gene).agg(F.max("end").alias("end"))
    runs = run_ids(lone, ["chrom"], ["start", gene], [gene], F.floor(F.col("start") / CHUNK),
                   lambda prev, cur: prev[gene] != cur[gene])
    return runs.groupBy("chrom", "run", gene).agg(
        F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def interval_totals(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """AGG-19: summed ``end - start`` per set."""
    return df.groupBy(*by).agg(F.sum(F.col("end") - F.col("start")).cast("bigint").alias("total_length"),
                               F.count("*").alias("intervals"))


def breakpoints_to_intervals(sv: DataFrame) -> DataFrame:
    """NRM-10: ``bnd`` and ``inv`` become two single-base rows, every other type one span."""
    def row(c: str, s: str, e: str) -> Column:
        return F.struct(F.col(c).alias("chrom"), F.col(s).cast("bigint").alias("start"),
                        F.col(e).cast("bigint").alias("end"))

    rows = F.when(F.col("sv_type").isin("bnd", "inv"),
                  F.array(row("chr1", "coord1", "coord1"), row("chr2", "coord2", "coord2"))
                  ).otherwise(F.array(row("chr1", "coord1", "coord2")))
    return sv.select("sv_id", "sv_type", F.explode(rows).alias("r")).select("sv_id", "sv_type", "r.*")
