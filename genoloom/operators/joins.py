"""Key joins of calls with annotation, filter, run and depth tables (JON-*).

No side is broadcast by hand: Catalyst broadcasts what its size statistics allow and
otherwise sort-merges, where a hot key is split by the skew rule because the annotation side
is reduced to one row per key first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.functions.stats import sorted_text
from genoloom.operators.intervals import locus_pairs, widen

VARIANT = ("chrom", "start", "end", "bases")


def clean_key(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, '"', ""))


def one_per_key(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One whole row per key, the largest, so a repeated key cannot multiply the left side."""
    best = df.groupBy(*keys).agg(F.max(F.struct(*cols)).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols])


def annotate_by_key(df: DataFrame, key: str, annot: DataFrame, annot_key: str, cols: Sequence[str],
                    fill: str = "NO_ANNO") -> DataFrame:
    """JON-1: left join on the upper-cased, unquoted key; every missing column shows ``fill``."""
    lookup = one_per_key(annot.withColumn("_key", clean_key(F.col(annot_key))), ["_key"], cols)
    return (
        df.withColumn("_key", clean_key(F.col(key))).join(lookup, "_key", "left")
        .withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(fill)) for c in cols}).drop("_key")
    )


def annotate_exact(calls: DataFrame, sources: dict[str, tuple[DataFrame, Sequence[str]]],
                   keys: Sequence[str] = VARIANT) -> DataFrame:
    """JON-2: left equi-joins on the variant key; columns are prefixed by the source name."""
    out = calls
    for name, (frame, cols) in sources.items():
        side = one_per_key(frame, keys, cols).withColumnsRenamed({c: f"{name}_{c}" for c in cols})
        out = out.join(side, list(keys), "left")
    return out


def catalogue_frequency(calls: DataFrame, catalogue: DataFrame, missing: str = "NO_MGRB",
                        other: str = "OTHER_VARS_ONLY") -> DataFrame:
    """JON-3: frequency text of the same base at the coordinate, else a marker.

    ``calls`` and ``catalogue`` carry ``chrom, pos, alt``; the catalogue also ``freq``.
    """
    same = catalogue.groupBy("chrom", "pos", "alt").agg(F.max("freq").alias("_freq"))
    sites = catalogue.select("chrom", "pos", F.lit(True).alias("_site")).distinct()
    return (
        calls.join(same, ["chrom", "pos", "alt"], "left").join(sites, ["chrom", "pos"], "left")
        .withColumn("population", F.when(F.col("_freq").isNotNull(), F.col("_freq").cast("string"))
                    .when(F.col("_site"), other).otherwise(missing))
        .drop("_freq", "_site")
    )


def annotate_position(calls: DataFrame, matrix: DataFrame, cols: Sequence[str]) -> DataFrame:
    """JON-4: join on chromosome and position alone."""
    return calls.join(one_per_key(matrix, ["chrom", "pos"], cols), ["chrom", "pos"], "left")


def passed_calls(calls: DataFrame, results: DataFrame, filter_name: str, runs: Sequence[int] | None = None,
                 chrom: str | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """JON-5: calls whose named filter passed, optionally of some runs and in one region."""
    out = calls
    if runs is not None:
        out = out.where(F.col("run_id").isin(*runs))
    if chrom is not None:
        out = out.where(F.col("chrom") == chrom)
    if start is not None:
        out = out.where(F.col("start") >= start)
    if end is not None:
        out = out.where(F.col("start") <= end)
    passed = results.where((F.col("filter_name") == filter_name) & (F.col("filterpass") == 1))
    return out.join(passed.select("id"), "id", "left_semi")


def any_filter_passed(calls: DataFrame, results: DataFrame, filters: Sequence[str]) -> DataFrame:
    """JON-6: calls that pass at least one of the primary filters."""
    passed = results.where(F.col("filter_name").isin(*filters) & (F.col("filterpass") == 1))
    return calls.join(passed.select("id"), "id", "left_semi")


def gene_variants(genes: DataFrame, exons: DataFrame, variants: DataFrame, runs: DataFrame,
                  margin: int = 10) -> DataFrame:
    """JON-7: variants of production runs in the exons of listed genes, with their samples.

    Each variant counts once per gene however many exon windows of the gene it lies in.
    """
    wanted = exons.join(genes.select("gene").distinct(), "gene", "left_semi").select("chrom", "start", "end", "gene")
    production = variants.join(runs.where(F.col("production") == 1).select("run_id", "sample"), ["run_id", "sample"],
                               "left_semi")
    loci = production.select("chrom", "start", "end").distinct()
    hits = locus_pairs(loci, widen(wanted, margin)).select("chrom", "start", "end", "gene").distinct()
    return (
        production.join(hits, ["chrom", "start", "end"])
        .groupBy("var_type", "gene", "chrom", "start", "bases")
        .agg(F.collect_set("sample").alias("_s"))
        .withColumn("n", F.size("_s").cast("bigint")).withColumn("samples", F.array_join(F.array_sort("_s"), ",")).drop("_s")
    )


def merge_reports(a: DataFrame, b: DataFrame, names: tuple[str, str], cols: Sequence[str],
                  keys: Sequence[str] = VARIANT) -> DataFrame:
    """JON-8: full outer join of two callers' reports; unequal values show as ``a:b``."""
    left = one_per_key(a, keys, cols).withColumnsRenamed({c: f"_a_{c}" for c in cols}).withColumn("_a", F.lit(1))
    right = one_per_key(b, keys, cols).withColumnsRenamed({c: f"_b_{c}" for c in cols}).withColumn("_b", F.lit(1))
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()

    def value(c: str) -> Column:
        x, y = F.col(f"_a_{c}").cast("string"), F.col(f"_b_{c}").cast("string")
        return F.when(both & ~x.eqNullSafe(y), F.concat_ws(":", x, y)).otherwise(F.coalesce(x, y)).alias(c)

    return left.join(right, list(keys), "full_outer").select(
        *keys,
        F.when(both, F.lit("_".join(names))).when(F.col("_a").isNotNull(), names[0]).otherwise(names[1]).alias("algorithms"),
        *[value(c) for c in cols],
    )


def master_over_supplement(master: DataFrame, supplement: DataFrame,
                           keys: Sequence[str] = ("chrom", "start", "end")) -> DataFrame:
    """JON-9: all master rows, and supplement rows only where the master has none."""
    extra = supplement.join(master.select(*keys).distinct(), list(keys), "left_anti")
    return master.unionByName(extra)


def ranked_fallback(mapped: DataFrame, unmapped: DataFrame, entry: str = "entry", order: str = "line_no",
                    preferred: str = r"CCDS\d+$") -> DataFrame:
    """JON-10: per coordinate the first preferred mapped entry, else the first mapped, else the first unmapped."""
    tagged = mapped.select("chrom", "pos", entry, order, F.lit("mapped").alias("source"),
                           F.when(F.col(entry).rlike(preferred), 0).otherwise(1).alias("_rank")).unionByName(
        unmapped.select("chrom", "pos", entry, order, F.lit("unmapped").alias("source"), F.lit(2).alias("_rank")))
    best = tagged.groupBy("chrom", "pos").agg(
        F.min(F.struct("_rank", order, entry, "source")).alias("_best"))
    return best.select("chrom", "pos", F.col(f"_best.{entry}").alias(entry), "_best.source")


def latest_run(runs: DataFrame, stamp: str = "run_stamp") -> DataFrame:
    """JON-11: newest run per sample, the larger id on a tie."""
    best = runs.groupBy("sample").agg(F.max(F.struct(stamp, "run_id")).alias("_b"))
    return best.select("sample", "_b.run_id", F.col(f"_b.{stamp}").alias(stamp))


def production_run(runs: DataFrame) -> DataFrame:
    """JON-11: the production run of each sample (the latest if several are marked)."""
    return latest_run(runs.where(F.col("production") == 1))


def marker_genotypes(markers: DataFrame, calls: DataFrame) -> DataFrame:
    """JON-12: genotype text of listed positions; 0/1, 1/1 and 0 are spelled out, the rest is ``NA``."""
    text = (
        F.when(F.col("gt") == "0/1", F.concat_ws("/", "ref", "alt"))
        .when(F.col("gt") == "1/1", F.concat_ws("/", "alt", "alt"))
        .when(F.col("gt") == "0", F.concat_ws("/", "ref", "ref"))
    )
    known = calls.select("chrom", "pos", text.alias("genotype")).groupBy("chrom", "pos").agg(
        F.max("genotype").alias("genotype"))
    return markers.join(known, ["chrom", "pos"], "left").withColumn("genotype", F.coalesce("genotype", F.lit("NA")))


def gene_dictionary(genes: DataFrame, lists: dict[str, tuple[DataFrame, str]],
                    via_homolog: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """JON-13: one column per gene list, joined on the upper-cased name, ``NO_<LIST>`` when absent.

    Lists in ``via_homolog`` are looked up by the gene's homolog name instead.
    """
    out = genes.withColumn("_name", clean_key(F.col("gene"))).withColumn("_homolog", clean_key(F.col("homolog")))
    for on, group in (("_name", lists), ("_homolog", via_homolog or {})):
        for name, (frame, col) in group.items():
            side = frame.groupBy(clean_key(F.col("gene")).alias(on)).agg(sorted_text(F.col(col)).alias(name))
            out = out.join(side, on, "left").withColumn(
                name, F.coalesce(F.col(name), F.lit("NO_" + name.upper())))
    return out.drop("_name", "_homolog")


def attach_depth(calls: DataFrame, depth: DataFrame) -> DataFrame:
    """JON-14: pileup depth of each call; a deletion is looked up one base before it, missing is 0."""
    site = F.when(F.col("var_type") == "DEL", F.col("start") - 1).otherwise(F.col("start"))
    per_site = depth.groupBy("chrom", F.col("pos").alias("_site")).agg(F.max("depth").alias("depth"))
    return (
        calls.drop("depth").withColumn("_site", site).join(per_site, ["chrom", "_site"], "left")
        .withColumn("depth", F.coalesce("depth", F.lit(0))).drop("_site")
    )


def filter_matrix(results: DataFrame, filters: Sequence[str], value: str = "filterpass",
                  absent: str = "nodata") -> DataFrame:
    """JON-15: one column per filter; the filter list is given, so no pass over the data finds it."""
    wide = results.groupBy("id").pivot("filter_name", list(filters)).agg(F.max(F.col(value).cast("string")))
    return wide.fillna(absent, subset=list(filters))
