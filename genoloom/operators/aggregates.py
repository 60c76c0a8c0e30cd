"""Aggregations over calls and genotypes (AGG-*). Interval aggregates live with the intervals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.functions.stats import count_if, middle, ratio, sorted_text
from genoloom.functions.zygosity import NO_DATA, carries, genotype_class
from genoloom.operators.chunks import once, order_statistics, with_totals


def _field(sample: Column, fmt: Column, name: str) -> Column:
    """First comma value of a named FORMAT field of one sample, as a number."""
    at = F.array_position(F.split(fmt, ":"), name).cast("int")
    text = F.get(F.split(sample, ":"), at - 1)
    return F.substring_index(text, ",", 1).try_cast("bigint")


def _base_field(sample: Column, fmt: Column, base: Column) -> Column:
    out = F.lit(None).cast("bigint")
    for b in "ACGT":
        out = F.when(base == b, _field(sample, fmt, b + "U")).otherwise(out)
    return out


def sample_allele_fractions(calls: DataFrame) -> DataFrame:
    """AGG-1..4: mean and median sample allele frequency and the read-count text per allele.

    The layout is chosen per record: indel evidence counts (TIR/TAR/TOR), base counts
    (AU/CU/GU/TU) or allele depths in the second FORMAT field. Genotypes of a record sit in one
    array, so this is row-local work without a shuffle. Without genotypes the INFO frequency is
    used; having neither is an error.
    """
    fmt, ref, alt = F.col("format"), F.col("ref"), F.col("alt")

    def pair(v: Column, n: Column, use: Column) -> Column:
        return F.struct(v.cast("bigint").alias("v"), n.cast("bigint").alias("n"), use.alias("use"))

    def indel(s: Column) -> Column:
        v = _field(s, fmt, "TIR")
        n = v + _field(s, fmt, "TAR") + _field(s, fmt, "TOR")
        return pair(v, n, v > 0)

    def snv(s: Column) -> Column:
        v = _base_field(s, fmt, alt)
        return pair(v, v + _base_field(s, fmt, ref), v > 0)

    def depth(s: Column) -> Column:
        ads = F.transform(F.split(F.get(F.split(s, ":"), F.lit(1)), ","), lambda x: x.try_cast("bigint"))
        n = F.aggregate(ads, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))
        v = F.coalesce(F.get(ads, F.col("allele_no")), F.lit(0))
        return pair(v, n, v > 1)

    with_digit = F.filter("samples", lambda s: s.rlike(r"\d"))
    evidence = (
        F.when(fmt.contains(":TIR"), F.filter(F.transform(with_digit, indel), lambda p: p["n"] != 0))
        .when(fmt.contains(":AU"), F.filter(F.transform(with_digit, snv), lambda p: p["n"] != 0))
        .otherwise(F.transform(F.filter("samples", lambda s: s.contains(":")), depth))
    )
    fractions = F.array_sort(F.transform(F.filter("_ev", lambda p: p["use"]), lambda p: p["v"] / p["n"]))
    has_samples = F.size("samples") > 0
    mean = F.when(F.size("_af") > 0, F.aggregate("_af", F.lit(0.0), lambda a, x: a + x) / F.size("_af")).otherwise(0.0)
    fallback = F.coalesce("info_af", F.raise_error(F.concat(F.lit("no allele frequency at "), "chrom", F.lit(":"), "pos"))
                          .cast("double"))
    return (
        once(once(calls, _ev=evidence), _af=fractions)
        .withColumn("mean_af", F.when(has_samples, mean).otherwise(fallback))
        .withColumn("median_af", F.when(has_samples, F.coalesce(middle(F.col("_af")), F.lit(0.0))).otherwise(fallback))
        .withColumn("var_read_counts", F.when(has_samples, F.array_join(
            F.transform("_ev", lambda p: F.concat_ws("/", p["v"], p["n"])), ",")).otherwise("N/A"))
        .drop("_ev", "_af")
    )


def allele_counts(calls: DataFrame) -> DataFrame:
    """AGG-5: the allele's own count and the record's total count over the allele number."""
    return calls.withColumn("allele", F.concat_ws("/", F.col("total_ac"), F.col("an"))).withColumn(
        "ac", F.coalesce("ac", F.lit(0)))


def genotypes(calls: DataFrame, sample_names: Sequence[str] | None = None) -> DataFrame:
    """Long genotypes from the sample array: one row per allele and sample with its ``gt``."""
    names = F.array(*[F.lit(s) for s in sample_names]) if sample_names else None
    long = calls.select("*", F.posexplode("samples").alias("_i", "_text"))
    sample = F.get(names, F.col("_i")) if names is not None else F.concat(F.lit("s"), F.col("_i").cast("string"))
    return long.withColumn("sample", sample).withColumn("gt", F.substring_index("_text", ":", 1)).drop("_i", "_text")


def cohort_counts(geno: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-6: het, hom, ref, no-call and carrier counts per variant, with the carriers.

    ``geno`` holds ``gt`` and ``allele_no`` per sample, or a ready ``zyg``. A genotype of other
    alleles only is treated as reference without being counted. The carrier list is whole; it is
    distinct per sample, hence bounded by the cohort.
    """
    zyg = F.col("zyg") if "zyg" in geno.columns else genotype_class(F.col("gt"), F.col("allele_no"))
    g = geno.withColumn("_z", F.when(zyg == NO_DATA, "no_call").otherwise(zyg))
    var = F.col("_z").isin("het", "hom")
    out = g.groupBy(*keys).agg(
        count_if(F.col("_z") == "het").alias("het_count"), count_if(F.col("_z") == "hom").alias("hom_count"),
        count_if(F.col("_z") == "ref").alias("ref_count"), count_if(F.col("_z") == "no_call").alias("no_call_count"),
        count_if(var).alias("var_count"),
        F.array_sort(F.collect_set(F.when(var, F.col("sample")))).alias("_c"))
    return out.withColumn(
        "carriers", F.when(F.col("var_count") == 0, "N/A(NO_VAR_SAMPLES)")
        .otherwise(F.array_join("_c", ","))).drop("_c")


def group_counts(geno: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-7: the counts per sample group, and the group's share of all carriers in percent."""
    g = geno.join(groups.select("sample", "grp"), "sample")
    per = g.groupBy(*keys, "grp").agg(
        count_if(carries(F.col("zyg"))).alias("var_count"), count_if(F.col("zyg") == "het").alias("het_count"),
        count_if(F.col("zyg") == "hom").alias("hom_count"), count_if(F.col("zyg") == "ref").alias("ref_count"),
        count_if(F.col("zyg") == NO_DATA).alias("no_call_count"))
    total = with_totals(per, list(keys), _all=F.sum("var_count"))
    return total.withColumn("var_percent", ratio(F.col("var_count"), F.col("_all"), 100.0)).drop("_all")


def group_matrix(per_group: DataFrame, keys: Sequence[str], groups: Sequence[str]) -> DataFrame:
    """AGG-7 output form: one column of carrier counts per listed group, 0 when absent."""
    return per_group.groupBy(*keys).pivot("grp", list(groups)).agg(F.max("var_count")).fillna(0, subset=list(groups))


def cluster_versus_rest(geno: DataFrame, cluster: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-8: carriers inside and outside a cluster of samples, frequencies, difference, share."""
    marked = geno.join(cluster.select("sample", F.lit(1).alias("_in")).distinct(), "sample", "left").withColumn(
        "_in", F.coalesce("_in", F.lit(0)))
    sizes = geno.select("sample").distinct().join(cluster.select("sample", F.lit(1).alias("_in")).distinct(), "sample", "left")
    n_in, n_all = sizes.agg(F.count("_in")).scalar(), sizes.agg(F.count("*")).scalar()
    var = carries(F.col("zyg"))
    per = marked.groupBy(*keys).agg(
        count_if(var & (F.col("_in") == 1)).alias("cluster_var"), count_if(var & (F.col("_in") == 0)).alias("rest_var"))
    per = per.withColumn("cluster_size", n_in).withColumn("rest_size", n_all - n_in)
    return (
        per.where(F.col("cluster_var") + F.col("rest_var") > 0)
        .withColumn("cluster_freq", ratio(F.col("cluster_var"), F.col("cluster_size")))
        .withColumn("rest_freq", ratio(F.col("rest_var"), F.col("rest_size")))
        .withColumn("difference", F.col("cluster_freq") - F.col("rest_freq"))
        .withColumn("portion_cluster", F.col("cluster_var") / (F.col("cluster_var") + F.col("rest_var")))
    )


def median_by(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """AGG-11: exact median; an even count averages the middle pair."""
    n = F.col("n")
    got = order_statistics(df, keys, value, {"_a": F.floor((n + 1) / 2), "_b": F.floor(n / 2) + 1})
    return got.select(*keys, ((F.col("_a") + F.col("_b")) / 2).alias("median"))


def five_numbers(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """AGG-12: min, Q1, Q2, Q3, max with the halves rule; null for four or fewer values.

    The halves exclude the middle value of an odd count. For an even count the lower half
    also leaves out its own last value while the upper half keeps its first; that rule is kept.
    """
    n = F.col("n")
    even = n % 2 == 0
    half = F.floor(n / 2)
    low = F.when(even, half - 1).otherwise(half)
    up_start = F.when(even, half).otherwise(half + 1)
    up = n - up_start

    def mid(size: Column, first: Column) -> tuple[Column, Column]:
        return first + F.floor((size - 1) / 2) + 1, first + F.floor(size / 2) + 1

    zero = F.lit(0)
    ranks = {"_min": F.lit(1), "_max": n}
    for name, (size, first) in {"q1": (low, zero), "q2": (n, zero), "q3": (up, up_start)}.items():
        ranks[f"_{name}a"], ranks[f"_{name}b"] = mid(size, first)
    got = order_statistics(df, keys, value, ranks)

    def shown(c: Column) -> Column:
        return F.when(n > 4, c.cast("double"))

    return got.select(
        *keys, "n", shown(F.col("_min")).alias("min"),
        *[shown((F.col(f"_{q}a") + F.col(f"_{q}b")) / 2).alias(q) for q in ("q1", "q2", "q3")],
        shown(F.col("_max")).alias("max"))


PERCENTILES = (0.01, 0.05, 0.10, 0.16, 0.84, 0.90, 0.95, 0.99)


def describe(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """AGG-13: n, mean, median, mode (smallest of ties), standard deviation, range and percentiles.

    Percentiles interpolate between the two nearest values; all order statistics come from one
    selection among the counted distinct values.
    """
    c, n = F.col(value), F.col("n")
    points = {"median": 0.5, **{f"p{round(p * 100):02d}": p for p in PERCENTILES}}
    ranks = {}
    for name, p in points.items():
        at = (n - 1) * F.lit(p)
        ranks[f"_{name}a"], ranks[f"_{name}b"] = F.floor(at) + 1, F.ceil(at) + 1
    got = order_statistics(df, keys, value, ranks)

    def between(name: str, p: float) -> Column:
        lo, hi = F.col(f"_{name}a"), F.col(f"_{name}b")
        at = (n - 1) * F.lit(p)
        return (lo + (hi - lo) * (at - F.floor(at))).alias(name)

    placed = got.select(*keys, *[between(name, p) for name, p in points.items()])
    common = (
        df.where(c.isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
        .groupBy(*keys).agg(F.max_by(c, F.struct("_n", -c)).alias("mode")))
    plain = df.groupBy(*keys).agg(
        F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"),
        F.min(c).alias("min"), F.max(c).alias("max"))
    return plain.join(common, list(keys)).join(placed, list(keys))


def gene_burden(calls: DataFrame, aa_length: DataFrame, key: Sequence[str]) -> DataFrame:
    """AGG-14: distinct and total variants per gene, split by affection, and percent of coding bases."""
    per_variant = calls.groupBy("gene", *key).agg(
        F.count("*").alias("_n"), F.max("affected").alias("_a"), F.max(1 - F.col("affected")).alias("_u"))
    per = per_variant.groupBy("gene").agg(
        F.count("*").alias("distinct_variants"), F.sum("_n").alias("total_variants"),
        F.sum("_a").cast("bigint").alias("affected_variants"), F.sum("_u").cast("bigint").alias("unaffected_variants"))
    length = aa_length.groupBy("gene").agg(F.max("aa_length").alias("_len"))
    return per.join(length, "gene", "left").withColumn(
        "percent_coding", F.when(F.col("_len") > 0, F.col("distinct_variants") / (F.col("_len") * 3) * 100)).drop("_len")


def carrier_counts(calls: DataFrame, samples: DataFrame, keys: Sequence[str], geno: DataFrame | None = None) -> DataFrame:
    """AGG-15: affected and unaffected carriers and the sample list per variant.

    Pileup genotypes decide where they exist; a variant no pileup shows falls back on its calls
    and its list is marked.
    """
    def counted(rows: DataFrame, mark: str) -> DataFrame:
        lone = rows.select(*keys, "sample").distinct().join(samples.select("sample", "affected"), "sample")
        return lone.groupBy(*keys).agg(
            count_if(F.col("affected") == 1).alias(f"_{mark}a"), count_if(F.col("affected") == 0).alias(f"_{mark}u"),
            sorted_text(F.col("sample")).alias(f"_{mark}s"))

    called = counted(calls, "c")
    if geno is None:
        return called.withColumnsRenamed({"_ca": "affected_carriers", "_cu": "unaffected_carriers", "_cs": "samples"})
    seen = counted(geno.where(carries(F.col("zyg"))), "g")
    both = called.join(seen, list(keys), "left")
    return both.select(
        *keys, F.coalesce("_ga", F.lit(0)).alias("affected_carriers"),
        F.coalesce("_gu", F.lit(0)).alias("unaffected_carriers"),
        F.coalesce("_gs", F.concat(F.col("_cs"), F.lit(" (NOT IN PILEUP)"))).alias("samples"))


def variants_per_sample(geno: DataFrame, keys: Sequence[str], by: Sequence[str] = ("sample",)) -> DataFrame:
    """AGG-16."""
    return geno.where(carries(F.col("zyg"))).groupBy(*by).agg(F.count("*").alias("varcount"))


def value_counts(df: DataFrame, cols: Sequence[str], min_count: int = 1) -> DataFrame:
    """AGG-17: frequency of values; ``min_count=2`` lists duplicates."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def matrix_summary(cells: DataFrame, keys: Sequence[str], min_var: int = 1) -> DataFrame:
    """AGG-18: counts per coded cell matrix row (0 no call, 1 ref, 2 hom, 3 het) and two percentages.

    ``cells`` is long, with ``code``; rows with no more than ``min_var`` variant cells are dropped.
    """
    per = cells.groupBy(*keys).agg(
        F.count("*").alias("cells"), *[count_if(F.col("code") == v).alias(n) for v, n in
                                       ((0, "no_call"), (1, "ref"), (2, "hom"), (3, "het"))])
    var, called = F.col("het") + F.col("hom"), F.col("het") + F.col("hom") + F.col("ref")
    return per.where(var > min_var).withColumn("pct_with_data", ratio(called, F.col("cells"), 100.0)).withColumn(
        "pct_variant", ratio(var, called, 100.0)).drop("cells")


def matrix_summary_wide(matrix: DataFrame, codes: str = "codes", min_var: int = 1) -> DataFrame:
    """AGG-18 on an array column of codes: the same counts without a shuffle."""
    def n(v: int) -> Column:
        return F.size(F.filter(codes, lambda c: c == v)).cast("bigint")

    out = matrix.withColumns({"no_call": n(0), "ref": n(1), "hom": n(2), "het": n(3)})
    var, called = F.col("het") + F.col("hom"), F.col("het") + F.col("hom") + F.col("ref")
    return out.where(var > min_var).withColumn("pct_with_data", ratio(called, F.size(codes), 100.0)).withColumn(
        "pct_variant", ratio(var, called, 100.0)).drop(codes)


def significance_counts(df: DataFrame, keys: Sequence[str], p: str, effect: str, alpha: float = 0.05) -> DataFrame:
    """AGG-20."""
    sig = F.col(p) < alpha
    return df.groupBy(*keys).agg(
        count_if(sig).alias("total"), count_if(sig & (F.col(effect) > 0)).alias("up"),
        count_if(sig & (F.col(effect) < 0)).alias("down"))


def cohort_variants(calls: DataFrame, coord: Sequence[str] = ("chrom", "start", "end", "bases")) -> DataFrame:
    """AGG-21: each distinct variant with the samples that have it."""
    return calls.groupBy(*coord).agg(F.collect_set("sample").alias("_s")).select(
        *coord, F.array_join(F.array_sort("_s"), ",").alias("samples"), F.size("_s").cast("bigint").alias("n_samples"))


def samples_by_type(samples: DataFrame, kind: str) -> DataFrame:
    """AGG-22."""
    return samples.groupBy(kind).agg(F.count_distinct("sample").alias("n"), sorted_text(F.col("sample")).alias("samples"))


def allele_dropout(geno: DataFrame, control: str, keys: Sequence[str]) -> DataFrame:
    """AGG-23: share of a sample's hom or ref calls at which the control is het, in percent."""
    het = geno.where((F.col("sample") == control) & (F.col("zyg") == "het")).select(
        *keys, F.lit(1).alias("_het")).distinct()
    rest = geno.where((F.col("sample") != control) & F.col("zyg").isin("hom", "ref"))
    per = rest.join(het, list(keys), "left").groupBy("sample").agg(
        F.count("*").alias("hom_ref"), F.count("_het").alias("control_het"))
    return per.withColumn("dropout_percent", F.col("control_het") / F.col("hom_ref") * 100)
