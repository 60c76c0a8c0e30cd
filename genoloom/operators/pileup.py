"""Pileup summaries (PIL-*). One pileup row holds one locus, so nearly all of this is row-local."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.functions import pileup as pl
from genoloom.functions import zygosity as zg
from genoloom.functions.stats import middle
from genoloom.operators.chunks import once


def tokenise(df: DataFrame, indels: bool = True) -> DataFrame:
    """PIL-1: ``tokens`` array of the alleles seen by each read."""
    expr = pl.tokens(F.col("bases")) if indels else pl.base_tokens(F.col("bases"), F.col("ref"))
    return once(df, tokens=expr)


def base_frequencies(df: DataFrame, indels: bool = False) -> DataFrame:
    """PIL-2: one row per locus and allele with count and frequency; a locus without bases is N, 0."""
    cols = [c for c in df.columns if c not in ("bases", "quals", "tags")]
    counted = once(tokenise(df, indels), _t=pl.tally(F.col("tokens")), _n=F.size("tokens"))
    none = F.array(F.struct(F.lit("N").alias("allele"), F.lit(0).alias("n")))
    return counted.select(*cols, "_n", F.explode(F.when(F.size("_t") > 0, F.col("_t")).otherwise(none)).alias("_a")).select(
        *cols, F.col("_a.allele").alias("allele"), F.col("_a.n").alias("n"),
        F.when(F.col("_n") > 0, F.col("_a.n") / F.col("_n")).otherwise(0.0).alias("frequency"))


def allele_table(df: DataFrame) -> DataFrame:
    """PIL-3: zygosity, highest alternate frequency and reads, and the frequency text per locus.

    Base frequencies are over the counted bases, indel frequencies over the depth. Loci of
    depth 0 are dropped; skipped-reference reads never count as the highest alternate.
    """
    ref, depth = F.upper("ref"), F.col("depth")

    def reads(items: Column) -> Column:
        return F.aggregate(items, F.lit(0), lambda a, s: a + s["n"])

    def freq_row(name: Column, f: Column) -> Column:
        return F.struct((-f).alias("neg"), name.alias("name"))

    # One tally of all tokens; the single-base form is the part of it that holds no indel.
    read = once(df.where(depth > 0), _tokens=pl.tokens(F.col("bases")))
    counted = once(read, _all=pl.tally(F.col("_tokens")))
    parted = once(
        counted, _ind=F.filter("_all", lambda s: s["allele"].rlike("^[+-]")),
        _alt=F.filter("_all", lambda s: ~s["allele"].rlike("^[+-]") & ~s["allele"].isin(F.lit("REF"), ref)),
        _ref=reads(F.filter("_all", lambda s: s["allele"].isin(F.lit("REF"), ref))))
    n_base = F.col("_ref") + reads(F.col("_alt"))
    ref_f = F.array(freq_row(F.concat(ref, F.lit("(ref)")), F.when(n_base > 0, F.col("_ref") / n_base).otherwise(0.0)))
    shares = once(
        parted.withColumn("_n", n_base), _rows=F.concat(
            ref_f, F.transform("_alt", lambda s: freq_row(s["allele"], s["n"] / F.col("_n"))),
            F.transform("_ind", lambda s: freq_row(s["allele"], F.round(s["n"] / depth, 4)))))
    best = F.array_max(F.transform(
        F.filter(F.slice("_rows", 2, 1 << 30), lambda s: s["name"] != "REFSKIP"), lambda s: -s["neg"]))
    text = F.array_join(F.transform(F.array_sort("_rows"), lambda s: F.concat(
        s["name"], F.lit(":"), F.format_string("%.5f", -s["neg"]))), ";")
    return once(
        shares,
        zyg=F.when(F.col("_ref") == 0, "hom").when((F.size("_alt") > 0) | (F.size("_ind") > 0), "het").otherwise("ref"),
        max_alt_freq=F.coalesce(best, F.lit(0.0)),
        frequencies=text,
    ).withColumn(
        "max_alt_reads", F.when(F.col("max_alt_freq") > 0, F.floor(depth * F.col("max_alt_freq") + 1e-9))
        .otherwise(1).cast("bigint")).drop("_tokens", "_all", "_ind", "_alt", "_ref", "_n", "_rows")


def tag_counts(df: DataFrame) -> DataFrame:
    """PIL-4: variant reads with a molecular tag, distinct tags, and ``tag(variant/all)`` text."""
    picked, all_tags = F.col("_p"), F.col("_all")

    def n(items: Column, t: Column) -> Column:
        return F.size(F.filter(items, lambda x: x == t))

    text = F.array_join(F.transform(
        F.array_sort(F.array_distinct(picked)),
        lambda t: F.concat(t, F.lit("("), n(picked, t).cast("string"), F.lit("/"),
                           F.when(t == "Indel_tag", F.lit("1")).otherwise(n(all_tags, t).cast("string")), F.lit(")"))), ":")
    tagged = once(df, _p=pl.tag_reads(F.col("bases"), F.col("tags")), _all=F.split("tags", ","))
    return tagged.withColumn("variant_tags", F.size("_p")).withColumn(
        "distinct_tags", F.size(F.array_distinct("_p"))).withColumn("tag_text", text).drop("_p", "_all")


def pileup_zygosity(df: DataFrame) -> DataFrame:
    """PIL-5: allele text ``A:12_ref:3`` by count, and zygosity from the 90 % rule."""
    named = F.transform(
        F.filter(pl.tokens(F.col("bases")), lambda t: t != "REFSKIP"),
        lambda t: F.when(t == "REF", "ref").when(t == "OTHER_DEL", "other_del").otherwise(t))
    share = F.size("_n") * 0.9
    top = F.exists("_t", lambda s: (s["allele"] != "ref") & (s["n"] >= share))
    is_ref = pl.count_of(F.col("_t"), F.lit("ref")) >= share
    read = once(once(df, _n=named), _t=pl.tally(F.col("_n")))
    return (
        read.withColumn("zyg", F.when(F.size("_n") == 0, "het").otherwise(zg.from_top_allele(top, is_ref)))
        .withColumn("alleles", F.array_join(F.transform(
            "_t", lambda s: F.concat_ws(":", s["allele"], s["n"].cast("string"))), "_"))
        .drop("_n", "_t")
    )


def call_zygosity(df: DataFrame) -> DataFrame:
    """PIL-6: commonest and next alternate base with fractions of the depth, and zygosity.

    Loci without an alternate base, and loci on an N reference, are not variants and are dropped.
    """
    ref = F.upper("ref")
    alts = F.filter("_t", lambda s: s["allele"] != ref)

    def frac(n: Column) -> Column:
        return F.round(n / F.col("depth"), 3)

    first, second = F.get("_alts", F.lit(0)), F.get("_alts", F.lit(1))
    real = F.filter(pl.base_tokens(F.col("bases"), F.col("ref")), lambda t: ~t.isin("OTHER_DEL", "REFSKIP"))
    read = once(df.where((ref != "N") & (ref != "*") & (F.col("depth") > 0)), _r=real)
    alleles = once(once(read, _t=pl.tally(F.col("_r"))), _alts=alts).where(F.size("_alts") > 0)
    return (
        alleles.withColumn("ref_freq", frac(pl.count_of(F.col("_t"), ref)))
        .withColumn("var_base", first["allele"]).withColumn("var_freq", frac(first["n"]))
        .withColumn("next_base", second["allele"]).withColumn("next_freq", frac(second["n"]))
        .withColumn("zyg", zg.from_call_fractions(F.col("ref_freq"), F.col("var_freq"), F.col("next_freq")))
        .drop("_r", "_t", "_alts")
    )


def indel_evidence(df: DataFrame) -> DataFrame:
    """PIL-7: reads with the called indel token, reference marks less those, fractions and zygosity.

    ``var_type`` and ``indel_bases`` (without sign) give the token to count.
    """
    sign = F.when(F.col("var_type") == "DEL", "-").otherwise("+")
    token = F.upper(F.concat(sign, F.length("indel_bases").cast("string"), F.col("indel_bases")))
    text = F.upper("bases")
    hits = ((F.length(text) - F.length(F.replace(text, token, F.lit("")))) / F.length(token)).cast("bigint")
    marks = F.length("bases") - F.length(F.translate("bases", ".,", ""))
    return (
        df.withColumn("var_reads", hits).withColumn("ref_reads", marks - F.col("var_reads"))
        .withColumn("var_freq", F.when(F.col("depth") > 0, F.col("var_reads") / F.col("depth")).otherwise(0.0))
        .withColumn("ref_freq", F.when(F.col("depth") > 0, F.col("ref_reads") / F.col("depth")).otherwise(0.0))
        .withColumn("zyg", zg.from_indel_fraction(F.round("var_freq", 3)))
    )


def fraction_zygosity(df: DataFrame, var_reads: str = "alt_reads", total: str = "depth") -> DataFrame:
    """PIL-8."""
    return df.withColumn("zyg", zg.from_fraction(F.col(var_reads), F.col(total)))


def base_quality(df: DataFrame) -> DataFrame:
    """PIL-9: median base quality and the decoded list."""
    return once(df, _q=pl.phred(F.col("quals"))).withColumn("median_quality", middle(F.array_sort("_q"))).withColumn(
        "quality_list", F.array_join(F.transform("_q", lambda x: x.cast("string")), ":")).drop("_q")


def quality_encoding(reads: DataFrame, by: Sequence[str] = (), quals: str = "quals") -> DataFrame:
    """PIL-10: phred33 if any quality code lies in (33, 64), else phred64.

    The reported rule looks at the first reads of a file; a distributed table has no first
    reads, so the check is a minimum and exists-aggregate over all, which combines map-side.
    """
    codes = F.transform(F.filter(F.split(F.col(quals), ""), lambda c: c != ""), lambda c: F.ascii(c))
    low = F.exists(codes, lambda c: (c > 33) & (c < 64))
    return reads.groupBy(*by).agg(F.max(low.cast("int")).alias("_low")).select(
        *by, F.when(F.col("_low") == 1, "phred33").otherwise("phred64").alias("encoding"))


def tumour_normal(tumour: DataFrame, normal: DataFrame) -> DataFrame:
    """PIL-11: reference and variant counts and other alleles in the tumour, all alleles in the normal.

    ``tumour`` carries ``ref`` and ``alt`` of the call; both carry ``chrom, pos, bases``.
    """
    def text(items: Column) -> Column:
        return F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["allele"], s["n"].cast("string"))), "_")

    def counted(df: DataFrame) -> DataFrame:
        return once(once(df, _r=pl.base_tokens(F.col("bases"), F.col("ref"))), _t=pl.tally(F.col("_r")))

    left = counted(tumour).select(
        "chrom", "pos", "ref", "alt", pl.count_of(F.col("_t"), F.upper("ref")).alias("ref_count"),
        pl.count_of(F.col("_t"), F.upper("alt")).alias("var_count"),
        text(F.filter("_t", lambda s: ~s["allele"].isin(F.upper("ref"), F.upper("alt")))).alias("tumour_other_alleles"))
    right = counted(normal).select("chrom", "pos", text(F.col("_t")).alias("normal_alleles"))
    return left.join(right, ["chrom", "pos"], "left")
