"""Zygosity rules and the allele pairs they imply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_DATA = "No data"


def genotype_class(gt: Column, allele: Column) -> Column:
    """ref / het / hom / no_call of one alternate allele; ``other`` is a call of other alleles only."""
    parts = F.split(gt, r"[/|]")
    a, b = parts[0], F.get(parts, F.lit(1))
    idx = allele.cast("string")
    return (
        F.when((a == "0") & (b == "0"), "ref")
        .when((a == ".") & (b == "."), "no_call")
        .when((a == b) & (a == idx), "hom")
        .when((a != b) & ((a == idx) | (b == idx)), "het")
        .otherwise("other")
    )


def from_fraction(var_reads: Column, total_reads: Column) -> Column:
    """Zygosity without a genotype field: below 0.02 ref, below 0.75 het, else hom."""
    af = F.when(total_reads > 0, var_reads / total_reads).otherwise(F.lit(0.0))
    return F.when(af < 0.02, "ref").when(af < 0.75, "het").otherwise("hom")


def from_call_fractions(ref_freq: Column, first: Column, second: Column) -> Column:
    """Zygosity from the reference and the two commonest alternate fractions (second may be null)."""
    with_ref = (ref_freq + first >= 0.8) & (ref_freq >= 0.3) & (first >= 0.3)
    with_alt = F.coalesce((first + second >= 0.8) & (second >= 0.3) & (first >= 0.3), F.lit(False))
    return F.when(first >= 0.8, "hom").when(with_ref | with_alt, "het").otherwise("other")


def from_indel_fraction(freq: Column) -> Column:
    return F.when(freq > 0.8, "hom").when(freq > 0.3, "het").otherwise("other")


def from_top_allele(any_alt: Column, is_ref: Column) -> Column:
    """hom when some non-reference allele reaches 90 %, ref when the reference does, else het."""
    return F.when(any_alt, "hom").when(is_ref, "ref").otherwise("het")


def allele_pair(zyg: Column, alleles: Column) -> Column:
    """Two alleles of a genotype; ``alleles`` is the pileup string ``A:12_ref:3`` (most common first).

    The reference allele comes first for a het; a het with one allele only is unknown.
    """
    blocks = F.split(alleles, "_(?!del)")
    first = F.substring_index(blocks[0], ":", 1)
    second = F.substring_index(F.get(blocks, F.lit(1)), ":", 1)

    def pair(a: Column, b: Column) -> Column:
        return F.struct(a.alias("first"), b.alias("second"))

    unknown, ref = F.lit("?"), F.lit("ref")
    return (
        F.when(zyg == NO_DATA, pair(unknown, unknown))
        .when(zyg == "ref", pair(ref, ref))
        .when(zyg == "hom", pair(first, first))
        .when(second.isNull(), pair(unknown, unknown))
        .when(F.lower(second).contains("ref"), pair(second, first))
        .otherwise(pair(first, second))
    )


def carries(zyg: Column) -> Column:
    return ~zyg.isin("ref", NO_DATA)
