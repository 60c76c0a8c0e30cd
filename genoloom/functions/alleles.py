"""Variant keys from REF/ALT pairs, in the two coordinate conventions the inputs use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from genoloom.functions.sequence import revcomp


def _key(start: Column, end: Column, bases: Column, kind: Column, ref_base: Column) -> Column:
    return F.struct(
        start.cast("bigint").alias("start"),
        end.cast("bigint").alias("end"),
        bases.alias("bases"),
        kind.alias("var_type"),
        ref_base.alias("ref_base"),
    )


def first_difference(ref: Column, alt: Column) -> Column:
    """1-based index of the first unequal base of two equally long strings; 1 for other pairs."""
    at = F.filter(
        F.sequence(F.lit(1), F.length(ref)),
        lambda i: F.substr(ref, i, F.lit(1)) != F.substr(alt, i, F.lit(1)),
    )
    search = (F.length(ref) == F.length(alt)) & (F.substr(ref, F.lit(1), F.lit(1)) == F.substr(alt, F.lit(1), F.lit(1)))
    return F.when(search, F.try_element_at(at, F.lit(1))).otherwise(1)


def vcf_key(pos: Column, ref: Column, alt: Column, diff: Column | None = None) -> Column:
    """Key struct for anchored VCF alleles.

    A deletion starts after the anchor base, an insertion sits on it, and a substitution of
    several bases becomes a single-base change at its first unequal base (``diff``, if the
    caller has it as a column already).
    """
    shrink = F.length(ref) - F.length(alt)
    diff = first_difference(ref, alt) if diff is None else diff
    return (
        F.when(
            shrink > 0,
            _key(pos + 1, pos + shrink, F.concat(F.lit("-"), F.substr(ref, F.lit(2), shrink)),
                 F.lit("DEL"), F.lit("N/A")),
        )
        .when(
            shrink < 0,
            _key(pos, pos, F.concat(F.lit("+"), F.substr(alt, F.lit(2), -shrink)),
                 F.lit("INS"), F.substr(alt, F.lit(1), F.lit(1))),
        )
        .otherwise(
            _key(
                pos + diff - 1,
                pos + diff - 1,
                F.concat(F.substr(ref, diff, F.lit(1)), F.lit("->"), F.substr(alt, diff, F.lit(1))),
                F.lit("SNV"),
                F.lit("N/A"),
            )
        )
    )


def dashed_key(pos: Column, ref: Column, alt: Column) -> Column:
    """Key struct for predictor alleles, where ``-`` stands for no base. Null if not classifiable."""
    plain_ref = F.when(ref == "-", F.lit("")).otherwise(ref)
    plain_alt = F.when(alt == "-", F.lit("")).otherwise(alt)
    grow = F.length(plain_alt) - F.length(plain_ref)
    insertion = (ref == "-") | (F.length(ref) < F.length(alt))
    deletion = (alt == "-") | (F.length(ref) > F.length(alt))
    return (
        F.when(
            insertion,
            _key(pos - 1, pos - 1, F.concat(F.lit("+"), F.substr(alt, F.lit(1), grow)),
                 F.lit("INS"), F.lit("N/A")),
        )
        .when(
            deletion,
            _key(pos, pos - grow - 1, F.concat(F.lit("-"), F.substr(ref, F.lit(1), -grow)),
                 F.lit("DEL"), F.lit("N/A")),
        )
        .when(
            (F.length(ref) == 1) & (F.length(alt) == 1),
            _key(pos, pos, F.concat(ref, F.lit("->"), alt), F.lit("SNV"), F.lit("N/A")),
        )
    )


def catalogue_key(pos: Column, ref: Column, alt: Column) -> Column:
    """``vcf_key`` for population catalogues; null for a substitution beyond the first base.

    A multi-base substitution counts as an SNV only when the bases after the first agree as
    text, which is the evident intent of the rule.
    """
    complex_change = (F.length(ref) == F.length(alt)) & (
        F.substr(ref, F.lit(2), F.length(ref)) != F.substr(alt, F.lit(2), F.length(alt))
    )
    return F.when(~complex_change, vcf_key(pos, ref, alt, F.lit(1)))


def key_text(chrom: Column, start: Column, end: Column, bases: Column) -> Column:
    return F.concat(chrom, F.lit(":"), start.cast("string"), F.lit("-"), end.cast("string"), F.lit(":"), bases)


def reconcile_locus(start: Column, end: Column, strand: Column, ref: Column, observed: Column) -> Column:
    """Array of (start, end, var_type, ref, alt) rows for one dbSNP-style record.

    ``start`` is 0-based, ``observed`` is a slash list on ``strand``. Shared prefixes of
    insertions and deletions are trimmed and equal-length changes split into single bases.
    """
    alts = F.transform(
        F.split(observed, "/"), lambda a: F.when(strand == "-", revcomp(a)).otherwise(a)
    )
    wanted = F.filter(alts, lambda a: a != ref)

    def change(s: Column, e: Column, kind: str, r: Column, a: Column, seen: Column) -> Column:
        return F.struct(
            s.cast("bigint").alias("start"), e.cast("bigint").alias("end"), F.lit(kind).alias("var_type"),
            r.alias("ref"), a.alias("alt"), seen.alias("seen"),
        )

    def one(a: Column) -> Column:
        single = a.rlike("^[ACGT]$") & ref.rlike("^[ACGT]$")
        wide = start != end
        cut_ref, cut_alt = F.length(a), F.length(ref)
        return (
            F.when(single, F.array(change(end, end, "SNV", ref, a, a)))
            .when(ref == "-", F.when(a != "-", F.array(change(start, end, "INS", F.lit("-"), a, a))))
            .when(a == "-", F.when(wide, F.array(change(start + 1, end, "DEL", ref, F.lit("-"), a))))
            .when(
                (F.length(a) < F.length(ref)) & F.startswith(ref, a),
                F.when(wide, F.array(change(start + cut_ref + 1, end, "DEL",
                                            F.substr(ref, cut_ref + 1, F.length(ref)), F.lit("-"), a))),
            )
            .when(
                (F.length(a) > F.length(ref)) & F.startswith(a, ref),
                F.array(change(start + cut_alt, start + cut_alt, "INS", F.lit("-"),
                               F.substr(a, cut_alt + 1, F.length(a)), a)),
            )
            .when(
                (F.length(a) == F.length(ref)) & wide,
                F.transform(
                    F.filter(
                        F.sequence(F.lit(1), F.length(ref)),
                        lambda i: (F.substr(ref, i, F.lit(1)) != F.substr(a, i, F.lit(1))) & (start + i <= end),
                    ),
                    lambda i: change(start + i, start + i, "SNV", F.substr(ref, i, F.lit(1)),
                                     F.substr(a, i, F.lit(1)), F.substr(a, i, F.lit(1))),
                ),
            )
        )

    return F.flatten(F.filter(F.transform(wanted, one), lambda rows: rows.isNotNull()))
