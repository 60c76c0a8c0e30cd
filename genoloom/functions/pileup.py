"""Pileup base strings as arrays, with built-in array functions only.

An indel token ``+2AG`` carries its own length, which a regular expression cannot express, so
the string is cut in front of each sign and digit, and the token length is read from the digits
of its piece. The read character before a token belongs to the indel and is not counted again.
Arrays that are counted should be columns (see ``chunks.once``): an expression used inside a
lambda is worked out for every element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _pieces(cleaned: Column) -> Column:
    """Array of (indel, rest): the token opening the piece, if any, and the read characters after it.

    A read that carries an indel is shown as ``I``.
    """
    marked = F.regexp_replace(cleaned, "[^0-9](?=[+-][0-9])", "I")

    def cut(piece: Column) -> Column:
        digits = F.regexp_extract(piece, "^[+-]([0-9]+)", 1)
        token = F.when(digits != "", F.length(digits) + 1 + digits.cast("int")).otherwise(0)
        return F.struct(
            F.when(token > 0, F.substr(piece, F.lit(1), token)).alias("indel"),
            F.substr(piece, token + 1, F.length(piece)).alias("rest"),
        )

    return F.transform(F.split(marked, "(?=[+-][0-9])"), cut)


def _clean(bases: Column) -> Column:
    return F.upper(F.regexp_replace(bases, r"\^.", ""))


def tokens(bases: Column, indels: bool = True) -> Column:
    """Alleles seen by each read: bases, ``REF``, ``OTHER_DEL``, ``REFSKIP`` and, if asked, indel tokens."""
    def reads(p: Column) -> Column:
        marks = F.transform(
            F.regexp_extract_all(p["rest"], F.lit(r"([ACGTN.,*<>])"), F.lit(1)),
            lambda c: F.when(c.isin(".", ","), "REF").when(c == "*", "OTHER_DEL")
            .when(c.isin("<", ">"), "REFSKIP").otherwise(c))
        if not indels:
            return marks
        return F.concat(F.when(p["indel"].isNotNull(), F.array(p["indel"]))
                        .otherwise(F.array().cast("array<string>")), marks)

    return F.flatten(F.transform(_pieces(_clean(bases)), reads))


def base_tokens(bases: Column, ref: Column) -> Column:
    """Tokens of the single-base form: indels skipped, reference marks spelled as the reference base."""
    return F.transform(tokens(bases, indels=False), lambda t: F.when(t == "REF", F.upper(ref)).otherwise(t))


def tally(items: Column) -> Column:
    """(allele, n) structs of an array, commonest first, ties by name."""
    counted = F.transform(
        F.array_distinct(items),
        lambda a: F.struct((-F.size(F.filter(items, lambda x: x == a))).alias("neg"), a.alias("allele")))
    return F.transform(F.array_sort(counted), lambda s: F.struct(s["allele"].alias("allele"), (-s["neg"]).alias("n")))


def count_of(tallied: Column, allele: Column) -> Column:
    hit = F.filter(tallied, lambda s: s["allele"] == allele)
    return F.coalesce(F.get(hit, F.lit(0))["n"], F.lit(0))


def tag_reads(bases: Column, tags: Column) -> Column:
    """Molecular tags of the variant reads.

    Reads and tags run in step. A read with a base contributes its own tag; a read followed by
    an indel contributes the tag of the read after it (the rule being followed), and
    ``Indel_tag`` where there is none.
    """
    cleaned = F.upper(F.regexp_replace(bases, r"[\[\]$^]", ""))
    per_read = F.split(F.array_join(F.transform(_pieces(cleaned), lambda p: p["rest"]), ""), "")
    return F.filter(
        F.transform(
            F.arrays_zip(F.filter(per_read, lambda c: c != "").alias("c"), F.split(tags, ",").alias("own"),
                         F.slice(F.concat(F.split(tags, ","), F.array(F.lit(None).cast("string"))), 2, 1 << 30).alias("next")),
            lambda r: F.when(r["c"] == "I", F.coalesce(r["next"], F.lit("Indel_tag")))
            .when(r["c"].rlike("[ACGTN]"), F.coalesce(r["own"], F.lit("Indel_tag")))),
        lambda x: x.isNotNull())


def phred(quals: Column) -> Column:
    """Quality characters as integers."""
    chars = F.filter(F.split(quals, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.ascii(c) - 33)
