"""Text conventions of the inputs: chromosome names, attribute strings, packed lists, sentinels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIST_MARK = "^^^"


def norm_chrom(c: Column) -> Column:
    """Drop a ``chr`` prefix and call the mitochondrion ``M``."""
    bare = F.regexp_replace(c, "(?i)^chr", "")
    return F.when(bare == "MT", F.lit("M")).otherwise(bare)


def chrom_rank(c: Column) -> Column:
    """Sort rank 1..22, X = 23, Y = 24; other names sort last."""
    bare = norm_chrom(c)
    return (
        F.when(bare == "X", F.lit(23))
        .when(bare == "Y", F.lit(24))
        .otherwise(F.coalesce(bare.try_cast("int"), F.lit(99)))
    )


def attr_map(c: Column, pair: str = ";", kv: str = "=") -> Column:
    """``k=v;k=v`` as a map. A key without value maps to null; a repeated key keeps its last value."""
    entries = F.filter(F.split(c, pair), lambda e: F.length(e) > 0)
    parsed = F.transform(
        entries,
        lambda e: F.struct(
            F.substring_index(e, kv, 1).alias("key"),
            F.when(F.instr(e, kv) > 0, F.substr(e, F.instr(e, kv) + F.lit(1))).alias("value"),
        ),
    )

    def last_values(p: Column) -> Column:
        keys = F.array_distinct(F.transform(p, lambda e: e["key"]))
        return F.map_from_arrays(
            keys, F.transform(keys, lambda k: F.element_at(F.filter(p, lambda e: e["key"] == k), -1)["value"]))

    # The lambda of a one-item array holds the parsed entries, so the text is split once and not for every key.
    return F.get(F.transform(F.array(parsed), last_values), F.lit(0))


def attr(c: Column, name: str) -> Column:
    """One value out of an attribute string, null when absent or empty."""
    got = F.regexp_extract(c, rf"(?:^|;){name}=([^;]+)", 1)
    return F.when(got != "", got)


def unpack(c: Column) -> Column:
    """``a^^^b^^^c`` as an array."""
    return F.split(c, r"\^\^\^")


def pack(*cols: Column) -> Column:
    return F.concat_ws(LIST_MARK, *cols)


def joined(c: Column, sep: str = ",") -> Column:
    """An array as sorted text, so results do not depend on arrival order."""
    return F.array_join(F.array_sort(c), sep)


def matched(c: Column, pattern: str, group: int = 1) -> Column:
    """Regex group, null (not empty text) when the pattern does not occur."""
    got = F.regexp_extract(c, pattern, group)
    return F.when(c.rlike(pattern), got)


def safe_name(name: str) -> str:
    """Column name usable as a store key: percent sign, brackets, blanks and slash replaced."""
    if name.startswith("%"):
        name = "percent" + name[1:]
    return name.replace("(", "_").replace(")", "_").replace(" ", "").replace("/", "_of_", 1)


def sentinel(c: Column, mark: str) -> Column:
    """Null, empty or ``N/A`` text shown as the report's own marker."""
    return F.when(c.isNull() | (c == "") | (c == "N/A"), F.lit(mark)).otherwise(c)
