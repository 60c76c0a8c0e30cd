"""Helpers shared by the text operators."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoloom.session import settle

# Fixed values of the word and line rules: ASCII white space, and the letters that are lower-cased.
WHITE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x20\\x09-\\x0D]+"

__all__ = ["LOWER", "UPPER", "WHITE", "WORD", "ascii_lower", "distinct_name", "may_hold", "orderable", "quoted", "settle", "ship", "whole"]


TEXT_BATCH = "1000"  # rows of a batch of texts that a Python worker gets, unless the session says otherwise


def ship(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package wherever they start, and give
    them texts in smaller batches than Spark's 10,000 rows, which bounds their memory.

    On a cluster the package is installed or sent with ``--py-files``, as for any other library.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_BATCH)
    sc = spark.sparkContext
    package = str(Path(__file__).resolve().parent.parent)
    if sc.master.startswith("local[") and not any(f.endswith("/genoloom") for f in sc.listFiles):
        sc.addFile(package, recursive=True)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(text, UPPER, LOWER)


def whole(text: str | Column) -> Column:
    """The text, a null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def distinct_name(df: DataFrame, stem: str) -> str:
    """A helper column name that no column of the frame has."""
    return f"_{stem}_{uuid.uuid4().hex[:8]}" if f"_{stem}" in map(str.lower, df.columns) else f"_{stem}"


def quoted(names: Iterable[str]) -> list[str]:
    """Column names as Spark takes them literally, dots and all."""
    return ["`" + n.replace("`", "``") + "`" for n in names]


def orderable(df: DataFrame) -> list[str]:
    """Quoted names of the columns that have an order: none that is, or holds, a map or a variant."""
    return quoted(n for n, kind in df.dtypes if not re.search(r"\b(map<|variant\b)", kind))


CELLS = 1 << 27  # of a membership filter: 16 MB of bitmaps at most, whatever the number of keys


def is_set(bits: Column, place: Column) -> Column:
    """Whether a bitmap built by ``bitmap_construct_agg`` has the place; false where there is none."""
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))


def may_hold(rows: DataFrame, keys: DataFrame, name: str, key: str = "tkey") -> DataFrame:
    """Add boolean ``name``: false only where the row's ``key`` (a 64-bit hash) is not among ``keys``.

    The keys become a filter of ``CELLS`` cells at most, which is broadcast, so that rows that cannot
    match are told apart without a shuffle. A full filter only lets more rows through.
    """
    def cell(c: Column) -> Column:
        return F.pmod(c, F.lit(CELLS))

    bitmaps = settle(keys.select(cell(F.col(key)).alias("c")).groupBy(F.shiftright("c", 15).alias("_bitmap")).agg(
        F.bitmap_construct_agg(F.col("c").bitwiseAND(F.lit((1 << 15) - 1))).alias("_bits")))
    joined = rows.join(F.broadcast(bitmaps), F.shiftright(cell(F.col(key)), 15) == F.col("_bitmap"), "left")
    place = cell(F.col(key)).bitwiseAND(F.lit((1 << 15) - 1))
    return joined.select(*quoted(rows.columns), is_set(F.col("_bits"), place).alias(name))
