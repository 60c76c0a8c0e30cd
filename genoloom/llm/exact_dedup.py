"""Exact dedup by two-pass Bloom filtering, in DataFrame operations only.

Pass 1 sets, for every row's digest, two cells of a Bloom filter and keeps the cells that were set
more than once. Pass 2 probes each row: only when both of its cells were set again can the digest be
repeated. Those rows shuffle and are grouped by the whole digest; all others pass straight through.

The filter is a table of 4 KB bitmaps. It has ``CELLS_PER_ROW`` cells for a row and ``MAX_CELLS`` at
most, so what is broadcast never exceeds ``MAX_CELLS / 8`` bytes (128 MB by default). Above 67 million
rows the filter fills up: more rows are shuffled in vain, in the end all, and the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.llm.common import ascii_lower, distinct_name, is_set, orderable, quoted, settle, whole

CELLS_PER_ROW = 16
MAX_CELLS = 1 << 30
BITMAP = 1 << 15  # cells of one bitmap, as bitmap_construct_agg builds them


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the text with A-Z lower-cased, in hex; a null is the empty text."""
    return F.sha2(ascii_lower(whole(text)), 256)


def _cells(digest: Column, n_cells: int) -> list[Column]:
    """(bitmap, place in it) of the digest's two cells."""
    cells = [F.pmod(F.xxhash64(digest, F.lit(seed)), F.lit(n_cells)) for seed in (1, 2)]
    return [F.struct(F.shiftright(c, 15).alias("bitmap"), c.bitwiseAND(F.lit(BITMAP - 1)).alias("place")) for c in cells]


def repeated_cells(rows: DataFrame, digest: Column, n_cells: int) -> DataFrame:
    """Pass 1: the bitmaps of cells that were set more than once."""
    cells = rows.select(F.explode(F.array(*_cells(digest, n_cells))).alias("c")).select("c.*")
    return (cells.groupBy("bitmap", "place").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            .groupBy("bitmap").agg(F.bitmap_construct_agg("place").alias("bits")))


def mark_possible(rows: DataFrame, digest: Column, name: str) -> DataFrame:
    """Pass 2: add boolean ``name``, true where the digest may be repeated; no row is shuffled.

    A true mark may be wrong, then the row is only shuffled in vain; a false one never is.
    """
    wanted = min(max(rows.count(), 1) * CELLS_PER_ROW, MAX_CELLS)
    n_cells = -(-wanted // BITMAP) * BITMAP
    bitmaps = settle(repeated_cells(rows, digest, n_cells))
    cells = [distinct_name(rows, f"cell_{k}") for k in "ab"]
    out = rows.withColumns(dict(zip(cells, _cells(digest, n_cells), strict=True)))
    both = F.lit(True)
    for k, cell in enumerate(cells):
        bitmap, bits = distinct_name(rows, f"bitmap_{k}"), distinct_name(rows, f"bits_{k}")
        side = bitmaps.select(F.col("bitmap").alias(bitmap), F.col("bits").alias(bits))
        out = out.join(F.broadcast(side), F.col(f"{cell}.bitmap") == F.col(bitmap), "left")
        both = both & is_set(F.col(bits), F.col(f"{cell}.place"))
    return out.withColumn(name, both).select(*quoted(rows.columns), name)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, passed_through.

    The row with the largest doc_id of equal texts stays; a null doc_id counts as the smallest. Of
    rows that repeat both text and doc_id one stays. A null text is the empty text. Other columns
    are not read.

    Digests are settled once, so the texts are read once. A repeated digest's rows are counted per
    doc_id before anything meets in one task, and the totals are joined back as a plain join of two
    shuffled sides, which adaptive execution splits for a hot text.
    """
    digests = settle(docs.select(F.col(doc_id).alias("doc_id"), text_digest(text).alias("text_sha256")))
    marked = mark_possible(digests, F.col("text_sha256"), "_possible")
    alone = marked.where(~F.col("_possible")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256", F.lit(True).alias("passed_through"))
    same = marked.where("_possible").groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    same = settle(same)
    total = settle(same.groupBy(F.col("text_sha256").alias("_sha")).agg(
        F.max("doc_id").alias("keep_id"), F.sum("_rows").alias("group_size")))
    copies = same.join(total, F.col("text_sha256") == F.col("_sha")).select(
        "doc_id", "keep_id", "group_size", "text_sha256",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_rows"))).alias("_copy"))
    copies = copies.select("doc_id", "keep_id", "group_size",
                           (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
                           "text_sha256", F.lit(False).alias("passed_through"))
    return alone.unionByName(copies)


def keep_last(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, all columns: of equal texts the one with the largest doc_id.

    Rows that cannot be repeated are not shuffled. Of the others the best row per digest is a
    grouping, so copies of a hot text meet in their own map task first; ties of doc_id go to the
    largest remaining columns, as far as they have an order. Other columns may have any name and type.
    """
    key, mark = distinct_name(docs, "digest"), distinct_name(docs, "possible")
    marked = mark_possible(docs.withColumn(key, text_digest(text)), F.col(key), mark)
    alone = marked.where(~F.col(mark)).select(quoted(docs.columns))
    best = marked.where(mark).groupBy(key).agg(
        F.max_by(F.struct(*quoted(docs.columns)), F.struct(F.col(doc_id).alias("_first"), *orderable(docs))).alias("_row")).select("_row.*")
    return alone.unionByName(best)
