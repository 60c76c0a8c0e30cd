"""Line dedup: hashes range-partitioned and sorted by document and position, first occurrences streamed.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased. Keys of at
least ``MIN_CHARS`` code points that two or more documents hold lose their lines everywhere but in
the document with the smallest doc_id. What is returned is not text but, per document, a bitmap of
the lines to keep, zlib-compressed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.llm.common import LOWER, UPPER, WHITE, may_hold, quoted, settle, whole

MIN_CHARS = 10
LAST = (1 << 63) - 1  # a null doc_id counts as this one, the last of all

_MARK = "kind int, h1 long, h2 long, doc long, version long, pos int, n_lines int"
_ARROW = pa.schema([("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("version", pa.int64()),
                    ("pos", pa.int32()), ("n_lines", pa.int32())])
DROP, OPEN, TAIL = 0, 1, 2


def _doc(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("doc")


def line_keys(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """One row per line with a key that counts: a 128-bit hash of the key, document, position."""
    lines = docs.select(_doc(doc_id), F.xxhash64(whole(text)).alias("version"), F.split(whole(text), "\n").alias("l"))
    lines = lines.select("doc", "version", F.size("l").alias("n_lines"), F.posexplode("l").alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(WHITE)), UPPER, LOWER)
    lines = lines.select("doc", "version", "n_lines", "pos", key.alias("key")).where(F.length("key") >= min_chars)
    return lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.concat(F.lit("\n"), F.col("key"))).alias("h2"),
                        "doc", "version", "pos", "n_lines")


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stream one sorted range: lines to drop, lines the previous range decides, and the range's last key.

    Only the current key and the document that holds it first are carried, so a key may fill any
    number of ranges. Lines of a range's first key that its first document holds stay OPEN.
    """
    key, owner, head = None, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2, doc = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]
        at = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        owners = doc[at]
        if key == (h1[0], h2[0]):
            owners[0] = owner
        if head is None:
            head = (h1[0], h2[0])
        owned = owners[run]
        drop = doc != owned
        still = ~drop & (h1 == head[0]) & (h2 == head[1])
        kind = np.where(drop, DROP, OPEN).astype(np.int32)
        key, owner = (h1[-1], h2[-1]), owners[-1]
        pick = np.flatnonzero(drop | still)
        if len(pick):
            yield pa.RecordBatch.from_arrays([pa.array(kind[pick]), *(c.take(pa.array(pick)) for c in batch.columns)], schema=_ARROW)
    if key is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip([TAIL, int(key[0]), int(key[1]), int(owner), 0, 0, 0], _ARROW, strict=True)], schema=_ARROW)


def _pack_bits(n_lines: pd.Series, dropped: pd.Series) -> pd.Series:
    out = []
    for n, at in zip(n_lines, dropped, strict=True):
        keep = np.ones(n, np.uint8)
        keep[np.asarray(at)] = 0
        out.append(zlib.compress(np.packbits(keep).tobytes()))
    return pd.Series(out)


def unpack_bits(bitmap: bytes, n_lines: int) -> np.ndarray:
    """The lines to keep, as booleans, from a compressed bitmap."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """doc, version, n_dropped, bitmap for every document that loses a line; others keep all lines.

    ``doc`` is the doc_id (a null counts as the largest), ``version`` a hash of the text, so that
    rows sharing a doc_id but not the text keep apart; they are one document in the rule, and equal
    rows are treated alike. A null text is one empty line.

    The line hashes are settled once, so texts are split once. They are range-partitioned by hash,
    document and position: a key that holds a third of all lines fills several ranges, and what a
    range cannot decide about its first key is decided by the last keys of the ranges (one row each).
    """
    order = ["h1", "h2", "doc", "version", "pos"]
    keys = settle(line_keys(docs, doc_id, text, min_chars))
    ranges = keys.repartitionByRange(*order).sortWithinPartitions(*order).select(*order[:2], "doc", "version", "pos", "n_lines")
    marks = settle(ranges.mapInArrow(_first_occurrences, _MARK))
    owners = marks.where(F.col("kind") == TAIL).groupBy("h1", "h2").agg(F.min("doc").alias("owner"))
    late = marks.where(F.col("kind") == OPEN).join(owners, ["h1", "h2"]).where("doc > owner")
    columns = ["doc", "version", "n_lines", "pos"]
    drops = marks.where(F.col("kind") == DROP).select(columns).unionByName(late.select(columns))
    lost = drops.groupBy("doc", "version", "n_lines").agg(F.collect_set("pos").alias("at"))
    return lost.select("doc", "version", F.size("at").cast("long").alias("n_dropped"), F.pandas_udf(_pack_bits, "binary")("n_lines", "at").alias("bitmap"))


def _kept_text(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    out = []
    for t, b in zip(text, bitmap, strict=True):
        if b is None:
            out.append(None)
            continue
        lines = t.split("\n")
        out.append("\n".join(line for line, keep in zip(lines, unpack_bits(b, len(lines)), strict=True) if keep))
    return pd.Series(out, dtype=object)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with kept_text, n_lines and n_dropped (input columns of these names are replaced).

    Only documents that may have a bitmap are shuffled to meet it, and only texts that lose lines
    leave the JVM; the others pass straight through. A filter of fixed size tells them apart.
    """
    added = ("kept_text", "n_lines", "n_dropped")
    rows = docs.select(F.struct(*quoted(docs.columns)).alias("row"), _doc(doc_id), whole(text).alias("text"))
    rows = rows.withColumn("version", F.xxhash64("text")).withColumn("tkey", F.xxhash64("doc", "version"))
    bitmaps = settle(bitmaps.withColumn("tkey", F.xxhash64("doc", "version")))
    marked = may_hold(rows, bitmaps, "may")
    met = marked.where("may").join(bitmaps.drop("tkey"), ["doc", "version"], "left")
    kept = F.pandas_udf(_kept_text, "string")(F.when(F.col("bitmap").isNotNull(), F.col("text")), F.col("bitmap"))
    met = met.select("row", "text", F.coalesce(kept, "text").alias("kept_text"), F.coalesce("n_dropped", F.lit(0).cast("long")).alias("n_dropped"))
    out = marked.where("NOT may").select("row", "text", F.col("text").alias("kept_text"), F.lit(0).cast("long").alias("n_dropped")).unionByName(met)
    return out.select(*(F.col(f"row.{c}") for c in quoted(c for c in docs.columns if c.lower() not in added)),
                      "kept_text", F.size(F.split("text", "\n")).cast("long").alias("n_lines"), "n_dropped")
