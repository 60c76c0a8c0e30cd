"""Token-id store: every document's ids compressed alone with one shared zstandard dictionary.

A store is a folder of Parquet files, so that any file system Spark can write to holds it and a lost
task's output is written again. ``dictionary`` has one row: the dictionary and its SHA-256. ``chunks``
has one row per chunk of about ``CHUNK_BYTES`` compressed bytes:

* shard, chunk: the order of chunks; ids run on through chunks in ascending doc_id order
* n_docs, n_tokens, first_doc, last_doc: what it holds, so that a reader finds a document's chunk
* dictionary: SHA-256 of the dictionary it needs, checked before reading
* width: bytes of an id (2 or 4, little-endian unsigned)
* doc_ids: the doc_id of each document
* offsets: little-endian unsigned 64-bit starts of the documents' frames, and the end of the last
* counts: little-endian unsigned 64-bit number of ids of each document
* payload: the frames one after another
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoloom.llm.common import distinct_name, whole
from genoloom.llm.tokens import encoder, values

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 2
LEVEL = 3
CHUNK_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCS = 512  # documents the dictionary is trained on; it changes sizes, never results

CHUNKS = ("shard int, chunk int, n_docs long, n_tokens long, first_doc long, last_doc long, dictionary string, width int, "
          "doc_ids array<long>, offsets binary, counts binary, payload binary")
DOCS = "shard int, chunk int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def serialise(ids: np.ndarray, end_id: int) -> bytes:
    return np.append(ids, ids.dtype.type(end_id)).tobytes()


def train_dictionary(docs: DataFrame, vocabulary: str, end_id: int, text: str) -> bytes:
    """A zstandard dictionary from the id arrays of at most ``SAMPLE_DOCS`` documents.

    Too few ids to train on give the ids themselves as dictionary, no documents an empty one.
    """
    texts = [r[0] for r in docs.select(whole(text)).limit(SAMPLE_DOCS).collect()]
    samples = [serialise(ids, end_id) for ids in encoder(vocabulary).encode(texts)]
    samples = [s[at : at + 8192] for s in samples for at in range(0, len(s), 8192)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def write_store(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode, compress and write ``docs`` (doc_id, text) in ascending doc_id order.

    A null text is the empty text, which is its end id alone. A null doc_id comes first. Rows that
    share a doc_id are all stored, ordered by text. An empty table gives a store without chunks.
    Texts are range-partitioned by doc_id and by a hash of the text, so no partition depends on one
    doc_id; a task holds one chunk at a time.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, vocabulary, end_id, text)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "dictionary string, bytes binary").coalesce(1).write.parquet(f"{path}/dictionary")

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=False)
        shard, chunk = TaskContext.get().partitionId(), 0
        ids_of: list[int | None] = []
        frames: list[bytes] = []
        counts: list[int] = []
        size = 0

        def flush() -> pa.RecordBatch:
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in frames])]).astype("<u8")
            named = [i for i in ids_of if i is not None] or [None]
            row = [shard, chunk, len(frames), sum(counts), named[0], named[-1], digest, encode.width.itemsize,
                   list(ids_of), offsets.tobytes(), np.array(counts, "<u8").tobytes(), b"".join(frames)]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, ARROW.types, strict=True)], schema=ARROW)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, found in zip(ids, encode.encode(values(batch.column(1))), strict=True):
                frame = compressor.compress(serialise(found, end_id))
                ids_of.append(i)
                frames.append(frame)
                counts.append(len(found) + 1)
                size += len(frame)
                if size >= CHUNK_BYTES:
                    yield flush()
                    ids_of, frames, counts, size, chunk = [], [], [], 0, chunk + 1
        if frames:
            yield flush()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    key = distinct_name(rows, "hash")
    ordered = (rows.withColumn(key, F.xxhash64("text")).repartitionByRange("doc_id", key)
               .sortWithinPartitions("doc_id", key, "text").drop(key))
    ordered.mapInArrow(compress, CHUNKS).write.parquet(f"{path}/chunks")


ARROW = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("first_doc", pa.int64()),
    ("last_doc", pa.int64()), ("dictionary", pa.string()), ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
    ("offsets", pa.binary()), ("counts", pa.binary()), ("payload", pa.binary())])


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    (row,) = spark.read.parquet(f"{path}/dictionary").collect()
    held = bytes(row["bytes"])
    if hashlib.sha256(held).hexdigest() != row["dictionary"]:
        raise ValueError("the store's dictionary is damaged")
    return row["dictionary"], held


def _frames(row: dict, digest: str, decompressor: zstandard.ZstdDecompressor) -> Iterator[np.ndarray]:
    if row["dictionary"] != digest:
        raise ValueError("the chunk needs another dictionary")
    offsets, payload = np.frombuffer(row["offsets"], "<u8"), memoryview(row["payload"])
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield np.frombuffer(decompressor.decompress(payload[a:b]), f"<u{row['width']}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per stored document: doc_id, start, n_tokens, ids_crc32, read from the files.

    ``start`` is the number of ids of all documents before it. Only totals per chunk are summed in
    order: first over shards, then over the chunks of each shard.
    """
    digest, held = _dictionary(spark, path)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
        for batch in batches:
            for k in range(batch.num_rows):
                (row,) = batch.slice(k, 1).to_pylist()
                crc, n = [], []
                for ids in _frames(row, digest, decompressor):
                    crc.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    n.append(len(ids))
                starts = np.concatenate([[0], np.cumsum(n)])[:-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * len(n), pa.int32()), pa.array([row["chunk"]] * len(n), pa.int32()),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                    names=["shard", "chunk", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    chunks = spark.read.parquet(f"{path}/chunks")
    sums = chunks.select("shard", "chunk", "n_tokens")
    shards = sums.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    within = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("chunk_start", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(shards, "shard")
    starts = starts.select("shard", "chunk", (F.col("shard_start") + F.col("chunk_start")).alias("base"))
    columns = ["shard", "chunk", "dictionary", "width", "doc_ids", "offsets", "payload"]
    return chunks.select(columns).mapInArrow(digests, DOCS).join(starts, ["shard", "chunk"]).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def read_ids(spark: SparkSession, path: str, doc_id: int) -> list[np.ndarray]:
    """Ids of one document (of each row stored under this doc_id) without reading other frames.

    The chunk statistics in the files lead to the chunk, its offsets to the frame.
    """
    digest, held = _dictionary(spark, path)
    decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
    found = []
    chunks = spark.read.parquet(f"{path}/chunks").where((F.col("first_doc") <= doc_id) & (F.col("last_doc") >= doc_id))
    for row in chunks.orderBy("shard", "chunk").toLocalIterator():
        offsets = np.frombuffer(row["offsets"], "<u8").tolist()
        if row["dictionary"] != digest:
            raise ValueError("the chunk needs another dictionary")
        found += [np.frombuffer(decompressor.decompress(bytes(row["payload"][offsets[k] : offsets[k + 1]])), f"<u{row['width']}")
                  for k, d in enumerate(row["doc_ids"]) if d == doc_id]
    return found
