"""Merkle manifest of a table: leaf coordinates by bitmap rank, levels by keyed slot arrays.

Every row is a leaf, the SHA-256 of its fields. A group's leaves ascend by doc_id, and every two
consecutive nodes become the digest of both until one is left, the group's subroot; the groups'
subroots become the root in the same way.

*Coordinates.* A leaf's place is the number of smaller doc_ids in its group. Each task makes
compressed bitmaps of the doc_ids it sees, one per group and container of 65,536 consecutive ids;
the bitmaps of a container are merged, and popcounts of containers are summed up along the id by
its upper 16, 32 and 48 bits, so no step sees more than 65,536 entries of a group. A container then
lists its non-empty 64-bit words with the popcount before each. A rank query joins a row with its
word by a hash join and counts the bits below its own: no leaf is sorted.

*Ties.* Bitmaps carry the counts of repeated doc_ids, so later ranks stay right. Rows that share a
doc_id (a null one is the smallest) are ordered by leaf digest, in buckets of its first bytes.

*Levels.* 1,024 consecutive nodes are one array, each node in the slot that its place names; a task
reduces the array by ten levels at once. So the passes over groups are one for every ten levels.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoloom.llm.common import settle
from genoloom.operators.ordering import with_rank

CONTAINER = 16  # bits of a doc_id inside a container
WORD = 6  # bits inside a 64-bit word
LEVELS = 10  # levels that one slot array is reduced by
SLOTS = 1 << LEVELS
FLUSH_IDS = 1 << 20  # doc_ids a task gathers before it writes their bitmaps

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: Sequence[Column | str]) -> Column:
    """SHA-256 in hex of the fields one after another, each as byte count, colon and value; ``-`` for null."""
    parts = []
    for f in fields:
        value = (F.col(f) if isinstance(f, str) else f).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _pack(offsets: np.ndarray, counts: np.ndarray) -> bytes:
    """A container's ids (ascending offsets) as its non-empty words, and the counts of repeated ones."""
    words, at = np.unique(offsets >> WORD, return_index=True)
    bits = np.bitwise_or.reduceat(np.uint64(1) << (offsets & 63).astype(np.uint64), at)
    more = counts > 1
    head = np.array([len(words), int(more.sum())], "<u4")
    body = b"".join([words.astype("<u2").tobytes(), bits.astype("<u8").tobytes(), offsets[more].astype("<u2").tobytes(),
                     (counts[more] - 1).astype("<u8").tobytes()])
    return zlib.compress(head.tobytes() + body, 1)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers, their bits, offsets of repeated ids and how often these come again."""
    raw = zlib.decompress(blob)
    n, m = np.frombuffer(raw, "<u4", 2).tolist()
    at = np.cumsum([8, 2 * n, 8 * n, 2 * m]).tolist()
    return (np.frombuffer(raw, "<u2", n, at[0]).astype(np.int64), np.frombuffer(raw, "<u8", n, at[1]),
            np.frombuffer(raw, "<u2", m, at[2]).astype(np.int64), np.frombuffer(raw, "<u8", m, at[3]).astype(np.int64))


def _counts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of a container's ids and how often each occurs."""
    words, bits, again, more = _unpack(blob)
    row, bit = np.nonzero(np.unpackbits(bits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
    offsets = (words[row] << WORD) + bit
    counts = np.ones(len(offsets), np.int64)
    counts[np.searchsorted(offsets, again)] += more
    return offsets, counts


def _partial_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, container, blob) of the doc_ids of a task, written whenever FLUSH_IDS have come in."""
    held, size = [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        coded = table.column(0).combine_chunks().dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        code = coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
        names = [*coded.dictionary.to_pylist(), None]
        ids = table.column(1).combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        at = ids.fill_null(0).to_numpy(zero_copy_only=False)
        order = np.lexsort((at, known, code))
        code, known, at = code[order], known[order], at[order]
        fresh = np.r_[True, (code[1:] != code[:-1]) | (known[1:] != known[:-1]) | (at[1:] != at[:-1])]
        place = np.flatnonzero(fresh)
        counts = np.diff(np.r_[place, len(at)])
        code, known, at = code[place], known[place], at[place]
        box = at >> CONTAINER
        edge = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (known[1:] != known[:-1]) | (box[1:] != box[:-1])])
        rows = ([], [], [])
        for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(at)], strict=True):
            rows[0].append(names[code[a]])
            rows[1].append(int(box[a]) if known[a] else None)
            rows[2].append(_pack(at[a:b] & 0xFFFF, counts[a:b]))
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary())],
                                         ["grp", "box", "blob"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= FLUSH_IDS:
            yield from flush()
            held, size = [], 0
    if size:
        yield from flush()


def _merged_bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, container, total, blob): blobs of one container, which come one after another, as one."""
    key, parts = None, []

    def emit() -> pa.RecordBatch:
        offsets, place = np.unique(np.concatenate([o for o, _ in parts]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([c for _, c in parts])).astype(np.int64)
        return pa.RecordBatch.from_arrays([
            pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int64()), pa.array([int(counts.sum())]), pa.array([_pack(offsets, counts)])],
            ["grp", "box", "total", "blob"])

    for batch in batches:
        for grp, box, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if parts and key != (grp, box):
                yield emit()
                parts = []
            key = (grp, box)
            parts.append(_counts(blob))
            if len(parts) > 64:  # bounds what is held of a container that every task has a bitmap of
                offsets, place = np.unique(np.concatenate([o for o, _ in parts]), return_inverse=True)
                parts = [(offsets, np.bincount(place, np.concatenate([c for _, c in parts])).astype(np.int64))]
    if parts:
        yield emit()


def directory(leaves: DataFrame) -> DataFrame:
    """grp, box, blob, base, n: the containers, the leaves before each in its group, and the group's leaves.

    Container totals are summed up by the upper bits of the id level by level, so each window holds
    at most 65,536 rows (one more for null ids), however many leaves a group has.
    """
    parts = leaves.select("grp", "doc_id").mapInArrow(_partial_bitmaps, "grp string, box long, blob binary")
    merged = parts.repartition("grp", "box").sortWithinPartitions("grp", "box").mapInArrow(
        _merged_bitmaps, "grp string, box long, total long, blob binary")
    boxes = settle(merged)
    known, out = [], boxes.withColumn("base", F.lit(0).cast("long"))
    for step, shift in enumerate((48 - CONTAINER, 32 - CONTAINER, 0)):
        part, upper = F.shiftright("box", shift), F.shiftright("box", shift + 16)
        level = boxes.groupBy("grp", part.alias("part")).agg(F.sum("total").alias("sum"), F.first(upper if step else F.lit(0)).alias("upper"))
        peers = Window.partitionBy("grp", "upper").orderBy(F.asc_nulls_first("part"))
        before = F.coalesce(F.sum("sum").over(peers.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        columns = [F.col("grp").alias("g"), F.col("part").alias("p"), before.alias("before")]
        if not step:
            columns.append(F.sum("sum").over(Window.partitionBy("grp")).alias("n"))
            known.append("n")
        level = level.select(*columns)
        out = out.join(level, F.col("grp").eqNullSafe(F.col("g")) & part.eqNullSafe(F.col("p"))).select(
            "grp", "box", "blob", (F.col("base") + F.col("before")).alias("base"), *known)
    return out


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Non-empty words of containers: number, bits, leaves of the group before it, repeated ids in it."""
    for batch in batches:
        for grp, box, blob, base, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words, bits, again, more = _unpack(blob)
            size = np.bitwise_count(bits).astype(np.int64)
            owner = np.searchsorted(words, again >> WORD)
            np.add.at(size, owner, more)
            before = base + np.cumsum(size) - size
            extras = [[] for _ in words]
            for k, off, extra in zip(owner.tolist(), (again & 63).tolist(), more.tolist(), strict=True):
                extras[k].append({"bit": off, "extra": extra})
            number = [None] if box is None else ((box << (CONTAINER - WORD)) + words).tolist()
            kind = pa.list_(pa.struct([("bit", pa.int32()), ("extra", pa.int64())]))
            yield pa.RecordBatch.from_arrays([
                pa.array([grp] * len(words), pa.string()), pa.array(number, pa.int64()), pa.array(bits.view(np.int64)), pa.array(before, pa.int64()),
                pa.array([e or None for e in extras], kind), pa.array([n] * len(words), pa.int64())],
                ["grp", "word", "bits", "before", "extras", "n"])


def places(leaves: DataFrame, boxes: DataFrame) -> DataFrame:
    """The leaves with ``place`` (from 0 in their group) and ``n``, the group's leaves."""
    words = boxes.select("grp", "box", "blob", "base", "n").mapInArrow(
        _words, "grp string, word long, bits long, before long, extras array<struct<bit: int, extra: long>>, n long")
    words = words.withColumnsRenamed({"grp": "g"}).hint("shuffle_hash")
    bit = F.coalesce(F.col("doc_id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")
    below = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), bit))))
    extra = F.aggregate("extras", F.lit(0).cast("long"), lambda s, e: s + F.when(e["bit"] < bit, e["extra"]).otherwise(0))
    joined = leaves.join(words, F.col("grp").eqNullSafe(F.col("g")) & F.shiftright("doc_id", WORD).eqNullSafe(F.col("word")))
    ranked = settle(joined.select(
        "grp", "doc_id", "leaf", "claim", (F.col("before") + below + F.coalesce(extra, F.lit(0).cast("long"))).alias("place"), "n",
        F.coalesce(F.exists("extras", lambda e: e["bit"] == bit), F.lit(False)).alias("tied")))
    # Rows of a repeated doc_id: the same leaf is counted before anything is ordered, and a leaf's
    # first bytes cut one hot doc_id into 65,536 buckets of even size.
    tied = ranked.where("tied").groupBy("grp", "doc_id", "leaf", "claim", "place", "n").agg(F.count(F.lit(1)).alias("rows"))
    tied = settle(tied.withColumn("cut", F.substring("leaf", 1, 2)))
    one = ["grp", "doc_id"]
    earlier = Window.unboundedPreceding, -1
    cuts = tied.groupBy(*one, "cut").agg(F.sum("rows").alias("sum")).select(
        F.col("grp").alias("g"), F.col("doc_id").alias("d"), F.col("cut").alias("c"),
        F.coalesce(F.sum("sum").over(Window.partitionBy(*one).orderBy("cut").rowsBetween(*earlier)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("rows").over(Window.partitionBy(*one, "cut").orderBy("leaf", "claim").rowsBetween(*earlier)), F.lit(0))
    tied = tied.withColumn("inside", inside).join(
        cuts, F.col("grp").eqNullSafe(F.col("g")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("cut") == F.col("c")))
    tied = tied.select("grp", "doc_id", "leaf", "claim", (F.col("place") + F.col("base") + F.col("inside")).alias("first"), "n",
                       F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)).alias("copy"))
    return ranked.where("NOT tied").drop("tied").unionByName(
        tied.select("grp", "doc_id", "leaf", "claim", (F.col("first") + F.col("copy")).alias("place"), "n"))


def digest(text: bytes) -> bytes:
    return hashlib.sha256(text).hexdigest().encode()


def block_levels(nodes: list[bytes], n: int) -> list[list[bytes]]:
    """The levels of one slot array, nodes in hex, in a tree that has ``n`` nodes on the array's level.

    An array that is its whole level stops at one node; any other goes through all of its levels.
    """
    height = LEVELS if n > SLOTS else (n - 1).bit_length()
    levels = [nodes]
    for _ in range(height):
        below = levels[-1]
        levels.append([digest(b"".join(below[k : k + 2])) for k in range(0, len(below), 2)])
    return levels


def block_paths(levels: list[list[bytes]], sides: str, siblings: bytes) -> list[tuple[str, bytes]]:
    """For each node of an array its sides and siblings (hex, bottom up), the array's own ones behind.

    A side is R or L for a sibling to the right or left, and ``-`` where the node was alone.
    """
    paths = [(sides, siblings)]
    for level in reversed(levels[:-1]):
        last = len(level) - 1
        paths = [("-" + paths[k >> 1][0], paths[k >> 1][1]) if k == last and k % 2 == 0 else
                 (("L" if k % 2 else "R") + paths[k >> 1][0], level[k ^ 1] + paths[k >> 1][1]) for k in range(len(level))]
    return paths


def fold(node: bytes, sides: str, siblings: bytes) -> bytes:
    """The root that a node (hex) and a path lead to."""
    at = 0
    for side in sides:
        if side == "-":
            node = digest(node)
            continue
        other = siblings[at : at + 64]
        at += 64
        node = digest(node + other if side == "R" else other + node)
    return node


def _arrays(batch: pa.RecordBatch, names: Sequence[str]) -> Iterator[tuple[dict, dict[str, list]]]:
    """Per slot array its own columns and the node columns in slot order."""
    slots = batch.column("slots")
    rows = batch.drop_columns(["slots"]).to_pylist()
    for k, row in enumerate(rows):
        nodes = slots[k].values
        slot = nodes.field("slot").to_numpy(zero_copy_only=False)
        order = np.empty(len(slot), np.int64)
        order[slot] = np.arange(len(slot))
        yield row, {n: nodes.field(n).take(pa.array(order)).to_pylist() for n in names}


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row, nodes in _arrays(batch, ["node"]):
            top = block_levels([x.hex().encode() for x in nodes["node"]], row["n"])[-1]
            out.append({"grp": row["grp"], "place": row["block"], "n": -(-row["n"] // SLOTS), "node": bytes.fromhex(top[0].decode())})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("grp", pa.string()), ("place", pa.int64()), ("n", pa.int64()), ("node", pa.binary())]))


def _child_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for row, nodes in _arrays(batch, ["node"]):
            levels = block_levels([x.hex().encode() for x in nodes["node"]], row["n"])
            for k, (sides, siblings) in enumerate(block_paths(levels, row["sides"], row["siblings"])):
                out.append({"grp": row["grp"], "place": row["block"] * SLOTS + k, "sides": sides, "siblings": siblings,
                            "subroot": row["subroot"], "root": row["root"]})
        yield pa.RecordBatch.from_pylist(out, pa.schema([
            ("grp", pa.string()), ("place", pa.int64()), ("sides", pa.string()), ("siblings", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary())]))


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, nodes in _arrays(batch, ["doc_id", "node", "claim"]):
            leaves = [x.hex().encode() for x in nodes["node"]]
            paths = block_paths(block_levels(leaves, row["n"]), row["sides"], row["siblings"])
            claims = [leaf if c is None else c.hex().encode() for c, leaf in zip(nodes["claim"], leaves, strict=True)]
            folded = [fold(c, *p).decode() for c, p in zip(claims, paths, strict=True)]
            size = len(leaves)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["grp"]] * size, pa.string()), pa.array(nodes["doc_id"], pa.int64()),
                pa.array([row["block"] * SLOTS + k for k in range(size)], pa.int64()), pa.array([x.decode() for x in leaves]),
                pa.array([s for s, _ in paths]), pa.array([s.decode() for _, s in paths]),
                pa.array([row["subroot"].hex()] * size), pa.array([row["root"].hex()] * size), pa.array(folded)],
                ["grp", "doc_id", "place", "leaf", "sides", "siblings", "subroot", "root", "folded_root"])


def _slot_arrays(nodes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per 1,024 consecutive places of a group; ``slots`` holds the nodes in any order."""
    slot = F.col("place").bitwiseAND(F.lit(SLOTS - 1)).cast("int").alias("slot")
    return nodes.groupBy("grp", F.shiftright("place", LEVELS).alias("block")).agg(
        F.max("n").alias("n"), F.collect_list(F.struct(slot, *columns)).alias("slots"))


def _climb(arrays: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Reduce slot arrays until every group has one node: the arrays of each pass, and the last nodes."""
    passes = [arrays]
    while True:
        nodes = settle(passes[-1].mapInArrow(_roots, "grp string, place long, n long, node binary"))
        if (nodes.agg(F.max("n")).first()[0] or 1) == 1:
            return passes, nodes
        passes.append(settle(_slot_arrays(nodes, ["node"])))


def _with_paths(arrays: DataFrame, paths: DataFrame) -> DataFrame:
    paths = paths.select(F.col("grp").alias("g"), F.col("place").alias("p"), "sides", "siblings", "subroot", "root")
    return arrays.join(paths, F.col("grp").eqNullSafe(F.col("g")) & (F.col("block") == F.col("p"))).drop("g", "p")


_PATH = "grp string, place long, sides string, siblings binary, subroot binary, root binary"


@dataclass
class Manifest:
    """``boxes``: the compressed bitmaps with their ranks. ``subroots``: grp, subroot, leaves.
    ``root``: one row with the root, none for an empty table. ``proofs``: per row grp, doc_id, place,
    leaf, sides, siblings (hex, bottom up), subroot, root, folded_root and verified."""

    boxes: DataFrame
    subroots: DataFrame
    root: DataFrame
    proofs: DataFrame


def build(docs: DataFrame, doc_id: str = "doc_id", group: str = "lang", fields: Sequence[str] = FIELDS,
          claimed: dict[str, Column] | None = None) -> Manifest:
    """The manifest of a table, with a proof for every row.

    ``claimed`` gives fields other values; ``folded_root`` is what the row with these values and its
    proof lead to, and ``verified`` tells whether that is the root.

    A null or empty field is a value of its own; a null group is the first one; null doc_ids come
    first in their group; rows that share a doc_id are ordered by leaf digest, and equal rows stand
    next to each other. Fields may have any length. Columns that are no field are not read. An empty
    table has no root and no rows.
    """
    claimed = claimed or {}
    leaf, claim = leaf_digest(fields), leaf_digest([claimed.get(f, F.col(f)) for f in fields])
    changed = reduce(Column.__or__, [~c.eqNullSafe(F.col(f)) for f, c in claimed.items()], F.lit(False))
    leaves = settle(docs.select(
        F.col(group).cast("string").alias("grp"), F.col(doc_id).cast("long").alias("doc_id"),
        F.unhex(leaf).alias("leaf"), F.when(changed, F.unhex(claim)).alias("claim")))
    boxes = settle(directory(leaves))
    placed = places(leaves, boxes).withColumnRenamed("leaf", "node")
    passes, subroots = _climb(settle(_slot_arrays(placed, ["doc_id", "node", "claim"])))
    sizes = boxes.groupBy(F.col("grp").alias("g")).agg(F.max("n").alias("leaves"))

    # The subroots are the leaves of one more tree, in the order of their groups.
    order = settle(with_rank(subroots.select("grp", "node"), [F.asc_nulls_first("grp")], "rank"))
    count = order.count()
    tops = order.select(F.lit("").alias("grp"), (F.col("rank") - 1).alias("place"), F.lit(count).cast("long").alias("n"), "node")
    top_passes, root = _climb(settle(_slot_arrays(tops, ["node"])))

    paths = root.select(F.lit("").alias("grp"), F.lit(0).cast("long").alias("place"), F.lit("").alias("sides"),
                        F.lit(b"").alias("siblings"), F.lit(b"").alias("subroot"), F.col("node").alias("root"))
    for arrays in reversed(top_passes):
        paths = settle(_with_paths(arrays, paths).mapInArrow(_child_paths, _PATH))
    paths = order.join(paths.drop("grp", "subroot"), F.col("rank") - 1 == F.col("place")).select(
        "grp", F.lit(0).cast("long").alias("place"), "sides", "siblings", F.col("node").alias("subroot"), "root")
    for arrays in reversed(passes[1:]):
        paths = settle(_with_paths(arrays, paths).mapInArrow(_child_paths, _PATH))
    proofs = _with_paths(passes[0], paths).mapInArrow(
        _proofs, "grp string, doc_id long, place long, leaf string, sides string, siblings string, subroot string, root string, folded_root string")
    return Manifest(
        boxes, order.join(sizes, F.col("grp").eqNullSafe(F.col("g"))).select("grp", F.lower(F.hex("node")).alias("subroot"), "leaves"),
        root.select(F.lower(F.hex("node")).alias("root")), proofs.withColumn("verified", F.col("folded_root") == F.col("root")))


def tampered_chars(doc_id: str = "doc_id", n_chars: str = "n_chars") -> Column:
    """``n_chars`` plus one where 7 divides the CRC-32 of the decimal doc_id; a null stays null."""
    hit = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 7 == 0
    return F.when(hit, F.try_add(F.col(n_chars), F.lit(1).cast("long"))).otherwise(F.col(n_chars))
