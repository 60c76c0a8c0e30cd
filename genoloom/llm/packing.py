"""Best-fit packing with swap-based local search.

Documents become pieces of at most ``capacity`` tokens. Pieces are dealt at random over shards of
about ``SHARD_BINS`` sequences; each shard is packed alone, so nothing passes through one task. A
shard starts from next fit in the order pieces come (see ``search_shard``). The local search then takes the emptiest
sequences and moves pieces out of them, or exchanges one piece for one or two for one with a fuller
sequence; each step raises the sum of squared fills, until sequences are empty and go.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoloom.llm.common import settle, whole
from genoloom.llm.tokens import encoder, values

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
CAPACITY = 4096
SHARD_BINS = 2048
SHARD_PIECES = 50_000

REPORT = ("bins_before", "bins_after", "moves", "swaps", "double_swaps")
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID,
           doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 and, if asked for, ids.

    The whole text is encoded (null: the empty text) and closed with ``end_id``; only documents of
    more than ``capacity`` ids are cut. Rows that share a doc_id are documents of their own; a null
    doc_id stays null. ``ids`` are little-endian unsigned 32-bit integers.
    """
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            doc, piece, start, length, crc, held = [], [], [], [], [], []
            for i, ids in zip(batch.column(0).to_pylist(), encode.encode(values(batch.column(1))), strict=True):
                ids = np.append(ids, ids.dtype.type(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    raw = part.tobytes()
                    doc.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(raw))
                    if with_ids:
                        held.append(raw)
            columns = {"doc_id": pa.array(doc, pa.int64()), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()),
                       "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                columns["ids"] = pa.array(held, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col(doc_id).cast("long"), whole(text)).mapInArrow(cut, schema)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions: each piece, by falling length, goes to the bin with the least room it fits in.

    ``rooms`` has bit r set while some bin has room r.
    """
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    rooms = 0
    for p in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        n = lengths[p]
        fitting = rooms >> n
        if fitting:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[b].append(p)
        else:
            b, room = len(bins), capacity
            bins.append([p])
        if left := room - n:
            by_room[left].append(b)
            rooms |= 1 << left
    return bins


def next_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of positions as pieces come: a piece that does not fit in the last bin opens a new one."""
    bins: list[list[int]] = []
    room = 0
    for p, n in enumerate(lengths):
        if n > room or not bins:
            bins.append([])
            room = capacity
        bins[-1].append(p)
        room -= n
    return bins


class LocalSearch:
    """Bins that are emptied one after another by steps that raise the sum of squared fills.

    A giver offers its pieces to the other underfull bins. A *move* goes to the bin with the least
    room the piece fits in, found in a bit set of rooms. Where nothing fits, *one for one* and *two
    for one* exchanges are looked for: a piece of another bin stands for a slot of its length and the
    bin's room, and the offer that gains most over all slots is taken. All slots are compared at once
    in numpy. A bin of capacity c has fewer than sqrt(2c) different lengths, which bounds the pairs.
    """

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.capacity = capacity
        self.size = np.asarray(lengths, np.int64)
        self.members = [set(b) for b in bins]
        self.owner = np.zeros(len(lengths), np.int64)
        for b, held in enumerate(bins):
            self.owner[held] = b
        self.fill = np.bincount(self.owner, self.size, len(bins)).astype(np.int64)
        self.by_room: list[set[int]] = [set() for _ in range(capacity + 1)]
        self.rooms = 0  # bit r is set while some underfull bin has room r
        for b in range(len(bins)):
            self._open(b)
        self.moves = self.swaps = self.double_swaps = 0
        self.live = sum(map(bool, self.members))

    @property
    def steps(self) -> int:
        return self.moves + self.swaps + self.double_swaps

    def _open(self, b: int) -> None:
        room = self.capacity - int(self.fill[b])
        if room and self.members[b]:
            self.by_room[room].add(b)
            self.rooms |= 1 << room

    def _close(self, b: int) -> None:
        room = self.capacity - int(self.fill[b])
        self.by_room[room].discard(b)
        if not self.by_room[room]:
            self.rooms &= ~(1 << room)

    def _carry(self, pieces: list[int], source: int, target: int) -> None:
        self.members[source].difference_update(pieces)
        self.members[target].update(pieces)
        self.owner[pieces] = target
        size = int(self.size[pieces].sum())
        self.fill[source] -= size
        self.fill[target] += size

    def _step(self, giver: int, taker: int, out: list[int], back: list[int]) -> None:
        self._close(taker)
        self._carry(out, giver, taker)
        self._carry(back, taker, giver)
        self._open(taker)

    def _move(self, giver: int) -> bool:
        """Move every piece of the giver that fits elsewhere with a gain, the longest first."""
        before = self.moves
        for p in sorted(self.members[giver], key=lambda p: (-self.size[p], p)):
            n = int(self.size[p])
            if fit := self.rooms >> n:
                taker = min(self.by_room[n + (fit & -fit).bit_length() - 1])
                if self.fill[taker] + n > self.fill[giver]:
                    self._step(giver, taker, [p], [])
                    self.moves += 1
        return self.moves > before

    def _exchange(self, giver: int) -> bool:
        """The exchange that gains most: one piece of the giver, else two, for one of an underfull bin."""
        room = self.capacity - self.fill
        room[giver] = 0
        theirs = np.flatnonzero(room[self.owner] > 0)
        taker, size = self.owner[theirs], self.size[theirs]
        slot = room[taker] + size
        own = np.array(sorted(self.members[giver], key=lambda p: (self.size[p], p)), np.int64)
        for count in (1, 2):
            if len(theirs) == 0 or len(own) < count:
                return False
            if count == 1:
                parts = own[:, None]
            else:
                n = self.size[own]
                own = own[np.r_[True, True, n[2:] != n[:-2]]]  # two pieces of a length serve for all of them
                parts = own[np.stack(np.triu_indices(len(own), 1), axis=1)]
            offer, first = np.unique(self.size[parts].sum(axis=1), return_index=True)
            at = np.searchsorted(offer, slot, side="right") - 1  # the most that a slot takes
            more = offer[at] - size
            gain = np.where((at >= 0) & (more > 0), more * (self.fill[taker] - self.fill[giver] + more), 0)
            k = int(gain.argmax())
            if gain[k] > 0:
                self._step(giver, int(taker[k]), parts[first[at[k]]].tolist(), [int(theirs[k])])
                self.swaps += count == 1
                self.double_swaps += count == 2
                return True
        return False

    def _empty(self, giver: int) -> None:
        self._close(giver)
        going = True
        while going and self.members[giver]:
            going = self._move(giver)
            going = bool(self.members[giver]) and self._exchange(giver) or going
        self._open(giver)
        self.live -= not self.members[giver]

    def run(self, passes: int = 8) -> LocalSearch:
        """Take every underfull bin as giver, the emptiest first, until the bins are as few as the total
        allows or no step is left. ``passes`` bounds the search; the packing is whole after every step."""
        goal = -(-int(self.size.sum()) // self.capacity)
        for _ in range(passes):
            before = self.steps
            underfull = [b for b, held in enumerate(self.members) if held and self.fill[b] < self.capacity]
            for giver in sorted(underfull, key=lambda b: (self.fill[b], b)):
                if self.live <= goal:
                    return self
                if self.members[giver]:
                    self._empty(giver)
            if self.steps == before:
                break
        return self

    @property
    def bins(self) -> list[list[int]]:
        return [sorted(held) for held in self.members if held]


def search_shard(lengths: list[int], capacity: int) -> tuple[int, LocalSearch]:
    """The bins at the start, and the search that ends with the fewest.

    The first search starts from next fit. Where it ends above what the total allows, as when most
    pieces are longer than half a bin, a second one starts from best fit by falling length.
    """
    start = next_fit(lengths, capacity)
    search = LocalSearch(start, lengths, capacity).run()
    if search.live > -(-sum(lengths) // capacity):
        other = best_fit(lengths, capacity)
        second = LocalSearch(other, lengths, capacity).run()
        if second.live < search.live:
            return len(other), second
    return len(start), search


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, passes: int = 8) -> list[list[int]]:
    """The bins that the search leaves."""
    return LocalSearch(bins, lengths, capacity).run(passes).bins


def pack(cut: DataFrame, capacity: int = CAPACITY, shard_bins: int = SHARD_BINS) -> DataFrame:
    """Add sequence_id and offset to pieces (settled, with a length column); other columns stay.

    Shards are dealt by a row number of the settled pieces, so no document, source or group of
    copies lands together. Offsets of a sequence are gapless from 0. ``bins_before`` and ``bins_after``
    are the sequences of the piece's shard at the search's start and end, ``moves``, ``swaps`` and
    ``double_swaps`` its steps (columns of these names are replaced).
    """
    cut = cut.drop(*REPORT)
    n, tokens = cut.select(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    shards = max(1, round(tokens / (capacity * shard_bins)), -(-n // SHARD_PIECES))
    dealt = cut.withColumn("_shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int"))

    def fill_shard(key: tuple, part: pa.Table) -> pa.Table:
        lengths = part["length"].to_pylist()
        sequence, offset = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        bins_before, search = search_shard(lengths, capacity)
        for b, members in enumerate(search.bins):
            at = 0
            for p in members:
                sequence[p], offset[p] = (key[0].as_py() << 32) + b, at
                at += lengths[p]
        out = part.drop_columns("_shard").append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
        for name, value in zip(REPORT, (bins_before, search.live, search.moves, search.swaps, search.double_swaps), strict=True):
            out = out.append_column(name, pa.array([value] * len(part), pa.int64()))
        return out

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    schema += "".join(f", {name} long" for name in REPORT)
    return dealt.groupBy("_shard").applyInArrow(fill_shard, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID,
                   doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset
    and the search's report.

    An empty table gives no rows. Pieces are settled, so texts are encoded once.
    """
    return pack(settle(pieces(docs, capacity, vocabulary, end_id, doc_id, text)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Training sequences from packed pieces with ids: sequence_id, length, ids (binary).

    A sequence has at most ``capacity`` tokens, which bounds a group.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("hex"))))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("p")).select(
        "sequence_id", "length", F.unhex(F.concat_ws("", F.col("p.hex"))).alias("ids"))
