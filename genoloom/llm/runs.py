"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of words with smallest period q, at least ``periods * q`` and ``least`` words
long, that cannot be made longer with the same period. Per level k the dictionary names the factors
of 2**k words: two factors of a text have one name if their words are equal. The name of a level's
factor is the pair of the names of its halves, so one sort a level makes all names, and a factor
that does not come back in its text drops out for good, because no longer one that begins with it
can come back.

Occurrences of a factor that lie within twice its length form an arithmetic progression whose
difference is a period there. So each occurrence proposes the distance to its successor if that is
more than 2**(k-1) and at most 2**k: a run of period q in that range holds a factor of that level
and its next occurrence q words on, and, holding both, can have no smaller period. Neighbouring
proposals of one period are the same run; the first of them is extended to both sides by looking
equal factors up, longest first, and what remains is deduplicated.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.llm.common import WORD, whole
from genoloom.llm.tokens import values

LEAST = 24  # words of a run
PERIODS = 3  # repetitions of a run, at least 3: the dictionary finds runs that hold three periods
SLICE_WORDS = 200_000  # words of texts that numpy works on at a time; a longer text comes alone

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def plant_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Make the tail of every tenth text periodic, as a test of what ``find_runs`` finds.

    With h the CRC-32 of the decimal doc_id and g = h div 10: if h mod 10 is 0 and the text has n > 0
    words, each word i >= a becomes word a + (i-a) mod p, where a = g mod n, p = 1 + (n-a) div (3 + g mod 8).
    Such a text is its words joined by one space; other texts, and rows without a doc_id, stay as they are.
    Other columns are kept.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.regexp_extract_all(whole(text), F.lit(WORD), 0)
    n, g = F.size(words), F.floor(h / 10).cast("bigint")
    a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    return docs.withColumn(text, F.when((h % 10 == 0) & (n > 0), planted).otherwise(F.col(text)))


class Factors:
    """The dictionary of basic factors of several texts laid end to end."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, longest: int):
        """``ids`` are word numbers, ``starts`` where each text begins, ``longest`` the greatest period sought."""
        n = len(ids)
        sizes = np.diff(np.r_[starts, n])
        self.text = np.repeat(np.arange(len(starts)), sizes)
        self._end = np.repeat(starts + sizes, sizes)
        self.names: list[tuple[np.ndarray, np.ndarray]] = []  # by level: places whose factor comes back, and its name
        self.found: list[tuple[np.ndarray, np.ndarray]] = []  # proposals: place and period
        place = np.arange(n)
        key = self.text * (int(ids.max(initial=0)) + 1) + ids
        for level in count():
            place, name = self._name(place, key, level)
            if 1 << level >= longest or not len(place):
                break
            half = 1 << level
            fits = place + 2 * half <= self._end[place]
            place, name = place[fits], name[fits]
            other = self._look_up(level, place + half)
            both = other >= 0
            place = place[both]
            key = name[both] * n + other[both]

    def _name(self, place: np.ndarray, key: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Name the factors of a level by one stable sort of their keys; keep those that come back."""
        order = np.argsort(key, kind="stable")
        place, key = place[order], key[order]
        same = key[1:] == key[:-1]
        gap = np.where(same, place[1:] - place[:-1], 0)
        near = (gap > (1 << level) // 2) & (gap <= 1 << level)
        self.found.append((place[:-1][near], gap[near]))
        name = np.cumsum(np.r_[0, ~same]) if len(place) else place
        again = np.r_[False, same] | np.r_[same, False] if len(place) else np.empty(0, bool)
        place, name = place[again], name[again]
        order = np.argsort(place)
        self.names.append((place[order], name[order]))
        return self.names[-1]

    def _look_up(self, level: int, at: np.ndarray) -> np.ndarray:
        """Names of a level's factors at places, -1 where the factor does not come back."""
        place, name = self.names[level]
        if not len(place):
            return np.full(len(at), -1, np.int64)
        k = np.minimum(np.searchsorted(place, at), len(place) - 1)
        return np.where(place[k] == at, name[k], -1)

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """Place and period, the first of neighbouring ones alike."""
        place = np.concatenate([p for p, _ in self.found])
        period = np.concatenate([g for _, g in self.found])
        order = np.lexsort((place, period))
        place, period = place[order], period[order]
        first = np.r_[True, (period[1:] != period[:-1]) | (place[1:] != place[:-1] + 1)] if len(place) else np.empty(0, bool)
        return place[first], period[first]

    def _reach(self, x: np.ndarray, y: np.ndarray, back: bool) -> np.ndarray:
        """How many words agree from ``x`` and ``y`` on (or before them), looking factors up longest first."""
        out = np.zeros(len(x), np.int64)
        n = len(self.text)
        for level in reversed(range(len(self.names))):
            size = 1 << level
            live = np.arange(len(x))
            while len(live):  # more than once on the longest level only
                u = x[live] - out[live] - size if back else x[live] + out[live]
                v = y[live] - out[live] - size if back else y[live] + out[live]
                inside = (u >= 0) & (v + size <= n)
                live, u, v = live[inside], u[inside], v[inside]
                # Factors of one name are of one text, so no text runs over into the next.
                first, second = self._look_up(level, u), self._look_up(level, v)
                live = live[(first == second) & (first >= 0)]
                out[live] += size
                if level < len(self.names) - 1:
                    break
        return out

    def runs(self, least: int, periods: int) -> np.ndarray:
        """Rows (text, start, length, period), starts counted over all texts; sorted, each run once."""
        place, period = self.proposals()
        start = place - self._reach(place, place + period, back=True)
        length = place + period + self._reach(place, place + period, back=False) - start
        keep = length >= np.maximum(least, periods * period)
        rows = np.stack([self.text[start], start, length, period], axis=1)[keep]
        return np.unique(rows, axis=0)


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST, periods: int = PERIODS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, sorted by start, then period."""
    number: dict[bytes, int] = {}
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    ids = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(ids) and sizes.max() >= least:
        used = sizes > 0
        at = np.flatnonzero(used)
        for text, start, length, period in Factors(ids, starts[used], int(sizes.max()) // periods).runs(least, periods).tolist():
            k = int(at[text])
            out[k].append((start - int(starts[k]), length, period))
    return out


def collapse(words: list[bytes], runs: Iterable[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, that is, all behind its first period, joined by one space."""
    runs = list(runs)
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def _slices(texts: Iterable[list[bytes]]) -> Iterator[list[list[bytes]]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > SLICE_WORDS:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """doc_id, ``runs`` (array of start, length, period, in words), ``best`` and ``collapsed`` of every row.

    Words are what ASCII white space separates. Runs are sorted by start, then period; ``best`` is
    the run with the greatest length / period (ties: smallest start, then period) and null without
    runs; ``collapsed`` is the text without repeated periods, its words joined by one space. A null,
    empty or blank text has no runs and collapses to the empty text. Null and repeated doc_ids are
    kept, a row is a text. Other columns are not read. Texts of a batch are worked on together,
    each whole.
    """
    if periods < 3:
        raise ValueError("the dictionary proposes the periods of runs that hold at least three")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, kept = [], []
            for part in _slices((v or b"").split() for v in values(batch.column(1))):
                runs = runs_of_texts(part, least, periods)
                found.extend(runs)
                kept.extend(collapse(words, r) for words, r in zip(part, runs, strict=True))
            best = [min(r, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if r else None for r in found]
            kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
            as_struct = [[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in found]
            best_struct = [None if b is None else dict(zip(("start", "length", "period"), b, strict=True)) for b in best]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(as_struct, pa.list_(kind)), pa.array(best_struct, kind), pa.array(kept, pa.binary())],
                ["doc_id", "runs", "best", "collapsed"])

    # As bytes: Python's bytes are split at ASCII white space, its strings at more than that.
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    out = rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, runs array<{RUN}>, best {RUN}, collapsed binary")
    return out.withColumn("collapsed", F.decode("collapsed", "UTF-8"))


def runs_line(runs: Column | str = "runs") -> Column:
    """``start,length,period`` of every run, each ended by a line feed."""
    return F.array_join(F.transform(runs, lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
