"""Byte-level BPE by speculation: greedy longest match proposes, adjacent pairs are verified, few words are merged.

A text is cut into words as the vocabulary's byte-level splitter does. For words not seen before:

1. *Speculate.* An Aho-Corasick automaton over the vocabulary takes the longest token at every place.
2. *Verify.* A word's proposal is its true encoding exactly if no merge ever crosses a border between
   two adjacent tokens. That depends on the two tokens alone, so numpy tests all distinct pairs of a
   batch at once: both tokens are taken apart in the reverse order of their making, and at each step
   the two pieces that meet at the border must not merge before the later one of them grew.
3. *Merge.* Only words with a pair that fails are merged by rank, which is the plain algorithm.

The test needs every merge to come after those that made its parts, every token to have one merge,
and every proposed token to be its own encoding; the first two are checked when the vocabulary is
loaded (else all words are merged by rank), and tokens that fail the third are not proposed.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.llm.tokens import held, slices, values

REMEMBERED = 400_000  # chunks, and as many words, a worker remembers; bounds its memory, not the result
# White space of Unicode (fixed values), as the byte-level splitter sees it.
SPACE = "\t-\r \x85\xa0  -     　"
# White space with what follows it up to the next white space: words never reach over such a chunk.
CHUNK = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
# Code points below this one (Latin, Greek, Cyrillic) are split here, by classes learnt from the
# library's own splitter; texts with others are given to that splitter.
NEAR = "\u0530"
NEVER = (1 << 63) - 1
MADE = (1 << 32) - 1  # a merge is kept as its rank, shifted, and the token it makes


def _byte_of_letter() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """The tokens of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, splitter = spec["model"], spec["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
        odd = (spec["normalizer"], splitter.get("add_prefix_space"), model.get("dropout"), model.get("continuing_subword_prefix"),
               model.get("end_of_word_suffix"), model.get("ignore_merges"), spec["post_processor"])
        if not plain or any(odd) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        self._letters = _byte_of_letter()
        self._merges = model["merges"]
        self._added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {self._bytes(t): i for t, i in model["vocab"].items()}
        size = max([*vocab.values(), *self._added.values()]) + 1
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = token
        for content, i in self._added.items():
            self.bytes_of[i] = content.encode()
        self._vocab = vocab

    def _bytes(self, letters: str) -> bytes:
        return bytes(map(self._letters.__getitem__, letters))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, added tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class SpeculativeBPE(Vocabulary):
    """A vocabulary with its automaton, its table of pairs and what a worker remembers of words."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import ahocorasick
        from tokenizers import Tokenizer

        super().__init__(path)
        self._splitter = Tokenizer.from_file(path).pre_tokenizer
        self._near = self._near_words()
        names = sorted(self._added, key=len, reverse=True)
        self._cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        vocab, size = self._vocab, len(self.bytes_of)
        self._single = [vocab[bytes([b])] for b in range(256)]
        self.width = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self._load_merges(self._merges, vocab, size)
        self._automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            if self._own[i]:
                self._automaton.add_word(token.decode("latin-1"), i)
        self._automaton.make_automaton()
        self._length = np.array([len(b) for b in self.bytes_of], np.int64)
        self._words: dict[bytes, bytes] = {}
        self._chunks: dict[str, bytes] = {}
        self._remembered = remembered
        self.merged = self.proposed = 0  # words that needed merging, and all new words

    def _near_words(self) -> re.Pattern:
        """The byte-level splitter's rule for code points below ``NEAR``.

        A letter or digit is what the library keeps in one piece with another one.
        """
        near, cut = list(map(chr, range(ord(NEAR)))), self._splitter.pre_tokenize_str
        letter, digit = ("".join(re.escape(c) for c in near if len(cut(probe + c)) == 1) for probe in "a1")
        return re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{digit}]+| ?[^{SPACE}{letter}{digit}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")

    def _load_merges(self, merges: list, vocab: dict[bytes, int], size: int) -> None:
        """Ranks and parts of tokens, the table of pairs, and which tokens are their own encoding."""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        left = np.array([vocab[self._bytes(a)] for a, _ in pairs], np.int64)
        right = np.array([vocab[self._bytes(b)] for _, b in pairs], np.int64)
        made = np.array([vocab[self._bytes(a + b)] for a, b in pairs], np.int64)
        self._rank = np.full(size, -1, np.int64)
        self._left, self._right = np.full((2, size), -1, np.int64)
        self._rank[made] = np.arange(len(pairs))
        self._left[made], self._right[made] = left, right
        self._size = size
        self._ranked = {(a, b): k << 32 | m for k, (a, b, m) in enumerate(zip(left.tolist(), right.tolist(), made.tolist(), strict=True))}
        keys = left * size + right
        order = np.argsort(keys)
        self._keys, self._key_ranks = np.r_[keys[order], NEVER], np.r_[order, NEVER]
        parts = np.maximum(self._rank[left], self._rank[right])
        self.sound = len(np.unique(made)) == len(pairs) and bool((parts < np.arange(len(pairs))).all())
        apart = np.ones(size, bool)
        apart[made] = self.stay_apart(left, right, np.arange(len(pairs)))
        self._own = np.zeros(size, bool)
        self._own[self._single] = True
        for a, b, m, ok in zip(left.tolist(), right.tolist(), made.tolist(), apart[made].tolist(), strict=True):
            self._own[m] = ok and self._own[a] and self._own[b]

    def stay_apart(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` next to each other stay as they are (up to rank ``before``).

        ``x`` is the last piece of ``a`` and ``y`` the first of ``b``, going back in time. Of two
        equal merges the left one comes first: a merge over the border needs a rank below that of
        ``a``'s undone merge, or at most that of ``b``'s.
        """
        out = np.ones(len(a), bool)
        x, y = a.copy(), b.copy()
        limit = np.full(len(a), NEVER, np.int64) if before is None else before.astype(np.int64)
        live = np.arange(len(a))
        while len(live):
            key = x * self._size + y
            at = np.searchsorted(self._keys, key)
            rank = np.where(self._keys[at] == key, self._key_ranks[at], NEVER)
            cross = rank < limit
            out[live[cross]] = False
            rx, ry = self._rank[x], self._rank[y]
            go = ~cross & ((rx >= 0) | (ry >= 0))
            live, x, y, rx, ry = live[go], x[go], y[go], rx[go], ry[go]
            undo_x = rx > ry
            limit = np.where(undo_x, rx, ry + 1)
            x, y = np.where(undo_x, self._right[x], x), np.where(undo_x, y, self._left[y])
        return out

    def merge(self, word: bytes) -> list[int]:
        """The plain algorithm: the pair of least rank, of equal ones the leftmost, until none is left."""
        ids = [self._single[b] for b in word]
        if len(ids) > 200:  # looking through all pairs for each merge would take too long
            return self._merge_heap(ids)
        get = self._ranked.get
        pairs = [get(p, NEVER) for p in zip(ids, ids[1:])]
        while pairs and (best := min(pairs)) < NEVER:
            k = pairs.index(best)
            ids[k : k + 2] = [best & MADE]
            del pairs[k]
            if k:
                pairs[k - 1] = get((ids[k - 1], ids[k]), NEVER)
            if k < len(pairs):
                pairs[k] = get((ids[k], ids[k + 1]), NEVER)
        return ids

    def _merge_heap(self, ids: list[int]) -> list[int]:
        after, prior = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        ranked, heap = self._ranked, []
        for k, pair in enumerate(zip(ids, ids[1:])):
            if pair in ranked:
                heap.append((ranked[pair], k, pair))
        heapq.heapify(heap)
        while heap:
            best, k, pair = heapq.heappop(heap)
            n = after[k]
            if n >= len(ids) or (ids[k], ids[n]) != pair:  # one of the two has been merged since
                continue
            ids[k], ids[n] = best & MADE, -1
            after[k] = m = after[n]
            for p, q in ((prior[k], k), (k, m)):
                if p >= 0 and q < len(ids) and (ids[p], ids[q]) in ranked:
                    heapq.heappush(heap, (ranked[ids[p], ids[q]], p, (ids[p], ids[q])))
            if m < len(ids):
                prior[m] = k
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct non-empty words, each as packed ``width`` integers."""
        self.proposed += len(words)
        if not words:
            return []
        if not self.sound:
            self.merged += len(words)
            return [np.array(self.merge(w), self.width).tobytes() for w in words]
        sizes = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(sizes + 1) - 1  # the place of the mark behind each word
        line = b"\n".join(words).decode("latin-1")
        mark = "Ā"  # no byte, so no token reaches over it
        found = self._automaton.iter_long("".join([line[e - n : e] + mark for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]))
        flat = np.array([v for pair in found for v in pair], np.int64).reshape(-1, 2)
        last, ids = flat[:, 0], flat[:, 1]
        owner = np.searchsorted(ends, last)
        whole = np.bincount(owner, self._length[ids], len(words)).astype(np.int64) == sizes
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, place = np.unique(ids[inner] * self._size + ids[inner + 1], return_inverse=True)
        apart = self.stay_apart(pairs // self._size, pairs % self._size)
        whole[owner[inner[~apart[place]]]] = False
        packed = ids.astype(self.width).tobytes()
        cut = np.searchsorted(owner, np.arange(len(words) + 1)) * self.width.itemsize
        out = [packed[s:e] for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
        failing = np.flatnonzero(~whole).tolist()
        self.merged += len(failing)
        for k in failing:
            out[k] = np.array(self.merge(words[k]), self.width).tobytes()
        return out

    def _split(self, chunk: str) -> list[bytes]:
        if chunk.isascii() or max(chunk) < NEAR:
            return [w.encode() for w in self._near.findall(chunk)]
        return [self._bytes(w) for w, _ in self._splitter.pre_tokenize_str(chunk)]

    def _learn(self, chunks: set[str]) -> None:
        fresh = list(filterfalse(self._chunks.__contains__, chunks))
        if len(self._chunks) + len(fresh) > self._remembered:
            self._chunks, fresh = {}, list(chunks)
        cuts = [self._split(c) for c in fresh]
        wanted = set().union(*cuts)
        if len(self._words) + len(wanted) > self._remembered:
            self._words = {}
        words = list(filterfalse(self._words.__contains__, wanted))
        self._words.update(zip(words, self.encode_words(words), strict=True))
        known = self._words.__getitem__
        self._chunks.update((c, b"".join(map(known, cut))) for c, cut in zip(fresh, cuts, strict=True))

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text, a null as the empty text; texts are taken in slices to bound memory."""
        for part in slices(texts):
            cuts = []
            for t in part:
                pieces = self._cut.split(t) if self._cut else [t]  # every second piece is an added token
                cuts.append([CHUNK.findall(p) if k % 2 == 0 else p for k, p in enumerate(pieces)])
            self._learn({c for cut in cuts for chunks in cut[::2] for c in chunks})
            known = self._chunks.__getitem__
            for cut in cuts:
                yield np.frombuffer(b"".join([
                    b"".join(map(known, piece)) if k % 2 == 0 else np.array([self._added[piece]], self.width).tobytes()
                    for k, piece in enumerate(cut)]), self.width)




def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``ids`` (array of int) of every row.

    Ids are those of the ``tokenizers`` library for the same file without special tokens added. A
    null or empty text has no ids; null and repeated doc_ids are kept as they are; a text that holds
    the name of an added token gets its id there, as in the library. Other columns are not read, so
    their names and types don't matter. Each row is worked on alone, whatever its length.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = held(SpeculativeBPE, path)
        for batch in batches:
            found = list(bpe.encode(values(batch.column(1))))
            ends = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found).astype(np.int32) if found else np.empty(0, np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decoded(ids: Column | str, path: str) -> Column:
    """The text of an array of ids, special tokens included; null for null."""
    def run(column: pd.Series) -> pd.Series:
        decode = held(Vocabulary, path).decode
        return pd.Series([None if i is None else decode(i.tolist()) for i in column], dtype=object)

    return F.pandas_udf(run, "string")(ids)
