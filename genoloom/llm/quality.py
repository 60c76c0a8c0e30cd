"""Quality rules with tokeniser fertility.

Two public vocabularies are laid over every word: byte-level BPE for many languages, and BPE pieces
with byte fallback. Per text they give characters per token, the share of byte-fallback pieces and
the entropy of the pieces. What is usual is learnt per language from the whole table: a text outside
its language's band is rejected, as is one that fails the fixed base rules. A band widens for short
texts by the sampling error of their few pieces, so every text is judged. A language with few texts
takes the band of its script, and a script with few texts that of the whole table.
"""

from __future__ import annotations

import base64
from itertools import filterfalse

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.llm.common import WHITE, quoted, settle
from genoloom.llm.tokens import held, slices

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SYMBOLS = "#*$%&|<>"
WINDOW = 5
REMEMBERED = 200_000  # words a worker remembers; bounds its memory, not the result
REACH = 4.0  # a band reaches this many quartile distances beyond the quartiles,
LEAST_REACH = 0.2  # and at least this share of the median;
LOW_ERRORS, HIGH_ERRORS = 3.0, 4.5  # to which so many sampling errors of the text's own pieces are added, as squares
STRAY_PIECES = 8.0  # fallback pieces (two characters) that any text may hold
ENTROPY_ERROR = 0.5  # of one piece, as a share of the most entropy
LEAST_TEXTS = 50  # a language or script with fewer usual texts has no band of its own

MEASURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_pieces long, "
            "chars_per_piece double, chars_per_token double, fallback_share double, piece_entropy double, piece_chars2 long, script string")
_NAMES = [part.split()[0] for part in MEASURES.split(", ")]
BANDED = ("chars_per_piece", "chars_per_token", "fallback_share", "piece_entropy")


class WordFertility:
    """Token counts of words, each looked up once per worker and remembered."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        import tiktoken

        with open(byte_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._bytes = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        ids = range(self._pieces.vocab_size())
        self._fallback = np.array([self._pieces.is_byte(i) for i in ids])
        self._chars2 = np.array([1 if self._pieces.is_byte(i) else len(self._pieces.id_to_piece(i).lstrip("\u2581")) ** 2 for i in ids])
        self._known: dict[bytes, tuple[int, bytes]] = {}

    def learn(self, words: set[bytes]) -> dict[bytes, tuple[int, bytes]]:
        """word -> (byte-level tokens, ids of the pieces), complete for ``words``."""
        fresh = list(filterfalse(self._known.__contains__, words))
        if len(self._known) + len(fresh) > REMEMBERED:
            self._known, fresh = {}, list(words)
        for at in range(0, len(fresh), 20_000):
            part = fresh[at : at + 20_000]
            plain = [w.decode() for w in part]
            pieces = self._pieces.encode(plain, num_threads=1)
            for w, s, p in zip(part, plain, pieces, strict=True):
                self._known[w] = (len(self._bytes.encode_ordinary(" " + s)), np.array(p, "<u2").tobytes())
        return self._known

    def is_fallback(self, ids: np.ndarray) -> np.ndarray:
        return self._fallback[ids]


    def squared_chars(self, ids: np.ndarray) -> int:
        """Sum of the squared lengths of pieces."""
        return int(self._chars2[ids].sum())


# First bytes of UTF-8 characters by script (fixed values); marks and digits belong to none.
SCRIPTS = {"latin": [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCA)], "greek": [0xCE, 0xCF], "cyrillic": [*range(0xD0, 0xD4)],
           "hebrew": [0xD6, 0xD7], "arabic": [*range(0xD8, 0xDC)], "indic": [0xE0], "kana": [0xE3], "han": [*range(0xE4, 0xEA)], "hangul": [*range(0xEA, 0xEE)]}
_SCRIPT_OF = np.full(256, len(SCRIPTS))
for _k, _lead in enumerate(SCRIPTS.values()):
    _SCRIPT_OF[_lead] = _k
_SCRIPT_NAMES = [*SCRIPTS]


def script_of(text: str) -> str:
    """The script most letters are of, ``none`` without letters; ties go to the first in ``SCRIPTS``."""
    if text.isascii():
        return "latin" if any(map(str.isalpha, text)) else "none"
    counts = np.bincount(_SCRIPT_OF[np.frombuffer(text.encode(), np.uint8)], minlength=len(SCRIPTS) + 1)[:-1]
    return _SCRIPT_NAMES[int(counts.argmax())] if counts.any() else "none"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a window of ``window`` words found twice or more, the first included.

    Windows are told apart exactly: words are numbered, then pairs, pairs of pairs and so on.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    code, most = ids[:n], len(numbers)
    for k in range(1, window):
        if most * len(numbers) >= 1 << 62:
            code = np.unique(code, return_inverse=True)[1]
            most = int(code.max()) + 1
        code = code * len(numbers) + ids[k : k + n]
        most *= len(numbers)
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    if len(counts) == n:
        return 0
    covered = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(counts[inverse] > 1)
    np.add.at(covered, at, 1)
    np.add.at(covered, at + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(lines) < 2:
        return 0
    lines = [line for line in lines if line.strip(WHITE)]
    return len(lines) - len(set(lines))


def _measure_text(text: str, words: list[bytes], known: dict, fertility: WordFertility) -> tuple:
    chars = len(text) - sum(map(text.count, WHITE))
    found = [known[w] for w in words]
    ids = np.frombuffer(b"".join([f[1] for f in found]), "<u2")
    tokens = sum(f[0] for f in found)
    shares = np.unique(ids, return_counts=True)[1] / max(len(ids), 1)
    entropy = float(-(shares * np.log2(shares)).sum()) / np.log2(len(ids)) if len(ids) > 1 else 0.0
    return (len(words), chars, sum(map(text.count, SYMBOLS)), repeated_lines(text), repeated_words(words), len(ids),
            chars / max(len(ids), 1), chars / max(tokens, 1), float(fertility.is_fallback(ids).mean()) if len(ids) else 0.0, entropy,
            fertility.squared_chars(ids), script_of(text))


def measures(text: Column, byte_path: str = BYTE_VOCABULARY, piece_path: str = PIECE_VOCABULARY) -> Column:
    """Struct of ``MEASURES`` of a whole text; a null text has no words. Entropy is a share of its most."""

    @F.pandas_udf(MEASURES)
    def of(texts: pd.Series) -> pd.DataFrame:
        fertility = held(WordFertility, byte_path, piece_path)
        rows = []
        for part in slices(texts):
            words = [t.encode().split() for t in part]
            known = fertility.learn(set().union(*words))
            rows += [_measure_text(t, w, known, fertility) for t, w in zip(part, words, strict=True)]
        return pd.DataFrame(rows, columns=_NAMES)

    return of(text)


def bands(measured: DataFrame, key: Column) -> DataFrame:
    """key, usual (a count) and, per banded measure, the quartiles, the reach beyond them and the
    sampling error of one piece, from all rows that pass the base rules, whatever their length."""
    usual = measured.where(~base_failed()).withColumn("key", key)
    cut = [F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000).alias(c) for c in BANDED]
    pieces = F.sum("n_pieces")
    found = usual.groupBy("key").agg(
        F.count(F.lit(1)).alias("usual"), *cut, (F.sum("word_chars") / pieces).alias("mean"), (F.sum("piece_chars2") / pieces).alias("mean2"),
        (F.sum(F.col("fallback_share") * F.col("n_pieces")) / pieces).alias("fallback"))
    per_piece = F.sqrt(F.greatest(F.col("mean2") - F.col("mean") ** 2, F.lit(0.0)))
    error = {"chars_per_piece": per_piece, "chars_per_token": per_piece * F.col("chars_per_token")[1] / F.greatest(F.col("chars_per_piece")[1], F.lit(0.05)),
             "fallback_share": F.sqrt(F.col("fallback") * (1 - F.col("fallback"))), "piece_entropy": F.lit(ENTROPY_ERROR)}
    out = [F.col("key"), F.col("usual")]
    for c in BANDED:
        low, mid, high = (F.col(c)[k] for k in range(3))
        reach = F.greatest(REACH * (high - low), LEAST_REACH * F.greatest(mid, F.lit(0.05)))
        out.append(F.struct(low.alias("low"), high.alias("high"), reach.alias("reach"), error[c].alias("error")).alias(c))
    return found.select(*out)


def base_failed() -> Column:
    """Fewer than 10 words, or more than a fifth of the words in repeated windows."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judged(measured: DataFrame) -> DataFrame:
    """Add base_failed, out_of_band and kept to settled measures (with a lang column)."""
    def named(level: str, key: Column) -> DataFrame:
        limits = bands(measured, key)
        return settle(limits.select(F.col("key").alias(f"_{level}"), *(F.when((F.col("usual") >= LEAST_TEXTS) | F.lit(level == "all"), F.col(c)).alias(f"_{level}_{c}") for c in BANDED)))

    rows = measured.join(named("lang", F.col("lang")), F.col("lang").eqNullSafe(F.col("_lang")), "left")
    for level, key in (("script", F.col("script")), ("all", F.lit(1))):  # a row for each script, and one
        rows = rows.join(F.broadcast(named(level, key)), key == F.col(f"_{level}"), "left")
    n = F.greatest(F.col("n_pieces"), F.lit(1))
    outside = F.lit(False)
    for c in BANDED:
        band = F.coalesce(*(F.col(f"_{level}_{c}") for level in ("lang", "script", "all")))
        low, high = (F.sqrt(band["reach"] ** 2 + (k * band["error"]) ** 2 / n) for k in (LOW_ERRORS, HIGH_ERRORS))
        strays = F.lit(STRAY_PIECES) / n if c == "fallback_share" else F.lit(0.0)
        outside = outside | F.coalesce((F.col(c) < band["low"] - low) | (F.col(c) > band["high"] + high + strays), F.lit(False))
    rows = rows.withColumn("base_failed", base_failed()).withColumn("out_of_band", outside)
    rows = rows.withColumn("kept", ~F.col("base_failed") & ~F.col("out_of_band"))
    return rows.select(*measured.columns, "base_failed", "out_of_band", "kept")


def verdicts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per input row: doc_id, lang, the measures, base_failed, out_of_band, kept.

    A null text has no words and fails; a null lang is a language of its own; a language with fewer than
    ``LEAST_TEXTS`` usual texts is judged by its script's band, such a script by that of all texts, and
    without any usual text nothing is out of band. Measures are settled, so texts are read once.
    """
    measured = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), measures(F.col(text)).alias("m"))
    return judged(settle(measured.select("doc_id", "lang", "m.*")))


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows that pass, all columns. Rows and measures are settled together, so no join by id is needed."""
    rows = settle(docs.select(F.struct(*quoted(docs.columns)).alias("row"), F.col(lang).alias("lang"), measures(F.col(text)).alias("m")))
    return judged(rows.select("row", "lang", "m.*")).where("kept").select("row.*")
