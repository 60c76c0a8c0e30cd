"""Personal data by weak supervision.

Patterns propose candidate spans; labelers of three sorts (regular expressions, gazetteers, context
cues) vote on each: yes, no or nothing. Expectation-maximisation over the counts of vote patterns
estimates how reliable every labeler is, kind by kind, and gives each pattern a probability. On
these soft labels a logistic classifier over votes and span features is trained; it decides which
spans are reported besides the base ones, which always are.

Only counts of (kind, votes, features) leave the executors: their number is fixed by the code
(``MOST_KEYS``), not by the data.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.llm.common import settle, whole

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
LABELERS = ("regex", "gazetteer", "context")
CONTEXT = 32  # characters before a span in which cue words count
ACCEPT = 0.5
EM_ROUNDS = 500

# Small gazetteers and cue words.
TOP_DOMAINS = frozenset("com org net edu gov io co uk de fr es it nl ch at eu us ca au jp info biz".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55",
                 "61", "81", "82", "86", "90", "91")
CARD_STARTS = ("34", "37", "36", "4", "51", "52", "53", "54", "55", "2221", "2720", "6011", "65", "62", "35")
SECRET_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "sk-", "sk_live_", "xox", "eyJ", "AIza", "hf_")
CUES = {
    "email": ("mail", "contact", "write to", "correo", "courriel", "kontakt"),
    "ip": ("ip", "host", "server", "address", "addr", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "anruf", "telefon"),
    "secret": ("token", "key", "secret", "password", "passwd", "pwd", "auth", "bearer", "credential"),
}

# The base patterns.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

# Further candidates: obfuscated addresses, telephone numbers without a plus sign, long keys.
OBFUSCATED = re.compile(r"\b[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot |\.) ?[A-Za-z0-9-]{2,63}){1,4}\b")
NATIONAL = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
KEY = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]{0,64}[0-9])[A-Za-z0-9_-]{20,}+")

_DIGITS = re.compile(r"[0-9]+")
_SPAN = "array<struct<kind: int, start: int, end: int, base: boolean, key: int>>"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of the base kinds, each leftmost and non-overlapping, in time linear in the text.

    An address is found from its @: nothing before the @ but the run of allowed characters can be
    its local part. The other patterns take whole runs, so a failed one is not tried again inside.
    """
    at, free = text.find("@"), 0
    while at >= 0:
        before = text[free:at]
        local = len(before) - len(before.rstrip(LOCAL))
        m = DOMAIN.match(text, at + 1) if local else None
        free = at + 1
        if m:
            yield 0, at - local, m.end()
            free = m.end()
        at = text.find("@", free)
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
            yield 1, m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := m.group().replace(" ", "").replace("-", "")) <= 19 and luhn(d):
            yield 2, m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum(len(d) for d in _DIGITS.findall(m.group())) <= 15:
                yield 3, m.start(), m.end()


def loose_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of candidates beyond the base kinds."""
    if " at " in text or "(at)" in text or "[at]" in text:
        yield from ((0, m.start(), m.end()) for m in OBFUSCATED.finditer(text))
    yield from ((2, m.start(), m.end()) for m in CARD.finditer(text) if 13 <= sum(c.isdigit() for c in m.group()) <= 19)
    yield from ((3, m.start(), m.end()) for m in NATIONAL.finditer(text))
    yield from ((4, m.start(), m.end()) for m in KEY.finditer(text))


def _vote(yes: bool, no: bool = False) -> int:
    return 1 if yes else 2 if no else 0


def votes(kind: int, span: str, before: str, base: bool) -> tuple[int, int, int]:
    """Votes of the labelers: 0 none, 1 yes, 2 no."""
    digits = "".join(_DIGITS.findall(span))
    if kind == 0:
        pattern = _vote(base, "(at)" not in span and "[at]" not in span and " dot " not in span)
        gazetteer = _vote(span.rsplit(".", 1)[-1].strip().lower() in TOP_DOMAINS or span.rsplit(" ", 1)[-1].lower() in TOP_DOMAINS, True)
    elif kind == 1:
        pattern = _vote(base)
        gazetteer = _vote(False, span.startswith(("0.", "127.", "255.")))
    elif kind == 2:
        pattern = _vote(base or luhn(digits), True)
        gazetteer = _vote(digits.startswith(CARD_STARTS), True)
    elif kind == 3:
        pattern = _vote(base, digits[:1] in ("0", "1"))
        gazetteer = _vote(digits.startswith(CALLING_CODES) if base else "(" in span)
    else:
        shaped = len(span) in (32, 40, 64) and not re.search(r"[^0-9a-fA-F]", span)
        pattern = _vote(shaped, len(digits) < 4 or len(digits) == len(span))
        gazetteer = _vote(span.startswith(SECRET_STARTS))
    low = before.lower()
    context = _vote(any(c in low for c in CUES[KINDS[kind]]), any(c in low for k, cs in CUES.items() if k != KINDS[kind] for c in cs if len(c) > 3))
    return pattern, gazetteer, context


def features(kind: int, span: str, before: str) -> tuple[int, int, int]:
    """Length class 0-3, share of digits 0-3, and whether the span is quoted or assigned."""
    n = len(span)
    length = (n > 12) + (n > 20) + (n > 36)
    share = min(3, 4 * sum(c.isdigit() for c in span) // n)
    return length, share, int(before.rstrip(" \"'")[-1:] in ("=", ":") or before[-1:] in ("\"", "'"))


MOST_KEYS = len(KINDS) * 2 * 27 * 32


def encode_key(kind: int, base: bool, vote: tuple, feature: tuple) -> int:
    key = kind * 2 + base
    for v in vote:
        key = key * 3 + v
    return ((key * 4 + feature[0]) * 4 + feature[1]) * 2 + feature[2]


def decode_key(key: int) -> tuple[int, int, tuple, tuple]:
    key, quoted = divmod(key, 2)
    key, share = divmod(key, 4)
    key, length = divmod(key, 4)
    vote = []
    for _ in LABELERS:
        key, v = divmod(key, 3)
        vote.append(v)
    return key // 2, key % 2, tuple(reversed(vote)), (length, share, quoted)


def spans_of(text: str) -> list[dict]:
    """All candidates of a text with their vote and feature key; base spans first, no loose one over them."""
    base = sorted(base_spans(text))
    taken = sorted((s, e) for _, s, e in base)
    free = []
    last = -1
    for kind, s, e in sorted(loose_spans(text), key=lambda x: (x[1], -x[2], x[0])):
        while taken and taken[0][1] <= s:
            taken.pop(0)
        if s < last or (taken and taken[0][0] < e):
            continue
        free.append((kind, s, e))
        last = e
    out = []
    for is_base, found in ((True, base), (False, free)):
        for kind, s, e in found:
            span, before = text[s:e], text[max(0, s - CONTEXT) : s]
            out.append({"kind": kind, "start": s, "end": e, "base": is_base,
                        "key": encode_key(kind, is_base, votes(kind, span, before, is_base), features(kind, span, before))})
    return out


_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("key", pa.int32())]))


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans of every row, settled. A null text is empty and has none."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [spans_of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _ARROW)], names=["doc_id", "spans"])

    return settle(docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text")).mapInArrow(
        find, f"doc_id long, spans {_SPAN}"))


def reliabilities(patterns: dict[tuple, float], rounds: int = EM_ROUNDS) -> tuple[np.ndarray, float, dict[tuple, float]]:
    """EM for two hidden classes: P(vote | class) per labeler, the share of class 1, P(class 1 | pattern).

    ``patterns`` counts vote tuples. The start takes the majority of votes; counts are smoothed by one
    vote per cell, and P(yes | class 1) starts above P(yes | class 0), which keeps the classes named.
    """
    votes_of = np.array(list(patterns), int)
    n = np.array(list(patterns.values()), float)
    lean = (votes_of == 1).sum(1) - (votes_of == 2).sum(1)
    post = 1 / (1 + np.exp(-1.5 * lean))
    table = np.zeros((2, votes_of.shape[1], 3))
    for _ in range(rounds):
        share = ((n * post).sum() + 1) / (n.sum() + 2)
        for c, w in enumerate((n * (1 - post), n * post)):
            for k in range(votes_of.shape[1]):
                table[c, k] = np.bincount(votes_of[:, k], w, 3) + 1
            table[c] /= table[c].sum(1, keepdims=True)
        like = [np.log(table[c, np.arange(votes_of.shape[1]), votes_of]).sum(1) for c in (0, 1)]
        post = 1 / (1 + (1 - share) / share * np.exp(np.clip(like[0] - like[1], -50, 50)))
    return table, share, dict(zip(patterns, post.tolist(), strict=True))


def _design(keys: list[int]) -> np.ndarray:
    rows = []
    for key in keys:
        kind, base, vote, (length, share, quoted) = decode_key(key)
        row = [1.0] + [float(kind == k) for k in range(len(KINDS))] + [float(base)]
        row += [float(v == s) for v in vote for s in (1, 2)]
        row += [float(length == k) for k in range(4)] + [float(share == k) for k in range(4)] + [float(quoted)]
        rows.append(row)
    return np.array(rows).reshape(len(keys), -1)


def train_classifier(counts: dict[int, int], rounds: int = 400) -> dict[int, float]:
    """P(personal data) of every key: EM per kind on votes, then logistic regression on votes and features."""
    if not counts:
        return {}
    soft: dict[int, float] = {}
    for kind in range(len(KINDS)):
        own = {k: n for k, n in counts.items() if decode_key(k)[0] == kind}
        patterns: dict[tuple, float] = {}
        for k, n in own.items():
            patterns[decode_key(k)[2]] = patterns.get(decode_key(k)[2], 0) + n
        if patterns:
            posterior = reliabilities(patterns)[2]
            soft |= {k: posterior[decode_key(k)[2]] for k in own}
    keys = sorted(counts)
    x, y = _design(keys), np.array([soft[k] for k in keys])
    w = np.array([counts[k] for k in keys], float)
    w /= w.sum()
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (w * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + 1e-4 * np.eye(len(beta))
        step = np.linalg.solve(hessian, x.T @ (w * (y - p)) - 1e-4 * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return dict(zip(keys, (1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))).tolist(), strict=True))


def _text_of(spans: Column) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"].alias("k"), s["start"].alias("s"), s["end"].alias("e"))))
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["s"].cast("string"), s["e"].cast("string"))), ",")


def find_pii(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_spans, spans.

    Offsets are code points, ends exclusive. Spans are the base ones and the candidates that the
    trained classifier gives at least ``accept``. Texts are read once; keys are counted over all rows.
    """
    found = candidates(docs, doc_id, text)
    keys = found.select(F.explode("spans").alias("s")).groupBy("s.key").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["key"]: r["n"] for r in keys.collect()}  # at most MOST_KEYS rows
    accepted = [k for k, p in train_classifier(counts).items() if p >= accept]
    reported = F.filter("spans", lambda s: s["base"] | (s["key"].isin(accepted) if accepted else F.lit(False)))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    number = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(BASE_KINDS)]
    return found.select("doc_id", *number, _text_of(base).alias("base_spans"), _text_of(reported).alias("spans"))
