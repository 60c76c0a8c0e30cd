"""Runs of words against a quadratic version, planted tails against the rule."""

import hashlib
import os
import random
import zlib

import pytest

from genoloom.llm import queries, runs
from genoloom.llm.common import ship

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def brute(words, least=24, periods=3):
    n, out = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            e = i + q
            if i > s and e - s >= max(least, periods * q) and not any(all(words[j] == words[j + d] for j in range(s, e - d)) for d in range(1, q)):
                out.append((s, e - s, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest_row(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    found = brute(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if found else (None, None, None)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    sha = lambda t: hashlib.sha256(t).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def texts(seed, count):
    rng, out = random.Random(seed), []
    for _ in range(count):
        letters = rng.choice([1, 2, 2, 3, 5, 40])
        words = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randrange(4)):
            block = [b"%d" % rng.randrange(letters + 1) for _ in range(rng.randint(1, 30))]
            words += (block * 9)[: rng.randint(1, 250)] + [b"%d" % rng.randrange(50) for _ in range(rng.randint(0, 9))]
        out.append(words)
    return out


@pytest.mark.parametrize("least,periods", [(24, 3), (3, 3), (10, 4)])
def test_runs_of_texts(least, periods):
    some = texts(least, 250)
    want = [brute(w, least, periods) for w in some]
    assert sum(map(len, want)) > 100
    assert runs.runs_of_texts(some, least, periods) == want
    assert [runs.runs_of_texts([w], least, periods)[0] for w in some] == want


def test_runs_side_by_side_in_neighbouring_texts():
    a, b = [b"x"] * 30, [b"x"] * 40
    assert runs.runs_of_texts([a, [], b, [b"y"]]) == [[(0, 30, 1)], [], [(0, 40, 1)], []]
    fib, last = [b"a"], [b"b"]
    while len(fib) < 2000:  # no factor of a Fibonacci word comes four times in a row
        fib, last = fib + last, fib
    assert runs.runs_of_texts([fib[:800]], 3, 3)[0] == brute(fib[:800], 3, 3) != []
    assert runs.runs_of_texts([fib], 4, 4) == [[]]


def test_query_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = [tuple(r) for r in queries.op11_runs(spark, SF).collect()]
    want = [digest_row(r.doc_id, r.text) for r in docs]
    assert sum(w[1] for w in want) > 10
    assert sorted(got) == sorted(want)


def test_odd_rows(spark):
    ship(spark)
    long = " ".join(["a b c d e f g"] * 20_000)
    data = [(None, "a " * 30, 1, 2), (1, None, 1, 2), (2, "", 1, 2), (3, " \t\n\x0b", 1, 2), (4, "a\x1cb\xa0c " * 30, 1, 2), (5, long, 1, 2),
            (5, long, 1, 2), (6, "A a " * 30, None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, runs int, `best.x` int")
    rows = {}
    for r in runs.find_runs(df).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert [tuple(x) for x in rows[None][0].runs] == [(0, 30, 1)] and rows[None][0].collapsed == "a"
    assert all(rows[k][0].runs == [] and rows[k][0].best is None and rows[k][0].collapsed == "" for k in (1, 2, 3))
    assert tuple(rows[4][0].best) == (0, 30, 1)
    assert len(rows[5]) == 2 and tuple(rows[5][0].best) == (0, 140_000, 7) and rows[5][1].collapsed == "a b c d e f g"
    assert tuple(rows[6][0].best) == (0, 60, 2)
    kept = {r.doc_id: r for r in runs.plant_repeats(df.where("doc_id IS NULL OR doc_id > 5")).collect()}
    assert kept[None].text == "a " * 30 and kept[6].runs is None
    assert runs.find_runs(runs.plant_repeats(df.limit(0))).collect() == []
    with pytest.raises(ValueError, match="at least three"):
        runs.find_runs(df, periods=2)
