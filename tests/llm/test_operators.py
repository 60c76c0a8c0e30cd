"""Operators against plain Python versions on small tables with nulls, empty, long and repeated rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from genoloom.llm import exact_dedup, jaccard_join, licenses, line_dedup, mixing, packing, pii, quality, token_store, toxicity
from genoloom.llm.common import may_hold, settle, ship
from genoloom.llm.components import components
from genoloom.llm.tokens import PieceEncoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, label string, kept boolean"
PLAIN = "the quick brown fox jumps over a lazy dog near an old river bank".split()


def _words(rng, n, stems=PLAIN):
    return " ".join(rng.choice(stems) + rng.choice(["", "s", "ing", "ed", ","]) for _ in range(n))


def _rows():
    rng = random.Random(5)
    texts = [None, "", " \t\n", "one", "ONE", "a b c d", "Same Text Of five words", "same text of Five words", "same text of five words"]
    long = _words(rng, 6000)
    base = _words(rng, 80)
    texts += [long, base, base + " tail", base.replace("fox", "hen", 1), base.upper(), "x" * 30_000, "line that repeats here\n" * 4 + "end",
              "start\n  LINE that repeats here \nother", "É, é́ don't 1,000 \x1c<|endoftext|> 日本語, 😀!"]
    texts += ["mail a.b+c@x-y.example.com, or @@a@b..c 1.2.3.4 999.1.1.1 0001.2.3.4.5 4111 1111-1111 1111 +1 (788) 555-0037 +12 "
              "token = \"0c497b5014f705c0be648d68b816f88c209136eb\"",
              "Released under the MIT License and again the Apache\nLicense; GNU General Public License, version 3", "Licensed under CC BY-NC 4.0."]
    texts += [_words(rng, rng.randint(5, 60)) for _ in range(20)]
    rows = [(k, t, ["en", None, "de"][k % 3], ["b", "a", None, "c"][k % 4], 0, "r", "l", k % 2 == 0) for k, t in enumerate(texts)]
    rows += [rows[10], rows[10], (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (7, "another text", "en", "a", 1, "r", "l", True)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    return settle(spark.createDataFrame(_rows(), SCHEMA).repartition(3))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def _split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for frame in (pii.find_pii(empty), exact_dedup.classes(empty), exact_dedup.keep_last(empty),
                  line_dedup.apply_bitmaps(empty, line_dedup.keep_bitmaps(empty)), packing.pack_documents(empty),
                  toxicity.score_documents(empty, labels), jaccard_join.link_documents(empty).members, jaccard_join.keep_one(empty),
                  mixing.taken_words(empty), mixing.mix(empty), quality.verdicts(empty), quality.keep_good(empty), licenses.scan(empty)):
        assert frame.collect() == []


def test_rows_with_odd_columns_are_kept_whole(spark, docs):
    odd = docs.limit(20).drop("row", "label", "kept").withColumns({
        "_bits_0": F.lit(1), "_bitmap_1": F.lit(2), "_cell_a": F.lit(3), "row": F.lit("r"), "tkey": F.lit(4), "may": F.lit(True), "Shard": F.lit(5),
        "maps": F.array(F.create_map(F.lit("k"), F.lit(1)))}).withColumn("a.b", F.lit("dot")).withColumn("c`d", F.lit("tick"))
    for frame in (exact_dedup.keep_last(odd), jaccard_join.keep_one(odd), quality.keep_good(odd), mixing.mix(odd, placed=False)):
        assert frame.columns == odd.columns
        assert all(r["a.b"] == "dot" and r["c`d"] == "tick" and r["maps"] == [{"k": 1}] for r in frame.collect())
    assert [c for c in mixing.mix(odd).columns if c.lower() == "shard"] == ["shard"]
    kept = line_dedup.apply_bitmaps(odd, line_dedup.keep_bitmaps(odd))
    assert kept.columns == [*odd.columns, "kept_text", "n_lines", "n_dropped"] and kept.count() == 20


def test_pii_base_spans(docs):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    ip = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    card, phone = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def want(t):
        digits = lambda m: re.sub(r"\D", "", m.group())
        luhn = lambda d: sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
        found = [[m.span() for m in email.finditer(t)],
                 [m.span() for m in ip.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))],
                 [m.span() for m in card.finditer(t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))],
                 [m.span() for m in phone.finditer(t) if 8 <= len(digits(m)) <= 15]]
        return [len(f) for f in found], ",".join(f"{k}:{a}:{b}" for k, f in zip(pii.BASE_KINDS, found, strict=True) for a, b in f)

    got = collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_spans) for r in pii.find_pii(docs).collect())
    assert got == collections.Counter((r[0], *want(r[1] or "")[0], want(r[1] or "")[1]) for r in _rows())
    rng = random.Random(1)
    for _ in range(300):
        t = "".join(rng.choice("a1.@+-% ()47") for _ in range(60))
        assert ",".join(f"{pii.BASE_KINDS[k]}:{a}:{b}" for k, a, b in sorted(pii.base_spans(t))) == want(t)[1]


def test_pii_learns_reliabilities():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.4
    right = np.where(truth, 1, 2)  # three labelers that err alone: fewer would not tell their errors apart
    votes = collections.Counter(zip(*(np.where(rng.random(len(truth)) < err, 3 - right, right).tolist() for err in (0.1, 0.15, 0.3)), strict=True))
    table, share, post = pii.reliabilities({k: float(n) for k, n in votes.items()})
    assert abs(share - 0.4) < 0.05 and abs(table[1, 0, 1] - 0.9) < 0.05 and abs(table[1, 2, 1] - 0.7) < 0.05
    assert post[(1, 1, 2)] > 0.9 > 0.1 > post[(2, 2, 1)]


def test_exact_dedup(docs):
    rows = _rows()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[_lower(r[1])].append(r[0])
    got = exact_dedup.classes(docs).collect()
    assert len(got) == len(rows)
    keep = {hashlib.sha256(t.encode()).hexdigest(): (max((i for i in g if i is not None), default=None), len(g)) for t, g in groups.items()}
    assert all((r.keep_id, r.group_size) == keep[r.text_sha256] for r in got)
    assert collections.Counter(r.text_sha256 for r in got if r.kept) == collections.Counter(list(keep))
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    kept = exact_dedup.keep_last(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, _lower(r.text)) for r in kept.collect()) == sorted((i, t) for t, (i, _) in ((t, keep[hashlib.sha256(t.encode()).hexdigest()]) for t in groups))


def test_filter_has_no_false_negative(spark):
    keys = spark.range(0, 5000, 7).select(F.xxhash64("id").alias("tkey"))
    rows = spark.range(5000).select("id", F.xxhash64("id").alias("tkey"))
    got = {r.id: r.may for r in may_hold(rows, keys, "may").collect()}
    assert all(got[k] for k in range(0, 5000, 7)) and sum(got.values()) < 800


def test_line_dedup(docs):
    rows = [(r[0] if r[0] is not None else line_dedup.LAST, r[1] or "") for r in _rows()]
    first = {}
    key = lambda line: _lower(line.strip(" \t\n\x0b\f\r"))
    for i, t in rows:
        for line in t.split("\n"):
            first[key(line)] = min(i, first.get(key(line), i))
    want = []
    for i, t in rows:
        keep = [line for line in t.split("\n") if len(key(line)) < 10 or first[key(line)] == i]
        want.append((i, t.count("\n") + 1, t.count("\n") + 1 - len(keep), "\n".join(keep)))
    got = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    assert sorted((line_dedup.LAST if r.doc_id is None else r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()) == sorted(want)


def test_line_dedup_hot_key_over_ranges(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a line of everyone\nown line number "), "id").alias("text"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)).groupBy("n_dropped").count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert {r.n_dropped: r["count"] for r in got} == {0: 1, 1: 2999}


def _whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_piece_encoder_equals_whole_texts():
    rng = random.Random(3)
    texts = ["".join(rng.choice("aé,. '́ßÀÿ\x85\xa0 <|>1９x!?;:S’µª\nİΣ") for _ in range(40)) for _ in range(1500)]
    texts += ["<|endoftext|> <|ENDOFTEXT|>x", *(r[1] for r in _rows())]
    encoder = PieceEncoder(public_tokenizers.path("word_bpe_49k.json"), remembered=500)
    assert [x.tolist() for x in encoder.encode(texts)] == _whole_ids(texts)


def test_packing(docs):
    rows = _rows()
    ids = [x + [1] for x in _whole_ids(r[1] for r in rows)]
    want = collections.Counter()
    for r, x in zip(rows, ids, strict=True):
        for k in range(0, len(x), 4096):
            part = np.array(x[k : k + 4096], "<u4")
            want[(r[0], k // 4096, k, len(part), zlib.crc32(part.tobytes()))] += 1
    got = packing.pack_documents(docs).collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    _gapless(got, 4096)


def _gapless(got, capacity):
    by = collections.defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
        assert sum(n for _, n in spans) <= capacity
    return len(by)


def test_packed_sequences_hold_the_ids(docs):
    cut = settle(packing.pieces(docs, capacity=64, with_ids=True))
    packed = settle(packing.pack(cut, capacity=64, shard_bins=8))
    n = _gapless(packed.collect(), 64)
    parts = collections.defaultdict(list)
    for r in packed.orderBy("sequence_id", "offset").collect():
        parts[r.sequence_id].append(bytes(r.ids))
    made = packing.sequences(packed).collect()
    assert len(made) == n and all(bytes(r.ids) == b"".join(parts[r.sequence_id]) for r in made)


def test_local_search_empties_bins():
    capacity = 10
    lengths = [6, 3, 5, 4, 2]  # two full bins, but not as they lie
    better = packing.local_search([[0, 1], [2, 3], [4]], lengths, capacity)
    assert len(better) == 2 and sorted(p for b in better for p in b) == [0, 1, 2, 3, 4]
    rng = random.Random(2)
    for _ in range(60):
        lengths = [rng.randint(1, 60) for _ in range(40)]
        start = [[k] for k in range(40)]
        done = packing.local_search(start, lengths, 60)
        assert sorted(p for b in done for p in b) == list(range(40))
        assert all(sum(lengths[p] for p in b) <= 60 for b in done) and len(done) < 40
        assert len(packing.local_search(packing.best_fit(lengths, 60), lengths, 60)) <= len(packing.best_fit(lengths, 60))


def test_local_search_gains_at_every_step(monkeypatch):
    step, seen = packing.LocalSearch._step, []

    def checked(self, *args):
        before = int((self.fill**2).sum())
        step(self, *args)
        seen.append((int((self.fill**2).sum()) - before, int(self.fill.max())))

    monkeypatch.setattr(packing.LocalSearch, "_step", checked)
    rng = random.Random(7)
    kinds = dict.fromkeys(("moves", "swaps", "double_swaps"), 0)
    for case in range(120):
        top = rng.choice([20, 50, 99])
        lengths = [rng.randint(1, top) for _ in range(rng.randint(1, 250))] + [100] * (case % 3)
        search = packing.LocalSearch(packing.next_fit(lengths, 100), lengths, 100).run()
        assert sorted(p for b in search.bins for p in b) == list(range(len(lengths))) and search.live == len(search.bins)
        assert all(sum(lengths[p] for p in b) <= 100 for b in search.bins)
        best = len(packing.best_fit(lengths, 100))
        assert search.live <= (1.1 * best if top == 99 else best)  # with most pieces over half a bin it may end above
        own = len(seen)
        assert packing.search_shard(lengths, 100)[1].live <= best
        del seen[own:]
        for kind in kinds:
            kinds[kind] += getattr(search, kind)
    assert all(gain > 0 and most <= 100 for gain, most in seen) and len(seen) == sum(kinds.values())
    assert min(kinds.values()) > 0


def test_search_works_on_documents_and_is_no_worse_than_best_fit(spark):
    ship(spark)
    got = packing.pack_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    bins = _gapless(got, 4096)
    assert bins <= len(packing.best_fit([r.length for r in got], 4096))
    assert {r.bins_after for r in got} == {bins} and got[0].bins_before > bins
    assert got[0].moves > 0 and got[0].swaps > 0


def test_search_with_many_short_pieces():
    rng = random.Random(8)
    lengths = [rng.choice([1, 2, 3, 3, 7]) for _ in range(30_000)] + [4096] * 5 + [4000] * 5
    search = packing.LocalSearch(packing.next_fit(lengths, 4096), lengths, 4096).run()
    assert search.live == -(-sum(lengths) // 4096)


def test_toxicity_held_out(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(900):
        bad = k % 3 == 0
        words = [rng.choice(PLAIN) + rng.choice(["", "x", "y", "z"]) for _ in range(rng.randint(20, 60))]
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["VILE!", "rotten", "nasty,"])
        rows.append((k, " ".join(words), ["en", "de", None][k % 3 - 1]))
        labels.append((k, int(bad)))
    rows += [(None, None, None), (5, rows[5][1], "en"), (9_000, "", "xx")]
    ship(spark)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = toxicity.score_documents(docs, spark.createDataFrame([*labels, (1, None), (None, 1)], "doc_id long, toxic int")).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    unseen = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.predicted == (r.doc_id % 3 == 0) for r in unseen) > 0.95 * len(unseen)


def _component_truth(rows):
    sets = []
    for _, t in rows:
        w = _split(_lower(t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


def _chain(rng, n):
    """A chain of copies, each with a few words changed against the one before, and unrelated texts with a common passage."""
    words, passage = _words(rng, 120).split(), _words(rng, 40)
    rows = []
    for _ in range(n):
        rows.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return rows + [f"{passage} {' '.join(f'u{rng.randrange(10**6)}' for _ in range(rng.randint(4, 60)))}" for _ in range(n)]


def test_jaccard_join(docs, spark):
    got = jaccard_join.link_documents(docs).members.collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _component_truth([r[:2] for r in _rows()])
    rows = list(enumerate(_chain(random.Random(6), 60)))
    got = jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).members.collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _component_truth(rows)


def test_jaccard_join_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP", 3)
    rows = list(enumerate(_chain(random.Random(8), 40)))
    got = jaccard_join.link_documents(spark.createDataFrame(rows, "doc_id long, text string")).members.collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == _component_truth(rows)


def test_jaccard_keep_one(docs):
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    truth = _component_truth([r[:2] for r in _rows()])
    wordless = [r[0] for r in _rows() if not _split(r[1])]
    groups = {c for _, n, c in truth if n}
    got = [r.doc_id for r in kept.collect()]
    assert sorted(str(i) for i in got) == sorted(str(i) for i in [*groups, *wordless])


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    up = {k: k for e in edges for k in e}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    linked = {k for a, b in edges if a != b for k in (a, b)}
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for k in linked}


def test_mixing(docs):
    rows = [(r[0], r[3], len(_split(r[1]))) for r in _rows()]
    sizes = collections.Counter()
    for _, s, n in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:  # share what is left by weight, fix those above their cap, share again
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    got = mixing.taken_words(docs).collect()
    assert collections.Counter((r.doc_id, r["size"]) for r in got) == collections.Counter((i, n) for i, _, n in rows)
    again = mixing.taken_words(docs).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, again))
    assert {round(r.target, 6) for r in got} == {round(t, 6) for t in target.values()}
    by_target = collections.defaultdict(int)
    for r in got:
        by_target[round(r.target, 6)] += r.taken
        assert r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
    largest = max(n for *_, n in rows)
    assert all(abs(v - t) <= 3 * largest for t, v in by_target.items())
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "shard", "place"]
    assert sum(len(_split(r.text)) for r in mixed.collect()) == sum(r.taken for r in got)


def test_mixing_deals_disjoint_blocks(spark):
    rows = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
                                      (F.col("id") % 50).alias("size"))
    targets, plan = mixing.plan_mix(settle(rows))
    shards = mixing.shard_of_draws(plan, depth=2).collect()
    draws = plan.select(F.sum(F.col("times") + F.col("cut").isNotNull().cast("long"))).first()[0]
    assert len(shards) == draws == len({(r.source, r.block, r.draw) for r in shards})
    per_shard = collections.Counter(r.shard for r in shards)
    assert max(per_shard.values()) - min(per_shard.values()) <= 2 and set(per_shard) == {0, 1, 2, 3}
    taken = mixing.with_draws(rows, targets, plan).groupBy("source", "t.target").agg(F.sum(F.col("size") * F.col("draws")).alias("taken")).collect()
    assert all(abs(r.taken - r.target) <= 50 for r in taken)


def test_mixing_takes_what_the_tree_places(spark, monkeypatch):
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 9).cast("int")).alias("text"))
    placed = mixing.mix(rows).cache()
    shards = collections.Counter(r.shard for r in placed.select("shard").collect())
    assert len(shards) == 4 and max(shards.values()) < 2 * min(shards.values())
    by_doc = {r.doc_id: r.n for r in placed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    assert all(r.taken == r["size"] * by_doc.get(r.doc_id, 0) for r in mixing.taken_words(rows).collect())
    in_order = [r.doc_id for r in placed.orderBy("shard", "place").select("doc_id").collect()]
    written = mixing.mix(rows, placed=False)
    assert written.columns == rows.columns and [r.doc_id for r in written.collect()] == in_order
    place = mixing.shard_of_draws
    monkeypatch.setattr(mixing, "shard_of_draws", lambda *a, **b: place(*a, **b).where("shard = 0"))
    only = placed.where("shard = 0").select(F.sum(F.size(F.split(F.trim("text"), " ")) * (F.length("text") > 0).cast("int"))).first()[0]
    first = mixing.mix(rows).select("shard").distinct().collect()
    assert [r.shard for r in first] == [0] and only > 0
    assert sum(r.taken for r in mixing.taken_words(rows).collect()) < sum(r["size"] * by_doc.get(r.doc_id, 0) for r in mixing.measured(rows).collect())


def test_quality_base(docs):
    def want(t):
        t = t or ""
        w, lines = _split(t), [x for x in t.split("\n") if _split(x)]
        windows = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
        return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
                len(w) < 10 or 100 * len(covered) > 20 * len(w))

    got = quality.verdicts(docs).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == \
        collections.Counter((r[0], *want(r[1])) for r in _rows())
    assert not any(r.kept and r.base_failed for r in got)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in got)


def test_quality_bands_reject_the_odd(spark):
    ship(spark)
    rng = random.Random(11)
    rows = [(k, _words(rng, rng.randint(90, 300)), "en") for k in range(120)]
    rows += [(500, " ".join(f"{rng.choice(PLAIN)}{'※☃'[k % 2] * 9}" for k in range(200)), "en"), (501, " ".join("qzxj"[k % 4] * 1 + str(rng.random()) for k in range(200)), "en")]
    got = {r.doc_id: r.kept for r in quality.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[k] for k in range(120)) and not got[500] and not got[501]


def test_quality_judges_short_texts_and_small_languages(spark):
    """The same symbol junk goes whether it is short or long, in a usual language or one of its own."""
    ship(spark)
    rng = random.Random(13)

    def junk(n):
        return " ".join("".join(rng.choice("#$%&*|<>{}[]^~=+@!?") for _ in range(rng.randint(2, 4))) for _ in range(n))

    rows = [(k, _words(rng, rng.choice([12, 14, 20, 40, 150, 300])), "en") for k in range(400)]
    rows += [(1000 + k, junk(n), lang) for k, (n, lang) in enumerate([(12, "en"), (200, "en"), (12, "zz"), (200, "zz"), (25, None), (40, "yy")])]
    rows += [(2000 + k, _words(rng, 15 + k), "few") for k in range(10)]
    got = {r.doc_id: r for r in quality.verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(got[k].kept for k in range(400)) >= 396 and all(got[2000 + k].kept for k in range(10))
    assert not any(got[1000 + k].kept for k in range(6)) and not any(got[1000 + k].base_failed for k in range(6))


def test_scripts():
    found = [quality.script_of(t) for t in ("", "123 !?", "abc é", "Привет мир x", "日本語です", "日本語", "한국어", "αβγ", "שלום", "مرحبا", "नमस्ते")]
    assert found == ["none", "none", "latin", "cyrillic", "han", "han", "hangul", "greek", "hebrew", "arabic", "indic"]


def test_repeated_words_of_many_distinct():
    rng = random.Random(12)
    words = [str(rng.randrange(60_000)).encode() for _ in range(30_000)]
    words += words[100:120]
    windows = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    assert quality.repeated_words(words) == len({j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)})


def test_license_base_places(docs):
    def want(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t))
        at, labels = [], set()
        for phrase, label in licenses.BASE_PHRASES:
            p = phrase.split()
            here = [k for k in range(len(w)) if w[k : k + len(p)] == p]
            at += here
            labels |= {label} if here else set()
        return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))

    got = licenses.scan(docs).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == \
        collections.Counter((r[0], *want(r[1])) for r in _rows())
    assert {r.labels for r in got} == {"", "apache,gpl,mit", "cc-by-nc"}


def test_license_templates_are_found(spark):
    texts = [f"// start of file {k} {notice} and more text" for k, (_, notice, _) in enumerate(licenses.TEMPLATES)]
    texts += ["permission redistribution software license warranty without any order", "Redistribution and use in binary forms"]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for k, (label, *_) in enumerate(licenses.TEMPLATES):
        assert label in got[k].labels.split(","), (k, got[k])
        assert got[k].score > 0.5
    assert got[len(texts) - 1].labels == got[len(texts) - 2].labels == ""


def test_license_notices_of_one_file(spark):
    every = " ".join(notice for _, notice, _ in licenses.TEMPLATES)
    notice = {label: text for label, text, _ in licenses.TEMPLATES}
    rows = [(0, every), (1, notice["bsd"] + " " + notice["cc-by-nc"]), (2, " x ".join(notice[k] for k in ("cc-by", "bsd", "mpl"))),
            (3, " ".join(reversed(every.split()))), (4, notice["bsd"].replace("following conditions", "terms"))]
    rows += [(k, notice["cc-by-nc"] if k % 2 else "plain text") for k in range(10, 60)]  # frequent, so its words are not rare
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].labels == ",".join(sorted(notice)) and got[0].score == 1.0
    assert [got[k].labels for k in (1, 2, 3)] == ["bsd,cc-by-nc", "bsd,cc-by,mpl", ""]
    assert got[4].labels == "bsd" and 0 < got[4].score < 1
    assert all(got[k].labels == ("cc-by-nc" if k % 2 else "") for k in range(10, 60))


def test_token_store_round_trip(spark, docs, empty, tmp_path):
    rows = _rows()
    path = str(tmp_path / "store")
    token_store.write_store(docs, path)
    got = token_store.read_documents(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    ids = [np.array(x + [2], "<u4") for x in _whole_ids(r[1] for r in rows)]
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == \
        collections.Counter((r[0], len(x), zlib.crc32(x.tobytes())) for r, x in zip(rows, ids, strict=True))
    assert sorted(x.tolist() for x in token_store.read_ids(spark, path, 7)) == sorted(x.tolist() for r, x in zip(rows, ids, strict=True) if r[0] == 7)
    token_store.write_store(empty, str(tmp_path / "none"))
    assert token_store.read_documents(spark, str(tmp_path / "none")).collect() == []


def test_license_notices_reworded(spark):
    cases = [
        ("Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
         "provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
        ("Permission to use, copy, modify and distribute this software and its documentation for any purpose and without fee is "
         "hereby granted", ""),
        ("All pictures are licensed under CC BY 4.0.", "cc-by"), ("Text licensed under CC BY-SA 4.0", "cc-by-sa"),
        ("licensed under CC BY-NC 4.0", "cc-by-nc"), ("# SPDX-License-Identifier: BSD-3-Clause", "bsd"),
        ("// SPDX-License-Identifier: Apache-2.0 OR MIT", "apache,mit"), ("licence: Apache-2.0 OR MIT", "apache,mit"),
        ("license = \"MIT OR Apache-2.0\"", "apache,mit"), ("Licensed under the EUPL, version 1.2 or later", "eupl"),
        ("SPDX-License-Identifier: EUPL-1.2", "eupl"), ("spdx license", ""), ("we used apache 2 times, 0 or more", ""),
        ("Redistribution and use in source and binary forms, kindly and with or without modification, are permitted provided that "
         "the following conditions are met", "bsd"),
        ("Redistribution and the use in source and binary forms, with or without modification, are permitted", ""),
        ("licensed " * 500 + "under CC BY 4.0 " + "by 4 0 cc " * 500, "cc-by"),
        ("Released (as every part of this work) under the MIT License", "mit")]
    rows = [(k, t) for k, (t, _) in enumerate(cases)]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(cases[k][0][:60], got[k]) for k in got] == [(cases[k][0][:60], cases[k][1]) for k in got]


def test_license_verification_shuffles_no_words(spark, docs):
    plan = licenses.notices(licenses.licence_words(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Python" not in plan
