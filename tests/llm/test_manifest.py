"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoloom.llm import manifest
from genoloom.llm.common import ship

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp string, `a.b` int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, bump=0):
    doc_id, source, lang, n_chars, text = row[:5]
    n_chars = None if n_chars is None else n_chars + bump
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join(parts))


def tree(nodes):
    """Root and, per node, its path of (side, sibling)."""
    paths, owners = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, groups = [], []
        for k in range(0, len(nodes), 2):
            pair = nodes[k : k + 2]
            for o in owners[k]:
                paths[o].append(("R", pair[1]) if len(pair) == 2 else ("-", ""))
            if len(pair) == 2:
                for o in owners[k + 1]:
                    paths[o].append(("L", pair[0]))
            up.append(sha("".join(pair)))
            groups.append(sum(owners[k : k + 2], []))
        nodes, owners = up, groups
    return nodes[0], paths


def truth(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted(((r[0] is not None, r[0] or 0), leaf(r), r) for r in rows if r[2] == g) for g in langs]
    roots = [tree([x[1] for x in g]) for g in groups]
    root, tops = tree([r for r, _ in roots])
    out = []
    for g, (subroot, paths), top in zip(groups, roots, tops):
        for (_, own, row), path in zip(g, paths):
            path = path + top
            doc_id = row[0]
            node = leaf(row, int(doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0))
            for side, other in path:
                node = sha(node + other if side == "R" else other + node if side == "L" else node)
            out.append((doc_id, own, subroot, root, sha("".join(s for _, s in path)), node, node == root))
    return out


def check(spark, rows):
    ship(spark)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    built = manifest.build(frame, claimed={"n_chars": manifest.tampered_chars()})
    got = built.proofs.select("doc_id", "leaf", "subroot", "root", F.sha2("siblings", 256), "folded_root", "verified").collect()
    key = lambda r: tuple((v is not None, v) if v is not None else (False, 0) for v in r)
    assert sorted(map(key, map(tuple, got))) == sorted(map(key, truth(rows)))
    return built


def rows_of(rng, count, langs, ids):
    return [(ids(k), rng.choice([None, "", "s", "ü"]), rng.choice(langs), rng.choice([None, 0, 17]), rng.choice([None, "", "é 😀", "t" * 50])) for k in range(count)]


def test_sizes_around_the_borders_of_slot_arrays(spark):
    rng = random.Random(1)
    sizes = {"a": 1, "b": 2, "c": 3, "é": 1023, "z": 1024, None: 1025, "": 2049}
    ids = iter(rng.sample(range(-(1 << 40), 1 << 40), sum(sizes.values())))
    rows = [(next(ids), "s", lang, k, "t") for lang, n in sizes.items() for k in range(n)]
    built = check(spark, rows)
    assert {r.grp: r.leaves for r in built.subroots.collect()} == sizes
    assert built.root.count() == 1 and built.proofs.where("grp IS NULL").agg(F.max("place")).first()[0] == 1024


def test_repeated_and_null_ids_and_equal_rows(spark):
    rng = random.Random(2)
    rows = rows_of(rng, 500, ["de", None], lambda k: rng.choice([None, 5, 5, 6, 63, 64, 65_535, 65_536, -1, -64, (1 << 63) - 1, -(1 << 63)]))
    rows += [(k, "s", "de", 1, "t") for k in range(-70, 70)] + [rows[0]] * 40
    check(spark, rows)


def test_one_group_one_row_and_no_row(spark):
    built = check(spark, [(7, None, None, None, None)])
    only = built.proofs.first()
    assert only.leaf == only.subroot == only.root and only.sides == "" and only.verified
    none = manifest.build(spark.createDataFrame([], SCHEMA))
    assert none.proofs.collect() == [] and none.root.collect() == [] and none.subroots.collect() == [] and none.boxes.collect() == []


def test_many_groups_and_a_long_text(spark):
    rng = random.Random(3)
    rows = rows_of(rng, 60, [f"l{k}" for k in range(1300)], lambda k: k) + [(k, None, f"l{k}", 1, "x") for k in range(1300)] + [(9_999, "s", "l1", 5, "w " * 500_000)]
    built = check(spark, rows)
    assert built.proofs.where("verified").count() < built.proofs.count()


def test_bitmaps_round_trip_and_merge():
    rng = np.random.default_rng(4)
    for size in (1, 2, 500, 65_536):
        offsets = np.sort(rng.choice(65_536, size, replace=False)).astype(np.int64)
        counts = rng.integers(1, 4, size)
        back, n = manifest._counts(manifest._pack(offsets, counts))
        assert (back == offsets).all() and (n == counts).all()


def test_proofs_lead_to_the_root(spark):
    ship(spark)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), (F.col("id") % 3).cast("string").alias("lang"), F.lit(1).alias("n_chars"), F.lit("t").alias("text"))
    for r in manifest.build(docs).proofs.limit(200).collect():
        assert manifest.fold(r.leaf.encode(), r.sides, r.siblings.encode()).decode() == r.root and r.verified


@pytest.mark.parametrize("extra", ["place", "rank", "slots", "node", "_place"])
def test_columns_with_clashing_names(spark, extra):
    rows = [(k, "s", "en", 1, "t") for k in range(3)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], f"doc_id long, source string, lang string, n_chars long, text string, {extra} int")
    assert manifest.build(frame).proofs.count() == 3
