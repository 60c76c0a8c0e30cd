"""Connected groups and dense breakpoints."""

import random

import pytest
from pyspark.sql import functions as F

from genoloom.operators import components, dense
from genoloom.operators import structural as sv

CALL = "sv_id string, chr1 string, coord1 long, chr2 string, coord2 long, sv_type string, caller string"


def plain_components(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    return sorted((x, root(x)) for x in up)


def test_components_of_random_links(spark):
    rng = random.Random(1)
    pairs = [(f"n{rng.randrange(400)}", f"n{rng.randrange(400)}") for _ in range(260)] + [("hub", f"n{k}") for k in range(0, 400, 7)]
    got = components.connected(spark.createDataFrame([*pairs, (None, "n1"), ("n1", None)], "a string, b string"))
    assert sorted(map(tuple, got.collect())) == [r for r in plain_components([p for p in pairs if p[0] != p[1]])]
    assert components.connected(spark.createDataFrame([("x", "x")], "a string, b string")).collect() == []


def test_components_of_a_long_chain(spark):
    order = list(range(10_000))
    random.Random(2).shuffle(order)
    chain = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    got = components.connected(chain)
    assert got.count() == 10_000 and got.where("label <> 0").count() == 0


def _calls(rng, n, spread, kinds=("del", "tra")):
    out = []
    for k in range(n):
        kind = rng.choice(kinds)
        start = 5000 + rng.randrange(spread)
        c2 = rng.choice("12") if kind == "tra" else "1"
        out.append((f"v{k}", "1", start, c2, start + rng.randrange(spread), kind, rng.choice(["c1", "c2"])))
    return out


@pytest.mark.parametrize("distance,spread", [(1, 3), (7, 30), (100, 400), (300, 5000)])
def test_classes_hold_every_pair_once(spark, distance, spread):
    calls = spark.createDataFrame(_calls(random.Random(distance), 160, spread), CALL)
    want = sorted((r.sv_id, r.other) for r in sv.caller_pairs(calls, "c1", "c2", distance).collect())
    want_tra = sorted((r.sv_id, r.other) for r in sv.translocation_pairs(calls, "c1", "c2", distance).collect())
    for found, pairs in zip(sv.caller_classes(calls, "c1", "c2", distance), (want, want_tra), strict=True):
        a = found.members.select(F.col("class").alias("class_a"), F.col("id").alias("a"))
        b = found.members.select(F.col("class").alias("class_b"), F.col("id").alias("b"))
        assert sorted(map(tuple, found.links.join(a, "class_a").join(b, "class_b").select("a", "b").collect())) == pairs
    got = sorted(map(tuple, sv.connected_events(calls, "c1", "c2", distance).collect()))
    pairs = sv.caller_pairs(calls, "c1", "c2", distance), sv.translocation_pairs(calls, "c1", "c2", distance)
    assert got == sorted(map(tuple, sv.group_events(*pairs, connected=True).collect())) and got


def test_hot_breakpoint_is_linear(spark):
    n = 100_000
    calls = spark.range(n).select(
        F.concat(F.lit("v"), F.col("id").cast("string")).alias("sv_id"), F.lit("1").alias("chr1"), (10_000 + F.col("id") % 60).alias("coord1"),
        F.lit("1").alias("chr2"), (90_000 + F.col("id") % 70).alias("coord2"), F.lit("del").alias("sv_type"),
        F.when(F.col("id") % 3 == 0, "c1").otherwise("c2").alias("caller"))
    found, _ = sv.caller_classes(calls, "c1", "c2", 2000)
    assert found.links.count() <= 16 and found.members.count() == n
    counts = dense.match_counts(found).agg(F.sum("n_matches")).first()[0]
    ones = -(-n // 3)
    assert counts == 2 * ones * (n - ones)
    assert sv.connected_events(calls, "c1", "c2", 2000).groupBy("event_id").count().collect()[0]["count"] == n


def test_ids_with_commas_stay_whole(spark):
    pairs = spark.createDataFrame([("del", "x", "a,b"), ("del", "y", "a"), ("del", "y", "b")], "sv_type string, sv_id string, other string")
    got = {r.sv_id: r.event_id for r in sv.group_events(pairs).collect()}
    assert set(got) == {"x", "a,b", "y", "a", "b"} and got["x"] == got["a,b"] != got["y"] == got["a"] == got["b"]
