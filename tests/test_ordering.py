"""Row numbers over whole tables."""

import random

from pyspark.sql import functions as F

from genoloom.operators import reports as rp
from genoloom.operators.ordering import with_rank


def test_rank_of_one_hot_key_fills_several_tasks(spark):
    rows = spark.range(0, 40_000, 1, 6).select(F.lit("N/A").alias("cell"), F.col("id"))
    got = with_rank(rows, [F.col("cell")])
    assert got.where("rank <> id + 1").count() == 0 and got.count() == 40_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # would join ranges as small as these
    try:
        files = with_rank(rows, [F.col("cell")]).groupBy(F.col("_metadata.file_path")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(files) > 2 and max(r["count"] for r in files) < 20_000


def test_rank_order_ties_nulls_and_odd_columns(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, 1.5, -2.0, 7.0]), rng.choice(["x", None, "y"]), {"k": 1}, k) for k in range(300)]
    data += [data[0], data[0]]
    df = spark.createDataFrame(data, "`a.b` double, _place string, m map<string,int>, rank int").withColumnRenamed("rank", "no")
    got = sorted((r["rank"], r["a.b"], r["_place"], r["no"]) for r in with_rank(df, [F.desc("`a.b`"), F.col("_place")]).collect())
    want = sorted(((v, p, n) for v, p, _, n in data), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or "", r[2]))
    assert [g[1:] for g in got] == want and [g[0] for g in got] == list(range(1, len(data) + 1))
    again = with_rank(df.withColumn("rank", F.lit(9)), [F.col("no")])
    assert again.columns.count("rank") == 1 and again.agg(F.max("rank")).first()[0] == len(data)
    assert with_rank(df.limit(0), [F.col("no")]).collect() == []


def test_sort_by_text_column(spark):
    cells = [("9", "2", 5), ("10", "X", 1), ("N/A", "1", 7), (None, "1", 3), ("0", "3", 1), ("-1", "1", 1), ("text", "1", 2)]
    got = rp.sort_by_column(spark.createDataFrame(cells, "v string, chrom string, start long"), "v").collect()
    assert [(r.v, r["rank"]) for r in got] == [("10", 1), ("9", 2), ("0", 3), ("text", 4), (None, 5), ("N/A", 6), ("-1", 7)]


def test_order_statistics_by_splitters_are_exact(spark):
    from genoloom.operators.chunks import order_statistics

    draw = random.Random(5)
    rows = [(k, v) for k in "ab" for v in [draw.random() for _ in range(700)] + [0.25] * 400 + [1e9, -3.0, None]] + [("c", 7.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    n = F.col("n")
    ranks = {"low": F.lit(1), "mid": F.floor((n + 1) / 2), "top": n, "none": n + 1}
    want = {}
    for k in "abc":
        v = sorted(x for g, x in rows if g == k and x is not None)
        want[k] = (len(v), v[0], v[(len(v) + 1) // 2 - 1], v[-1], None)
    for rounds in (1, 2):
        got = order_statistics(df, ["k"], "v", ranks, rounds)
        assert {r.k: tuple(r)[1:] for r in got.collect()} == want
