"""Region tagging by a sweep, codons of called bases and prefix sums without keys, against brute force."""

import random

from pyspark.sql import functions as F

from genoloom.operators import accuracy as ac
from genoloom.operators import annotate as an
from genoloom.operators import chunks
from genoloom.operators.sweep import tag_overlaps

WIDE = chunks.CHUNK


def _spans(rng, n, reach):
    out = []
    for _ in range(n):
        start = rng.randrange(-50, 6 * WIDE)
        out.append((rng.choice(["1", "2", "X"]), rng.choice(["SNV", "DEL"]), start, start + rng.choice([0, 3, 400, reach])))
    return out


def test_tags_equal_brute_force(spark):
    rng = random.Random(7)
    loci = _spans(rng, 400, 2 * WIDE) + [("1", "SNV", None, 5), ("1", "SNV", 5, None), (None, "SNV", 1, 9), ("2", None, 1, 9)]
    wide = _spans(rng, 12, 3 * WIDE) + [("X", "DEL", 4 * WIDE, 1 << 62), ("1", "SNV", None, 9), (None, "SNV", 0, 1 << 40)]
    typed = _spans(rng, 60, 2 * WIDE)
    typed += [(c, t, e + 1, e + 1) for c, t, _, e in loci[:30] if e is not None]  # touching, not overlapping
    loci += loci[:20] + [("X", "SNV", 1 << 50, 1 << 50), ("X", "SNV", 1 << 61, 1 << 61), ("2", "SNV", 1 << 61, 1 << 61)]
    schema = "chrom string, var_type string, start long, `end` long"
    frame = spark.createDataFrame(loci, schema).withColumn("_pos", F.lit("own")).withColumn("a.b", F.lit(1))
    got = tag_overlaps(frame, {"region": (spark.createDataFrame(wide, schema), ()),
                               "hit": (spark.createDataFrame(typed, schema), ("var_type",))})
    assert got.columns == [*frame.columns, "region", "hit"]

    def any_hit(row, spans, keyed):
        c, t, s, e = row
        if None in (c, s, e) or (keyed and t is None):
            return False
        return any(c == c2 and (not keyed or t == t2) and None not in (s2, e2) and s2 <= e and e2 >= s for c2, t2, s2, e2 in spans)

    want = sorted((*map(str, row), any_hit(row, wide, False), any_hit(row, typed, True)) for row in loci)
    rows = got.collect()
    assert sorted((str(r.chrom), str(r.var_type), str(r.start), str(r.end), r.region, r.hit) for r in rows) == want
    assert {r["_pos"] for r in rows} == {"own"} and any(r.region for r in rows) and any(r.hit for r in rows)


def test_tags_with_empty_sides(spark):
    none = spark.createDataFrame([], "chrom string, start long, `end` long")
    one = spark.createDataFrame([("1", 3, 4)], none.schema)
    assert tag_overlaps(none, {"hit": (one, ())}).collect() == []
    assert [r.hit for r in tag_overlaps(one, {"hit": (none, ())}).collect()] == [False]
    assert tag_overlaps(one, {}).collect() == one.collect()


def test_truth_comparison_reads_calls_once(spark, tmp_path):
    path = str(tmp_path / "calls")
    spark.createDataFrame([("a", "1", "SNV", 5, 5), ("b", "1", "SNV", 5, 5), ("a", "1", "SNV", 5, 5), ("a", "1", "SNV", 50, 50),
                           ("b", "1", "DEL", 5, 9)], "caller string, chrom string, var_type string, start long, `end` long").write.parquet(path)
    calls = spark.read.parquet(path)
    regions = spark.createDataFrame([("1", 1, 20)], "chrom string, start long, `end` long")
    truth = spark.createDataFrame([("1", "SNV", 4, 5)], "chrom string, var_type string, start long, `end` long")
    figures = {}
    for shared in (None, True, False):
        out = ac.truth_comparison(calls, regions, truth, shared=shared)
        assert out._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
        figures[shared] = sorted((r.caller, r.var_type, r.in_regions, r.in_truth) for r in out.collect())
    assert figures[None] == [("a", "SNV", 2, 2), ("b", "DEL", 1, 0), ("b", "SNV", 1, 1)]
    assert figures[True] == [("a", "SNV", 2, 2), ("b", "SNV", 1, 1)]
    assert figures[False] == [("b", "DEL", 1, 0)]


def test_called_residues_are_the_tables_rows(spark):
    rng = random.Random(11)
    exons, bases = [], {}
    for g in range(30):
        at, strand = rng.randrange(1, 2000), rng.choice("+-")
        for k in range(rng.randrange(1, 7)):
            size = rng.choice([1, 1, 2, 3, 4, 7, 12])
            exons.append((str(g % 3), f"G{g}", strand, at, at + size - 1, f"e{k}"))
            for pos in range(at, at + size):
                if rng.random() < 0.97:
                    bases[(str(g % 3), pos)] = rng.choice("ACGT")
            at += size + rng.choice([1, 5, 40])
    table = spark.createDataFrame([(c, p, b) for (c, p), b in bases.items()], "chrom string, pos long, base string")
    frame = spark.createDataFrame(exons, "chrom string, gene string, strand string, start long, `end` long, exon string")
    sites = [key for key in bases if rng.random() < 0.5] + [("0", 10**7)]
    calls = spark.createDataFrame(sites + sites[:5], "chrom string, pos long")
    whole = an.residue_table(frame, table)
    want = whole.join(calls.distinct(), ["chrom", "pos"], "left_semi").select(whole.columns)
    got = an.called_residues(calls, frame, table)
    assert got.columns == whole.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 100


def test_running_sum_without_keys_has_no_single_window(spark, monkeypatch):
    monkeypatch.setattr(chunks, "TREE", 4)
    values = spark.range(2000).select((F.col("id") * 37 % 5003).alias("v"), (F.col("id") % 11).alias("w"))
    got = chunks.running_sum(values, [], [F.desc("v")], -F.floor(F.col("v") / 16), "w", "total")
    assert "SinglePartition" not in got.select("v", "total")._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    total, want = 0, {}
    for v, w in sorted(((i * 37 % 5003, i % 11) for i in range(2000)), reverse=True):
        total += w
        want[v] = total
    assert {r.v: r.total for r in got.collect()} == want
