"""Events without a partner, and groups that are done, are not carried through further rounds."""

from __future__ import annotations

from genoloom.operators import components, dense


def _counted(monkeypatch, module):
    """Row counts of the frames that a module settles, in order."""
    counts, settle = [], module.settle

    def counting(df):
        written = settle(df)
        counts.append(written.count())
        return written

    monkeypatch.setattr(module, "settle", counting)
    return counts


def test_lone_events_are_settled_once(spark, monkeypatch):
    counts = _counted(monkeypatch, dense)
    far = [("1", k * 1_000_000, k * 1_000_000 + 50, f"{k}") for k in range(1, 101)]
    near = [("1", 10, 90, "x"), ("1", 10, 90, "x"), ("1", 60, 200, "y")]
    schema = "chrom string, start long, end long, id string"
    a = spark.createDataFrame(far + near, schema)
    b = spark.createDataFrame([(c, s + 400_000, e + 400_000, i) for c, s, e, i in far] + [("1", 40, 120, "z")], schema)
    found = dense.match_classes(a, b, ["chrom"], 2000)
    got = {(r.side, r.id, r.n_matches) for r in dense.match_counts(found).collect()}
    assert got == {("a", "x", 1), ("a", "y", 1), ("b", "z", 2)}
    assert found.members.where("id = 'x'").count() == 1
    assert sum(counts) < 203 + 30  # the first frame has every event


def test_classes_at_cell_edges_meet(spark):
    schema = "chrom string, start long, end long, id string"
    spots = [(s, s + 100) for base in (0, 4250, 8500, 2_125_000) for s in (base - 126, base - 1, base, base + 1, base + 125, base + 2000, base + 2124) if s >= 0]
    a = spark.createDataFrame([("1", s, e, str(k)) for k, (s, e) in enumerate(spots)], schema)
    b = spark.createDataFrame([("1", s + 1999, e - 1 + 1999, str(k)) for k, (s, e) in enumerate(spots)], schema)
    found = dense.match_counts(dense.match_classes(a, b, ["chrom"], 2000, strict=True)).collect()
    truth = {}
    for k, (s, e) in enumerate(spots):
        for m, (s2, e2) in enumerate(spots):
            if abs(s - s2 - 1999) < 2000 and abs(e - e2 - 1998) < 2000:
                truth["a", str(k)] = truth.get(("a", str(k)), 0) + 1
                truth["b", str(m)] = truth.get(("b", str(m)), 0) + 1
    assert {(r.side, r.id): r.n_matches for r in found} == truth


def test_done_groups_leave_the_rounds(spark, monkeypatch):
    chain = [(k, k + 1) for k in range(1000, 1040)]
    pairs = [(2 * k, 2 * k + 1) for k in range(1000, 1300)]
    links = spark.createDataFrame(chain + [(a + 10_000, b + 10_000) for a, b in pairs], "a long, b long")
    counts = _counted(monkeypatch, components)
    got = dict(components.connected(links).collect())
    assert got == {k: 1000 for k in range(1000, 1041)} | {n + 10_000: a + 10_000 for a, b in pairs for n in (a, b)}
    assert max(counts[2:]) <= len(chain)
