"""The registered text queries against their SQL, and the pipeline against its stages done plainly."""

import os

import pytest
from compare import compare, connect

import corpus_pipeline
from genoloom.llm import queries
from genoloom.llm.common import settle, ship

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("key", sorted(queries.oracles()))
def test_query_matches_sql(spark, key):
    _, problem = compare(queries.queries()[key](spark, SF), connect(SF), queries.oracles()[key])
    assert problem is None, problem


def test_every_operator_has_a_query():
    assert [k.split("_")[0] for k in queries.queries()] == [f"op{n}" for n in range(1, 14)]


def test_pipeline_stages(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = settle(stage(spark, docs, SF))
        assert out.columns == docs.columns
        kept[name], docs = out.collect(), out
    passed = {r.doc_id: r.text for r in kept["quality rules"]}
    last = {}
    for i, t in passed.items():
        key = t.translate({c: c + 32 for c in range(65, 91)})
        last[key] = max(i, last.get(key, i))
    assert sorted(r.doc_id for r in kept["exact dedup"]) == sorted(last.values())
    from test_operators import _component_truth

    truth = _component_truth([(r.doc_id, r.text) for r in kept["exact dedup"]])
    assert sorted(r.doc_id for r in kept["n-gram jaccard join"]) == sorted({c for _, _, c in truth})
    mixed = [r.doc_id for r in kept["mixing sources to target weights"]]
    assert set(mixed) <= {r.doc_id for r in kept["n-gram jaccard join"]} and max(mixed.count(i) for i in set(mixed)) <= 3
    packed = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in packed if r.piece == 0) == sorted(mixed)
