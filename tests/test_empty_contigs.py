"""Assembly figures of sequences some of which are empty or missing, against the query's SQL."""

from __future__ import annotations

import duckdb
import pytest

from compare import compare
from genoloom.operators import sequences as sq
from genoloom.plans import catalogue


@pytest.mark.parametrize("texts, n50, l50", [
    (["", "ACGTACGT", "NNACGTAC", "ACnT", "", "A"], 8, 1),
    (["", "AC", "ACGT" * 600, "G" * 1024, "G" * 1023], 2400, 0),
    ([None, "", "AC", "AC", ""], 2, 0),
    (["", ""], 0, 0),
    (["", None], 0, 0),
    ([None, None], None, None)])
def test_empty_contigs_are_counted(spark, texts, n50, l50):
    got = sq.assembly_stats(spark.createDataFrame([(t,) for t in texts], "text string"), "text")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?)", [(t,) for t in texts])
    _, problem = compare(got, con, catalogue.oracles()["seq_1"])
    assert problem is None, problem
    row = got.first()
    assert (row["contigs"], row["n50"], row["l50"]) == (len(texts), n50, l50)
