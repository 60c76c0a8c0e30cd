"""Family queries multiply rows of ``part`` only after they are dealt out."""

from __future__ import annotations

import pytest

import genoloom.plans.catalogue  # noqa: F401
from genoloom.plans import registry
from genoloom.plans.registry import Tables, spark_queries


@pytest.mark.parametrize("name", ["ped_4", "ped_11", "ped_14", "ovl_15"])
def test_rows_of_part_are_dealt_out(spark, capsys, name):
    capsys.readouterr()
    spark_queries()[name](spark, "/root/testdata/sf0.001").explain()
    found = capsys.readouterr().out
    # Read upwards: the deepest operators come last.
    assert "hashpartitioning(p_partkey" in found[found.rindex("Generate"):]


@pytest.mark.parametrize("rows, parts", [(1 << 16, 8), (10, 20)])
def test_dealt_partitions_number_with_the_rows(spark, monkeypatch, rows, parts):
    monkeypatch.setattr(registry, "DEALT_ROWS", rows, raising=False)
    dealt = Tables(spark, "/root/testdata/sf0.001").part
    assert dealt.count() == 200
    assert dealt.rdd.getNumPartitions() == parts
