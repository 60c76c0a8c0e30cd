"""Plans that must hold whatever the size estimates say: no multiplied side goes through the driver."""

from __future__ import annotations

import pytest

from genoloom.plans.registry import spark_queries
import genoloom.plans.catalogue  # noqa: F401

SMALL = "/root/testdata/sf0.001"


def plan(spark, capsys, name: str) -> str:
    capsys.readouterr()
    spark_queries()[name](spark, SMALL).explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", ["ann_8", "ann_11", "ann_17", "ann_18", "ovl_1", "ovl_1_spans", "ovl_2", "sv_9", "sv_10", "sv_11", "cov_1", "cov_5"])
def test_spread_sides_are_not_broadcast(spark, capsys, name):
    found = plan(spark, capsys, name)
    assert "SortMergeJoin" in found
    assert "BroadcastHashJoin" not in found


@pytest.mark.parametrize("name", ["ped_3", "ped_5", "rpt_13", "cov_1", "ann_17"])
def test_rows_are_dealt_out_before_they_are_multiplied(spark, capsys, name):
    found = plan(spark, capsys, name)
    # Read upwards: the deepest operators come last.
    assert "hashpartitioning(p_partkey" in found[found.index("Generate"):]
