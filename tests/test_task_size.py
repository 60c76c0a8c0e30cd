"""Tasks of large joins read a bounded part, which a session may choose itself."""

from __future__ import annotations

from genoloom.plans.registry import Tables

KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def test_an_unset_task_size_is_set_and_a_chosen_one_stays(spark):
    other = spark.newSession()
    other.conf.unset(KEY)
    Tables(other, "/root/testdata/sf0.001")
    assert other.conf.get(KEY) == "16m"
    other.conf.set(KEY, "48m")
    Tables(other, "/root/testdata/sf0.001")
    assert other.conf.get(KEY) == "48m"
