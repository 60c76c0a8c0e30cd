"""Everything registered, gathered from the query modules."""

from __future__ import annotations

from importlib import import_module

from genoloom.plans import registry

MODULES = (
    "interval_queries",
    "set_join_queries",
    "filter_queries",
    "source_queries",
    "aggregate_queries",
    "pedigree_queries",
    "sv_queries",
    "annotation_queries",
    "report_queries",
    "sequence_queries",
)

for _name in MODULES:
    import_module(f"genoloom.plans.{_name}")


def queries():
    return registry.spark_queries()


def oracles():
    return registry.oracle_statements()


def flagship(spark, sf_dir):
    return registry.spark_queries()["flagship"](spark, sf_dir)
