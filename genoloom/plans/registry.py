"""Registry of named queries and the table access they share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from genoloom.plans.views import TABLES, VIEWS
from genoloom.session import size_tasks

# Tables with views that make up to 81 rows of one. A file of narrow rows is a single split, whose task
# would make, sort and group all of them.
SPREAD = {"part": "p_partkey"}

# Rows that a task multiplies, whatever the number of partitions the session asks for.
DEALT_ROWS = 1 << 16

_QUERIES: dict[str, tuple[Callable, str | None]] = {}


class Tables:
    """Driver tables and derived views of one scale folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir, self._seen = spark, sf_dir.rstrip("/"), {}
        size_tasks(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._seen:
            if name in TABLES:
                df = self.spark.read.parquet(f"{self._dir}/{name}.parquet")
                if name in SPREAD:
                    # A quarter of the later partitions: blocks of a shuffle number with the product of both.
                    # More where rows ask for it; their number comes from the file footers.
                    quarter = int(self.spark.conf.get("spark.sql.shuffle.partitions")) // 4
                    parts = max(quarter, 8, -(-df.count() // DEALT_ROWS))
                    df = df.repartition(parts, SPREAD[name])
            else:
                df = self.sql(VIEWS[name])
            self._seen[name] = df
        return self._seen[name]

    def sql(self, text: str) -> DataFrame:
        """Run SQL whose sources are tables or views written in braces."""
        used = set(re.findall(r"\{(\w+)\}", text))
        text = re.sub(r"EACH\((\d+),(\d+)\)", r"explode(sequence(\1, \2))", text)
        return self.spark.sql(text.replace('"', "`"), **{n: getattr(self, n) for n in used})


def query(key: str, oracle: str | None = None):
    """Register ``fn(t: Tables) -> DataFrame``; the oracle names views as ``fx_*``."""

    def add(fn):
        if key in _QUERIES:
            raise ValueError(f"duplicate query {key}")
        _QUERIES[key] = (fn, oracle)
        return fn

    return add


def _needs(text: str, found: list[str]) -> list[str]:
    """Views used by a statement, dependencies first."""
    for name in sorted(set(re.findall(r"\b(fx_\w+)\b", text))):
        if name not in found:
            _needs(VIEWS[name], found)
            if name not in found:
                found.append(name)
    return found


def with_views(body: str) -> str:
    """Prepend the views an oracle statement uses as common table expressions."""
    views = _needs(body, [])
    plain = {n: re.sub(r"EACH\((\d+),(\d+)\)", r"unnest(range(\1, \2 + 1))", VIEWS[n]) for n in views}
    ctes = [f"{n} AS ({re.sub(r'[{}]', '', plain[n])})" for n in views]
    body = body.strip()
    if lead := re.match(r"WITH (RECURSIVE )?", body, re.IGNORECASE):
        ctes.append(body[lead.end() :])
        return lead.group() + ",\n".join(ctes)
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: (lambda spark, sf_dir, _fn=fn: _fn(Tables(spark, sf_dir))) for k, (fn, _) in _QUERIES.items()}


def oracle_statements() -> dict[str, str]:
    return {k: with_views(sql) for k, (_, sql) in _QUERIES.items() if sql}
