"""Row numbers over a whole table, without one task that sees all rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoloom.session import settle

TASK_ROWS = 33  # bits that monotonically_increasing_id leaves for the rows of one task


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not have, in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def _tie_break(df: DataFrame) -> list[Column]:
    """Every column that Spark can order, so that equal sort keys still have one order."""
    plain = [n for n, kind in df.dtypes if not re.search(r"\bmap<|\bvariant\b|\binterval\b", kind)]
    return [F.col(f"`{n.replace('`', '``')}`") for n in plain]


def with_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add ``name``, the row's number from 1 in the order given; a column of that name is replaced.

    The remaining columns break ties, so equal keys, even one value in all rows, fill several
    ranges. Rows are range-partitioned and sorted once and settled with their place in their task;
    the sizes of the tasks, one row each, give every task's offset. Rows that agree in all columns
    that can be ordered are interchangeable. An empty table gives an empty result.
    """
    df = df.drop(name)
    place, part, of, offset = (free_name(df, stem) for stem in ("_place", "_part", "_of", "_offset"))
    keys = [*order, *_tie_break(df)]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(place, F.monotonically_increasing_id())
    placed = settle(placed).withColumn(part, F.shiftright(place, TASK_ROWS))
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col(part).alias(of), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(offset))
    within = F.col(place).bitwiseAND(F.lit((1 << TASK_ROWS) - 1)) + 1
    joined = placed.join(F.broadcast(offsets), F.col(part) == F.col(of))  # one row for each task of the sort
    return joined.withColumn(name, F.col(offset) + within).drop(place, part, of, offset)
