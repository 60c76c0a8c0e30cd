"""Aggregate expressions with the exact conventions of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def middle(values: Column) -> Column:
    """Median of a sorted array; an even count averages the two middle values."""
    n = F.size(values)
    hi = F.floor(n / 2).cast("int")
    return (
        F.when(n == 0, F.lit(None).cast("double"))
        .when(n % 2 == 1, F.get(values, hi).cast("double"))
        .otherwise((F.get(values, hi - 1) + F.get(values, hi)) / 2.0)
    )


def ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """``part / whole * scale``, zero when there is nothing to divide by."""
    return F.when(whole > 0, part / whole * F.lit(scale)).otherwise(F.lit(0.0))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def sorted_text(c: Column, sep: str = ",") -> Column:
    """Distinct values of a group as sorted text. Use where a dimension bounds the group."""
    return F.array_join(F.array_sort(F.collect_set(c)), sep)
