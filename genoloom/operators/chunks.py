"""Ordered scans that never put a whole group into one task.

A window over a chromosome, family or cohort would sort one group in one task. These helpers
cut the group into chunks of its order column, scan inside each chunk, and carry state between
chunks through a summary frame with one row per chunk. Spark reuses the shared exchange, so
the input is shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Distinct positions per chunk are bounded by this width, and a chromosome has at most a few
# thousand chunks, so neither level of the scan can grow with the number of rows.
CHUNK = 1 << 18

# Chunks that one task adds up in a scan without keys.
TREE = 1 << 10


def once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns through a generator, which the optimizer does not inline.

    Filters and later projections are otherwise rewritten in terms of the input text, so a
    parsed or tokenised value would be worked out again for every use.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def merged(df: DataFrame) -> DataFrame:
    """A side of a join that must not be broadcast: sort-merge, whatever Catalyst takes its size to be.

    Sizes are estimated from compressed files and don't count the rows that a generator adds, so a
    side of a gigabyte can pass for one below the broadcast limit and be sent through the driver.
    """
    return df.hint("merge")


def with_totals(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Add group aggregates to every row.

    A grouping with map-side combine joined back, instead of a window: a hot group is split by
    the skew-join rule, whereas a window would hold it in one task.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return df.join(totals, list(keys))


def _sums_before(sums: DataFrame) -> DataFrame:
    """``_before``, the sum of all earlier chunks, for a scan that has no keys.

    Chunks are gathered by ``TREE``; a window adds up inside a gathering, and the sums of the
    gatherings before it come as one array. No task sees all chunks.
    """
    wide = F.floor(F.col("_chunk") / TREE)
    inside = Window.partitionBy("_wide").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = sums.groupBy(wide.alias("_wide")).agg(F.sum("_sum").alias("_sum")).agg(
        F.collect_list(F.struct("_wide", "_sum"))).scalar()
    upper = F.aggregate(F.filter("_tops", lambda x: x["_wide"] < F.col("_wide")), F.lit(0).cast("bigint"),
                        lambda acc, x: acc + x["_sum"])
    return sums.withColumn("_wide", wide).withColumn("_inside", F.coalesce(F.sum("_sum").over(inside), F.lit(0))).withColumn(
        "_tops", tops).select("_chunk", (F.col("_inside") + upper).alias("_before"))


def running_sum(df: DataFrame, part: Sequence[str], order: Sequence[Column], chunk: Column, value: str,
                out: str) -> DataFrame:
    """Inclusive running sum of ``value``; ``chunk`` must not decrease along ``order``.

    Without keys in ``part`` the chunk must be an integer and the value integral; the chunks are then
    added up as a tree.
    """
    cut = df.withColumn("_chunk", chunk).repartition(*part, "_chunk")
    within = Window.partitionBy(*part, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sums = cut.groupBy(*part, "_chunk").agg(F.sum(value).alias("_sum"))
    if part:
        before = Window.partitionBy(*part).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    else:
        offsets = _sums_before(sums)
    return (
        cut.withColumn("_run", F.sum(value).over(within))
        .join(offsets, [*part, "_chunk"])
        .withColumn(out, F.col("_before") + F.col("_run"))
        .drop("_chunk", "_run", "_before")
    )


def run_ids(df: DataFrame, part: Sequence[str], order: Sequence[str], state: Sequence[str],
            chunk: Column, starts_new, out: str = "run") -> DataFrame:
    """Number the runs of consecutive rows.

    ``starts_new(prev, cur)`` gets the state structs of the row before and of the row itself
    and says whether a new run begins; the first row of a partition always begins one.
    """
    part, order = list(part), list(order)
    # One explicit exchange below the three uses of the frame, so that its input is worked out
    # once; pass a frame with only the needed columns, else the uses are pruned differently.
    cut = df.withColumn("_chunk", chunk).withColumn("_state", F.struct(*state)).repartition(*part, "_chunk")
    within = Window.partitionBy(*part, "_chunk").orderBy(*order)
    over_chunks = Window.partitionBy(*part).orderBy("_chunk")
    edges = (
        cut.groupBy(*part, "_chunk").agg(F.max_by("_state", F.struct(*order)).alias("_last"))
        .withColumn("_carry", F.lag("_last").over(over_chunks)).drop("_last")
    )
    prev = F.coalesce(F.lag("_state").over(within), F.col("_carry"))
    flagged = (
        cut.join(edges, [*part, "_chunk"])
        .withColumn("_prev", prev)
        .withColumn("_new", F.when(F.col("_prev").isNull() | starts_new(F.col("_prev"), F.col("_state")), 1)
                    .otherwise(0))
        .drop("_prev", "_carry", "_state")
    )
    offsets = (
        flagged.groupBy(*part, "_chunk").agg(F.sum("_new").alias("_sum"))
        .withColumn("_before", F.coalesce(F.sum("_sum").over(over_chunks.rowsBetween(Window.unboundedPreceding, -1)),
                                          F.lit(0))).drop("_sum")
    )
    return (
        flagged.join(offsets, [*part, "_chunk"])
        .withColumn(out, F.col("_before") + F.sum("_new").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("_chunk", "_new", "_before")
    )


# Splitters cut a group's distinct values into this many buckets of about equal size.
SPLITS = 64


def _narrow(values: DataFrame, targets: DataFrame, group: Sequence[str], value: str, bucket: str) -> tuple[DataFrame, DataFrame]:
    """Cut each group at its own quantiles and keep the buckets that hold a wanted rank.

    Returns the values that are left, with their ``bucket``, and the targets by bucket, their ranks
    counted from the bucket's first value. A bucket is known by the splitters below a value, so
    equal values share one; how well the splitters fit decides balance, never the result.
    """
    cuts = values.groupBy(*group).agg(
        F.percentile_approx(value, [i / SPLITS for i in range(1, SPLITS)], 16 * SPLITS).alias("_cuts"))
    placed = values.join(cuts, list(group)).withColumn(
        bucket, F.size(F.filter("_cuts", lambda x: x < F.col(value)))).drop("_cuts")
    # At most SPLITS rows a group.
    below = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*group, bucket).agg(F.sum("_n").alias("_sum")).withColumn(
        "_before", F.coalesce(F.sum("_sum").over(below), F.lit(0)))
    inside = F.filter("_targets", lambda t: (t["rank"] > F.col("_before")) & (t["rank"] <= F.col("_before") + F.col("_sum")))
    wanted = counts.join(targets, list(group)).withColumn("_targets", F.transform(
        inside, lambda t: F.struct(t["name"].alias("name"), (t["rank"] - F.col("_before")).alias("rank"))))
    wanted = wanted.where(F.size("_targets") > 0).select(*group, bucket, "_targets")
    return placed.join(wanted.drop("_targets"), [*group, bucket], "left_semi"), wanted


def order_statistics(df: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, Column], rounds: int = 1) -> DataFrame:
    """Exact k-th smallest values per group, and the group's size ``n``.

    ``ranks`` maps output names to 1-based rank expressions over ``n``; a rank outside 1 to ``n``
    gives null. Values are first counted per distinct value with map-side combine, so a group
    costs its number of distinct values. Selection goes by splitters: every round keeps about one
    ``SPLITS``-th of the values for each rank, whatever their range and spread, and only what is
    left after ``rounds`` is ordered.
    """
    keys = list(keys)
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    sizes = counted.groupBy(*keys).agg(F.sum("_n").alias("n"))
    targets = sizes.select(*keys, F.array(*[
        F.struct(F.lit(name).alias("name"), rank.cast("bigint").alias("rank")) for name, rank in ranks.items()]).alias("_targets"))
    left, group = counted, keys
    for i in range(rounds):
        left, targets = _narrow(left, targets, group, value, f"_bucket{i}")
        group = [*group, f"_bucket{i}"]
    upto = Window.partitionBy(*group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    found = left.withColumn("_upto", F.sum("_n").over(upto)).join(targets, group).select(
        *keys, value, F.explode(F.filter("_targets", lambda t: (
            t["rank"] > F.col("_upto") - F.col("_n")) & (t["rank"] <= F.col("_upto")))["name"]).alias("_name"))
    picks = found.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == name, F.col(value))).alias(name) for name in ranks])
    return sizes.join(picks, keys, "left")
