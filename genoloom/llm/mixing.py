"""Mixing sources to target weights with a splitting tree over block quotas, in DataFrame operations only.

Every source's documents are dealt over blocks of about ``BLOCK_DOCS`` documents by a hash of doc_id.
A source whose target is r times its size gives all blocks floor(r) times, then blocks in a permuted
order until the rest is used up; the last block gives its first documents in permuted order. So only
that one block per source is looked at document by document.

Block draws go to output shards through a binary tree. At each node half of the node's draws, taken
at random without replacement, go left: the counts per source are a multivariate-hypergeometric
draw. The leaves' counts are exact quotas; each source's permuted draws are handed out in runs of
those lengths, and documents are ordered at random inside their shard.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoloom.llm.common import WORD, quoted, settle, whole

WEIGHTS = (1, 2, 3)
MOST = 3  # a source, and so a document, is taken this many times at most
BLOCK_DOCS = 2000
SHARD_DRAWS = 8  # block draws of an output shard, about; the tree is as deep as that needs
SEED = "mix-1"


def n_words(text: str = "text") -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def _order(*parts: Column) -> Column:
    """A reproducible random order key: MD5 of the seed and the parts."""
    return F.md5(F.concat_ws("|", F.lit(SEED), *(F.coalesce(p.cast("string"), F.lit("-")) for p in parts)))


def _block(order: Column, n_blocks: Column) -> Column:
    return F.pmod(F.conv(F.substring(order, 1, 8), 16, 10).cast("long"), n_blocks)


def source_targets(sized: DataFrame) -> DataFrame:
    """source, source_size, n_blocks, target: weights share all words, filled up to ``MOST`` times the size.

    Sources in code point order, null last, weigh 1, 2, 3, 1, ... What a source cannot take is
    shared among the others by weight; that ends at one level l with target = min(weight * l, cap).
    The level is found with running sums over sources by cap / weight: at the first source that the
    level leaves below its cap, which is the largest such level. One row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    sources = sources.select("*", weight.alias("weight"), (F.col("source_size") * MOST).alias("cap"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    sources = sources.select("*", F.when(level * F.col("weight") <= F.col("cap"), level).alias("level"))
    everywhere = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = F.max("level").over(everywhere)
    target = F.least(F.col("weight") * found, F.col("cap").cast("double"))
    return sources.select("source", "source_size", F.ceil(F.col("docs") / BLOCK_DOCS).cast("long").alias("n_blocks"), target.alias("target"))


def _with_source(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Rows (doc_id, source, ...) with ``t``, their source's figures, and their place: order ``key`` and ``block``."""
    side = targets.select(F.struct(*targets.columns).alias("t"))
    rows = rows.join(side, F.col("source").eqNullSafe(F.col("t.source"))).withColumn("key", _order(F.lit("doc"), F.col("doc_id")))
    return rows.withColumn("block", _block(F.col("key"), F.col("t.n_blocks")))


def block_plan(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """source, block, times, cut: a block's documents are all taken ``times`` times, and those whose
    order key is at most ``cut`` once more. One row per block."""
    placed = _with_source(sized, targets).select("source", "block", "key", "size")
    blocks = placed.groupBy("source", "block").agg(F.sum("size").alias("words"))
    blocks = settle(blocks)
    joined = blocks.join(targets.select(F.col("source").alias("_source"), "source_size", "target"),
                         F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    joined = joined.withColumn("times", full).withColumn("left", F.col("target") - F.col("times") * F.col("source_size"))
    run = Window.partitionBy("source").orderBy(_order(F.lit("block"), F.col("source"), F.col("block")), "block")
    used = F.coalesce(F.sum("words").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    joined = joined.withColumn("room", F.col("left") - used)
    whole_block = (F.col("words") <= F.col("room")) & (F.col("left") > 0)
    joined = settle(joined.select("source", "block", (F.col("times") + whole_block.cast("long")).alias("times"),
                                  F.when(~whole_block & (F.col("room") > 0), F.col("room")).alias("room")))
    last = joined.where("room IS NOT NULL").select(F.col("source").alias("_source"), F.col("block").alias("_block"), F.col("room").alias("_room"))
    inside = placed.join(last, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")))
    inside = inside.groupBy("source", "block", "key", "_room").agg(F.sum("size").alias("size"))
    run = Window.partitionBy("source", "block").orderBy("key")
    used = F.coalesce(F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = inside.withColumn("used", used).where(F.col("used") + F.col("size") / 2 <= F.col("_room"))
    cuts = cuts.groupBy("source", "block").agg(F.max("key").alias("cut"))
    cuts = cuts.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "cut")
    return joined.join(cuts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block")), "left").select(
        "source", "block", "times", "cut")


def _block_draws() -> Column:
    return F.col("times") + F.col("cut").isNotNull().cast("long")


def tree_depth(plan: DataFrame) -> int:
    """The depth at which a shard has about ``SHARD_DRAWS`` block draws."""
    draws = plan.agg(F.sum(_block_draws())).first()[0] or 0
    return max(0, math.ceil(math.log2(max(1, draws) / SHARD_DRAWS)))


def shard_of_draws(plan: DataFrame, depth: int | None = None) -> DataFrame:
    """source, block, draw, shard for every draw of a block (draws count from 1).

    Draws number a two-thousandth of the documents; the tree's root is one sort of them.
    """
    depth = tree_depth(plan) if depth is None else depth
    draws = _block_draws()
    units = plan.where(draws > 0).select("source", "block", F.explode(F.sequence(F.lit(1).cast("long"), draws)).alias("draw"), F.lit(0).alias("node"))
    units = settle(units)

    def split(nodes: DataFrame, level: int) -> DataFrame:
        key = _order(F.lit(f"split{level}"), F.col("source"), F.col("block"), F.col("draw"))
        ordered = nodes.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy(key)))
        ordered = ordered.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("node")))
        return ordered.select("source", "block", "draw", (F.col("node") * 2 + (F.col("place") > F.floor(F.col("n") / 2)).cast("int")).alias("node"))

    quotas = reduce(split, range(depth), units).groupBy("source", "node").agg(F.count(F.lit(1)).alias("quota"))
    before = Window.partitionBy("source").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("quota").over(before), F.lit(0))
    runs = quotas.withColumn("first", first).select(
        F.col("source").alias("_source"), F.col("node").alias("shard"), F.explode(F.sequence(F.col("first") + 1, F.col("first") + F.col("quota"))).alias("_place"))
    permuted = Window.partitionBy("source").orderBy(_order(F.lit("draw"), F.col("source"), F.col("block"), F.col("draw")))
    places = units.withColumn("_at", F.row_number().over(permuted).cast("long"))
    return places.join(runs, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_at") == F.col("_place"))).select("source", "block", "draw", "shard")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source and size of every row, settled, so texts are counted once."""
    return settle(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(text).alias("size")))


def plan_mix(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(targets, block plan), settled; their rows number sources and blocks."""
    targets = settle(source_targets(sized))
    return targets, settle(block_plan(sized, targets))


def placed_plan(plan: DataFrame, depth: int | None = None) -> DataFrame:
    """The block plan with ``shards``, where the tree has placed a block's draws, in draw order; settled."""
    at = F.array_sort(F.collect_list(F.struct("draw", "shard")))
    shards = shard_of_draws(plan, depth).groupBy("source", "block").agg(F.transform(at, lambda d: d["shard"]).alias("shards"))
    shards = shards.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "shards")
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    return settle(plan.join(shards, same, "left").select(*plan.columns, F.coalesce("shards", F.array().cast("array<int>")).alias("shards")))


def with_draws(rows: DataFrame, targets: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows (doc_id, source, ...) with ``t``, ``block`` and ``draws``, the times each is taken; with
    ``shards``, that of each draw, if the plan is placed. Rows that repeat a doc_id are taken alike;
    null doc_ids count as one id, a null source as a source."""
    placed = "shards" in plan.columns
    plan = plan.select(F.struct(*plan.columns).alias("p"))
    rows = _with_source(rows, targets).join(
        plan, F.col("source").eqNullSafe(F.col("p.source")) & (F.col("block") == F.col("p.block")), "left")
    extra = F.coalesce(F.col("key") <= F.col("p.cut"), F.lit(False)).cast("long")
    rows = rows.withColumn("draws", F.coalesce(F.col("p.times"), F.lit(0)) + extra)
    if placed:
        rows = rows.withColumn("shards", F.slice(F.coalesce("p.shards", F.array().cast("array<int>")), F.lit(1), F.col("draws").cast("int")))
    return rows.drop("p")


def taken_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken. No rows for an empty table.

    ``taken`` counts the row's words once for every draw that the tree has placed in a shard.
    """
    sized = measured(docs, doc_id, text, source)
    targets, plan = plan_mix(sized)
    return with_draws(sized, targets, placed_plan(plan)).select(
        "doc_id", "size", F.col("t.source_size").alias("source_size"), F.col("t.target").alias("target"),
        (F.col("size") * F.size("shards")).alias("taken"))


def mix(docs: DataFrame, depth: int | None = None, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        placed: bool = True) -> DataFrame:
    """The mixed rows: every row as often as it is drawn, with shard and place if ``placed`` (input
    columns of these names are replaced). Sort a shard by place to get its order. If not ``placed``
    the rows come in that order, shard by shard, with the input columns only.

    Only block tables are joined to the rows, so texts move only where Spark finds a side too large
    to broadcast (then the keys are blocks, which are even), and once to be put in order.
    """
    sized = measured(docs, doc_id, text, source)
    targets, plan = plan_mix(sized)
    rows = docs.select(F.struct(*quoted(docs.columns)).alias("row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"))
    rows = with_draws(rows, targets, placed_plan(plan, depth))
    rows = rows.select("row", "doc_id", F.posexplode("shards").alias("_nth", "shard"))
    rows = rows.withColumn("place", F.xxhash64(F.lit(SEED), "shard", "doc_id", (F.col("_nth") + 1).cast("long")))
    if not placed:
        return rows.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place").select("row.*")
    return rows.select(*(F.col(f"row.{c}") for c in quoted(c for c in docs.columns if c.lower() not in ("shard", "place"))), "shard", "place")
