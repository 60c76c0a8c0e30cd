"""Sweep line over interval ends: which loci touch which interval sets, in one pass over the loci."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoloom.operators.chunks import CHUNK

# Chunk numbers are held in this range, so that a start such as 2^62 gives a bounded number of chunks.
# Numbers still follow the positions, so results are exact beyond it too.
LAST_CHUNK = 1 << 16


def _chunk(pos: Column) -> Column:
    """Chunk of a position; null stays null."""
    return F.when(pos.isNotNull(), F.least(F.greatest(F.floor(pos / CHUNK), F.lit(0)), F.lit(LAST_CHUNK)))


def _reaches(spans: DataFrame, keys: Sequence[str], flag: str, last: Column) -> DataFrame:
    """Events of one set: the furthest end per start, and per later chunk the furthest end so far.

    What is carried comes from one row a chunk with a start, which holds until the next such chunk,
    so a key has one carried event a chunk, up to the ``last`` chunk with a start of any set.
    """
    lone = spans.groupBy(*keys, "start").agg(F.max("end").alias(flag)).withColumn("_chunk", _chunk(F.col("start")))
    chunks = Window.partitionBy(*keys).orderBy("_chunk")
    edges = lone.groupBy(*keys, "_chunk").agg(F.max(flag).alias("_far")).select(
        *keys, "_chunk", F.max("_far").over(chunks.rowsBetween(Window.unboundedPreceding, 0)).alias(flag),
        F.lead("_chunk").over(chunks).alias("_next")).withColumn("_stop", F.coalesce("_next", last))
    carried = edges.where("_stop > _chunk").select(
        *keys, F.explode(F.expr("sequence(_chunk + 1, _stop)")).alias("_chunk"), F.lit(None).cast("bigint").alias("_pos"), flag)
    return carried.unionByName(lone.select(*keys, "_chunk", F.col("start").cast("bigint").alias("_pos"), flag))


def tag_overlaps(loci: DataFrame, sets: Mapping[str, tuple[DataFrame, Sequence[str]]],
                 part: Sequence[str] = ("chrom",)) -> DataFrame:
    """Add one boolean per interval set: whether the locus overlaps any of its intervals.

    ``sets`` maps the new column to (intervals, further key columns that must agree besides
    ``part``). Ends are closed. Loci are read and shuffled once, whatever the number of sets: they
    stand at their end in the sweep, and overlap when the furthest end among the intervals begun
    by then is not before their start. The state carried between chunks comes from the intervals
    alone; loci behind the last start of all sets stand in its chunk. A locus with a missing coordinate or key overlaps nothing; an interval with one is
    left out. Equal loci stay separate rows of one task, so reduce repeated ones first.
    """
    part = list(part)
    extra = sorted({k for _, more in sets.values() for k in more})
    whole = {flag: spans.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*part, *more, "start", "end")]))
             for flag, (spans, more) in sets.items()}
    tops = [spans.agg(F.max(_chunk(F.col("start")))).scalar() for spans in whole.values()]
    last = F.greatest(F.lit(0), F.lit(0), *tops)
    place = _chunk(F.col("end"))
    rows = loci.select(
        *part, *extra, F.when(place.isNotNull(), F.least(place, last)).alias("_chunk"), F.col("end").cast("bigint").alias("_pos"),
        F.lit(1).alias("_kind"), F.col("start").alias("_from"),
        F.struct(*[F.col(f"`{c}`") for c in loci.columns]).alias("_row"))
    reach = {flag: f"_reach{i}" for i, flag in enumerate(sets)}
    for flag, (_, more) in sets.items():
        events = _reaches(whole[flag], [*part, *more], reach[flag], last).withColumn("_kind", F.lit(0))
        rows = rows.unionByName(events, allowMissingColumns=True)
    met = rows.repartition(*part, "_chunk")
    for flag, (_, more) in sets.items():
        # The partitioning above serves every window; carried events have no position and sort first.
        upto = Window.partitionBy(*part, "_chunk", *more).orderBy("_pos", "_kind").rowsBetween(Window.unboundedPreceding, 0)
        met = met.withColumn(reach[flag], F.max(reach[flag]).over(upto))
    flags = [F.coalesce(F.col(reach[flag]) >= F.col("_from"), F.lit(False)).alias(flag) for flag in sets]
    return met.where("_kind = 1").select("_row.*", *flags)
