"""Distance matches of spans as classes, so that hot breakpoints don't multiply.

Two callers with n and m events at one locus have n * m matching pairs. Here events are gathered in
square cells of (start, end). Cells of a sixteenth of the distance are compared by the bounds of what
they hold: when even the farthest members match, the two cells are one link between classes; when the
nearest don't, nothing; only cells in between are cut into sixteenths again, down to single
positions, where the rule itself decides. A pair of events is in exactly one link of two classes.
What is compared is bounded by the geometry of cells, not by the number of events in them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.operators.chunks import merged
from genoloom.session import settle

CUT = 16  # a cell's side is about the side above divided by this


@dataclass
class MatchClasses:
    """``links``: keys, class_a, class_b; every event of class_a matches every event of class_b.
    ``members``: keys, class, side ('a' or 'b'), id, for all classes that are in a link."""

    links: DataFrame
    members: DataFrame


def cell_sides(distance: int) -> list[int]:
    """Falling sides, each a multiple of the next: a cell lies in one cell of the side above."""
    sides = [max(distance // CUT, 1)]
    while sides[-1] > 1:
        sides.append(max(sides[-1] // CUT, 1))
    for k in range(len(sides) - 2, -1, -1):
        sides[k] -= sides[k] % sides[k + 1]
    return sides


def _cell(side: int) -> list[Column]:
    return [F.floor(F.col("start") / side).cast("long"), F.floor(F.col("end") / side).cast("long")]


def _name(keys: Sequence[str], side: int) -> Column:
    """A class: the side it is of, its keys and its cell. Keys come from tab-separated text."""
    return F.concat_ws("\t", F.col("who"), F.lit(str(side)), *[F.col(k).cast("string") for k in keys], *[c.cast("string") for c in _cell(side)])


def _gap(a: str, b: str) -> tuple[Column, Column]:
    """Least and greatest distance between a position of [a_lo, a_hi] and one of [b_lo, b_hi]."""
    lo_a, hi_a, lo_b, hi_b = (F.col(f"{x}_{e}") for x in (a, b) for e in ("lo", "hi"))
    return F.greatest(lo_a - hi_b, lo_b - hi_a, F.lit(0)), F.greatest(hi_a - lo_b, hi_b - lo_a)


def match_classes(a: DataFrame, b: DataFrame, keys: Sequence[str], distance: int, strict: bool = False) -> MatchClasses:
    """Matches between two sets of spans (``keys, start, end, id``) as classes and links between them.

    Spans match when starts and ends are both nearer than the distance, or, unless ``strict``, at
    most the distance away while the spans overlap. A null key, start or end matches nothing. A
    repeated row is a member once.
    """
    keys = list(keys)
    if distance < 1:
        raise ValueError("the distance is at least 1")
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*keys, "start", "end")])
    events = settle(a.select(F.lit("a").alias("who"), *keys, "start", "end", "id").unionByName(
        b.select(F.lit("b").alias("who"), *keys, "start", "end", "id")).where(known))
    sides = cell_sides(distance)

    def units(rows: DataFrame, side: int, parent: int | None, who: str) -> DataFrame:
        """The classes of a side with the bounds of what they hold, and the class above."""
        cells = [c for s in (side, parent) if s for c in _cell(s)]
        found = rows.where(F.col("who") == who).groupBy("who", *keys, *[c.alias(f"_{i}") for i, c in enumerate(cells)]).agg(
            F.min("start").alias("start"), F.max("start").alias(f"{who}s_hi"), F.min("end").alias("end"), F.max("end").alias(f"{who}e_hi"))
        # The least start and end lie in the cells grouped by, so they name them.
        up = F.lit(None).cast("string") if parent is None else _name(keys, parent)
        return found.select(*keys, _name(keys, side).alias(f"class_{who}"), up.alias(f"up_{who}"), F.col("start").alias(f"{who}s_lo"),
                            f"{who}s_hi", F.col("end").alias(f"{who}e_lo"), f"{who}e_hi")

    def compared(pairs: DataFrame) -> DataFrame:
        """Each pair with ``found``: 1 where all match, 0 where some may, none where no one does."""
        near_s, far_s = _gap("as", "bs")
        near_e, far_e = _gap("ae", "be")
        every = (far_s < distance) & (far_e < distance)
        if strict:
            some = (near_s < distance) & (near_e < distance)
        else:
            some = (near_s <= distance) & (near_e <= distance) & (F.col("bs_lo") <= F.col("ae_hi")) & (F.col("be_hi") >= F.col("as_lo")) | (
                (near_s < distance) & (near_e < distance))
        # A class of one locus has no inside: some is all.
        point = (F.col("as_lo") == F.col("as_hi")) & (F.col("ae_lo") == F.col("ae_hi")) & (F.col("bs_lo") == F.col("bs_hi")) & (F.col("be_lo") == F.col("be_hi"))
        return pairs.withColumn("found", F.when(every | (some & point), 1).when(some, 0)).where("found IS NOT NULL")

    # A class of a is in the cell of its least start and end, a class of b in all cells that its partners can be in.
    reach = distance + sides[0]
    left = units(events, sides[0], None, "a").withColumns({f"_{e}": F.floor(F.col(f"a{e}_lo") / (2 * reach)).cast("long") for e in "se"})
    right = units(events, sides[0], None, "b")
    for e in "se":
        first, last = F.col(f"b{e}_lo") - reach, F.col(f"b{e}_hi") + distance
        right = right.withColumn(f"_{e}", F.explode(F.sequence(*[F.floor(c / (2 * reach)).cast("long") for c in (first, last)])))
    pairs = settle(compared(left.join(merged(right), [*keys, "_s", "_e"])).select(*keys, "class_a", "class_b", "found"))
    # Events of classes in no pair go no further; only those of open pairs are cut finer.
    tops = pairs.select(F.explode(F.array("class_a", "class_b")).alias("class"), (F.col("found") == 0).alias("open")).groupBy("class").agg(
        F.max("open").alias("open"))
    near = settle(events.withColumn("class", _name(keys, sides[0])).join(merged(tops), "class").distinct())
    cut = near.where("open")
    links = [pairs.where("found = 1")]
    for parent, side in zip(sides, sides[1:]):
        open_pairs = pairs.where("found = 0").select(F.col("class_a").alias("up_a"), F.col("class_b").alias("up_b"))
        below = open_pairs.join(units(cut, side, parent, "a"), "up_a").join(units(cut, side, parent, "b").drop(*keys), "up_b")
        pairs = settle(compared(below).select(*keys, "class_a", "class_b", "found"))
        links.append(pairs.where("found = 1"))
    links = reduce(DataFrame.unionByName, links).drop("found")
    used = links.select(F.explode(F.array("class_a", "class_b")).alias("class")).distinct()
    names = F.when(F.col("open"), F.array(*[_name(keys, s) for s in sides])).otherwise(F.array("class"))
    inside = near.select(*keys, F.col("who").alias("side"), "id", F.explode(names).alias("class")).distinct()
    return MatchClasses(links, settle(inside.join(used, "class", "left_semi")))


def match_counts(found: MatchClasses) -> DataFrame:
    """(keys, side, id, n_matches) of every event with a match, counted without making pairs."""
    keys = [c for c in found.links.columns if c not in ("class_a", "class_b")]
    sizes = settle(found.members.groupBy("class").agg(F.count(F.lit(1)).alias("n")))
    links = found.links
    both = links.select(F.col("class_a").alias("class"), F.col("class_b").alias("other")).unionByName(
        links.select(F.col("class_b").alias("class"), F.col("class_a").alias("other")))
    per = both.join(sizes.withColumnRenamed("class", "other"), "other").groupBy("class").agg(F.sum("n").alias("n"))
    return found.members.join(per, "class").groupBy(*keys, "side", "id").agg(F.sum("n").alias("n_matches"))


def match_links(found: MatchClasses) -> DataFrame:
    """(a, b) links between classes that connect exactly the events that matches connect.

    All events of a class in a link share their partners, so the class stands for them; a class that
    lies in another one, both being in links, is tied to it.
    """
    nested = found.members.groupBy("side", "id").agg(F.sort_array(F.collect_set("class")).alias("c"))  # one for each cell size at most
    tied = nested.where(F.size("c") > 1).select(F.col("c")[0].alias("a"), F.explode(F.slice("c", 2, 100)).alias("b")).distinct()
    return found.links.select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).unionByName(tied)
