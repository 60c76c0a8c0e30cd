"""Texts that are dear to make or to cut are worked out once a row."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoloom.functions.text import attr_map
from genoloom.operators import structural as sv


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_an_attribute_text_is_split_once(spark, capsys):
    rows = spark.createDataFrame([("a=1;b;a=2=3;;c=",), ("",), (None,)], "t string")
    found = rows.select(attr_map(F.col("t")).alias("m"))
    assert plan(found, capsys).count("split(t") == 1
    assert [r.m for r in found.collect()] == [{"a": "2=3", "b": None, "c": ""}, {}, None]


def test_sv_lines_are_not_worked_out_for_a_filter(spark, capsys):
    made = spark.range(3).select(F.concat_ws("\t", F.lit("chr1"), F.col("id") + 10, F.lit("D1"), F.lit("N"), F.lit("<DEL>"), F.lit("."), F.lit("PASS"),
                                             F.concat(F.lit("SVTYPE=DEL;END="), F.col("id") + 90)).alias("line"))
    found = sv.normalise_delly(made)
    assert plan(found, capsys).count("concat_ws") == 1
    assert found.count() == 3


def test_sv_header_and_blank_lines_are_dropped(spark):
    row = "chr1\t10\tD1\tN\t<DEL>\t.\tPASS\tSVTYPE=DEL;END=90"
    rows = spark.createDataFrame([(x,) for x in ("##x", "#CHROM\tPOS", "", "   ", None, row)], "line string")
    assert [(r.sv_id, r.coord1, r.coord2) for r in sv.normalise_delly(rows).collect()] == [("D1", 10, 90)]
