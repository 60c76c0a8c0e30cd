"""OVL-*, AGG-9, AGG-10, AGG-19, NRM-10, SRC-6."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoloom.operators import intervals as iv
from genoloom.plans.registry import query

# Call sites against gene intervals; the site is a single base.
SITE_GENE = """
SELECT DISTINCT s.chrom, s.start, s."end", g.gene, g.start AS c_start, g."end" AS c_end
FROM fx_point s JOIN fx_gene g ON s.chrom = g.chrom AND g.start <= s."end" AND g."end" >= s.start"""

# Genes against exons: both sides are spans.
GENE_EXON = """
SELECT g.chrom, g.start, g."end", g.gene, x.exon, x.start AS c_start, x."end" AS c_end
FROM fx_gene g JOIN fx_exon x ON g.chrom = x.chrom AND x.start <= g."end" AND x."end" >= g.start"""


def sites(t):
    return t.fx_point.select("chrom", "start", "end").distinct()


def exon_names(t):
    return t.fx_exon.select("chrom", "start", "end", "exon")


@query("ovl_1", SITE_GENE)
def ovl_1(t):
    return iv.overlap_pairs(sites(t), t.fx_gene.select("chrom", "start", "end", "gene"), longest=0)


@query("ovl_1_spans", GENE_EXON)
def ovl_1_spans(t):
    return iv.overlap_pairs(t.fx_gene.select("chrom", "start", "end", "gene"), exon_names(t), bin_width=100)


@query("ovl_2", """
SELECT x.chrom, x.start, x."end", x.exon, g.gene, g.start AS c_start, g."end" AS c_end
FROM fx_gene g JOIN fx_exon x ON g.chrom = x.chrom WHERE g.start <= x.start AND g."end" >= x."end\"""")
def ovl_2(t):
    return iv.overlap_pairs(exon_names(t), t.fx_gene.select("chrom", "start", "end", "gene"), mode="full")


@query("ovl_3", GENE_EXON + ' WHERE x.start >= g.start AND x."end" <= g."end"')
def ovl_3(t):
    return iv.overlap_pairs(t.fx_gene.select("chrom", "start", "end", "gene"), exon_names(t), mode="full_rev")


@query("ovl_4", """
SELECT a.chrom, a.start, a."end", a.id, b.id AS other, b.start AS c_start, b."end" AS c_end
FROM fx_variant a JOIN fx_variant b ON a.chrom = b.chrom AND a.start = b.start AND a."end" = b."end"
WHERE a.filter = 'PASS' AND b.filter <> 'PASS'""")
def ovl_4(t):
    v = t.fx_variant
    return iv.overlap_pairs(
        v.where("filter = 'PASS'").select("chrom", "start", "end", "id"),
        v.where("filter <> 'PASS'").select("chrom", "start", "end", F.col("id").alias("other")), mode="exact")


@query("ovl_5", """
SELECT x.chrom, x.start, x."end", x.exon, g.gene, g.start AS c_start, g."end" AS c_end
FROM fx_gene g JOIN fx_exon x ON g.chrom = x.chrom AND x.start <= g."end" AND x."end" >= g.start
WHERE 2 * (least(x."end", g."end") - greatest(x.start, g.start)) >= x."end" - x.start""")
def ovl_5(t):
    return iv.overlap_pairs(exon_names(t), t.fx_gene.select("chrom", "start", "end", "gene"), mode="fifty_pct")


SV_SPANS = """
SELECT a.sv_id, b.sv_id AS other, a.coord1 AS start, a.coord2 AS "end", a.chr1 AS chrom,
 b.coord1 AS c_start, b.coord2 AS c_end
FROM fx_sv a JOIN fx_sv b ON a.chr1 = b.chr1
 AND ((abs(a.coord1 - b.coord1) <= 500 AND abs(a.coord2 - b.coord2) <= 500
   AND b.coord1 <= a.coord2 AND b.coord2 >= a.coord1)
  OR (abs(a.coord1 - b.coord1) < 500 AND abs(a.coord2 - b.coord2) < 500))
WHERE a.caller = 'c1' AND b.caller = 'c2' AND a.sv_type <> 'tra' AND b.sv_type <> 'tra'"""


def spans(t, caller, name):
    return t.fx_sv.where((F.col("caller") == caller) & (F.col("sv_type") != "tra")).select(
        F.col("chr1").alias("chrom"), F.col("coord1").alias("start"), F.col("coord2").alias("end"),
        F.col("sv_id").alias(name))


@query("ovl_6", SV_SPANS)
def ovl_6(t):
    return iv.overlap_pairs(spans(t, "c1", "sv_id"), spans(t, "c2", "other"), max_distance=500)


MATCHED = """
SELECT s.chrom, s.start, s."end", count(DISTINCT g.gene) AS n,
 string_agg(DISTINCT g.gene, '^^^' ORDER BY g.gene) AS m
FROM (SELECT DISTINCT chrom, start, "end" FROM fx_point) s
LEFT JOIN fx_gene g ON s.chrom = g.chrom AND g.start <= s."end" AND g."end" >= s.start
GROUP BY s.chrom, s.start, s."end\""""


def gene_names(t):
    return t.fx_gene.select("chrom", "start", "end", F.col("gene").alias("name"))


@query("ovl_7", f"""
WITH m AS ({MATCHED}) SELECT chrom, start, "end", coalesce(m, 'NO_MATCH') AS matches, n AS n_matches FROM m""")
def ovl_7(t):
    return iv.overlap_matches(sites(t), gene_names(t), keep_unmatched="NO_MATCH", longest=0)


@query("ovl_8", f'WITH m AS ({MATCHED}) SELECT chrom, start, "end" FROM m WHERE n = 0')
def ovl_8(t):
    return iv.overlap_unmatched(sites(t), t.fx_gene, longest=0)


@query("ovl_9", f'WITH m AS ({MATCHED}) SELECT chrom, start, "end", m AS matches, n AS n_matches FROM m WHERE n > 0')
def ovl_9(t):
    return iv.overlap_matches(sites(t), gene_names(t))


@query("ovl_10", """
SELECT s.chrom, s.start, s."end", s.sample, s.alt, g.gene
FROM fx_point s JOIN fx_gene g ON s.chrom = g.chrom AND g.start <= s."end" AND g."end" >= s.start""")
def ovl_10(t):
    pairs = iv.overlap_pairs(t.fx_point, t.fx_gene.select("chrom", "start", "end", "gene"))
    return pairs.select("chrom", "start", "end", "sample", "alt", "gene")


# Brand names repeat over many part intervals, so nearly all are duplicates.
BRANDS = """
SELECT g.*, count(*) OVER (PARTITION BY descr) AS k FROM fx_gene g"""


def brands(t):
    return t.fx_gene.select("chrom", "start", "end", F.col("descr").alias("name"))


@query("ovl_11", f"""
WITH b AS ({BRANDS}) SELECT s.chrom, s.start, s."end", count(DISTINCT b.descr) AS n_matches,
 string_agg(DISTINCT b.descr || CASE WHEN k > 1 THEN '-DUP' ELSE '' END, '^^^'
  ORDER BY b.descr || CASE WHEN k > 1 THEN '-DUP' ELSE '' END) AS matches
FROM (SELECT DISTINCT chrom, start, "end" FROM fx_point) s
JOIN b ON s.chrom = b.chrom AND b.start <= s."end" AND b."end" >= s.start GROUP BY s.chrom, s.start, s."end\"""")
def ovl_11(t):
    return iv.overlap_matches(sites(t), brands(t), flag_dups=True)


@query("ovl_12", """
WITH lists AS (SELECT chrom, start, "end", list_aggregate(list_sort(list_filter(
   ['s' || (p_no % 5), 's' || (p_no % 7), gene], lambda x: NOT x IN ('s1', 's2'))), 'string_agg', ',') AS name
  FROM (SELECT *, CAST(substr(gene, 2) AS BIGINT) AS p_no FROM fx_gene) q)
SELECT s.chrom, s.start, s."end", count(DISTINCT l.name) AS n_matches,
 string_agg(DISTINCT l.name, '^^^' ORDER BY l.name) AS matches
FROM (SELECT DISTINCT chrom, start, "end" FROM fx_point) s
JOIN lists l ON s.chrom = l.chrom AND l.start <= s."end" AND l."end" >= s.start GROUP BY s.chrom, s.start, s."end\"""")
def ovl_12(t):
    no = F.substring("gene", 2, 20).cast("bigint")
    names = F.array_join(F.array_sort(F.array(F.concat(F.lit("s"), no % 5), F.concat(F.lit("s"), no % 7), F.col("gene"))), ",")
    lists = t.fx_gene.select("chrom", "start", "end", names.alias("name"))
    return iv.overlap_matches(sites(t), lists, ignore=("s1", "s2"))


@query("ovl_12_single", f"""
WITH b AS (SELECT * FROM fx_gene WHERE descr <> 'Brand#1') SELECT s.chrom, s.start, s."end",
 count(DISTINCT b.descr) AS n_matches, string_agg(DISTINCT b.descr, '^^^' ORDER BY b.descr) AS matches
FROM (SELECT DISTINCT chrom, start, "end" FROM fx_point) s
JOIN b ON s.chrom = b.chrom AND b.start <= s."end" AND b."end" >= s.start GROUP BY s.chrom, s.start, s."end\"""")
def ovl_12_single(t):
    return iv.overlap_matches(sites(t), brands(t), ignore=("Brand#1",))


@query("ovl_13", """
SELECT s.chrom, s.start, s."end", count(DISTINCT g.gene) AS n_matches,
 string_agg(DISTINCT g.gene || '_of_' || g.descr, '^^^' ORDER BY g.gene || '_of_' || g.descr) AS matches
FROM (SELECT DISTINCT chrom, start, "end" FROM fx_point) s
JOIN fx_gene g ON s.chrom = g.chrom AND g.start <= s."end" AND g."end" >= s.start GROUP BY s.chrom, s.start, s."end\"""")
def ovl_13(t):
    named = t.fx_gene.select("chrom", "start", "end", F.concat_ws(" of ", "gene", "descr").alias("name"))
    return iv.overlap_matches(sites(t), named, underscore=True)


@query("ovl_14", f"""
WITH m AS ({MATCHED.replace('g.gene', 'g.descr')}) SELECT chrom, start, "end", n AS n_matches FROM m""")
def ovl_14(t):
    return iv.overlap_matches(sites(t), brands(t), keep_unmatched="NO_MATCH").drop("matches")


@query("ovl_15", """
WITH b AS (SELECT *, row_number() OVER (PARTITION BY descr ORDER BY chrom, start, "end") AS k FROM fx_gene),
 n AS (SELECT chrom, start, "end", descr || CASE WHEN k > 1 THEN '-DUPKEY' || (k - 1) ELSE '' END AS name FROM b)
SELECT x.chrom, x.start, x."end", x.exon, count(DISTINCT n.name) AS n_matches,
 string_agg(DISTINCT n.name, '^^^' ORDER BY n.name) AS matches
FROM fx_exon x JOIN n ON x.chrom = n.chrom AND n.start <= x."end" AND n."end" >= x.start
WHERE 2 * least(x."end" - x.start, greatest(n."end" - x.start, x."end" - n.start)) > x."end" - x.start
GROUP BY x.chrom, x.start, x."end", x.exon""")
def ovl_15(t):
    return iv.overlap_matches(exon_names(t), brands(t), mode="fifty_pct_strict", group_by_name=False)


@query("ovl_16", """
WITH m AS (SELECT DISTINCT s.chrom, s.start, s."end", s.sample, s.alt, s.rn, g.descr
 FROM (SELECT *, row_number() OVER () AS rn FROM fx_point) s
 JOIN fx_gene g ON s.chrom = g.chrom AND g.start <= s."end" AND g."end" >= s.start)
SELECT d.descr, count(m.rn) AS matched, (SELECT count(*) FROM fx_point) - count(m.rn) AS unmatched
FROM (SELECT DISTINCT descr FROM fx_gene) d LEFT JOIN m ON m.descr = d.descr GROUP BY d.descr""")
def ovl_16(t):
    return iv.overlap_counts(t.fx_point, t.fx_gene, "descr")


@query("ovl_17", """
WITH ext AS (SELECT chrom, gene, greatest(min(start) - 10, 0) AS lo, max("end") + 10 AS hi, min(strand) AS strand
  FROM fx_exon GROUP BY chrom, gene)
SELECT s.chrom, s.start, s."end", string_agg(DISTINCT e.gene, ',' ORDER BY e.gene) AS gene,
 string_agg(DISTINCT e.strand, ',' ORDER BY e.strand) AS strand
FROM (SELECT DISTINCT chrom, start, "end" FROM fx_point) s
LEFT JOIN ext e ON s.chrom = e.chrom AND e.lo <= s.start AND e.hi >= s.start GROUP BY s.chrom, s.start, s."end\"""")
def ovl_17(t):
    return iv.genes_at_points(sites(t), t.fx_exon, columns=("gene", "strand"))


@query("ovl_18", """
SELECT g.gene, count(DISTINCT s.start) AS n_sites
FROM (SELECT DISTINCT chrom, start, "end" FROM fx_point) s
JOIN fx_gene g ON s.chrom = g.chrom AND greatest(g.start - 1200, 0) <= s."end" AND g."end" + 1200 >= s.start
GROUP BY g.gene""")
def ovl_18(t):
    wide = iv.widen(t.fx_gene.select("chrom", "start", "end", "gene"), 1200)
    return iv.overlap_pairs(sites(t), wide).groupBy("gene").agg(F.count_distinct("start").alias("n_sites"))


@query("ovl_19", """
SELECT count(*) AS covered_bases, CAST(sum(depth) AS BIGINT) AS total_depth, chrom FROM fx_depth d
WHERE EXISTS (SELECT 1 FROM fx_gene g WHERE g.chrom = d.chrom AND g.start <= d.pos AND g."end" >= d.pos)
GROUP BY chrom""")
def ovl_19(t):
    points = t.fx_depth.select("chrom", F.col("pos").alias("start"), F.col("pos").alias("end"), "depth")
    return iv.overlap_any(points, t.fx_gene, longest=0).groupBy("chrom").agg(
        F.count("*").alias("covered_bases"), F.sum("depth").alias("total_depth"))


@query("ovl_20", """
SELECT chrom, pos, alt, CASE WHEN a = 1 AND b = 1 THEN 'both' WHEN a = 1 THEN 'a_only' ELSE 'b_only' END AS found_in
FROM (SELECT chrom, pos, alt, max(CASE WHEN qual < 40 THEN 1 ELSE 0 END) AS a,
 max(CASE WHEN qual >= 40 THEN 1 ELSE 0 END) AS b FROM fx_call GROUP BY chrom, pos, alt) q""")
def ovl_20(t):
    c = t.fx_call
    return iv.tool_comparison(c.where("qual < 40"), c.where("qual >= 40"), ["chrom", "pos", "alt"])


@query("agg_9", """
WITH o AS (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end"
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM fx_gene),
 g AS (SELECT *, sum(CASE WHEN prev IS NULL OR start > prev + 1 THEN 1 ELSE 0 END)
  OVER (PARTITION BY chrom ORDER BY start, "end" ROWS UNBOUNDED PRECEDING) AS island FROM o)
SELECT chrom, min(start) AS start, max("end") AS "end" FROM g GROUP BY chrom, island""")
def agg_9(t):
    return iv.merge_intervals(t.fx_gene)


@query("agg_10", 'SELECT chrom, gene, min(start) AS start, max("end") AS "end" FROM fx_exon GROUP BY chrom, gene')
def agg_10(t):
    return iv.gene_extents(t.fx_exon)


@query("agg_10_runs", """
WITH l AS (SELECT chrom, start, descr, max("end") AS "end" FROM (SELECT chrom, start, "end", descr FROM fx_gene) q
  GROUP BY chrom, start, descr),
 p AS (SELECT *, lag(descr) OVER (PARTITION BY chrom ORDER BY start, descr) AS prev FROM l),
 r AS (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> descr THEN 1 ELSE 0 END)
  OVER (PARTITION BY chrom ORDER BY start, descr ROWS UNBOUNDED PRECEDING) AS run FROM p)
SELECT chrom, descr, min(start) AS start, max("end") AS "end" FROM r GROUP BY chrom, run, descr""")
def agg_10_runs(t):
    return iv.gene_runs(t.fx_gene, "descr")


@query("agg_19", """
SELECT sv_type, CAST(sum(coord2 - coord1) AS BIGINT) AS total_length, count(*) AS intervals
FROM fx_sv WHERE sv_type <> 'tra' GROUP BY sv_type""")
def agg_19(t):
    return iv.interval_totals(
        t.fx_sv.where("sv_type <> 'tra'").select("sv_type", F.col("coord1").alias("start"), F.col("coord2").alias("end")),
        ["sv_type"])


@query("nrm_10", """
SELECT sv_id, sv_type, chr1 AS chrom, coord1 AS start, CASE WHEN sv_type = 'inv' THEN coord1 ELSE coord2 END AS "end"
FROM fx_sv UNION ALL SELECT sv_id, sv_type, chr2, coord2, coord2 FROM fx_sv WHERE sv_type = 'inv'""")
def nrm_10(t):
    return iv.breakpoints_to_intervals(t.fx_sv)


@query("src_6", """
SELECT CASE WHEN coord2 < coord1 + 300 THEN 'rejected' ELSE 'good' END AS verdict, count(*) AS n FROM fx_sv GROUP BY 1""")
def src_6(t):
    rows = t.fx_sv.select(F.col("chr1").alias("chrom"), (F.col("coord1") + 300).alias("start"), F.col("coord2").alias("end"))
    good, rejected = iv.validate_intervals(rows)
    both = good.withColumn("verdict", F.lit("good")).unionByName(rejected.withColumn("verdict", F.lit("rejected")))
    return both.groupBy("verdict").agg(F.count("*").alias("n"))
