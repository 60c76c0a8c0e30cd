"""SV-* and SRC-9."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoloom.operators import structural as sv
from genoloom.operators.dense import match_counts
from genoloom.plans.registry import query
from genoloom.session import settle

BASE = "SELECT *, CAST(substr(sv_id, 3) AS BIGINT) AS n FROM fx_sv"
# One end of a translocation survives: the one that sorts first as text, then by position.
FIRST = "(chr1 < chr2 OR (chr1 = chr2 AND coord1 <= coord2))"


@query("sv_1", f"""
WITH b AS ({BASE}), r AS (SELECT *, sv_type <> 'tra' OR n % 2 = 0 OR {FIRST} AS keep FROM b)
SELECT CAST(n AS VARCHAR) AS sv_id, CASE WHEN keep THEN chr1 ELSE chr2 END AS chr1, CASE WHEN keep THEN coord1 ELSE coord2 END AS coord1, CASE WHEN keep THEN chr2 ELSE chr1 END AS chr2,
 CASE WHEN keep THEN coord2 ELSE coord1 END AS coord2, sv_type, CASE WHEN sv_type = 'tra' THEN 0 ELSE coord2 - coord1 END AS length, 'lumpy' AS caller, CAST(NULL AS DOUBLE) AS qual, n % 7 AS pe, n % 5 AS sr FROM r""")
def sv_1(t):
    return sv.normalise_lumpy(t.fx_lumpy)


@query("sv_2", f"""
WITH b AS ({BASE}) SELECT 'D' || n AS sv_id, chr1, coord1, chr2, coord2, CASE WHEN sv_type = 'inv' THEN 'tra' ELSE sv_type END AS sv_type,
 CASE WHEN sv_type IN ('tra', 'inv') THEN 0 WHEN sv_type = 'ins' THEN 4 * (1 + n % 300) ELSE coord2 - coord1 END AS length, 'delly' AS caller, CAST(n % 60 AS DOUBLE) AS qual, n % 7 AS pe,
 CASE WHEN n % 3 = 0 THEN n % 5 ELSE 0 END AS sr, CASE WHEN sv_type = 'ins' THEN '+' || repeat('ACGT', CAST(1 + n % 300 AS INT)) END AS bases
FROM b WHERE n % 10 <> 0""")
def sv_2(t):
    return sv.normalise_delly(t.fx_delly)


@query("sv_3", f"""
WITH b AS ({BASE}) SELECT 'M' || n AS sv_id, chr1, coord1, chr2, CASE WHEN sv_type = 'ins' THEN coord1 ELSE coord2 END AS coord2, sv_type,
 CASE sv_type WHEN 'tra' THEN NULL WHEN 'ins' THEN CASE WHEN n % 2 = 0 THEN 2 * (1 + n % 600) END ELSE coord2 - coord1 END AS length, 'manta' AS caller, CAST(n % 999 AS DOUBLE) AS qual,
 (n % 8) || ',0,' || (n % 6) AS pe, CASE WHEN n % 4 = 0 THEN '' ELSE (n % 9) || ',1,' || (n % 3) END AS sr, 'Ref=1:Hom=1:Het=1' AS sample_count,
 CASE WHEN sv_type = 'ins' THEN '+' || CASE WHEN n % 2 = 1 THEN 'AGG' ELSE repeat('AC', CAST(1 + n % 600 AS INT)) END END AS bases
FROM b WHERE n % 6 <> 0 AND n % 50 <> 7""")
def sv_3(t):
    return sv.normalise_manta(t.fx_manta)


@query("sv_4", f"""
WITH b AS ({BASE}), r AS (SELECT *, sv_type <> 'tra' OR {FIRST} AS keep FROM b)
SELECT 'L' || n || CASE WHEN keep THEN '' ELSE 'm' END AS sv_id, CASE WHEN keep THEN chr1 ELSE chr2 END AS chr1, CASE WHEN keep THEN coord1 ELSE coord2 END AS coord1, CASE WHEN keep THEN chr2 ELSE chr1 END AS chr2,
 CASE WHEN keep THEN coord2 ELSE coord1 END AS coord2, sv_type, CASE WHEN sv_type <> 'tra' THEN coord2 - coord1 END AS length, 'sniffles' AS caller, CASE WHEN n % 6 = 0 THEN 'NEAR' ELSE 'PASS' END AS status, '0/1' AS zyg,
 n % 11 AS ref_reads, n % 13 AS var_reads, CASE WHEN n % 11 + n % 13 > 0 THEN (n % 13) / (n % 11 + n % 13) ELSE 0 END AS var_freq,
 CASE WHEN sv_type = 'ins' THEN repeat('ACGT', CAST(1 + n % 300 AS INT)) END AS bases FROM r""")
def sv_4(t):
    return sv.normalise_long_read(t.fx_longread, "sniffles")


@query("src_9", """
SELECT 'lumpy' AS caller, count(*) AS n FROM fx_sv UNION ALL SELECT 'delly', count(*) FROM fx_sv WHERE CAST(substr(sv_id, 3) AS BIGINT) % 10 <> 0
UNION ALL SELECT 'manta', count(*) FROM fx_sv WHERE CAST(substr(sv_id, 3) AS BIGINT) % 6 <> 0 AND CAST(substr(sv_id, 3) AS BIGINT) % 50 <> 7 UNION ALL SELECT 'sniffles', count(*) FROM fx_sv""")
def src_9(t):
    parts = [sv.normalise(rows, c).select("caller") for rows, c in (
        (t.fx_lumpy, "lumpy"), (t.fx_delly, "delly"), (t.fx_manta, "manta"), (t.fx_longread, "sniffles"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("caller").agg(F.count("*").alias("n"))


NEAR = """abs(a.coord1 - b.start) <= 500 AND abs(a.coord2 - b."end") <= 500 AND
 ((b.start <= a.coord2 AND b."end" >= a.coord1) OR (abs(a.coord1 - b.start) < 500 AND abs(a.coord2 - b."end") < 500))"""


@query("sv_5", f"""
SELECT a.sv_id, a.sv_type, coalesce(string_agg(DISTINCT b.entry, ',' ORDER BY b.entry), 'novel') AS dgv, CASE WHEN count(b.entry) = 0 THEN 1 ELSE 0 END AS filterpass
FROM fx_sv a LEFT JOIN fx_svpop b ON a.chr1 = b.chrom AND a.sv_type = b.sv_type AND {NEAR} WHERE a.sv_type <> 'tra' GROUP BY a.sv_id, a.sv_type""")
def sv_5(t):
    return sv.population_match(t.fx_sv.where("sv_type <> 'tra'"), t.fx_svpop, 500)


PAIRS = """
SELECT a.sv_type, a.sv_id, b.sv_id AS other FROM fx_sv a JOIN fx_sv b ON a.chr1 = b.chr1 AND a.sv_type = b.sv_type AND a.caller = 'c1' AND b.caller = 'c2'
AND a.sv_type IN ('del', 'dup', 'inv') AND abs(a.coord1 - b.coord1) <= 2000 AND abs(a.coord2 - b.coord2) <= 2000
AND ((b.coord1 <= a.coord2 AND b.coord2 >= a.coord1) OR (abs(a.coord1 - b.coord1) < 2000 AND abs(a.coord2 - b.coord2) < 2000))"""


@query("sv_6", PAIRS)
def sv_6(t):
    return sv.caller_pairs(t.fx_sv, "c1", "c2", 2000)


TRA = """
WITH o AS (SELECT sv_id, caller, least(chr1, chr2) AS c_lo, greatest(chr1, chr2) AS c_hi, CASE WHEN chr1 < chr2 THEN coord1 ELSE coord2 END AS x, CASE WHEN chr1 < chr2 THEN coord2 ELSE coord1 END AS y FROM fx_sv WHERE sv_type = 'tra')
SELECT a.c_lo, a.c_hi, a.sv_id, b.sv_id AS other FROM o a JOIN o b ON a.c_lo = b.c_lo AND a.c_hi = b.c_hi AND a.caller = 'c1' AND b.caller = 'c2' AND abs(a.x - b.x) < 2000 AND abs(a.y - b.y) < 2000"""


@query("sv_8", TRA)
def sv_8(t):
    return sv.translocation_pairs(t.fx_sv, "c1", "c2", 2000)


EVENTS = f"""
WITH p AS ({PAIRS}), l AS (SELECT sv_type, sv_id, string_agg(DISTINCT other, ',' ORDER BY other) AS li FROM p GROUP BY sv_type, sv_id), t AS (SELECT * FROM ({TRA}) q),
 m AS (SELECT sv_type || ':' || li AS event_id, sv_type, sv_id FROM l UNION ALL SELECT sv_type || ':' || li, sv_type, unnest(string_split(li, ',')) FROM l
  UNION ALL SELECT 'tra:' || c_lo || ':' || c_hi, 'tra', sv_id FROM t UNION ALL SELECT 'tra:' || c_lo || ':' || c_hi, 'tra', other FROM t)
SELECT sv_id, sv_type, min(event_id) AS event_id FROM m GROUP BY sv_id, sv_type"""


def events(t):
    return sv.group_events(sv.caller_pairs(t.fx_sv, "c1", "c2", 2000), sv.translocation_pairs(t.fx_sv, "c1", "c2", 2000))


@query("sv_7", EVENTS)
def sv_7(t):
    return events(t)


LINKS = f"SELECT sv_type, sv_id, other FROM ({PAIRS}) q UNION ALL SELECT 'tra', sv_id, other FROM ({TRA}) r"


@query("sv_6_counts", f"""
WITH l AS ({LINKS}) SELECT sv_type, sv_id, count(*) AS n_matches FROM (SELECT sv_type, sv_id FROM l UNION ALL SELECT sv_type, other FROM l) m GROUP BY sv_type, sv_id""")
def sv_6_counts(t):
    plain, tra = sv.caller_classes(t.fx_sv, "c1", "c2", 2000)
    return match_counts(plain).select("sv_type", F.col("id").alias("sv_id"), "n_matches").unionByName(
        match_counts(tra).select(F.lit("tra").alias("sv_type"), F.col("id").alias("sv_id"), "n_matches"))


@query("sv_7_connected", f"""
WITH RECURSIVE l AS ({LINKS}), e AS (SELECT sv_type, sv_id AS a, other AS b FROM l UNION SELECT sv_type, other, sv_id FROM l),
 r(sv_type, a, b) AS (SELECT sv_type, a, a FROM e UNION SELECT r.sv_type, r.a, e.b FROM r JOIN e ON e.sv_type = r.sv_type AND e.a = r.b)
SELECT a AS sv_id, sv_type, sv_type || ':' || min(b) AS event_id FROM r GROUP BY a, sv_type""")
def sv_7_connected(t):
    return sv.connected_events(t.fx_sv, "c1", "c2", 2000)


STATUS = "CASE WHEN coord2 % 7 = 0 THEN 'FAIL_REASONS: filter_dgv' ELSE 'OVERALL_PASS' END"
PASSED = f"""
WITH e AS (SELECT * FROM ({EVENTS}) q), c AS (SELECT s.*, {STATUS} AS final_status, e.event_id FROM fx_sv s LEFT JOIN e ON s.sv_id = e.sv_id AND s.sv_type = e.sv_type),
 w AS (SELECT event_id, bool_or(final_status NOT LIKE '%PASS%') AS bad FROM c WHERE event_id IS NOT NULL GROUP BY event_id)
SELECT c.sv_id, c.sv_type, c.caller, c.coord1, c.final_status, c.event_id, CASE WHEN w.bad = false THEN 1 ELSE 0 END AS passed FROM c LEFT JOIN w ON c.event_id = w.event_id"""


def passed(t):
    calls = t.fx_sv.withColumn("final_status", F.expr(STATUS))
    return sv.propagate_status(calls, settle(events(t)))


@query("sv_9", PASSED)
def sv_9(t):
    return passed(t).select("sv_id", "sv_type", "caller", "coord1", "final_status", "event_id", "passed")


@query("sv_10", f"""
WITH p AS (SELECT *, CASE WHEN coord1 % 3 = 0 THEN 1 ELSE 0 END AS exon_event, CASE WHEN coord1 % 4 <> 1 THEN 1 ELSE 0 END AS gene_event FROM ({PASSED}) q),
 l AS (SELECT sv_type, event_id FROM p WHERE passed = 1 AND exon_event = 1 AND gene_event = 1 GROUP BY ALL),
 t AS (SELECT p.*, CASE WHEN passed = 1 AND gene_event = 1 AND (exon_event = 1 OR l.event_id IS NOT NULL) THEN 'HIGH' WHEN passed = 1 AND exon_event = 0 AND gene_event = 1 AND p.sv_type IN ('del', 'dup') THEN 'MEDIUM'
  WHEN passed = 0 AND exon_event = 1 AND gene_event = 1 THEN 'MEDIUM' WHEN passed = 1 AND exon_event = 0 AND p.sv_type IN ('tra', 'inv') THEN 'LOW' WHEN passed = 0 AND exon_event = 0 THEN 'LOWEST' ELSE 'NOT_REPORTED' END AS priority
  FROM p LEFT JOIN l ON p.sv_type = l.sv_type AND p.event_id = l.event_id),
 k AS (SELECT sv_type, event_id, priority, passed, count(DISTINCT caller) AS c, count(DISTINCT sv_id) AS n FROM t WHERE event_id IS NOT NULL GROUP BY 1, 2, 3, 4)
SELECT t.sv_id, t.sv_type, t.event_id, t.passed, t.exon_event, t.gene_event, t.priority, coalesce(k.c, 1) AS caller_count, coalesce(k.n, 1) AS call_count
FROM t LEFT JOIN k ON t.sv_type = k.sv_type AND t.event_id = k.event_id AND t.priority = k.priority AND t.passed = k.passed""")
def sv_10(t):
    calls = passed(t).withColumn("exon_event", F.expr("CASE WHEN coord1 % 3 = 0 THEN 1 ELSE 0 END")).withColumn(
        "gene_event", F.expr("CASE WHEN coord1 % 4 <> 1 THEN 1 ELSE 0 END"))
    return sv.priority_tiers(calls).select("sv_id", "sv_type", "event_id", "passed", "exon_event", "gene_event", "priority",
                                           "caller_count", "call_count")


GENES = """
WITH pt AS (SELECT sv_id, chr1 AS c, coord1 AS p FROM fx_sv UNION ALL SELECT sv_id, chr2, coord2 FROM fx_sv),
 sp AS (SELECT sv_id, chr1 AS c, coord1 AS s, coord2 AS e FROM fx_sv WHERE sv_type <> 'tra' UNION ALL SELECT p.sv_id, p.c, p.p, p.p FROM pt p JOIN fx_sv v ON p.sv_id = v.sv_id AND v.sv_type = 'tra'),
 g AS (SELECT sv_id, string_agg(DISTINCT gene, ',' ORDER BY gene) AS genes, count(DISTINCT gene) AS n FROM sp JOIN fx_gene x ON x.chrom = c AND x.start <= e AND x."end" >= s GROUP BY sv_id),
 bg AS (SELECT sv_id, string_agg(DISTINCT gene, ',' ORDER BY gene) AS b FROM pt JOIN fx_gene x ON x.chrom = c AND x.start <= p AND x."end" >= p GROUP BY sv_id),
 be AS (SELECT sv_id, string_agg(DISTINCT exon, ',' ORDER BY exon) AS b FROM pt JOIN fx_exon x ON x.chrom = c AND x.start <= p AND x."end" >= p GROUP BY sv_id)
SELECT v.sv_id, v.sv_type, g.genes, coalesce(g.n, 0) AS gene_count, bg.b AS breakpoint_genes, coalesce(be.b, 'NO_EXON_BP') AS breakpoint_exons
FROM fx_sv v LEFT JOIN g ON v.sv_id = g.sv_id LEFT JOIN bg ON v.sv_id = bg.sv_id LEFT JOIN be ON v.sv_id = be.sv_id"""


def overlaps(t):
    return sv.gene_overlap(t.fx_sv.select("sv_id", "sv_type", "chr1", "coord1", "chr2", "coord2"), t.fx_gene, t.fx_exon)


@query("sv_11", GENES)
def sv_11(t):
    return overlaps(t).drop("chr1", "coord1", "chr2", "coord2")


@query("sv_12", f"""
WITH o AS (SELECT * FROM ({GENES}) q) SELECT sv_id, CASE WHEN breakpoint_genes IS NOT NULL THEN breakpoint_genes WHEN gene_count = 0 THEN 'NO_GENES' ELSE genes END AS report_genes FROM o""")
def sv_12(t):
    return sv.genes_to_report(overlaps(t)).select("sv_id", "report_genes")


# Translocations by both breakpoints.
@query("sv_13", """
WITH sp AS (SELECT sv_id, chr1 AS c, coord1 AS s, coord2 AS e FROM fx_sv WHERE sv_type <> 'tra' UNION ALL SELECT sv_id, chr1, coord1, coord1 FROM fx_sv WHERE sv_type = 'tra'
  UNION ALL SELECT sv_id, chr2, coord2, coord2 FROM fx_sv WHERE sv_type = 'tra'),
 h AS (SELECT DISTINCT sp.sv_id, g.gene FROM sp JOIN fx_gene g ON g.chrom = c AND g.start <= e AND g."end" >= s)
SELECT v.sv_id, coalesce(h.gene, 'NO_GENE') AS gene, i.descr, i.family FROM fx_sv v LEFT JOIN h ON v.sv_id = h.sv_id LEFT JOIN fx_gene_info i ON h.gene = i.gene""")
def sv_13(t):
    from genoloom.operators.intervals import overlap_pairs

    tra = t.fx_sv.where("sv_type = 'tra'")
    spans = t.fx_sv.where("sv_type <> 'tra'").selectExpr("sv_id", "chr1 AS chrom", "coord1 AS start", "coord2 AS `end`")
    for chrom, at in (("chr1", "coord1"), ("chr2", "coord2")):
        spans = spans.unionByName(tra.selectExpr("sv_id", f"{chrom} AS chrom", f"{at} AS start", f"{at} AS `end`"))
    hits = t.fx_sv.select("sv_id").join(
        overlap_pairs(spans, t.fx_gene.select("chrom", "start", "end", "gene"), bin_width=10_000).select("sv_id", "gene"), "sv_id", "left")
    return sv.gene_summary(hits, t.fx_gene_info, ["descr", "family"])


CROSS = """
WITH f AS (SELECT v.*, s.family, s.relation, s.affected, least(chr1, chr2) AS lo, greatest(chr1, chr2) AS hi, CASE WHEN chr1 < chr2 THEN coord1 ELSE coord2 END AS x, CASE WHEN chr1 < chr2 THEN coord2 ELSE coord1 END AS y
  FROM fx_famsv v JOIN fx_sample s ON v.sample = s.sample),
 p AS (SELECT * FROM f WHERE relation = 'proband'), o AS (SELECT * FROM f WHERE relation <> 'proband'),
 m AS (SELECT DISTINCT p.sv_id, o.sample, o.affected FROM p JOIN o ON p.family = o.family AND p.sv_type = o.sv_type AND p.chr1 = o.chr1 AND p.sv_type <> 'tra' AND abs(p.coord1 - o.coord1) <= 250 AND abs(p.coord2 - o.coord2) <= 250
   AND ((o.coord1 <= p.coord2 AND o.coord2 >= p.coord1) OR (abs(p.coord1 - o.coord1) < 250 AND abs(p.coord2 - o.coord2) < 250))
  UNION SELECT p.sv_id, o.sample, o.affected FROM p JOIN o ON p.family = o.family AND p.sv_type = 'tra' AND o.sv_type = 'tra' AND p.lo = o.lo AND p.hi = o.hi AND abs(p.x - o.x) < 500 AND abs(p.y - o.y) < 500)
SELECT p.family, p.sv_id, p.sv_type, 1 + count(CASE WHEN m.affected = 1 THEN 1 END) AS affected_carriers, count(CASE WHEN m.affected = 0 THEN 1 END) AS unaffected_carriers,
 concat_ws(',', any_value(p.sample), string_agg(m.sample, ',' ORDER BY m.sample)) AS samples FROM p LEFT JOIN m ON p.sv_id = m.sv_id GROUP BY p.family, p.sv_id, p.sv_type"""


@query("sv_14", CROSS)
def sv_14(t):
    return sv.cross_sample_match(t.fx_famsv, t.fx_sample, 250)


@query("sv_15", f"""
SELECT *, row_number() OVER (ORDER BY affected_carriers DESC, unaffected_carriers, CASE priority WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 ELSE 3 END, sv_type, sv_id, family) AS rank
FROM (SELECT *, CASE WHEN sv_id LIKE '%1' THEN 'HIGH' WHEN sv_id LIKE '%2' THEN 'MEDIUM' ELSE 'LOW' END AS priority FROM ({CROSS}) c) p""")
def sv_15(t):
    ranked = sv.cross_sample_match(t.fx_famsv, t.fx_sample, 250).withColumn(
        "priority", F.expr("CASE WHEN sv_id LIKE '%1' THEN 'HIGH' WHEN sv_id LIKE '%2' THEN 'MEDIUM' ELSE 'LOW' END"))
    return sv.rank_family_events(ranked)


@query("sv_16", f"WITH b AS ({BASE}) SELECT 'D' || n AS sv_id, n % 7 AS pe, CASE WHEN n % 3 = 0 THEN n % 5 ELSE 0 END AS sr FROM b WHERE n % 10 <> 0 AND n % 7 + CASE WHEN n % 3 = 0 THEN n % 5 ELSE 0 END >= 4")
def sv_16(t):
    return sv.enough_support(sv.normalise_delly(t.fx_delly)).select("sv_id", "pe", "sr")
