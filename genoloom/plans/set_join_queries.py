"""SET-* and JON-*."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoloom.operators import joins as jn
from genoloom.operators import sets as st
from genoloom.plans.registry import query

KEYS = ["chrom", "pos"]
PICK = ("s0", "s1", "s2", "s3")
PICKED = "('s0', 's1', 's2', 's3')"
PER_KEY = "SELECT chrom, pos, count(DISTINCT sample) AS n FROM fx_call GROUP BY chrom, pos"
PER_PICKED = f"SELECT chrom, pos, count(DISTINCT sample) AS n FROM fx_call WHERE sample IN {PICKED} GROUP BY chrom, pos"


def sample_sets(t):
    return st.load_sets(t.fx_call, "sample", KEYS)


@query("set_1", "SELECT DISTINCT sample AS set_id, chrom, pos FROM fx_call")
def set_1(t):
    return sample_sets(t)


def grade_sets(t):
    """Two sets that share many keys: calls below and from quality 40."""
    return st.load_sets(t.fx_call.withColumn("grade", F.when(F.col("qual") < 40, "low").otherwise("high")), "grade",
                        ["chrom", "ref", "alt", "depth"])


@query("set_2", """
SELECT chrom, ref, alt, depth FROM fx_call WHERE qual < 40 INTERSECT
SELECT chrom, ref, alt, depth FROM fx_call WHERE qual >= 40""")
def set_2(t):
    return st.intersect(grade_sets(t), ["chrom", "ref", "alt", "depth"])


@query("set_2_list", f"WITH k AS ({PER_PICKED.replace(PICKED, chr(40) + chr(39) + 's0' + chr(39) + ', ' + chr(39) + 's1' + chr(39) + ')')}) SELECT chrom, pos FROM k WHERE n = 2")
def set_2_list(t):
    return st.intersect(sample_sets(t), KEYS, ["s0", "s1"])


@query("set_3", f"SELECT DISTINCT chrom, pos FROM fx_call WHERE sample IN {PICKED}")
def set_3(t):
    return st.union(sample_sets(t), KEYS, PICK)


@query("set_4", f"WITH k AS ({PER_KEY}) SELECT chrom, pos FROM k WHERE n >= 2")
def set_4(t):
    return st.in_at_least(sample_sets(t), KEYS, 2)


@query("set_5", f"WITH k AS ({PER_KEY}) SELECT chrom, pos FROM k WHERE n <= 1")
def set_5(t):
    return st.in_at_most(sample_sets(t), KEYS, 1)


@query("set_6", f"""
SELECT DISTINCT chrom, pos FROM fx_call WHERE sample IN {PICKED}
EXCEPT SELECT chrom, pos FROM fx_call WHERE sample IN ('s5', 's6')""")
def set_6(t):
    sets = sample_sets(t)
    return st.exclude(st.union(sets, KEYS, PICK), sets, KEYS, ["s5", "s6"])


@query("set_7", f"""
WITH k AS (SELECT chrom, ref, alt, depth, string_agg(DISTINCT sample, '&' ORDER BY sample) AS region FROM fx_call
 GROUP BY chrom, ref, alt, depth) SELECT region, count(*) AS n FROM k GROUP BY region""")
def set_7(t):
    keys = ["chrom", "ref", "alt", "depth"]
    return st.region_counts(st.load_sets(t.fx_call, "sample", keys), keys)


@query("set_8", f"""
WITH k AS (SELECT chrom, pos, count(DISTINCT sample) AS n FROM fx_call WHERE sample NOT IN ('s5', 's6') GROUP BY chrom, pos)
SELECT chrom, pos FROM k WHERE n = 1 EXCEPT SELECT chrom, pos FROM fx_call WHERE sample IN ('s5', 's6')""")
def set_8(t):
    return st.cohort_unique(sample_sets(t), KEYS, ["s5", "s6"])


@query("jon_1", """
SELECT g.gene, g.start, coalesce(i.descr, 'NO_ANNO') AS info, coalesce(i.family, 'NO_ANNO') AS family
FROM fx_gene g LEFT JOIN (SELECT * FROM fx_gene_info WHERE aa_length <> 7) i
 ON upper(g.gene) = upper(replace(i.raw_key, '"', ''))""")
def jon_1(t):
    info = t.fx_gene_info.where("aa_length <> 7").withColumnRenamed("descr", "info")
    return jn.annotate_by_key(t.fx_gene.select("gene", "start"), "gene", info, "raw_key", ["info", "family"])


@query("jon_2", """
WITH a AS (SELECT chrom, start, "end", bases, max(qual) AS qual FROM fx_variant WHERE snv_class = 'SOMATIC' GROUP BY ALL),
 b AS (SELECT chrom, start, "end", bases, max(depth) AS depth FROM fx_variant WHERE snv_class = 'LOH' GROUP BY ALL)
SELECT v.id, v.chrom, v.start, v."end", v.bases, a.qual AS som_qual, b.depth AS loh_depth FROM fx_variant v
LEFT JOIN a ON v.chrom = a.chrom AND v.start = a.start AND v."end" = a."end" AND v.bases = a.bases
LEFT JOIN b ON v.chrom = b.chrom AND v.start = b.start AND v."end" = b."end" AND v.bases = b.bases""")
def jon_2(t):
    v = t.fx_variant
    return jn.annotate_exact(v.select("id", "chrom", "start", "end", "bases"), {
        "som": (v.where("snv_class = 'SOMATIC'"), ["qual"]), "loh": (v.where("snv_class = 'LOH'"), ["depth"])})


@query("jon_3", """
WITH c AS (SELECT chrom, pos, alt, max(freq) AS freq FROM fx_popfreq GROUP BY chrom, pos, alt)
SELECT v.chrom, v.pos, v.alt, v.sample, v.depth,
 CASE WHEN c.freq IS NOT NULL THEN CAST(c.freq AS VARCHAR)
  WHEN EXISTS (SELECT 1 FROM fx_popfreq p WHERE p.chrom = v.chrom AND p.pos = v.pos) THEN 'OTHER_VARS_ONLY'
  ELSE 'NO_MGRB' END AS population
FROM fx_call v LEFT JOIN c ON v.chrom = c.chrom AND v.pos = c.pos AND v.alt = c.alt""")
def jon_3(t):
    calls = t.fx_call.select("chrom", "pos", "alt", "sample", "depth")
    return jn.catalogue_frequency(calls, t.fx_popfreq)


@query("jon_4", """
SELECT c.chrom, c.pos, c.alt, c.sample, c.qual, d.depth AS site_depth FROM fx_call c
LEFT JOIN fx_depth d ON c.chrom = d.chrom AND c.pos = d.pos AND d.depth > 20""")
def jon_4(t):
    matrix = t.fx_depth.where("depth > 20").withColumnRenamed("depth", "site_depth")
    return jn.annotate_position(t.fx_call.select("chrom", "pos", "alt", "sample", "qual"), matrix, ["site_depth"])


@query("jon_5", """
SELECT id, chrom, start, bases FROM fx_variant v WHERE chrom = '5' AND start BETWEEN 20000 AND 150000
AND EXISTS (SELECT 1 FROM fx_filter f WHERE f.id = v.id AND f.filter_name = 'filter_c' AND f.filterpass = 1)""")
def jon_5(t):
    return jn.passed_calls(t.fx_variant, t.fx_filter, "filter_c", chrom="5", start=20000, end=150000).select(
        "id", "chrom", "start", "bases")


@query("jon_6", """
SELECT id, chrom, start, bases FROM fx_variant v WHERE EXISTS (SELECT 1 FROM fx_filter f WHERE f.id = v.id
AND f.filter_name IN ('filter_a', 'filter_d') AND f.filterpass = 1)""")
def jon_6(t):
    return jn.any_filter_passed(t.fx_variant, t.fx_filter, ["filter_a", "filter_d"]).select("id", "chrom", "start", "bases")


@query("jon_7", """
WITH x AS (SELECT e.* FROM fx_exon e JOIN fx_gene g ON e.gene = g.gene AND g.descr IN ('Brand#1', 'Brand#2', 'Brand#3')),
 p AS (SELECT v.* FROM fx_variant v JOIN fx_run r ON v.run_id = r.run_id AND v.sample = r.sample AND r.production = 1)
SELECT p.var_type, x.gene, p.chrom, p.start, p.bases, count(DISTINCT p.sample) AS n,
 string_agg(DISTINCT p.sample, ',' ORDER BY p.sample) AS samples
FROM p JOIN x ON p.chrom = x.chrom AND greatest(x.start - 10, 0) <= p."end" AND x."end" + 10 >= p.start
GROUP BY p.var_type, x.gene, p.chrom, p.start, p.bases""")
def jon_7(t):
    genes = t.fx_gene.where("descr IN ('Brand#1', 'Brand#2', 'Brand#3')")
    return jn.gene_variants(genes, t.fx_exon, t.fx_variant, t.fx_run)


@query("jon_8", """
WITH a AS (SELECT chrom, start, "end", bases, max(struct_pack(d := depth, q := qual)) AS r FROM fx_variant
  WHERE run_id % 2 = 0 GROUP BY ALL),
 b AS (SELECT chrom, start, "end", bases, max(struct_pack(d := depth, q := qual)) AS r FROM fx_variant
  WHERE run_id % 3 <> 1 GROUP BY ALL)
SELECT coalesce(a.chrom, b.chrom) AS chrom, coalesce(a.start, b.start) AS start, coalesce(a."end", b."end") AS "end",
 coalesce(a.bases, b.bases) AS bases,
 CASE WHEN a.chrom IS NULL THEN 'Mutect' WHEN b.chrom IS NULL THEN 'Strelka' ELSE 'Strelka_Mutect' END AS algorithms,
 CASE WHEN a.chrom IS NULL OR b.chrom IS NULL OR a.r.d = b.r.d THEN CAST(coalesce(a.r.d, b.r.d) AS VARCHAR)
  ELSE a.r.d || ':' || b.r.d END AS depth,
 CASE WHEN a.chrom IS NULL OR b.chrom IS NULL OR a.r.q = b.r.q THEN CAST(coalesce(a.r.q, b.r.q) AS VARCHAR)
  ELSE a.r.q || ':' || b.r.q END AS qual
FROM a FULL JOIN b ON a.chrom = b.chrom AND a.start = b.start AND a."end" = b."end" AND a.bases = b.bases""")
def jon_8(t):
    v = t.fx_variant
    return jn.merge_reports(v.where("run_id % 2 = 0"), v.where("run_id % 3 <> 1"), ("Strelka", "Mutect"), ["depth", "qual"])


@query("jon_9", """
SELECT id, chrom, start, "end", bases FROM fx_variant WHERE filter = 'PASS' UNION ALL
SELECT id, chrom, start, "end", bases FROM fx_variant s WHERE filter <> 'PASS' AND NOT EXISTS (SELECT 1 FROM fx_variant m
 WHERE m.filter = 'PASS' AND m.chrom = s.chrom AND m.start = s.start AND m."end" = s."end")""")
def jon_9(t):
    v = t.fx_variant.select("id", "chrom", "start", "end", "bases", "filter")
    return jn.master_over_supplement(v.where("filter = 'PASS'"), v.where("filter <> 'PASS'")).drop("filter")


ENTRY = "'P' || sample || CASE WHEN depth % 3 = 0 THEN ':CCDS' || depth ELSE ':X' || depth END"


@query("jon_10", f"""
WITH e AS (SELECT chrom, pos, {ENTRY} AS entry, qual * 1000 + depth AS line_no,
  CASE WHEN alt_reads % 2 = 0 THEN 'mapped' ELSE 'unmapped' END AS source FROM fx_call),
 r AS (SELECT *, row_number() OVER (PARTITION BY chrom, pos ORDER BY
  CASE WHEN source = 'unmapped' THEN 2 WHEN regexp_matches(entry, 'CCDS[0-9]+$') THEN 0 ELSE 1 END, line_no, entry) AS rn FROM e)
SELECT chrom, pos, entry, source FROM r WHERE rn = 1""")
def jon_10(t):
    e = t.fx_call.selectExpr("chrom", "pos", f"{ENTRY} AS entry", "qual * 1000 + depth AS line_no", "alt_reads")
    return jn.ranked_fallback(e.where("alt_reads % 2 = 0"), e.where("alt_reads % 2 = 1"))


@query("jon_11", """
SELECT sample, run_id, run_stamp FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY run_stamp DESC, run_id DESC) AS rn
 FROM fx_run) q WHERE rn = 1""")
def jon_11(t):
    return jn.latest_run(t.fx_run)


@query("jon_11_production", """
SELECT sample, run_id, run_stamp FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY run_stamp DESC, run_id DESC) AS rn
 FROM fx_run WHERE production = 1) q WHERE rn = 1""")
def jon_11_production(t):
    return jn.production_run(t.fx_run)


@query("jon_12", """
WITH c AS (SELECT chrom, pos, CASE zyg WHEN 'het' THEN 'A/G' WHEN 'hom' THEN 'G/G' WHEN 'ref' THEN 'A/A' END AS g
 FROM fx_geno WHERE sample = 's3')
SELECT m.chrom, m.pos, m.gene, coalesce(c.g, 'NA') AS genotype FROM (SELECT chrom, start + 50 * (length(gene) % 3) AS pos, gene
 FROM fx_gene) m LEFT JOIN c ON m.chrom = c.chrom AND m.pos = c.pos""")
def jon_12(t):
    calls = t.fx_geno.where("sample = 's3'").selectExpr(
        "chrom", "pos", "'A' AS ref", "'G' AS alt",
        "CASE zyg WHEN 'het' THEN '0/1' WHEN 'hom' THEN '1/1' WHEN 'ref' THEN '0' ELSE './.' END AS gt")
    markers = t.fx_gene.selectExpr("chrom", "start + 50 * (length(gene) % 3) AS pos", "gene")
    return jn.marker_genotypes(markers, calls)


@query("jon_13", """
WITH v AS (SELECT gene, string_agg(DISTINCT descr, ',' ORDER BY descr) AS v FROM fx_gene WHERE length(descr) = 7 GROUP BY gene),
 o AS (SELECT homolog AS gene, string_agg(DISTINCT family, ',' ORDER BY family) AS o FROM fx_gene_info WHERE aa_length < 30 GROUP BY homolog)
SELECT i.gene, i.homolog, coalesce(v.v, 'NO_VOGELSTEIN') AS vogelstein, coalesce(o.o, 'NO_OMIM') AS omim
FROM fx_gene_info i LEFT JOIN v ON upper(i.gene) = upper(v.gene) LEFT JOIN o ON upper(i.homolog) = upper(o.gene)""")
def jon_13(t):
    genes = t.fx_gene_info.select("gene", "homolog")
    listed = t.fx_gene.where("length(descr) = 7").selectExpr("lower(gene) AS gene", "descr")
    omim = t.fx_gene_info.where("aa_length < 30").selectExpr("homolog AS gene", "family")
    return jn.gene_dictionary(genes, {"vogelstein": (listed, "descr")}, {"omim": (omim, "family")})


@query("jon_14", """
WITH d AS (SELECT chrom, pos, max(depth) AS depth FROM fx_depth GROUP BY chrom, pos)
SELECT v.id, v.chrom, v.start, v.var_type, coalesce(d.depth, 0) AS depth FROM fx_variant v
LEFT JOIN d ON v.chrom = d.chrom AND d.pos = CASE WHEN v.var_type = 'DEL' THEN v.start - 1 ELSE v.start END""")
def jon_14(t):
    return jn.attach_depth(t.fx_variant.select("id", "chrom", "start", "var_type", "depth"), t.fx_depth)


FILTERS = tuple("filter_" + c for c in "abcdefg")


@query("jon_15", "SELECT id, " + ", ".join(
    f"coalesce(CAST(max(CASE WHEN filter_name = '{f}' THEN filterpass END) AS VARCHAR), 'nodata') AS {f}" for f in FILTERS)
    + " FROM fx_filter GROUP BY id")
def jon_15(t):
    return jn.filter_matrix(t.fx_filter, FILTERS)
