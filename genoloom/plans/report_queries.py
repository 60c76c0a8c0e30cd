"""RPT-*, ACC-* and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoloom.operators import accuracy as ac
from genoloom.operators import aggregates as ag
from genoloom.operators import filters as fl
from genoloom.operators import intervals as iv
from genoloom.operators import joins as jn
from genoloom.operators import reports as rp
from genoloom.plans.registry import query
from genoloom.plans.sv_queries import BASE
from genoloom.session import settle

CLASSED = """
SELECT *, CASE WHEN filter_dbsnp = 'N/A' THEN 'N/A' WHEN filter_dbsnp = 'PASS' THEN 'NOVEL' WHEN var_freq IS NULL THEN 'NO_FREQ' WHEN var_freq < 0.02 THEN 'RARE_ALLELE' WHEN ref_freq < 0.02 THEN 'RARE_REF' ELSE 'COMMON' END AS population_class,
 CASE WHEN filter_dbsnp IN ('PASS', 'N/A') THEN 0 WHEN var_freq < 0.02 THEN 0 ELSE 1 END AS population_fail FROM fx_report"""


@query("rpt_1", f"WITH c AS ({CLASSED}) SELECT id, population_class, population_fail FROM c")
def rpt_1(t):
    return rp.population_class(t.fx_report).select("id", "population_class", "population_fail")


# Of the events without a frequency every other one is in the catalogue.
SV_REPORT = f"""
SELECT sv_id, CASE WHEN sv_type = 'tra' THEN CASE WHEN n % 2 = 0 THEN 'FAIL' ELSE 'PASS' END WHEN n % 10 = 0 THEN 'N/A' ELSE 'FAIL' END AS filter_dgv,
 CASE WHEN sv_type <> 'tra' THEN CAST(n % 100 AS DOUBLE) / 100 END AS dgv_freq, CAST(n % 7 AS INT) AS pe, CASE WHEN n % 3 = 0 THEN CAST(n % 5 AS INT) END AS sr FROM ({BASE}) b"""
SV_CLASSED = f"""
SELECT *, CASE WHEN population_class IN ('NO_FREQ', 'RARE_REF', 'COMMON') THEN 1 ELSE 0 END AS population_fail FROM (
 SELECT *, CASE filter_dgv WHEN 'N/A' THEN 'N/A' WHEN 'PASS' THEN 'NOVEL' ELSE CASE WHEN dgv_freq IS NULL THEN 'NO_FREQ' WHEN dgv_freq < 0.02 THEN 'RARE_ALLELE' WHEN 1 - dgv_freq < 0.02 THEN 'RARE_REF' ELSE 'COMMON' END END AS population_class
 FROM ({SV_REPORT}) r) c"""


def sv_classed(t):
    return rp.sv_population_class(t.sql(SV_REPORT.replace("fx_sv", "{fx_sv}")))


@query("rpt_1_sv", f"SELECT sv_id, population_class, population_fail FROM ({SV_CLASSED}) q")
def rpt_1_sv(t):
    return sv_classed(t).select("sv_id", "population_class", "population_fail")


@query("rpt_2_sv", f"""
SELECT sv_id, coalesce('FAIL REASONS: ' || nullif(concat_ws(' , ', CASE WHEN population_fail = 1 THEN 'filter_dgv' END,
 CASE WHEN coalesce(sr, 0) + coalesce(pe, 0) < 4 THEN 'Not enough supporting reads' END), ''), 'OVERALL_PASS') AS final_status FROM ({SV_CLASSED}) q""")
def rpt_2_sv(t):
    return rp.apply_rules(sv_classed(t), population_reason="filter_dgv", min_support=4).select("sv_id", "final_status")


RULED = f"""
SELECT *, coalesce('FAIL REASONS: ' || nullif(concat_ws(' , ', CASE WHEN population_fail = 1 THEN 'filter_dbsnp' END, CASE WHEN quality < 20 THEN 'quality < 20' END, CASE WHEN depth < 5 THEN 'depth < 5' END,
 CASE WHEN ref || '->' || alt = 'C->G' THEN 'base_change' END, CASE WHEN filter_common = 'PREVIOUSLY_SEEN' THEN 'filter_common' END), ''), 'OVERALL_PASS') AS final_status FROM ({CLASSED}) c"""


def ruled(t):
    return rp.apply_rules(rp.population_class(t.fx_report), {"quality": 20, "depth": 5}, ["C->G"], ["filter_common"])


@query("rpt_2", f"WITH r AS ({RULED}) SELECT id, final_status FROM r")
def rpt_2(t):
    return ruled(t).select("id", "final_status")


SYNED = f"SELECT * EXCLUDE (final_status), CASE WHEN final_status = 'OVERALL_PASS' AND exon_type = 'SYN' AND var_type = 'SNV' THEN 'synonomous FAIL' ELSE final_status END AS final_status FROM ({RULED}) r"


@query("rpt_3", f"WITH s AS ({SYNED}) SELECT id, final_status FROM s")
def rpt_3(t):
    return rp.fail_synonymous(ruled(t)).select("id", "final_status")


@query("rpt_4", " UNION ALL ".join(
    f"SELECT '{f}' AS filter, count(CASE WHEN {f} IN ('PASS', '1') THEN 1 END) AS pass, count(CASE WHEN {f} IN ('FAIL', '0') THEN 1 END) AS fail FROM fx_report"
    for f in ("filter_dbsnp", "filter_exac", "filter_common")))
def rpt_4(t):
    return rp.filter_counts(t.fx_report, ["filter_dbsnp", "filter_exac", "filter_common"])


@query("rpt_5", f"""
WITH s AS (SELECT *, var_type AS var_class, final_status = 'OVERALL_PASS' AS ok, exon_type LIKE '%SPLICE%' AS sp FROM ({SYNED}) q), a AS (SELECT count(*) AS n FROM s), g AS (SELECT gene, count(*) AS n FROM s WHERE ok GROUP BY gene)
SELECT 'class' AS section, lower(var_class) AS item, CAST(count(*) AS DOUBLE) AS n, count(*) / any_value(a.n) * 100 AS percent FROM s, a GROUP BY var_class
UNION ALL SELECT 'exon_type', lower(exon_type), count(*), count(*) / any_value(a.n) * 100 FROM s, a WHERE NOT sp GROUP BY exon_type
UNION ALL SELECT 'splice', exon_type, count(*), count(*) / any_value(a.n) * 100 FROM s, a WHERE sp GROUP BY exon_type
UNION ALL SELECT 'place', CASE WHEN sp THEN 'splice' ELSE 'exonic' END, count(*), count(*) / any_value(a.n) * 100 FROM s, a GROUP BY sp
UNION ALL SELECT 'passed', CASE WHEN sp THEN 'splice' ELSE 'exonic' END, count(*), count(*) / any_value(a.n) * 100 FROM s, a WHERE ok GROUP BY sp
UNION ALL SELECT 'passed', 'distinct_genes', count(*), NULL FROM g UNION ALL SELECT 'passed', 'median_depth', median(depth), NULL FROM s WHERE ok UNION ALL SELECT 'passed', 'median_quality', median(quality), NULL FROM s WHERE ok
UNION ALL SELECT 'genes_hit_again', gene, n, NULL FROM g WHERE n > 1""")
def rpt_5(t):
    rows = rp.fail_synonymous(ruled(t)).select(
        F.col("var_type").alias("var_class"), "exon_type", "final_status", "gene", "depth", "quality")
    return rp.run_summary(settle(rows))


@query("rpt_6", """
SELECT id, var_type, exon_type, depth, chrom, start, row_number() OVER (ORDER BY var_type, CASE WHEN exon_type LIKE '%SPLICE%' THEN 1 ELSE 0 END, depth DESC, chrom, start, id) AS rank
FROM fx_report""")
def rpt_6(t):
    return rp.order_report(t.fx_report.select("id", "var_type", "exon_type", "depth", "chrom", "start"))


LOCUS_RANK = "CASE chrom WHEN 'X' THEN 23 WHEN 'Y' THEN 24 ELSE coalesce(try_cast(chrom AS INT), 99) END"


@query("rpt_7", f"""
SELECT id, given_status AS final_status, affected_carriers, unaffected_carriers, var_freq, chrom, start,
 row_number() OVER (ORDER BY CASE WHEN given_status <> 'OVERALL_PASS' THEN 1 ELSE 0 END, affected_carriers DESC, unaffected_carriers, coalesce(var_freq, 0), {LOCUS_RANK}, start, id) AS rank
FROM fx_report""")
def rpt_7(t):
    return rp.order_cohort(t.fx_report.withColumnRenamed("given_status", "final_status").select(
        "id", "final_status", "affected_carriers", "unaffected_carriers", "var_freq", "chrom", "start"))


@query("rpt_8", f"""
WITH s AS ({SYNED}) SELECT id, population_class, CASE WHEN final_status <> 'OVERALL_PASS' THEN 'LOW_PRIORITY' WHEN population_class = 'RARE_ALLELE' THEN 'RARE' WHEN population_class = 'NO_FREQ' THEN 'NO_FREQ' ELSE 'NOVEL' END AS tier FROM s""")
def rpt_8(t):
    return rp.tiers(rp.fail_synonymous(ruled(t))).select("id", "population_class", "tier")


@query("rpt_9", """
SELECT id, CASE WHEN id % 3 = 0 THEN 'R->Q' ELSE 'NO_AA_CHANGE' END AS aa_change, CASE WHEN id % 5 = 0 THEN 'NO_GMAF' ELSE '0.0' || (depth % 9) END AS gmaf,
 CASE WHEN id % 4 = 0 THEN CAST(qual AS VARCHAR) ELSE 'NO_GNOMAD' END AS gnomad, coalesce(nullif(CASE WHEN id % 7 = 0 THEN '' ELSE 'x' END, ''), 'NO_DBSNP') AS rs FROM fx_variant""")
def rpt_9(t):
    rows = t.fx_variant.selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'R->Q' END AS aa_change", "CASE WHEN id % 5 = 0 THEN 'N/A' ELSE '0.0' || (depth % 9) END AS gmaf",
        "CASE WHEN id % 4 = 0 THEN qual END AS gnomad", "CASE WHEN id % 7 = 0 THEN '' ELSE 'x' END AS rs")
    return rp.fill_sentinels(rows)


WORDS = ("immun", "colitis")
POINTS = """CASE freq_text WHEN 'N/A' THEN 3 WHEN 'No_freq' THEN 3 ELSE CASE WHEN CAST(freq_text AS DOUBLE) < 0.05 THEN 0.5 ELSE 0 END + CASE WHEN CAST(freq_text AS DOUBLE) < 0.02 THEN 1 ELSE 0 END + CASE WHEN CAST(freq_text AS DOUBLE) < 0.005 THEN 0.5 ELSE 0 END END"""
HARM = """CASE WHEN sift_score = 'N/A' OR polyphen_score = 'N/A' THEN 1 WHEN CAST(sift_score AS DOUBLE) < 0.05 OR CAST(polyphen_score AS DOUBLE) > 0.7 THEN 1 ELSE 0 END
 + CASE WHEN cadd_phred = 'N/A' THEN 1 WHEN CAST(cadd_phred AS DOUBLE) > 10 THEN 1 ELSE 0 END"""
TAIL = "CASE WHEN go = 'NO_GO' OR go LIKE '%immun%' THEN 1 ELSE 0 END + CASE WHEN phenotype LIKE '%colitis%' THEN 2 WHEN phenotype = 'NO_PHENOTYPE' THEN 1 ELSE 0 END"


def score_sql(types: str, harm: str) -> str:
    return f"""
SELECT id, CAST(CASE WHEN samples LIKE '%s2%' AND exon_type IN ({types}) AND given_status = 'OVERALL_PASS' AND (exac = 'N/A' OR CAST(split_part(exac, ':', 2) AS DOUBLE) < 0.02)
 THEN {POINTS.replace("freq_text WHEN 'N/A'", "freq_text WHEN 'N/A'")} + {harm} + {TAIL} ELSE 0 END AS DOUBLE) AS variant_score_total, CASE WHEN gene IN ('G7', 'G70') THEN 1 ELSE 0 END AS gene_filter FROM fx_report""".replace(
        "CAST(freq_text", "TRY_CAST(freq_text").replace("CAST(sift", "TRY_CAST(sift").replace("CAST(polyphen", "TRY_CAST(polyphen").replace(
        "CAST(cadd", "TRY_CAST(cadd").replace("CAST(split", "TRY_CAST(split")


def scored(t):
    return t.fx_report.withColumn("final_status", F.col("given_status")).withColumn("var_freq", F.col("freq_text"))


@query("rpt_10", score_sql("'MISSENSE', 'NONSENSE', 'SPLICE (1)', 'SPLICE (2)', 'SPLICE (3)'", HARM))
def rpt_10(t):
    return rp.variant_score(scored(t), WORDS, ["G7", "G70"]).select("id", "variant_score_total", "gene_filter")


@query("rpt_11", score_sql("'EXON', 'SPLICE (1)', 'SPLICE (2)', 'SPLICE (3)'", "0"))
def rpt_11(t):
    return rp.indel_score(scored(t), WORDS, ["G7", "G70"]).select("id", "variant_score_total", "gene_filter")


@query("rpt_12", """
SELECT chrom, pos, alt, string_agg(DISTINCT sample, '; ' ORDER BY sample) AS sample, string_agg(DISTINCT CAST(qual AS VARCHAR), '; ' ORDER BY CAST(qual AS VARCHAR)) AS qual FROM fx_call GROUP BY 1, 2, 3""")
def rpt_12(t):
    return rp.collapse_samples(t.fx_call, ["chrom", "pos", "alt"], ["sample", "qual"])


SAMPLES = [f"s{i}" for i in range(25)]


@query("rpt_13", "SELECT chrom, pos, " + ", ".join(f"max(CASE WHEN sample = '{s}' THEN zyg END) AS {s}" for s in SAMPLES) + " FROM fx_geno GROUP BY chrom, pos")
def rpt_13(t):
    return rp.genotype_matrix(t.fx_geno, ["chrom", "pos"], SAMPLES)


@query("rpt_13_files", "SELECT chrom, pos, " + ", ".join(f"coalesce(max(CASE WHEN sample = '{s}' THEN zyg END), 'NA') AS {s}" for s in SAMPLES)
       + " FROM fx_geno WHERE zyg <> 'No data' GROUP BY chrom, pos")
def rpt_13_files(t):
    parts = {s: t.fx_geno.where(f"sample = '{s}' AND zyg <> 'No data'").selectExpr("chrom", "pos", "zyg AS genotype") for s in SAMPLES}
    return rp.join_genotype_files(parts, ["chrom", "pos"])


CELLS = [f"s{i}" for i in range(2, 25)]
KNOWN = "SELECT chrom, start AS pos, CASE WHEN start % 9 = 0 THEN 'rs1' END AS rs, CASE WHEN start % 4 = 0 THEN 0.01 ELSE 0.0005 END AS gnomad FROM {fx_gene}"


@query("rpt_14", "WITH k AS (" + KNOWN.replace("{", "").replace("}", "") + "), w AS (SELECT chrom, pos, " + ", ".join(
    f"max(CASE WHEN sample = '{s}' THEN CASE zyg WHEN 'ref' THEN 0 WHEN 'No data' THEN 3 ELSE 1 END END) AS {s}" for s in CELLS)
    + """, count(CASE WHEN sample IN ('s0', 's1') AND zyg = 'ref' THEN 1 END) AS r, count(CASE WHEN sample NOT IN ('s0', 's1') AND zyg = 'No data' THEN 1 END) AS m FROM fx_geno GROUP BY chrom, pos)
SELECT * EXCLUDE (r, m) FROM w WHERE r = 2 AND m < 3 AND NOT EXISTS (SELECT 1 FROM k WHERE k.chrom = w.chrom AND k.pos = w.pos AND (k.rs IS NOT NULL OR k.gnomad > 0.001))""")
def rpt_14(t):
    return rp.cell_matrix(t.fx_geno, ["s0", "s1"], t.sql(KNOWN), ["chrom", "pos"], CELLS, max_no_call=3)


@query("rpt_15", f"""
SELECT id, freq_text, chrom, start, row_number() OVER (ORDER BY coalesce(try_cast(freq_text AS DOUBLE), 0) DESC, CASE WHEN try_cast(freq_text AS DOUBLE) IS NULL THEN 1 ELSE 0 END, {LOCUS_RANK}, start, id) AS rank
FROM fx_report""")
def rpt_15(t):
    return rp.sort_by_column(t.fx_report.select("id", "freq_text", "chrom", "start"), "freq_text")


@query("rpt_16", "SELECT filter_name, count(CASE WHEN filtermatch = 1 THEN 1 END) AS match, count(CASE WHEN filtermatch = 0 THEN 1 END) AS nomatch FROM fx_filter GROUP BY filter_name")
def rpt_16(t):
    return rp.filter_ledger(t.fx_filter)


@query("rpt_17", """
WITH v AS (SELECT id, chrom, start, "end", qual, depth % 4 AS ac, CASE WHEN id % 3 = 0 THEN 0 ELSE depth % 7 END AS total_ac FROM fx_variant)
SELECT id, chrom, start, "end", qual, ac, total_ac, qual / nullif(CASE WHEN total_ac > 0 THEN total_ac ELSE sum(ac) OVER (PARTITION BY chrom, start, "end") END, 0) AS average_quality FROM v""")
def rpt_17(t):
    rows = t.fx_variant.selectExpr("id", "chrom", "start", "`end`", "qual", "depth % 4 AS ac", "CASE WHEN id % 3 = 0 THEN 0 ELSE depth % 7 END AS total_ac")
    return rp.average_quality(rows)


@query("rpt_18", """
SELECT chrom || ':' || start || ':' || "end" || ':' || bases || ':G' || (id % 9) || ':' || CASE WHEN id % 2 = 0 THEN 'R->Q' ELSE 'stop_gained' END AS variant, depth AS g0, qual AS g1 FROM fx_variant WHERE id % 4 <> 0""")
def rpt_18(t):
    rows = t.fx_variant.selectExpr("chrom", "start", "`end`", "bases", "'G' || (id % 9) AS gene", "CASE WHEN id % 2 = 0 THEN 'R->Q' END AS aa_change",
                                   "'stop_gained' AS consequence", "id % 4 <> 0 AS priority", "depth AS g0", "qual AS g1")
    return rp.group_listing(rows, ["g0", "g1"])


FILTERS = ("filter_a", "filter_b", "filter_c")


@query("rpt_19", """
WITH g AS (SELECT v.chrom, v.start, v."end", string_agg(DISTINCT x.gene, ',' ORDER BY x.gene) AS gene, string_agg(DISTINCT x.descr, ',' ORDER BY x.descr) AS descr FROM (SELECT DISTINCT chrom, start, "end" FROM fx_variant) v
  JOIN fx_gene x ON x.chrom = v.chrom AND x.start <= v."end" AND x."end" >= v.start GROUP BY 1, 2, 3), f AS (SELECT id, """ + ", ".join(
    f"coalesce(CAST(max(CASE WHEN filter_name = '{f}' THEN filterpass END) AS VARCHAR), 'nodata') AS {f}" for f in FILTERS) + """ FROM fx_filter GROUP BY id)
SELECT v.id, v.chrom, v.start, v.bases, coalesce(g.gene, 'No gene overlap') AS gene, coalesce(g.descr, 'No gene overlap') AS descr, """ + ", ".join(
    f"coalesce(f.{f}, 'N/A') AS {f}" for f in FILTERS) + ' FROM fx_variant v LEFT JOIN g ON g.chrom = v.chrom AND g.start = v.start AND g."end" = v."end" LEFT JOIN f ON f.id = v.id')
def rpt_19(t):
    calls = t.fx_variant
    genes = iv.locus_pairs(calls.select("chrom", "start", "end").distinct(), t.fx_gene)
    matrix = jn.filter_matrix(t.fx_filter, [f"filter_{c}" for c in "abc"])
    return rp.assemble_lines(calls, genes, matrix, ["gene", "descr"], list(FILTERS), ["id", "chrom", "start", "bases", "gene", "descr", *FILTERS])


@query("rpt_20", """
SELECT chrom, pos, count(CASE WHEN zyg IN ('het', 'hom') THEN 1 END) AS pass_count, count(CASE WHEN zyg NOT IN ('het', 'hom') THEN 1 END) AS nopass_count,
 coalesce(string_agg(CASE WHEN zyg IN ('het', 'hom') THEN sample END, ',' ORDER BY sample), '') AS carriers, count(CASE WHEN zyg IN ('het', 'hom') THEN 1 END) / count(*) * 100 AS pass_percent FROM fx_geno GROUP BY chrom, pos""")
def rpt_20(t):
    geno = t.fx_geno.selectExpr("chrom", "pos", "sample", "CASE zyg WHEN 'het' THEN '0/1' WHEN 'hom' THEN '1|1' ELSE '.' END AS gt")
    return rp.pass_counts(geno, ["chrom", "pos"])


CALLERS = """
SELECT id, chrom, start, "end", bases, var_type, CASE id % 3 WHEN 0 THEN 'gatk' WHEN 1 THEN 'strelka' ELSE 'freebayes' END AS caller FROM {fx_variant}
UNION ALL SELECT id, chrom, start, "end", bases, var_type, 'second' FROM {fx_variant} WHERE id % 4 = 0"""
CALLERS_SQL = CALLERS.replace("{", "").replace("}", "")
TRUTH = "SELECT chrom, start, \"end\", var_type FROM {fx_variant} WHERE filter <> 'PASS' OR id % 5 = 0"
TRUTH_SQL = TRUTH.replace("{", "").replace("}", "")
# Wide regions so that many calls lie inside.
REGIONS_SQL = 'SELECT chrom, start - 3000 AS start, "end" + 3000 AS "end" FROM fx_gene WHERE CAST(substr(gene, 2) AS BIGINT) % 3 = 0'


def truth_sql(calls: str) -> str:
    return f"""
WITH c AS ({calls}), tr AS ({TRUTH_SQL}), rg AS ({REGIONS_SQL}), i AS (SELECT * FROM c WHERE EXISTS (SELECT 1 FROM rg WHERE rg.chrom = c.chrom AND rg.start <= c."end" AND rg."end" >= c.start)),
 m AS (SELECT i.*, EXISTS (SELECT 1 FROM tr WHERE tr.chrom = i.chrom AND tr.var_type = i.var_type AND tr.start <= i."end" AND tr."end" >= i.start) AS hit FROM i),
 g AS (SELECT caller, var_type, count(*) AS in_regions, count(CASE WHEN hit THEN 1 END) AS in_truth FROM m GROUP BY caller, var_type)
SELECT g.*, tt.n AS truth_total, 100 - in_truth / in_regions * 100 AS false_positive, 100 - in_truth / tt.n * 100 AS false_negative FROM g JOIN (SELECT var_type, count(*) AS n FROM tr GROUP BY var_type) tt ON g.var_type = tt.var_type"""


def regions(t):
    return t.fx_gene.where("CAST(substr(gene, 2) AS BIGINT) % 3 = 0").selectExpr("chrom", "start - 3000 AS start", "`end` + 3000 AS `end`")


@query("acc_1", truth_sql(CALLERS_SQL))
def acc_1(t):
    return ac.truth_comparison(t.sql(CALLERS), regions(t), t.sql(TRUTH))


def shared_sql(op: str) -> str:
    return truth_sql(f"""SELECT a.* FROM ({CALLERS_SQL}) a JOIN (SELECT chrom, var_type, start, "end" FROM ({CALLERS_SQL}) b GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT caller) {op}) k
 ON a.chrom = k.chrom AND a.var_type = k.var_type AND a.start = k.start AND a."end" = k."end\"""")


@query("acc_2", shared_sql("> 1"))
def acc_2(t):
    return ac.truth_comparison(t.sql(CALLERS), regions(t), t.sql(TRUTH), shared=True)


@query("acc_2_single", shared_sql("= 1"))
def acc_2_single(t):
    return ac.truth_comparison(t.sql(CALLERS), regions(t), t.sql(TRUTH), shared=False)


@query("acc_3", f"""
WITH k AS (SELECT chrom, start, "end", bases, string_agg(DISTINCT caller, '&' ORDER BY caller) AS region FROM ({CALLERS_SQL}) c GROUP BY 1, 2, 3, 4) SELECT region, count(*) AS n FROM k GROUP BY region""")
def acc_3(t):
    return ac.concordance(t.sql(CALLERS), ["gatk", "strelka", "freebayes", "second"])


@query("acc_4", """
WITH h AS (SELECT DISTINCT chrom, pos FROM fx_popfreq WHERE freq > 0.5) SELECT sample, count(*) AS calls, count(h.pos) AS hits, count(h.pos) / count(*) * 100 AS percent, count(h.pos) / count(*) * 100 / 0.093 AS enrichment
FROM fx_call c LEFT JOIN h ON c.chrom = h.chrom AND c.pos = h.pos GROUP BY sample""")
def acc_4(t):
    return ac.hit_rate(t.fx_call.select("sample", "chrom", "pos"), t.fx_popfreq.where("freq > 0.5"), 0.093)


# Flagship: which rare calls fall in which genes, and how many samples carry them, in report order.
@query("flagship", """
WITH f AS (SELECT chrom, pos, max(freq) AS freq FROM fx_popfreq GROUP BY chrom, pos), c AS (SELECT DISTINCT chrom, pos, ref, alt, sample, CASE WHEN alt_reads / depth < 0.02 THEN 'ref' WHEN alt_reads / depth < 0.75 THEN 'het' ELSE 'hom' END AS zyg FROM fx_call),
 k AS (SELECT chrom, pos, ref, alt, count(CASE WHEN zyg = 'het' THEN 1 END) AS het_count, count(CASE WHEN zyg = 'hom' THEN 1 END) AS hom_count, count(CASE WHEN zyg <> 'ref' THEN 1 END) AS var_count,
  string_agg(DISTINCT CASE WHEN zyg <> 'ref' THEN sample END, ',' ORDER BY CASE WHEN zyg <> 'ref' THEN sample END) AS carriers FROM c GROUP BY 1, 2, 3, 4),
 g AS (SELECT p.chrom, p.pos, string_agg(DISTINCT x.gene, '^^^' ORDER BY x.gene) AS genes FROM (SELECT DISTINCT chrom, pos FROM fx_call) p JOIN fx_gene x ON x.chrom = p.chrom AND x.start <= p.pos AND x."end" >= p.pos GROUP BY 1, 2)
SELECT k.chrom, k.pos, k.ref, k.alt, g.genes, k.het_count, k.hom_count, k.var_count, k.carriers, f.freq FROM k JOIN g ON k.chrom = g.chrom AND k.pos = g.pos LEFT JOIN f ON f.chrom = k.chrom AND f.pos = k.pos
WHERE k.var_count >= 1 AND coalesce(f.freq, 0) <= 0.5""")
def flagship(t):
    from genoloom.operators.pileup import fraction_zygosity

    zyg = fraction_zygosity(t.fx_call.select("chrom", "pos", "ref", "alt", "sample", "alt_reads", "depth"))
    geno = zyg.select("chrom", "pos", "ref", "alt", "sample", "zyg").distinct()
    counts = fl.cohort_filter(
        ag.cohort_counts(geno, ["chrom", "pos", "ref", "alt"]).withColumn("mean_af", F.lit(None).cast("double")), min_samples=1)
    sites = counts.withColumn("start", F.col("pos")).withColumn("end", F.col("pos"))
    genes = t.fx_gene.select("chrom", "start", "end", F.col("gene").alias("name"))
    named = iv.overlap_matches(sites, genes, longest=0).withColumnRenamed("matches", "genes")
    rare = jn.annotate_position(named, t.fx_popfreq, ["freq"]).where("coalesce(freq, 0) <= 0.5")
    ordered = rare.orderBy(F.desc("var_count"), F.coalesce("freq", F.lit(0.0)), "chrom", "pos", "alt")
    return ordered.select("chrom", "pos", "ref", "alt", "genes", "het_count", "hom_count", "var_count", "carriers", "freq")
