"""FLT-*."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoloom.operators import filters as fl
from genoloom.plans.registry import query

V = ["id", "chrom", "start", "end", "bases", "var_type"]
VSQL = 'id, chrom, start, "end", bases, var_type'
QUAL = {"SNV": 20, "DEL": 40, "INS": 30}
QSQL = "qual >= CASE var_type WHEN 'SNV' THEN 20 WHEN 'DEL' THEN 40 ELSE 30 END"


@query("flt_1", f"SELECT {VSQL} FROM fx_variant WHERE depth BETWEEN 5 AND 50 AND {QSQL} AND snv_class IN ('SOMATIC', 'LOH')")
def flt_1(t):
    return fl.call_filter(t.fx_variant, 5, 50, QUAL, classes=("SOMATIC", "LOH")).select(V)


@query("flt_1_tumour", f"""
SELECT {VSQL} FROM fx_variant WHERE depth >= 5 AND {QSQL} AND clr <> 'NO_CLR' AND CAST(substr(clr, 4) AS INT) >= 15""".replace("substr(clr, 4)", "nullif(regexp_extract(clr, '[0-9]+'), '')"))
def flt_1_tumour(t):
    return fl.call_filter(t.fx_variant, 5, 50, QUAL, min_clr=15, targeted=True, tumour=True).select(V)


@query("flt_1_caller", f"SELECT {VSQL} FROM fx_variant WHERE filter = 'PASS'")
def flt_1_caller(t):
    return fl.call_filter(t.fx_variant, 5, 50, QUAL, caller_pass=True).select(V)


@query("flt_2", "SELECT doc_id, header FROM (SELECT doc_id, header, CASE WHEN doc_id % 3 = 0 THEN replace(seq, 'A', 'n') ELSE seq END AS seq FROM fx_seq) q WHERE upper(seq) NOT LIKE '%N%'")
def flt_2(t):
    seqs = t.fx_seq.selectExpr("doc_id", "header", "CASE WHEN doc_id % 3 = 0 THEN replace(seq, 'A', 'n') ELSE seq END AS seq")
    return fl.drop_unknown_bases(seqs, "seq").select("doc_id", "header")


@query("flt_3", f"SELECT {VSQL} FROM fx_variant WHERE chrom = '7' AND start BETWEEN 10000 AND 120000")
def flt_3(t):
    return fl.in_region(t.fx_variant, "7", 10000, 120000).select(V)


LISTED = "SELECT gene FROM fx_gene WHERE descr IN ('Brand#1', 'Brand#12')"


def listed(t):
    return t.fx_gene.where("descr IN ('Brand#1', 'Brand#12')").select("gene")


def gene_rows(t):
    return t.fx_exon.select("gene", "exon", "chrom", "start")


@query("flt_4", f"SELECT gene, exon, chrom, start FROM fx_exon WHERE gene IN ({LISTED})")
def flt_4(t):
    return fl.gene_include(gene_rows(t), listed(t))


@query("flt_5", f"SELECT gene, exon, chrom, start, CASE WHEN gene IN ({LISTED}) THEN 'problem_gene FAIL' ELSE 'PASS' END AS gene_status FROM fx_exon")
def flt_5(t):
    return fl.gene_exclude(gene_rows(t), listed(t))


PRED = """
SELECT id, CASE WHEN qual % 3 = 0 THEN 'benign' WHEN qual % 3 = 1 THEN 'probably_damaging' ELSE 'N/A' END AS polyphen_prediction,
 CASE WHEN depth % 2 = 0 THEN 'deleterious' ELSE 'tolerated' END AS sift_prediction,
 CASE WHEN depth % 5 = 0 THEN 'No_freq' ELSE '0.0' || (depth % 9 + 1) END AS var_allele_freq FROM {fx_variant}"""


@query("flt_6", f"""
WITH p AS ({PRED.replace('{', '').replace('}', '')}) SELECT * FROM p WHERE polyphen_prediction = 'probably_damaging'
AND sift_prediction = 'deleterious' AND TRY_CAST(var_allele_freq AS DOUBLE) <= 0.05""")
def flt_6(t):
    return fl.prediction_filter(t.sql(PRED), "probably_damaging", "deleterious", 0.05)


COHORT = """
SELECT chrom, pos, alt, CASE WHEN sum(depth) > 0 THEN CAST(sum(alt_reads) AS DOUBLE) / sum(depth) END AS mean_af,
 count(CASE WHEN alt_reads > 0 THEN 1 END) AS var_count, count(CASE WHEN qual = 0 THEN 1 END) AS no_call_count
FROM {fx_call} GROUP BY chrom, pos, alt"""


@query("flt_7", f"WITH c AS ({COHORT.replace('{', '').replace('}', '')}) SELECT * FROM c WHERE mean_af >= 0.3 AND no_call_count <= 10 AND var_count >= (SELECT count(*) // 2 FROM fx_sample)")
def flt_7(t):
    preset = fl.quality_preset("strict", t.fx_sample.count())
    return fl.cohort_filter(t.sql(COHORT), **preset)


KEY = ["chrom", "pos", "alt"]
CARRY = "SELECT DISTINCT chrom, pos, alt FROM fx_call"


def variants(t):
    return t.fx_call.select(KEY).distinct()


@query("flt_8", f"{CARRY} WHERE sample IN ('s1', 's2')")
def flt_8(t):
    return fl.seen_in_samples(variants(t), t.fx_call, ("s1", "s2"), KEY)


@query("flt_9", f"{CARRY} WHERE sample IN ('s1', 's2') EXCEPT {CARRY} WHERE sample NOT IN ('s1', 's2')")
def flt_9(t):
    return fl.somatic_only(variants(t), t.fx_call, ("s1", "s2"), KEY)


@query("flt_10", f"{CARRY} EXCEPT {CARRY} WHERE sample IN ('s1', 's2')")
def flt_10(t):
    return fl.subtract_controls(variants(t), t.fx_call, ("s1", "s2"), KEY)


ANNO = """
SELECT id, CASE WHEN id % 3 = 0 THEN 'R->Q' END AS aa_change,
 CASE id % 4 WHEN 0 THEN 'frameshift_variant' WHEN 1 THEN 'stop_gained' WHEN 2 THEN 'intron_variant' END AS consequence,
 CASE WHEN id % 5 = 0 THEN NULL WHEN id % 5 = 1 THEN '0.01,0.' || (qual + 10) ELSE '0.00' || (depth % 9) END AS gmaf,
 CASE WHEN id % 6 = 0 THEN NULL ELSE '0.0' || (qual + 10) END AS gnomad FROM {fx_variant}"""


@query("flt_11", f"""
WITH a AS ({ANNO.replace('{', '').replace('}', '')}) SELECT *, (aa_change IS NOT NULL OR coalesce(regexp_matches(consequence, 'frameshift|stop_gained'), false))
 AND coalesce(TRY_CAST(split_part(gmaf, ',', 1) AS DOUBLE) <= 0.02, true)
 AND coalesce(TRY_CAST(nullif(split_part(gmaf, ',', 2), '') AS DOUBLE) <= 0.02, true)
 AND coalesce(TRY_CAST(gnomad AS DOUBLE) <= 0.02, true) AS priority FROM a""")
def flt_11(t):
    return fl.rare_damaging(t.sql(ANNO))


@query("flt_12", f"SELECT gene, exon, chrom, start, CASE WHEN gene IN ({LISTED}) THEN 'YES' ELSE 'NO' END AS priority_gene FROM fx_exon")
def flt_12(t):
    return fl.priority_gene(gene_rows(t), listed(t))


CELLS = """
SELECT chrom, pos, CAST(sum(alt_reads) AS BIGINT) AS var_cells, CAST(sum(depth - alt_reads) AS BIGINT) AS ref_cells,
 100.0 * sum(alt_reads) / sum(depth) AS pct_variant FROM {fx_call} GROUP BY chrom, pos"""


@query("flt_13", f"""
WITH c AS ({CELLS.replace('{', '').replace('}', '')}) SELECT chrom, pos, var_cells, ref_cells FROM c
WHERE var_cells + ref_cells > 30 AND var_cells > 5 AND round(floor(pct_variant) / 100, 2) > 0.4""")
def flt_13(t):
    cells = t.sql(CELLS).withColumn("pct_variant", F.col("pct_variant").cast("double"))
    return fl.single_cell_support(cells, 30, 5, 0.4).select("chrom", "pos", "var_cells", "ref_cells")


@query("flt_16", """
SELECT sv_id, sv_type, length, CASE WHEN length > 4000 AND sv_type <> 'inv' THEN
 CASE WHEN final_status LIKE '%PASS%' THEN 'FAIL_REASONS: length_fail' ELSE final_status || ',length_fail' END
 ELSE final_status END AS final_status
FROM (SELECT sv_id, sv_type, abs(coord2 - coord1) AS length, CASE WHEN caller = 'c1' THEN 'OVERALL_PASS' ELSE 'FAIL_REASONS: filter_dgv' END AS final_status
 FROM fx_sv) q WHERE length >= 100""")
def flt_16(t):
    sv = t.fx_sv.selectExpr("sv_id", "sv_type", "abs(coord2 - coord1) AS length",
                            "CASE WHEN caller = 'c1' THEN 'OVERALL_PASS' ELSE 'FAIL_REASONS: filter_dgv' END AS final_status")
    return fl.sv_length_status(fl.sv_min_length(sv), max_length=4000)


GT = """
SELECT id, CASE WHEN id % 11 = 0 THEN NULL ELSE qual END AS qual, depth AS gq,
 CASE id % 5 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' WHEN 2 THEN '1/1' WHEN 3 THEN './.' ELSE '1/2' END AS gt,
 CAST(1 + id % 2 AS INT) AS allele_no FROM {fx_variant}"""


@query("flt_17", f"""
WITH g AS ({GT.replace('{', '').replace('}', '')}) SELECT * FROM g WHERE (qual IS NULL OR qual > 40)
AND (gq >= 20 OR split_part(gt, '/', 1) <> split_part(gt, '/', 2))
AND allele_no = CASE gt WHEN '0/1' THEN 1 WHEN '1/1' THEN 1 WHEN '1/2' THEN 2 END""")
def flt_17(t):
    return fl.sample_allele_only(fl.genotype_qc(t.sql(GT), 40, 20))


@query("flt_18", """
WITH p AS (SELECT chrom, pos, count(*) AS n_samples, count(CASE WHEN zyg <> 'No data' THEN 1 END) AS n_called,
 CAST(sum(CASE zyg WHEN 'het' THEN 1 WHEN 'hom' THEN 2 ELSE 0 END) AS BIGINT) AS alt_alleles FROM fx_geno GROUP BY chrom, pos),
 m AS (SELECT *, CASE WHEN n_called > 0 THEN least(alt_alleles / (2 * n_called), 1 - alt_alleles / (2 * n_called)) END AS maf FROM p)
SELECT * FROM m WHERE n_called / n_samples > 0.9 AND maf > 0.25""")
def flt_18(t):
    return fl.callset_qc(t.fx_geno, ["chrom", "pos"], 0.9, 0.25)


@query("flt_19", "SELECT chrom, pos, alt, sample, depth, alt_reads FROM fx_call WHERE depth >= 2 AND CAST(alt_reads AS DOUBLE) / depth >= 0.8")
def flt_19(t):
    return fl.support_ratio(t.fx_call.select("chrom", "pos", "alt", "sample", "depth", "alt_reads"), "depth", "alt_reads")


@query("flt_20", f"""
SELECT {VSQL} FROM fx_variant v WHERE var_type IN ('DEL', 'INS') AND EXISTS (SELECT 1 FROM fx_gene g
 WHERE g.chrom = v.chrom AND g.start <= v."end" AND g."end" >= v.start)""")
def flt_20(t):
    return fl.variant_class(t.fx_variant, ("DEL", "INS"), t.fx_gene).select(V)


@query("flt_21", f"""
SELECT {VSQL} FROM fx_variant v WHERE filter = 'PASS' AND EXISTS (SELECT 1 FROM fx_variant w WHERE w.filter <> 'PASS'
 AND w.chrom = v.chrom AND w.start = v.start AND w."end" = v."end" AND w.bases = v.bases)""")
def flt_21(t):
    v = t.fx_variant
    return fl.exists_in(v.where("filter = 'PASS'"), v.where("filter <> 'PASS'"), with_bases=True).select(V)


@query("flt_22", "WITH len AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', {n})" for c, n in fl.HUMAN_LENGTHS.items()) + """) x(chrom, n_bases)),
 s AS (SELECT chrom, min(pos) AS first, max(pos) AS last, count(*) AS n FROM fx_call GROUP BY chrom)
SELECT s.chrom, first, last, n, CASE WHEN s.chrom IN ('X', 'Y') OR n_bases IS NULL THEN 'skipped' WHEN n / n_bases < 0.0001 THEN 'too_sparse'
 WHEN first / n_bases > 0.01 AND s.chrom NOT IN ('13', '14', '15', '21', '22') THEN 'late_start'
 WHEN last / n_bases < 0.99 THEN 'early_end' ELSE 'ok' END AS verdict, (SELECT count(*) FROM s) >= 23 AS enough_chromosomes
FROM s LEFT JOIN len ON s.chrom = len.chrom""")
def flt_22(t):
    return fl.completeness(t.fx_call)


@query("flt_23", """
SELECT event_id FROM events WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT)
 < 3000.0 / (SELECT count(*) FROM events) * 4294967296""")
def flt_23(t):
    reads = t.events.select("event_id")
    return fl.downsample(reads, "event_id", 3000, reads.agg(F.count("*")).scalar())
