"""AGG-*, FRQ-*, COV-*, PIL-*."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoloom.functions.pileup import tally
from genoloom.operators import aggregates as ag
from genoloom.operators import coverage as cv
from genoloom.operators import filters as fl
from genoloom.operators import frequencies as fq
from genoloom.operators import pileup as pp
from genoloom.plans.registry import query
from genoloom.plans.source_queries import DBSNP_ROWS, EXAC_KEYS
from genoloom.sources import readers as rd

LOCUS = ["chrom", "pos"]


def fractions(t, layout):
    v = rd.parse_vcf(t.fx_vcfm.where(F.col("layout") == layout).select("line"))
    return ag.sample_allele_fractions(v).select("chrom", "pos", "allele_no", "mean_af", "median_af", "var_read_counts")


# Two samples with evidence; f1, f2 are null when a sample does not count.
def af_oracle(pairs: str) -> str:
    return f"""
WITH p AS ({pairs}), q AS (SELECT *, CAST(a AS DOUBLE) / na AS x1, CAST(b AS DOUBLE) / nb AS x2 FROM p)
SELECT chrom, pos, allele_no, txt AS var_read_counts,
 CASE WHEN u1 AND u2 THEN (x1 + x2) / 2 WHEN u1 THEN x1 WHEN u2 THEN x2 ELSE 0 END AS mean_af,
 CASE WHEN u1 AND u2 THEN (x1 + x2) / 2 WHEN u1 THEN x1 WHEN u2 THEN x2 ELSE 0 END AS median_af FROM q"""


@query("agg_1", af_oracle("""
SELECT chrom, pos, 1 AS allele_no, v1 AS a, r1 + v1 + w1 AS na, v2 AS b, r2 + v2 + w2 AS nb, v1 > 1 AS u1, v2 > 1 AS u2,
 v1 || '/' || (r1 + v1 + w1) || ',' || v2 || '/' || (r2 + v2 + w2) AS txt FROM fx_vcfm WHERE layout = 'depth'
UNION ALL SELECT chrom, pos, 2, w1, r1 + v1 + w1, w2, r2 + v2 + w2, w1 > 1, w2 > 1,
 w1 || '/' || (r1 + v1 + w1) || ',' || w2 || '/' || (r2 + v2 + w2) FROM fx_vcfm WHERE layout = 'depth' AND alts NOT LIKE '%*'"""))
def agg_1(t):
    return fractions(t, "depth")


@query("agg_2", af_oracle("""
SELECT chrom, pos, 1 AS allele_no, v1 AS a, r1 + v1 + w1 AS na, v2 AS b, r2 + v2 + w2 AS nb, v1 > 0 AS u1, v2 > 0 AS u2,
 concat_ws(',', CASE WHEN r1 + v1 + w1 > 0 THEN v1 || '/' || (r1 + v1 + w1) END, CASE WHEN r2 + v2 + w2 > 0 THEN v2 || '/' || (r2 + v2 + w2) END) AS txt
FROM fx_vcfm WHERE layout = 'indel'"""))
def agg_2(t):
    return fractions(t, "indel")


@query("agg_3", af_oracle("""
SELECT chrom, pos, 1 AS allele_no, v1 AS a, r1 + v1 AS na, v2 AS b, r2 + v2 AS nb, v1 > 0 AS u1, v2 > 0 AS u2,
 concat_ws(',', CASE WHEN r1 + v1 > 0 THEN v1 || '/' || (r1 + v1) END, CASE WHEN r2 + v2 > 0 THEN v2 || '/' || (r2 + v2) END) AS txt
FROM fx_vcfm WHERE layout = 'base'"""))
def agg_3(t):
    return fractions(t, "base")


@query("agg_4", """
SELECT chrom, pos, 1 AS allele_no, 0.25 AS mean_af, 0.25 AS median_af, 'N/A' AS var_read_counts FROM fx_vcfm WHERE layout = 'info'
UNION ALL SELECT chrom, pos, 2, 0.125, 0.125, 'N/A' FROM fx_vcfm WHERE layout = 'info' AND alts NOT LIKE '%*'""")
def agg_4(t):
    return fractions(t, "info")


@query("agg_5", """
SELECT chrom, pos, 1 AS allele_no, 1 + pos % 3 AS ac, (3 + pos % 3) || '/6' AS allele FROM fx_vcfm WHERE layout <> 'info'
UNION ALL SELECT chrom, pos, 2, 2, (3 + pos % 3) || '/6' FROM fx_vcfm WHERE layout = 'depth' AND alts NOT LIKE '%*'""")
def agg_5(t):
    v = rd.parse_vcf(t.fx_vcfm.where("layout <> 'info'").select("line"))
    return ag.allele_counts(v).select("chrom", "pos", "allele_no", "ac", "allele")


COUNTS = """
SELECT chrom, pos, count(CASE WHEN zyg = 'het' THEN 1 END) AS het_count, count(CASE WHEN zyg = 'hom' THEN 1 END) AS hom_count,
 count(CASE WHEN zyg = 'ref' THEN 1 END) AS ref_count, count(CASE WHEN zyg = 'No data' THEN 1 END) AS no_call_count,
 count(CASE WHEN zyg IN ('het', 'hom') THEN 1 END) AS var_count,
 coalesce(string_agg(DISTINCT CASE WHEN zyg IN ('het', 'hom') THEN sample END, ',' ORDER BY CASE WHEN zyg IN ('het', 'hom') THEN sample END), 'N/A(NO_VAR_SAMPLES)') AS carriers
FROM fx_geno GROUP BY chrom, pos"""


@query("agg_6", COUNTS)
def agg_6(t):
    return ag.cohort_counts(t.fx_geno, LOCUS)


@query("agg_6_vcf", """
SELECT chrom, pos, 1 AS allele_no, 1 AS het_count, 0 AS hom_count, 0 AS ref_count, 1 AS no_call_count, 1 AS var_count, 's0' AS carriers
FROM fx_vcfm WHERE layout = 'depth' UNION ALL
SELECT chrom, pos, 2, 1, 0, 0, 1, 1, 's1' FROM fx_vcfm WHERE layout = 'depth' AND alts NOT LIKE '%*'""".replace(
    "1 AS het_count", "2 AS het_count").replace("1 AS var_count, 's0'", "2 AS var_count, 's0,s1'"))
def agg_6_vcf(t):
    v = rd.parse_vcf(t.fx_vcfm.where("layout = 'depth'").select("line"))
    return ag.cohort_counts(ag.genotypes(v), ["chrom", "pos", "allele_no"])


GROUPED = """
SELECT chrom, pos, s.grp, count(CASE WHEN zyg IN ('het', 'hom') THEN 1 END) AS var_count, count(CASE WHEN zyg = 'het' THEN 1 END) AS het_count,
 count(CASE WHEN zyg = 'hom' THEN 1 END) AS hom_count, count(CASE WHEN zyg = 'ref' THEN 1 END) AS ref_count,
 count(CASE WHEN zyg = 'No data' THEN 1 END) AS no_call_count FROM fx_geno g JOIN fx_sample s ON g.sample = s.sample GROUP BY chrom, pos, s.grp"""


@query("agg_7", f"""
WITH g AS ({GROUPED}) SELECT *, CASE WHEN sum(var_count) OVER (PARTITION BY chrom, pos) > 0
 THEN CAST(var_count AS DOUBLE) / CAST(sum(var_count) OVER (PARTITION BY chrom, pos) AS DOUBLE) * 100 ELSE 0 END AS var_percent FROM g""")
def agg_7(t):
    return ag.group_counts(t.fx_geno, t.fx_sample, LOCUS)


@query("agg_7_matrix", f"""
WITH g AS ({GROUPED}) SELECT chrom, pos, max(CASE WHEN grp = 'g0' THEN var_count END) AS g0, max(CASE WHEN grp = 'g1' THEN var_count END) AS g1,
 max(CASE WHEN grp = 'g2' THEN var_count END) AS g2 FROM g GROUP BY chrom, pos""")
def agg_7_matrix(t):
    return ag.group_matrix(ag.group_counts(t.fx_geno, t.fx_sample, LOCUS), LOCUS, ["g0", "g1", "g2"])


@query("agg_8", """
WITH c AS (SELECT chrom, pos, count(CASE WHEN zyg IN ('het', 'hom') AND s.grp = 'g1' THEN 1 END) AS cluster_var,
 count(CASE WHEN zyg IN ('het', 'hom') AND s.grp <> 'g1' THEN 1 END) AS rest_var FROM fx_geno g JOIN fx_sample s ON g.sample = s.sample GROUP BY chrom, pos)
SELECT *, 8 AS cluster_size, 17 AS rest_size, cluster_var / 8 AS cluster_freq, rest_var / 17 AS rest_freq,
 cluster_var / 8 - rest_var / 17 AS difference, cluster_var / (cluster_var + rest_var) AS portion_cluster FROM c WHERE cluster_var + rest_var > 0""")
def agg_8(t):
    return ag.cluster_versus_rest(t.fx_geno, t.fx_sample.where("grp = 'g1'"), LOCUS)


@query("agg_11", "SELECT sample, median(depth) AS median FROM fx_call GROUP BY sample")
def agg_11(t):
    return ag.median_by(t.fx_call, ["sample"], "depth")


# The halves rule on sorted lists, one-based indexes.
@query("agg_12", """
WITH l AS (SELECT chrom, pos % 7 AS k, list_sort(list(depth)) AS a, count(*) AS n FROM fx_call GROUP BY chrom, pos % 7),
 h AS (SELECT *, CASE WHEN n % 2 = 0 THEN a[1:(n // 2 - 1)] ELSE a[1:(n // 2)] END AS lo, CASE WHEN n % 2 = 0 THEN a[(n // 2 + 1):n] ELSE a[(n // 2 + 2):n] END AS hi FROM l)
SELECT chrom, k, n, CASE WHEN n > 4 THEN CAST(a[1] AS DOUBLE) END AS min, CASE WHEN n > 4 THEN list_median(lo) END AS q1,
 CASE WHEN n > 4 THEN list_median(a) END AS q2, CASE WHEN n > 4 THEN list_median(hi) END AS q3, CASE WHEN n > 4 THEN CAST(a[n] AS DOUBLE) END AS max FROM h""")
def agg_12(t):
    rows = t.fx_call.selectExpr("chrom", "pos % 7 AS k", "depth")
    return ag.five_numbers(rows, ["chrom", "k"], "depth")


@query("agg_13", """
WITH m AS (SELECT sample, depth, count(*) AS c, row_number() OVER (PARTITION BY sample ORDER BY count(*) DESC, depth) AS rn FROM fx_call GROUP BY sample, depth)
SELECT c.sample, count(*) AS n, avg(c.depth) AS mean, median(c.depth) AS median, (SELECT m.depth FROM m WHERE m.sample = c.sample AND rn = 1) AS mode,
 round(stddev_samp(c.depth), 6) AS stddev, min(c.depth) AS min, max(c.depth) AS max, """ + ", ".join(
    f"round(quantile_cont(c.depth, {p}), 6) AS p{round(p * 100):02d}" for p in ag.PERCENTILES) + " FROM fx_call c GROUP BY c.sample")
def agg_13(t):
    d = ag.describe(t.fx_call, ["sample"], "depth")
    return d.withColumns({c: F.round(c, 6) for c in d.columns if c.startswith("p") or c == "stddev"})


def affected_calls(t):
    """Calls inside genes, with the affection status of their sample."""
    return t.fx_geno.where("zyg IN ('het', 'hom')").join(t.fx_sample.select("sample", "affected"), "sample")


@query("agg_14", """
WITH c AS (SELECT g.gene, g.chrom, g.pos, s.affected FROM fx_geno g JOIN fx_sample s ON g.sample = s.sample WHERE zyg IN ('het', 'hom')),
 l AS (SELECT 'G' || CAST(floor(p_partkey / 40) AS BIGINT) AS gene, max(p_size) AS aa FROM part GROUP BY 1)
SELECT c.gene, count(DISTINCT chrom || ':' || pos) AS distinct_variants, count(*) AS total_variants,
 count(DISTINCT CASE WHEN affected = 1 THEN chrom || ':' || pos END) AS affected_variants,
 count(DISTINCT CASE WHEN affected = 0 THEN chrom || ':' || pos END) AS unaffected_variants,
 count(DISTINCT chrom || ':' || pos) / (max(l.aa) * 3) * 100 AS percent_coding FROM c JOIN l ON c.gene = l.gene GROUP BY c.gene""")
def agg_14(t):
    lengths = t.part.selectExpr("'G' || CAST(floor(p_partkey / 40) AS BIGINT) AS gene", "p_size AS aa_length")
    return ag.gene_burden(affected_calls(t), lengths, LOCUS)


@query("agg_15", """
WITH c AS (SELECT DISTINCT chrom, 1000 + ((pos - 1000) // 50) * 50 AS pos, sample FROM fx_call),
 g AS (SELECT chrom, pos, sample FROM fx_geno WHERE zyg IN ('het', 'hom')),
 ca AS (SELECT chrom, pos, string_agg(sample, ',' ORDER BY sample) AS s FROM c GROUP BY chrom, pos),
 ga AS (SELECT chrom, pos, count(CASE WHEN affected = 1 THEN 1 END) AS a, count(CASE WHEN affected = 0 THEN 1 END) AS u,
  string_agg(g.sample, ',' ORDER BY g.sample) AS s FROM g JOIN fx_sample f ON g.sample = f.sample GROUP BY chrom, pos)
SELECT ca.chrom, ca.pos, coalesce(a, 0) AS affected_carriers, coalesce(u, 0) AS unaffected_carriers, coalesce(ga.s, ca.s || ' (NOT IN PILEUP)') AS samples
FROM ca LEFT JOIN ga ON ca.chrom = ga.chrom AND ca.pos = ga.pos""")
def agg_15(t):
    calls = t.fx_call.selectExpr("chrom", "1000 + ((pos - 1000) div 50) * 50 AS pos", "sample")
    return ag.carrier_counts(calls, t.fx_sample, LOCUS, t.fx_geno)


@query("agg_16", "SELECT sample, count(*) AS varcount FROM fx_geno WHERE zyg IN ('het', 'hom') GROUP BY sample")
def agg_16(t):
    return ag.variants_per_sample(t.fx_geno, LOCUS)


@query("agg_17", "SELECT chrom, pos, alt, sample, count(*) AS n FROM fx_call GROUP BY ALL HAVING count(*) >= 2")
def agg_17(t):
    return ag.value_counts(t.fx_call, ["chrom", "pos", "alt", "sample"], 2)


CODED = "CASE zyg WHEN 'No data' THEN 0 WHEN 'ref' THEN 1 WHEN 'hom' THEN 2 ELSE 3 END"
MATRIX = f"""
WITH m AS (SELECT chrom, pos, count(CASE WHEN c = 0 THEN 1 END) AS no_call, count(CASE WHEN c = 1 THEN 1 END) AS ref, count(CASE WHEN c = 2 THEN 1 END) AS hom,
 count(CASE WHEN c = 3 THEN 1 END) AS het FROM (SELECT chrom, pos, {CODED} AS c FROM fx_geno) q GROUP BY chrom, pos)
SELECT *, (het + hom + ref) / 25 * 100 AS pct_with_data, CASE WHEN het + hom + ref > 0 THEN (het + hom) / (het + hom + ref) * 100 ELSE 0 END AS pct_variant
FROM m WHERE het + hom > 9"""


@query("agg_18", MATRIX)
def agg_18(t):
    return ag.matrix_summary(t.fx_geno.selectExpr("chrom", "pos", f"{CODED} AS code"), LOCUS, 9)


@query("agg_20", """
SELECT chrom, count(CASE WHEN p < 0.05 THEN 1 END) AS total, count(CASE WHEN p < 0.05 AND fc > 0 THEN 1 END) AS up, count(CASE WHEN p < 0.05 AND fc < 0 THEN 1 END) AS down
FROM (SELECT chrom, qual / 500 AS p, depth - 25 AS fc FROM fx_call) q GROUP BY chrom""")
def agg_20(t):
    return ag.significance_counts(t.fx_call.selectExpr("chrom", "qual / 500 AS p", "depth - 25 AS fc"), ["chrom"], "p", "fc")


@query("agg_21", """
SELECT chrom, start, "end", bases, string_agg(DISTINCT sample, ',' ORDER BY sample) AS samples, count(DISTINCT sample) AS n_samples
FROM fx_variant GROUP BY chrom, start, "end", bases""")
def agg_21(t):
    return ag.cohort_variants(t.fx_variant)


@query("agg_22", "SELECT relation, count(DISTINCT sample) AS n, string_agg(DISTINCT sample, ',' ORDER BY sample) AS samples FROM fx_sample GROUP BY relation")
def agg_22(t):
    return ag.samples_by_type(t.fx_sample, "relation")


@query("agg_23", """
SELECT g.sample, count(*) AS hom_ref, count(c.pos) AS control_het, count(c.pos) / count(*) * 100 AS dropout_percent FROM fx_geno g
LEFT JOIN (SELECT DISTINCT chrom, pos FROM fx_geno WHERE sample = 's0' AND zyg = 'het') c ON g.chrom = c.chrom AND g.pos = c.pos
WHERE g.sample <> 's0' AND g.zyg IN ('hom', 'ref') GROUP BY g.sample""")
def agg_23(t):
    return ag.allele_dropout(t.fx_geno, "s0", LOCUS)


@query("frq_1", f"""
WITH rows_ AS (SELECT * FROM ({DBSNP_ROWS}) q WHERE ref <> alt AND var_type = 'SNV'),
 cnt AS (SELECT chrom, "end" AS pos, allele, sum(n) AS n FROM (SELECT chrom, "end", ref AS allele, n1 AS n FROM fx_dbsnp WHERE has_counts
   UNION ALL SELECT chrom, "end", plus_alt, n2 FROM fx_dbsnp WHERE has_counts) u GROUP BY chrom, "end", allele),
 ent AS (SELECT chrom, start AS pos, ref, alt, string_agg(DISTINCT rs, ',' ORDER BY rs) AS rs FROM rows_ GROUP BY chrom, start, ref, alt),
 j AS (SELECT e.*, coalesce(a.n, 0) AS na, coalesce(r.n, 0) AS nr, EXISTS (SELECT 1 FROM cnt k WHERE k.chrom = e.chrom AND k.pos = e.pos) AS known
  FROM ent e LEFT JOIN cnt a ON a.chrom = e.chrom AND a.pos = e.pos AND a.allele = e.alt LEFT JOIN cnt r ON r.chrom = e.chrom AND r.pos = e.pos AND r.allele = e.ref)
SELECT chrom, pos, ref, alt, rs, CASE WHEN known THEN CASE WHEN nr = 0 THEN 0 ELSE CAST(nr AS DOUBLE) / CAST(nr + sum(na) OVER w AS DOUBLE) END END AS ref_freq,
 CASE WHEN known THEN CASE WHEN na = 0 THEN 0 ELSE CAST(na AS DOUBLE) / CAST(nr + sum(na) OVER w AS DOUBLE) END END AS alt_freq
FROM j WINDOW w AS (PARTITION BY chrom, pos, ref)""")
def frq_1(t):
    return fq.snv_frequencies(t.fx_dbsnp)


@query("frq_2", f"""
WITH rows_ AS (SELECT * FROM ({DBSNP_ROWS}) q WHERE var_type <> 'SNV'),
 ent AS (SELECT chrom, start, "end", var_type, CASE WHEN var_type = 'INS' THEN alt ELSE ref END AS bases, string_agg(DISTINCT rs, ',' ORDER BY rs) AS rs,
  sum(CASE WHEN has_counts THEN n2 END) AS na, sum(CASE WHEN has_counts THEN n1 END) AS nr FROM rows_ GROUP BY 1, 2, 3, 4, 5)
SELECT chrom, start, "end", var_type, bases, rs,
 CASE WHEN na IS NOT NULL THEN CASE WHEN nr = 0 THEN 0 ELSE CAST(nr AS DOUBLE) / CAST(nr + sum(na) OVER w AS DOUBLE) END END AS ref_freq,
 CASE WHEN na IS NOT NULL THEN CASE WHEN na = 0 THEN 0 ELSE CAST(na AS DOUBLE) / CAST(nr + sum(na) OVER w AS DOUBLE) END END AS alt_freq
FROM ent WINDOW w AS (PARTITION BY chrom, start, "end", var_type)""")
def frq_2(t):
    return fq.indel_frequencies(t.fx_dbsnp)


@query("frq_3", f"""
WITH k AS ({EXAC_KEYS}) SELECT chrom, start, "end", var_type, start || ':' || string_agg(DISTINCT bases || ':' || printf('%.6f', ac / an) || ':' || qual, ';'
 ORDER BY bases || ':' || printf('%.6f', ac / an) || ':' || qual) AS entry FROM k GROUP BY chrom, start, "end", var_type""")
def frq_3(t):
    return fq.population_frequencies(rd.parse_population(t.fx_exac.select("line")))


COLLAPSE = ", ".join(f"string_agg(DISTINCT {src}, ',' ORDER BY {src}) AS {c}" for c, src in (
    ("var_type", "want_type"), ("base_change", "want_base"), ("strand", "strand"), ("aa_change", "want_aa"), ("gene", "want_gene"),
    ("histology", "histology"), ("tumour", "tumour"), ("status", "status")))


@query("frq_4", f"""
SELECT want_chrom AS chrom, want_start AS start, want_end AS "end", CASE WHEN want_type = 'SNV' THEN 'snv' ELSE 'indel' END AS mut_group, {COLLAPSE}
FROM fx_cosmic WHERE want_type IS NOT NULL GROUP BY 1, 2, 3, 4""")
def frq_4(t):
    return fq.cosmic_collapse(fq.cosmic_change(t.fx_cosmic))


@query("frq_4_genes", "SELECT DISTINCT upper(want_gene) AS gene FROM fx_cosmic WHERE want_type IS NOT NULL")
def frq_4_genes(t):
    return fq.cosmic_genes(fq.cosmic_change(t.fx_cosmic))


@query("frq_5", """
SELECT sv_id, CASE sv_type WHEN 'tra' THEN NULL WHEN 'del' THEN (coord1 % 90) / 100 ELSE (CAST(coord1 % 90 AS DOUBLE) + 12.5) / 100 / 2 END AS dgv_freq FROM fx_sv""")
def frq_5(t):
    text = F.expr("CASE sv_type WHEN 'tra' THEN 'no match' WHEN 'del' THEN 'gain ' || (coord1 % 90) || '%' ELSE 'gain ' || (coord1 % 90) || '% loss 12.5%' END")
    return fq.sv_population_frequency(t.fx_sv.select("sv_id", text.alias("text")), "text").drop("text")


EXON_DEPTH = """
SELECT x.chrom, x.start, x."end", x.exon, d.pos, d.depth FROM fx_exon x LEFT JOIN fx_depth d ON x.chrom = d.chrom AND d.pos BETWEEN x.start AND x."end\""""


@query("cov_1", f'WITH d AS ({EXON_DEPTH}) SELECT chrom, start, "end", string_agg(DISTINCT exon, \',\') AS exons, median(depth) AS median, min(depth) AS min, max(depth) AS max FROM d GROUP BY chrom, start, "end"')
def cov_1(t):
    return cv.exon_depth(t.fx_exon, t.fx_depth)


STATUS = f"""
WITH d AS ({EXON_DEPTH}), r AS (SELECT DISTINCT chrom, start, "end", exon FROM fx_exon),
 b AS (SELECT chrom, start, "end", exon, unnest(range(start, "end" + 1)) AS base FROM r),
 u AS (SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM fx_depth f WHERE f.chrom = b.chrom AND f.pos = b.base AND f.depth >= 20)),
 i AS (SELECT *, base - row_number() OVER (PARTITION BY chrom, exon ORDER BY base) AS g FROM u),
 runs AS (SELECT chrom, start, "end", exon, min(base) AS lo, max(base) AS hi FROM i GROUP BY chrom, start, "end", exon, g),
 txt AS (SELECT chrom, start, "end", exon, string_agg(CASE WHEN lo = hi THEN CAST(lo AS VARCHAR) ELSE lo || '-' || hi END, ',' ORDER BY lo) AS t, CAST(sum(hi - lo + 1) AS BIGINT) AS n FROM runs GROUP BY 1, 2, 3, 4),
 s AS (SELECT chrom, start, "end", exon, count(pos) AS n_any, count(CASE WHEN depth >= 20 THEN 1 END) AS n_cov FROM d GROUP BY 1, 2, 3, 4)
SELECT s.chrom, s.start, s."end", s.exon AS exons,
 CASE WHEN n_any = 0 THEN 'NO_COVER' WHEN txt.n IS NULL THEN 'FULL_COVER' WHEN n_cov > 0 THEN txt.t ELSE 'ONLY_LOW_COVER' END AS status,
 CASE WHEN n_any = 0 THEN s."end" - s.start WHEN txt.n IS NULL THEN 0 WHEN n_cov > 0 THEN txt.n ELSE s."end" - s.start END AS missing_bases
FROM s LEFT JOIN txt ON s.chrom = txt.chrom AND s.exon = txt.exon"""


@query("cov_2", STATUS)
def cov_2(t):
    return cv.exon_status(t.fx_exon, t.fx_depth, 20)


@query("cov_3", f'WITH st AS ({STATUS}) SELECT chrom, CAST(sum(missing_bases) AS BIGINT) AS missing_bases, CAST(sum("end" - start) AS BIGINT) AS total_bases, CAST(sum(missing_bases) AS DOUBLE) / CAST(sum("end" - start) AS DOUBLE) * 100 AS missing_percent FROM st GROUP BY chrom')
def cov_3(t):
    return cv.missing_bases(cv.exon_status(t.fx_exon, t.fx_depth, 20))


@query("cov_4", """
SELECT sample, count(CASE WHEN depth > 1 THEN 1 END) AS bases_over_1, count(CASE WHEN depth > 15 THEN 1 END) AS bases_over_15, avg(depth) AS mean_depth,
 count(CASE WHEN depth > 1 THEN 1 END) / 3344125 * 100 AS percent_over_1, count(CASE WHEN depth > 15 THEN 1 END) / 3344125 * 100 AS percent_over_15 FROM fx_call GROUP BY sample""")
def cov_4(t):
    return cv.breadth(t.fx_call)


@query("cov_5", """
SELECT g.gene, count(*) AS positions, CAST(sum(d.depth) AS BIGINT) AS total_depth, avg(d.depth) AS mean_depth FROM fx_gene g
JOIN fx_depth d ON g.chrom = d.chrom AND d.pos BETWEEN greatest(g.start - 2000, 0) AND g."end" + 2000 GROUP BY g.gene""")
def cov_5(t):
    return cv.gene_depth(t.fx_gene, t.fx_depth, 2000)


STATS = """
SELECT sample, count(*) AS total, count(CASE WHEN flag & 4 = 0 THEN 1 END) AS aligned, count(CASE WHEN flag & 4 <> 0 THEN 1 END) AS unaligned,
 count(CASE WHEN flag & 1 <> 0 AND flag & 2304 = 0 AND flag & 12 = 0 THEN 1 END) AS paired,
 count(CASE WHEN flag & 1 <> 0 AND flag & 2304 = 0 AND flag & 4 = 0 AND flag & 8 <> 0 THEN 1 END) AS singletons,
 count(CASE WHEN flag & 1 <> 0 AND flag & 2304 = 0 AND flag & 12 = 0 AND mate_chrom <> chrom THEN 1 END) AS mispaired FROM fx_read GROUP BY sample"""
STATS = STATS.replace("flag & 2304 = 0", "(flag & 2304) = 0").replace("flag & 12 = 0", "(flag & 12) = 0").replace("flag & 4 = 0", "(flag & 4) = 0").replace(
    "flag & 4 <> 0", "(flag & 4) <> 0").replace("flag & 1 <> 0", "(flag & 1) <> 0").replace("flag & 8 <> 0", "(flag & 8) <> 0")


@query("cov_6", STATS)
def cov_6(t):
    return cv.alignment_stats(t.fx_read, ["sample"])


@query("cov_7", f"""
WITH s AS ({STATS}), h AS (SELECT sample, count(DISTINCT chrom || ':' || pos) AS n FROM fx_read r WHERE (flag & 4) = 0
 AND EXISTS (SELECT 1 FROM fx_exon x WHERE x.chrom = r.chrom AND x.start <= r.pos + 19 AND x."end" >= r.pos) GROUP BY sample)
SELECT s.sample, coalesce(h.n, 0) AS exon_positions, paired, aligned, coalesce(h.n, 0) / CASE WHEN paired > 0 THEN paired ELSE aligned END * 100 AS percent_on_target
FROM s LEFT JOIN h ON s.sample = h.sample""")
def cov_7(t):
    return cv.reads_on_target(t.fx_read, t.fx_exon)


@query("cov_8", f"""
WITH s AS ({STATS}), st AS (SELECT * FROM ({STATUS}) q) SELECT sample, total, aligned, aligned / total * 100 AS percent_aligned,
 100 * aligned / 2897310462 AS estimated_coverage, (SELECT count(*) FROM st WHERE missing_bases > 0) AS incomplete_exons FROM s""")
def cov_8(t):
    return cv.run_sheet(t.fx_read, cv.exon_status(t.fx_exon, t.fx_depth, 20), 100)


def loci(t):
    return t.fx_pileup.select("chrom", "pos", "ref", "alt", "depth", "bases", "quals", "tags")


@query("pil_1", "SELECT chrom, pos, allele, n FROM fx_pile_truth")
def pil_1(t):
    tok = pp.tokenise(loci(t)).select("chrom", "pos", F.explode(tally(F.col("tokens"))).alias("a"))
    return tok.select("chrom", "pos", "a.allele", "a.n")


SNV_TRUTH = """
SELECT chrom, pos, ref, depth, CASE WHEN allele = 'REF' THEN ref ELSE allele END AS allele, n FROM fx_pile_truth WHERE allele NOT IN ('+2AG', '-1T')"""


@query("pil_2", f"""
WITH s AS ({SNV_TRUTH}) SELECT p.chrom, p.pos, p.ref, p.alt, p.depth, coalesce(s.allele, 'N') AS allele, coalesce(s.n, 0) AS n,
 coalesce(CAST(s.n AS DOUBLE) / CAST(sum(s.n) OVER (PARTITION BY p.chrom, p.pos) AS DOUBLE), 0) AS frequency
FROM fx_pileup p LEFT JOIN s ON p.chrom = s.chrom AND p.pos = s.pos""")
def pil_2(t):
    return pp.base_frequencies(loci(t))


ALLELES = f"""
WITH s AS ({SNV_TRUTH}), f AS (SELECT chrom, pos, ref, depth, allele, CAST(n AS DOUBLE) / CAST(sum(n) OVER (PARTITION BY chrom, pos) AS DOUBLE) AS fr FROM s),
 a AS (SELECT chrom, pos, allele AS name, fr, allele = ref AS is_ref FROM f UNION ALL
  SELECT chrom, pos, allele, round(n / depth, 4), false FROM fx_pile_truth WHERE allele IN ('+2AG', '-1T') UNION ALL
  SELECT p.chrom, p.pos, p.ref, 0.0, true FROM fx_pileup p WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.chrom = p.chrom AND f.pos = p.pos AND f.allele = p.ref)),
 g AS (SELECT chrom, pos, max(CASE WHEN NOT is_ref THEN fr END) AS mx, bool_or(is_ref AND fr > 0) AS has_ref, bool_or(NOT is_ref) AS has_alt,
  string_agg(name || CASE WHEN is_ref THEN '(ref)' ELSE '' END || ':' || printf('%.5f', fr), ';' ORDER BY fr DESC, name || CASE WHEN is_ref THEN '(ref)' ELSE '' END) AS frequencies FROM a GROUP BY chrom, pos)
SELECT g.chrom, g.pos, p.depth, CASE WHEN NOT has_ref THEN 'hom' WHEN has_alt THEN 'het' ELSE 'ref' END AS zyg, coalesce(mx, 0) AS max_alt_freq,
 CASE WHEN mx > 0 THEN CAST(floor(p.depth * mx + 1e-9) AS BIGINT) ELSE 1 END AS max_alt_reads, frequencies
FROM g JOIN fx_pileup p ON g.chrom = p.chrom AND g.pos = p.pos WHERE p.depth > 0"""


@query("pil_3", ALLELES)
def pil_3(t):
    return pp.allele_table(loci(t)).drop("ref", "alt", "bases", "quals", "tags")


@query("flt_15", f"WITH al AS (SELECT * FROM ({ALLELES}) q) SELECT chrom, pos, max_alt_freq, max_alt_reads FROM al WHERE max_alt_freq >= 0.2 AND max_alt_reads >= 3")
def flt_15(t):
    return fl.pileup_threshold(pp.allele_table(loci(t)), 0.2, 3).select("chrom", "pos", "max_alt_freq", "max_alt_reads")


@query("pil_4", """
WITH r AS (SELECT chrom, pos, depth, tags, n_ref + n_alt + n_alt2 AS first_indel, unnest(range(n_ref, n_ref + n_alt + n_alt2 + n_ins + n_del)) AS j FROM fx_pileup),
 g AS (SELECT chrom, pos, CASE WHEN j < first_indel THEN 'T' || (j % 3) WHEN j + 1 < depth THEN 'T' || ((j + 1) % 3) ELSE 'Indel_tag' END AS tag FROM r),
 c AS (SELECT chrom, pos, tag, count(*) AS n FROM g GROUP BY chrom, pos, tag),
 l AS (SELECT c.*, CASE WHEN tag = 'Indel_tag' THEN 1 ELSE (p.depth + 2 - CAST(substr(tag, 2) AS INT)) // 3 END AS n_all FROM c JOIN fx_pileup p ON c.chrom = p.chrom AND c.pos = p.pos),
 x AS (SELECT chrom, pos, sum(n) AS variant_tags, count(*) AS distinct_tags, string_agg(tag || '(' || n || '/' || n_all || ')', ':' ORDER BY tag) AS tag_text FROM l GROUP BY chrom, pos)
SELECT p.chrom, p.pos, coalesce(variant_tags, 0) AS variant_tags, coalesce(distinct_tags, 0) AS distinct_tags, coalesce(tag_text, '') AS tag_text
FROM fx_pileup p LEFT JOIN x ON p.chrom = x.chrom AND p.pos = x.pos""")
def pil_4(t):
    return pp.tag_counts(loci(t)).select("chrom", "pos", "variant_tags", "distinct_tags", "tag_text")


ZYG5 = """
WITH n AS (SELECT chrom, pos, CASE allele WHEN 'REF' THEN 'ref' WHEN 'OTHER_DEL' THEN 'other_del' ELSE allele END AS allele, n FROM fx_pile_truth),
 s AS (SELECT *, sum(n) OVER (PARTITION BY chrom, pos) AS tot FROM n),
 g AS (SELECT chrom, pos, bool_or(allele <> 'ref' AND n >= 0.9 * tot) AS hom, bool_or(allele = 'ref' AND n >= 0.9 * tot) AS isref,
  string_agg(allele || ':' || n, '_' ORDER BY n DESC, CASE WHEN allele IN ('ref', 'other_del') THEN allele ELSE allele END) AS alleles FROM s GROUP BY chrom, pos)
SELECT p.chrom, p.pos, CASE WHEN hom THEN 'hom' WHEN isref THEN 'ref' ELSE 'het' END AS zyg, coalesce(alleles, '') AS alleles
FROM fx_pileup p LEFT JOIN g ON p.chrom = g.chrom AND p.pos = g.pos"""


@query("pil_5", ZYG5)
def pil_5(t):
    return pp.pileup_zygosity(loci(t)).select("chrom", "pos", "zyg", "alleles")


@query("pil_6", """
WITH v AS (SELECT chrom, pos, alt AS b, n_alt AS n FROM fx_pileup WHERE n_alt > 0 UNION ALL SELECT chrom, pos, alt2, n_alt2 FROM fx_pileup WHERE n_alt2 > 0),
 k AS (SELECT *, row_number() OVER (PARTITION BY chrom, pos ORDER BY n DESC, b) AS rn FROM v),
 f AS (SELECT p.chrom, p.pos, round((n_ref + n_start + n_end) / depth, 3) AS ref_freq, a.b AS var_base, round(a.n / depth, 3) AS var_freq, c.b AS next_base, round(c.n / depth, 3) AS next_freq
  FROM fx_pileup p JOIN k a ON a.chrom = p.chrom AND a.pos = p.pos AND a.rn = 1 LEFT JOIN k c ON c.chrom = p.chrom AND c.pos = p.pos AND c.rn = 2)
SELECT *, CASE WHEN var_freq >= 0.8 THEN 'hom' WHEN (ref_freq + var_freq >= 0.8 AND ref_freq >= 0.3 AND var_freq >= 0.3)
 OR coalesce(var_freq + next_freq >= 0.8 AND next_freq >= 0.3 AND var_freq >= 0.3, false) THEN 'het' ELSE 'other' END AS zyg FROM f""")
def pil_6(t):
    return pp.call_zygosity(loci(t)).select("chrom", "pos", "ref_freq", "var_base", "var_freq", "next_base", "next_freq", "zyg")


@query("pil_7", """
WITH e AS (SELECT chrom, pos, depth, n_ins AS var_reads, n_ref + n_ins + n_del + n_start + n_end - n_ins AS ref_reads FROM fx_pileup)
SELECT chrom, pos, var_reads, ref_reads, CASE WHEN depth > 0 THEN var_reads / depth ELSE 0 END AS var_freq, CASE WHEN depth > 0 THEN ref_reads / depth ELSE 0 END AS ref_freq,
 CASE WHEN depth > 0 AND round(var_reads / depth, 3) > 0.8 THEN 'hom' WHEN depth > 0 AND round(var_reads / depth, 3) > 0.3 THEN 'het' ELSE 'other' END AS zyg FROM e""")
def pil_7(t):
    rows = loci(t).withColumn("var_type", F.lit("INS")).withColumn("indel_bases", F.lit("ag"))
    return pp.indel_evidence(rows).select("chrom", "pos", "var_reads", "ref_reads", "var_freq", "ref_freq", "zyg")


@query("pil_8", """
SELECT chrom, pos, alt, sample, depth, alt_reads, CASE WHEN alt_reads / depth < 0.02 THEN 'ref' WHEN alt_reads / depth < 0.75 THEN 'het' ELSE 'hom' END AS zyg FROM fx_call""")
def pil_8(t):
    return pp.fraction_zygosity(t.fx_call.select("chrom", "pos", "alt", "sample", "depth", "alt_reads"))


@query("pil_9", """
WITH q AS (SELECT chrom, pos, list_concat([q1 + 7 for x in range(depth - n_q2)], [q2 + 7 for x in range(n_q2)]) AS l FROM fx_pileup)
SELECT chrom, pos, list_median(l) AS median_quality, coalesce(array_to_string(l, ':'), '') AS quality_list FROM q""")
def pil_9(t):
    return pp.base_quality(loci(t)).select("chrom", "pos", "median_quality", "quality_list")


@query("pil_10", "SELECT sample, CASE WHEN max(CASE WHEN ascii(quals) BETWEEN 34 AND 63 THEN 1 ELSE 0 END) = 1 THEN 'phred33' ELSE 'phred64' END AS encoding FROM fx_read GROUP BY sample")
def pil_10(t):
    return pp.quality_encoding(t.fx_read, ["sample"])


@query("pil_11", f"""
WITH s AS ({SNV_TRUTH}), al AS (SELECT chrom, pos, string_agg(allele || ':' || n, '_' ORDER BY n DESC, allele) AS normal_alleles FROM s GROUP BY chrom, pos)
SELECT p.chrom, p.pos, p.ref, p.alt, n_ref + n_start + n_end AS ref_count, n_alt AS var_count,
 coalesce((SELECT string_agg(allele || ':' || n, '_' ORDER BY n DESC, allele) FROM s WHERE s.chrom = p.chrom AND s.pos = p.pos AND s.allele NOT IN (p.ref, p.alt)), '') AS tumour_other_alleles,
 CASE WHEN p.depth > 4 THEN coalesce(al.normal_alleles, '') END AS normal_alleles FROM fx_pileup p LEFT JOIN al ON al.chrom = p.chrom AND al.pos = p.pos""")
def pil_11(t):
    return pp.tumour_normal(loci(t), loci(t).where("depth > 4").select("chrom", "pos", "ref", "bases"))
