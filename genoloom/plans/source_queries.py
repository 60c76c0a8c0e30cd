"""SRC-* line parsers and NRM-* normalisation."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoloom.functions import alleles
from genoloom.functions.text import attr, chrom_rank, norm_chrom, safe_name, sentinel
from genoloom.operators import frequencies as fq
from genoloom.plans.registry import query
from genoloom.session import shared_folder
from genoloom.sources import readers as rd

# fx_vcf alleles: only position 1 can differ when lengths agree (the texts are rotations), and
# the second alternate of line number 7 is the dropped star.
VCF_TRUTH = """
SELECT * FROM (SELECT CAST(1 + l_suppkey % 22 AS VARCHAR) AS chrom, 1000 + l_partkey * 50 + l_linenumber AS pos,
 substr('ACGTACGT', CAST(1 + l_partkey % 4 AS INT), CAST(1 + l_linenumber % 3 AS INT)) AS ref,
 CASE WHEN l_linenumber = 7 THEN 'T' ELSE substr('TGCATGCA', CAST(1 + l_partkey % 4 AS INT), CAST(1 + l_suppkey % 3 AS INT)) END AS alt,
 CAST(round(l_tax * 100) AS INT) * 10 AS qual, CAST(l_quantity AS INT) AS r, CAST(round(l_discount * 100) AS INT) AS v FROM lineitem) q
WHERE ref <> alt"""

KEYED = f"""
SELECT *, CASE WHEN length(ref) > length(alt) THEN 'DEL' WHEN length(ref) < length(alt) THEN 'INS' ELSE 'SNV' END AS var_type,
 CASE WHEN length(ref) = length(alt) AND ref[1] = alt[1] THEN CASE WHEN ref[2] = alt[2] THEN 3 ELSE 2 END ELSE 1 END AS d
FROM ({VCF_TRUTH}) t"""

KEY_COLS = """
 CASE var_type WHEN 'DEL' THEN pos + 1 WHEN 'INS' THEN pos ELSE pos + d - 1 END AS start,
 CASE var_type WHEN 'DEL' THEN pos + length(ref) - length(alt) WHEN 'INS' THEN pos ELSE pos + d - 1 END AS "end",
 CASE var_type WHEN 'DEL' THEN '-' || substr(ref, 2, length(ref) - length(alt)) WHEN 'INS' THEN '+' || substr(alt, 2, length(alt) - length(ref))
  ELSE ref[d] || '->' || alt[d] END AS bases,
 CASE WHEN var_type = 'INS' THEN alt[1] ELSE 'N/A' END AS ref_base"""


@query("src_1", f"SELECT chrom, pos, ref, alt, 1 AS allele_no, CAST(qual AS DOUBLE) AS qual, var_type, {KEY_COLS}, 1 AS ac, 2 AS an FROM ({KEYED}) k")
def src_1(t):
    return rd.parse_vcf(t.fx_vcf).select("chrom", "pos", "ref", "alt", "allele_no", "qual", "var_type", "start", "end",
                                         "bases", "ref_base", "ac", "an")


# 64 files; those of even positions have two samples, the others one.
@query("src_1_files", f"""
SELECT k.pos % 64 AS part, s.sample, k.chrom, k.pos, k.ref, k.alt, 1 AS allele_no, var_type, {KEY_COLS}, s.gt
FROM ({KEYED}) k JOIN (VALUES ('tumour', 0, '0/1'), ('normal', 0, '1/1'), ('blood', 1, '0/1')) s(sample, odd, gt) ON s.odd = k.pos % 2""")
def src_1_files(t):
    head = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"
    part = F.split("line", "\t")[1].cast("long") % 64
    rows = t.fx_vcf.select("line", part.alias("part"))
    rows = rows.select("part", F.lit(1).alias("after"), F.when(F.col("part") % 2 == 0, F.concat("line", F.lit("\t1/1:7,8"))).otherwise(F.col("line")).alias("line"))
    heads = rows.select("part").distinct().select("part", F.lit(0).alias("after"), F.when(F.col("part") % 2 == 0, f"{head}\ttumour\tnormal").otherwise(f"{head}\tblood").alias("line"))
    path = shared_folder(t.spark)
    rows.unionByName(heads).repartition("part").sortWithinPartitions("part", "after").select("part", "line").write.partitionBy("part").text(path)
    read = rd.read_vcf_genotypes(t.spark, f"{path}/*")
    return read.select(F.regexp_extract("path", r"part=(\d+)", 1).cast("long").alias("part"), "sample", "chrom", "pos", "ref", "alt", "allele_no",
                       "var_type", "start", "end", "bases", "ref_base", "gt")


@query("nrm_1", f"SELECT chrom, var_type, {KEY_COLS} FROM ({KEYED}) k WHERE length(ref) <> length(alt) OR length(ref) = 1")
def nrm_1(t):
    v = rd.parse_vcf(t.fx_vcf)
    return v.where("length(ref) <> length(alt) OR length(ref) = 1").select(
        "chrom", "var_type", "start", "end", "bases", "ref_base")


@query("nrm_2", f"SELECT chrom, var_type, {KEY_COLS} FROM ({KEYED}) k WHERE length(ref) = length(alt) AND length(ref) > 1")
def nrm_2(t):
    v = rd.parse_vcf(t.fx_vcf)
    return v.where("length(ref) = length(alt) AND length(ref) > 1").select(
        "chrom", "var_type", "start", "end", "bases", "ref_base")


DASHED = """
SELECT id, chrom, start AS pos, CASE var_type WHEN 'INS' THEN '-' WHEN 'DEL' THEN substr(bases, 2) ELSE substr(bases, 1, 1) END AS ref,
 CASE var_type WHEN 'DEL' THEN '-' WHEN 'INS' THEN substr(bases, 2) ELSE substr(bases, 4, 1) END AS alt, var_type, bases FROM {fx_variant}"""


@query("nrm_3", """
SELECT id, chrom, CASE var_type WHEN 'INS' THEN start - 1 ELSE start END AS start,
 CASE var_type WHEN 'INS' THEN start - 1 ELSE start + length(bases) * (CASE WHEN var_type = 'DEL' THEN 1 ELSE 0 END) - CASE WHEN var_type = 'DEL' THEN 2 ELSE 0 END END AS "end",
 bases, var_type FROM fx_variant""")
def nrm_3(t):
    k = alleles.dashed_key(F.col("pos"), F.col("ref"), F.col("alt"))
    return t.sql(DASHED).select("id", "chrom", k.alias("k")).select("id", "chrom", "k.start", "k.end", "k.bases", "k.var_type")


EXAC_TRUTH = """
SELECT chrom, pos, qual, ac, an, alt, ref FROM (SELECT chrom, pos, qual, ac1 AS ac, an, alt1 AS alt, ref FROM fx_exac
 UNION ALL SELECT chrom, pos, qual, ac2, an, alt2, ref FROM fx_exac) u WHERE an > 0"""

# ACG>A DEL, ACG>ATT complex (dropped), AC>GC first-base SNV, AC>ACT INS of C, A>T SNV, A>AGG INS.
EXAC_KEYS = f"""
SELECT chrom, CASE WHEN ref = 'ACG' THEN pos + 1 ELSE pos END AS start, CASE WHEN ref = 'ACG' THEN pos + 2 ELSE pos END AS "end",
 CASE ref || alt WHEN 'ACGA' THEN '-CG' WHEN 'ACGC' THEN 'A->G' WHEN 'ACACT' THEN '+C' WHEN 'AT' THEN 'A->T' ELSE '+GG' END AS bases,
 CASE ref || alt WHEN 'ACGA' THEN 'DEL' WHEN 'ACGC' THEN 'SNV' WHEN 'AT' THEN 'SNV' ELSE 'INS' END AS var_type, CAST(qual AS VARCHAR) AS qual, ac, an
FROM ({EXAC_TRUTH}) u WHERE NOT (ref = 'ACG' AND alt = 'ATT')"""


@query("nrm_4", EXAC_KEYS)
def nrm_4(t):
    return fq.catalogue_variants(rd.parse_population(t.fx_exac.select("line")))


DBSNP_ROWS = """
SELECT chrom, rs, kind, has_counts, n1, n2, CASE kind WHEN 'del' THEN start + 1 WHEN 'trim' THEN start + 2 WHEN 'grow' THEN start + 1 WHEN 'ins' THEN start ELSE start + 1 END AS start,
 CASE kind WHEN 'grow' THEN start + 1 WHEN 'mnv' THEN start + 1 ELSE "end" END AS "end",
 CASE kind WHEN 'snv' THEN 'SNV' WHEN 'mnv' THEN 'SNV' WHEN 'ins' THEN 'INS' WHEN 'grow' THEN 'INS' ELSE 'DEL' END AS var_type,
 CASE kind WHEN 'snv' THEN ref WHEN 'mnv' THEN ref[1] WHEN 'del' THEN ref WHEN 'trim' THEN ref[2] ELSE '-' END AS ref,
 CASE kind WHEN 'snv' THEN plus_alt WHEN 'mnv' THEN plus_alt[1] WHEN 'ins' THEN plus_alt WHEN 'grow' THEN substr(plus_alt, 2) ELSE '-' END AS alt
FROM fx_dbsnp
UNION ALL SELECT chrom, rs, kind, has_counts, n1, n2, start + 2, start + 2, 'SNV', ref[2], plus_alt[2] FROM fx_dbsnp WHERE kind = 'mnv' AND ref[2] <> plus_alt[2]"""


@query("nrm_5", f'SELECT chrom, rs, start, "end", var_type, ref, alt FROM ({DBSNP_ROWS}) q WHERE ref <> alt')
def nrm_5(t):
    return fq.reconcile(t.fx_dbsnp).select("chrom", "rs", "start", "end", "var_type", "ref", "alt")


@query("nrm_6", """
SELECT id, c AS chrom, CASE c WHEN 'X' THEN 23 WHEN 'Y' THEN 24 WHEN 'M' THEN 99 ELSE CAST(c AS INT) END AS chrom_rank
FROM (SELECT id, CASE chrom WHEN '20' THEN 'X' WHEN '21' THEN 'Y' WHEN '22' THEN 'M' ELSE chrom END AS c FROM fx_variant) q""")
def nrm_6(t):
    raw = F.expr("CASE chrom WHEN '20' THEN 'chrX' WHEN '21' THEN 'Y' WHEN '22' THEN 'MT' ELSE 'chr' || chrom END")
    v = t.fx_variant.select("id", raw.alias("raw"))
    return v.select("id", norm_chrom(F.col("raw")).alias("chrom"), chrom_rank(F.col("raw")).alias("chrom_rank"))


@query("nrm_7", """
SELECT want_chrom AS chrom, want_start AS start, want_end AS "end", want_type AS var_type, want_base AS base_change,
 want_aa AS aa_change, want_gene AS gene FROM fx_cosmic WHERE want_type IS NOT NULL""")
def nrm_7(t):
    return fq.cosmic_change(t.fx_cosmic).select("chrom", "start", "end", "var_type", "base_change", "aa_change", "gene")


@query("nrm_8", "SELECT n_nationkey AS percentoftotal_, n_name AS gene_hgnc_, n_regionkey AS affected_of_total FROM nation")
def nrm_8(t):
    named = t.nation.toDF("% of total)", "gene(hgnc)", "affected/total")
    cleaned = [safe_name(c) for c in named.columns]
    return named.toDF(*cleaned)


@query("nrm_9", """
SELECT id, filter_name, 'rs' || regexp_extract(attribute, 'rs=rs([0-9]+)', 1) AS rs, regexp_extract(attribute, 'gmaf=([0-9.]+)', 1) AS gmaf,
 regexp_extract(attribute, 'exon=([0-9/]+)', 1) AS exon, 'N/A' AS pubmed FROM fx_filter""")
def nrm_9(t):
    a = F.col("attribute")
    return t.fx_filter.select("id", "filter_name", *[
        sentinel(attr(a, k), "N/A").alias(k) for k in ("rs", "gmaf", "exon", "pubmed")])


IV_LINES = """
SELECT concat_ws(chr(9), chrom, CAST(start AS STRING), CASE WHEN n % 4 < 2 THEN CAST("end" AS STRING) END, CASE WHEN n % 4 IN (0, 2) THEN gene || CASE WHEN n % 4 = 0 THEN ' and more' ELSE '' END END) AS line
FROM (SELECT *, CAST(substr(gene, 2) AS BIGINT) AS n FROM {fx_gene}) q"""


@query("src_2", """
SELECT chrom, start, CASE WHEN n % 4 < 2 THEN "end" ELSE start END AS "end",
 CASE n % 4 WHEN 0 THEN gene || ' and more' WHEN 2 THEN gene ELSE 'serial' END AS name
FROM (SELECT *, CAST(substr(gene, 2) AS BIGINT) AS n FROM fx_gene) q""")
def src_2(t):
    return rd.parse_intervals(t.sql(IV_LINES)).withColumn(
        "name", F.when(F.col("name").rlike("^[0-9]+$"), "serial").otherwise(F.col("name")))


@query("src_3", "SELECT family, sample, sex, affected, 'pa' AS father, 'ma' AS mother FROM fx_sample")
def src_3(t):
    rows = t.fx_sample.select(F.concat_ws("\t", "family", "sample", F.lit("pa"), F.lit("ma"), F.expr(
        "CASE sex WHEN 'male' THEN '1' ELSE '2' END"), (F.col("affected") + 1).cast("string")).alias("line"))
    return rd.parse_ped(rows)


@query("src_4", "SELECT chrom, pos, ref, depth, bases, quals, tags FROM fx_pileup")
def src_4(t):
    rows = t.fx_pileup.selectExpr("concat_ws('\\t', 'chr' || chrom, CAST(pos AS STRING), lower(ref), CAST(depth AS STRING), bases, quals, tags) AS line")
    return rd.parse_pileup(rows)


@query("src_7", """
SELECT CAST(n_name AS VARCHAR) AS gene, CAST(n_nationkey AS VARCHAR) AS depth, 'No Data' AS score FROM nation
UNION ALL SELECT p_name, 'No Data', CAST(p_size AS VARCHAR) FROM part""")
def src_7(t):
    return rd.merge_headers([t.nation.selectExpr("n_name AS gene", "n_nationkey AS depth"),
                             t.part.selectExpr("p_name AS gene", "p_size AS score")])


@query("src_8", "SELECT chrom, pos, ref, alt, CAST(qual AS VARCHAR) AS qual, ac, an FROM (" + EXAC_TRUTH + ") u")
def src_8(t):
    return rd.parse_population(t.fx_exac.select("line"))


@query("src_8_dbsnp", 'SELECT chrom, start, "end", rs, strand, ref, observed, alleles, counts FROM fx_dbsnp')
def src_8_dbsnp(t):
    pad = ", ".join(["'x'"] * 12)
    rows = t.fx_dbsnp.selectExpr(
        f"concat_ws('\\t', '585', 'chr' || chrom, CAST(start AS STRING), CAST(`end` AS STRING), rs, '0', strand, ref, ref, observed, {pad}, alleles, counts) AS line")
    return rd.parse_dbsnp(rows)


@query("src_10", "SELECT header, seq FROM fx_seq")
def src_10(t):
    rows = t.fx_seq.selectExpr("concat('>', header, chr(10), substr(seq, 1, 60), chr(10), substr(seq, 61)) AS line")
    return rd.parse_fasta(rows)
