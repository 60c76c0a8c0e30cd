"""SEQ-* and SNK-*. Sink queries write to the shared folder and read the result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoloom.functions.sequence import CODON_AMINO
from genoloom.operators import aggregates as ag
from genoloom.operators import reports as rp
from genoloom.operators import sequences as sq
from genoloom.plans.registry import query
from genoloom.session import shared_folder
from genoloom.sources import readers as rd
from genoloom.sources import sinks as sk
from genoloom.sources import store as st


@query("seq_1", """
WITH l AS (SELECT n_chars AS len, n_chars - (length(text) - length(replace(replace(text, 'N', ''), 'n', ''))) AS nf FROM (SELECT text, length(text) AS n_chars FROM documents) d),
 o AS (SELECT len, sum(len) OVER (ORDER BY len DESC ROWS UNBOUNDED PRECEDING) AS cum, row_number() OVER (ORDER BY len DESC) AS rn FROM l), h AS (SELECT sum(len) / 2 AS half FROM l)
SELECT count(*) AS contigs, CAST(sum(len) AS BIGINT) AS total, CAST(sum(nf) AS BIGINT) AS n_free, max(len) AS longest, count(CASE WHEN len > 100000 THEN 1 END) AS over_100k, count(CASE WHEN len > 1000000 THEN 1 END) AS over_1m,
 count(CASE WHEN len > 10000000 THEN 1 END) AS over_10m, (SELECT max(len) FROM o, h WHERE cum >= half) AS n50, (SELECT min(rn) - 1 FROM o, h WHERE cum >= half) AS l50 FROM l""")
def seq_1(t):
    return sq.assembly_stats(t.documents, "text")


@query("seq_2", """
SELECT header, CASE WHEN doc_id % 2 = 0 THEN substr(seq, 1, 10) || repeat('N', 20) || substr(seq, 31) ELSE seq END AS seq, CASE WHEN doc_id % 2 = 0 THEN substr(seq, 11, 20) END AS removed, 'mask' AS mode FROM fx_seq
UNION ALL SELECT header, CASE WHEN doc_id % 2 = 0 THEN substr(seq, 1, 10) || substr(seq, 31) ELSE seq END, CASE WHEN doc_id % 2 = 0 THEN substr(seq, 11, 20) END, 'cut' FROM fx_seq
UNION ALL SELECT header, substr(seq, 11, 20), NULL, 'extract' FROM fx_seq WHERE doc_id % 2 = 0
UNION ALL SELECT header, CASE WHEN doc_id % 2 = 0 THEN NULL ELSE seq END, CASE WHEN doc_id % 2 = 0 THEN seq END, 'remove' FROM fx_seq""")
def seq_2(t):
    even = t.fx_seq.where("doc_id % 2 = 0").select("header")
    parts = [sq.edit_sequences(t.fx_seq, 11, 30, m, even).withColumn("mode", F.lit(m)) for m in ("mask", "cut", "extract", "remove")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("seq_3", "SELECT header, reverse(translate(seq, 'ACGTacgt', 'TGCAtgca')) AS revcomp FROM fx_seq")
def seq_3(t):
    return sq.reverse_complement(t.fx_seq).select("header", "revcomp")


# Codons are cut and looked up one by one and put together again per sequence.
PROTEIN = "string_agg(substr('" + CODON_AMINO + "', CAST(16 * (strpos('TCAG', substr(codon, 1, 1)) - 1) + 4 * (strpos('TCAG', substr(codon, 2, 1)) - 1) + strpos('TCAG', substr(codon, 3, 1)) AS INT), 1), '' ORDER BY i)"


@query("seq_4", f"""
WITH c AS (SELECT header, i, substr(seq, CAST(3 * i + 1 AS INT), 3) AS codon FROM (SELECT header, seq, unnest(range(length(seq) // 3)) AS i FROM fx_seq) q) SELECT header, {PROTEIN} AS protein FROM c GROUP BY header""")
def seq_4(t):
    return sq.translate(t.fx_seq).select("header", "protein")


@query("seq_5", f"""
WITH f AS (SELECT header, k, substr(CASE WHEN k < 3 THEN seq ELSE reverse(translate(seq, 'ACGT', 'TGCA')) END, CAST(k % 3 + 1 AS INT)) AS s FROM (SELECT header, seq, unnest(range(6)) AS k FROM fx_seq) q),
 c AS (SELECT header, k, i, substr(s, CAST(3 * i + 1 AS INT), 3) AS codon FROM (SELECT header, k, s, unnest(range(length(s) // 3)) AS i FROM f) q), p AS (SELECT header, k, replace({PROTEIN}, '_', '*') AS protein FROM c GROUP BY header, k),
 b AS (SELECT *, length(protein) - length(replace(protein, '*', '')) AS stops, row_number() OVER (PARTITION BY header ORDER BY length(protein) - length(replace(protein, '*', '')), k) AS rn FROM p)
SELECT header, ['f1', 'f2', 'f3', 'r1', 'r2', 'r3'][k + 1] AS frame, stops, substr(protein, strpos(protein, 'M')) AS protein FROM b WHERE rn = 1 AND strpos(protein, 'M') > 0 AND length(substr(protein, strpos(protein, 'M'))) > 1""")
def seq_5(t):
    return sq.best_frame(t.fx_seq)


@query("seq_6", """
WITH m AS (SELECT l_partkey AS feature, 'c' || (l_linenumber % 4) AS condition, avg(CAST(l_quantity AS INT)) AS mean FROM lineitem GROUP BY 1, 2)
SELECT a.condition || '_vs_' || b.condition AS pair, a.feature, (a.mean + b.mean) / 2 AS base_mean, round(log2((a.mean + 1) / (b.mean + 1)), 9) AS log2_fold, p.p_name AS tax FROM m a JOIN m b ON a.feature = b.feature AND a.condition < b.condition
LEFT JOIN part p ON p.p_partkey = a.feature AND p.p_size > 10""")
def seq_6(t):
    counts = t.lineitem.selectExpr("l_partkey AS feature", "'c' || (l_linenumber % 4) AS condition", "CAST(l_quantity AS INT) AS value")
    tax = t.part.where("p_size > 10").selectExpr("p_partkey AS feature", "p_name AS tax")
    return sq.pairwise_contrasts(counts, tax).withColumn("log2_fold", F.round("log2_fold", 9))


@query("seq_7", """
WITH m AS (SELECT l_partkey AS feature, CAST(sum(CASE WHEN l_linenumber < 4 THEN CAST(l_quantity AS INT) ELSE 0 END) AS DOUBLE) AS a, CAST(sum(CASE WHEN l_linenumber >= 4 THEN CAST(l_quantity AS INT) ELSE 0 END) AS DOUBLE) AS b FROM lineitem GROUP BY 1)
SELECT feature, a, b, CASE WHEN a >= b THEN 'DOWN' ELSE 'UP' END AS direction, CASE WHEN a >= b THEN a / (b + 0.1) ELSE b / (a + 0.1) END AS ratio FROM m WHERE (a <> 0 OR b <> 0) AND a + b > 10""")
def seq_7(t):
    counts = t.lineitem.groupBy(F.col("l_partkey").alias("feature")).agg(
        F.sum(F.expr("CASE WHEN l_linenumber < 4 THEN CAST(l_quantity AS INT) ELSE 0 END")).cast("double").alias("a"),
        F.sum(F.expr("CASE WHEN l_linenumber >= 4 THEN CAST(l_quantity AS INT) ELSE 0 END")).cast("double").alias("b"))
    return sq.fold_direction(counts, "a", "b")


# All layouts, whole lines. Printed fractions round half up.
@query("snk_1", """
WITH p AS (
 SELECT *, 1 AS k, split_part(alts, ',', 1) AS alt, v1 AS a, r1 + v1 + w1 AS na, v2 AS b, r2 + v2 + w2 AS nb, v1 > 0 AS u1, v2 > 0 AS u2 FROM fx_vcfm WHERE layout = 'indel'
 UNION ALL SELECT *, 1, split_part(alts, ',', 1), v1, r1 + v1, v2, r2 + v2, v1 > 0, v2 > 0 FROM fx_vcfm WHERE layout = 'base'
 UNION ALL SELECT *, 1, split_part(alts, ',', 1), v1, r1 + v1 + w1, v2, r2 + v2 + w2, v1 > 1, v2 > 1 FROM fx_vcfm WHERE layout IN ('depth', 'info')
 UNION ALL SELECT *, 2, split_part(alts, ',', 2), w1, r1 + v1 + w1, w2, r2 + v2 + w2, w1 > 1, w2 > 1 FROM fx_vcfm WHERE layout IN ('depth', 'info') AND alts NOT LIKE '%*'),
 q AS (SELECT *, CAST(a AS DOUBLE) / na AS x1, CAST(b AS DOUBLE) / nb AS x2, CASE WHEN layout = 'indel' THEN pos + 1 ELSE pos END AS loc FROM p),
 m AS (SELECT *, CASE WHEN layout = 'info' THEN 0.25 / k WHEN u1 AND u2 THEN (x1 + x2) / 2 WHEN u1 THEN x1 WHEN u2 THEN x2 ELSE 0 END AS af,
  CASE layout WHEN 'info' THEN 'N/A' WHEN 'depth' THEN a || '/' || na || ',' || b || '/' || nb
   ELSE concat_ws(',', CASE WHEN na > 0 THEN a || '/' || na END, CASE WHEN nb > 0 THEN b || '/' || nb END) END AS txt FROM q),
 f AS (SELECT *, format('{:.3f}', round(CAST(af AS DOUBLE), 3)) AS af3 FROM m)
SELECT concat_ws(chr(9), chrom, CAST(loc AS VARCHAR), CAST(loc AS VARCHAR),
 CASE WHEN layout = 'indel' THEN 'DEL;' WHEN k = 2 THEN 'INS;' ELSE 'SNV;' END || chrom || ':' || loc || '-' || loc || ':' || CASE WHEN layout = 'indel' THEN '-C' WHEN k = 2 THEN '+G' ELSE ref || '->' || alt END
 || ';Q=' || qual || ';AC=' || CASE WHEN layout = 'info' THEN CASE k WHEN 1 THEN 3 ELSE 1 END WHEN k = 1 THEN 1 + pos % 3 ELSE 2 END || ';ZC=' || k || ';ALLELE=' || CASE WHEN layout = 'info' THEN 4 ELSE 3 + pos % 3 END || '/6'
 || ';MEANAF=' || af3 || ';MEDAF=' || af3 || ';VAR_READ_COUNTS=' || txt || CASE WHEN k = 2 THEN ';REF=' || substr(alt, 1, 1) ELSE '' END,
 CASE WHEN layout = 'info' THEN '' ELSE concat_ws(chr(9), g1, g2, g3) END) AS line FROM f""")
def snk_1(t):
    path = shared_folder(t.spark)
    sk.write_normalised(ag.allele_counts(ag.sample_allele_fractions(rd.parse_vcf(t.fx_vcfm.select("line")))), path)
    return rd.lines(t.spark, path)


@query("snk_2", """SELECT chrom, start, "end", gene FROM fx_gene""")
def snk_2(t):
    path = shared_folder(t.spark)
    sk.write_by_chrom(t.fx_gene.select("chrom", "start", "end", "gene"), path)
    back = t.spark.read.option("sep", "\t").schema("start BIGINT, `end` BIGINT, gene STRING, chrom STRING").csv(path)
    return back.select("chrom", "start", "end", "gene")


@query("snk_3", """SELECT v.chrom, f.filter_name AS filter, v.start, v."end", v.bases, f.attribute FROM fx_variant v JOIN fx_filter f ON v.id = f.id""")
def snk_3(t):
    path = shared_folder(t.spark)
    rows = t.fx_variant.join(t.fx_filter, "id").selectExpr("chrom", "filter_name AS filter", "start", "`end`", "bases", "attribute")
    sk.write_variant_store(rows, path)
    return t.spark.read.schema(rows.schema).parquet(path).select("chrom", "filter", "start", "end", "bases", "attribute")


@query("snk_4", """SELECT id, CASE WHEN given_status <> 'OVERALL_PASS' THEN 'LOW_PRIORITY' WHEN filter_dbsnp IN ('PASS', 'N/A') THEN 'NOVEL' WHEN var_freq IS NULL THEN 'NO_FREQ' WHEN var_freq < 0.02 THEN 'RARE' ELSE 'NOVEL' END AS tier FROM fx_report""")
def snk_4(t):
    path = shared_folder(t.spark)
    rows = rp.tiers(rp.population_class(t.fx_report).withColumn("final_status", F.col("given_status")))
    sk.write_report_tiers(rows, path)
    return t.spark.read.parquet(path).select("id", "tier")


@query("snk_5", "SELECT run_id, sample, run_stamp FROM fx_run UNION ALL SELECT run_id, sample, run_stamp FROM fx_run WHERE production = 1")
def snk_5(t):
    path = shared_folder(t.spark)
    sk.bulk_insert(t.fx_run.select("run_id", "sample", "run_stamp"), path)
    sk.bulk_insert(t.fx_run.where("production = 1").select("run_id", "sample", "run_stamp"), path)
    return t.spark.read.parquet(path)


@query("snk_6", "SELECT id % 10 AS run_id, id, filter_name, filterpass FROM fx_filter WHERE NOT (id % 10 = 3 AND filter_name = 'filter_b')")
def snk_6(t):
    old, new = shared_folder(t.spark), shared_folder(t.spark)
    rows = t.fx_filter.selectExpr("id % 10 AS run_id", "id", "filter_name", "filterpass")
    rows.write.partitionBy("filter_name").parquet(old)
    sk.delete_filter(t.spark, old, new, 3, "filter_b")
    return t.spark.read.parquet(new).select("run_id", "id", "filter_name", "filterpass")


@query("snk_6_store", """
SELECT id % 10 AS run_id, id, filter_name, filterpass FROM fx_filter WHERE NOT (id % 10 = 3 AND filter_name = 'filter_b')
UNION ALL SELECT run_id, id, filter_name, filterpass FROM (SELECT id % 10 AS run_id, id, filter_name, filterpass FROM fx_filter) f WHERE run_id = 3 AND filter_name = 'filter_b' AND filterpass = 1""")
def snk_6_store(t):
    # One filter of one run is appended, removed, and appended anew with its passing rows only.
    root = shared_folder(t.spark)
    rows = t.fx_filter.selectExpr("id % 10 AS run_id", "id", "filter_name", "filterpass")
    st.create_store(t.spark, root, rows.schema, ["run_id", "filter_name"])
    st.append_rows(rows, root, ["id"])
    st.remove_rows(t.spark, root, {"run_id": 3, "filter_name": "filter_b"})
    st.append_rows(rows.where("run_id = 3 AND filter_name = 'filter_b' AND filterpass = 1"), root, ["id"])
    return st.read_store(t.spark, root)


@query("snk_7", "SELECT chrom, pos FROM fx_call WHERE qual < 40 UNION SELECT chrom, pos FROM fx_call WHERE qual >= 20")
def snk_7(t):
    path = shared_folder(t.spark)
    t.fx_call.where("qual < 40").select("chrom", "pos").distinct().write.parquet(path)
    sk.append_new(t.fx_call.where("qual >= 20").select("chrom", "pos"), path, ["chrom", "pos"])
    return t.spark.read.parquet(path)


@query("snk_8", """
SELECT r.read_id, r.chrom, r.pos, r.barcode, g.cell_type FROM fx_read r JOIN (SELECT 'bc' || s_suppkey AS barcode, 'type' || (s_suppkey % 4) AS cell_type FROM supplier WHERE s_suppkey % 5 <> 0) g ON r.barcode = g.barcode""")
def snk_8(t):
    path = shared_folder(t.spark)
    groups = t.supplier.where("s_suppkey % 5 <> 0").selectExpr("'bc' || s_suppkey AS barcode", "'type' || (s_suppkey % 4) AS cell_type")
    sk.write_by_group(t.fx_read.select("read_id", "chrom", "pos", "barcode"), groups, path)
    return t.spark.read.schema("read_id STRING, chrom STRING, pos BIGINT, barcode STRING, cell_type STRING").parquet(path)


@query("snk_9", """
SELECT id, 0 AS column_number, 'gene' AS column_name, gene AS column_value FROM fx_report UNION ALL SELECT id, 1, 'exon_type', exon_type FROM fx_report UNION ALL SELECT id, 2, 'depth', CAST(depth AS VARCHAR) FROM fx_report""")
def snk_9(t):
    path = shared_folder(t.spark)
    sk.write_report_rows(t.fx_report, path, ["id"], ["gene", "exon_type", "depth"])
    return t.spark.read.parquet(path).select("id", "column_number", "column_name", "column_value")


@query("src_11", "SELECT chrom, start, \"end\", gene AS name FROM fx_gene")
def src_11(t):
    base = shared_folder(t.spark)
    rows = t.fx_gene.select(F.col("chrom").alias("c"), F.concat_ws("\t", "chrom", F.col("start").cast("string"), F.col("end").cast("string"), "gene"))
    rows.write.partitionBy("c").text(base)
    paths = {r.chrom: f"{base}/c={r.chrom}" for r in t.fx_gene.select("chrom").distinct().collect()}
    return rd.concat_by_chrom(t.spark, paths, rd.read_intervals)
