"""Derived views: the driver tables reshaped into the inputs the operators expect.

The same text runs on Spark (braces name tables, double quotes become backquotes) and, inlined
as common table expressions, on the SQL oracle. ``EACH(a,b)`` stands for one row per integer.
"""

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS: dict[str, str] = {}

VIEWS["fx_sample"] = """
SELECT CAST(n_nationkey AS BIGINT) AS sample_no, 's' || n_nationkey AS sample,
 'f' || CAST(floor(n_nationkey / 5) AS BIGINT) AS family,
 CASE n_nationkey % 5 WHEN 0 THEN 'mother' WHEN 1 THEN 'father' WHEN 2 THEN 'proband' ELSE 'sibling' END AS relation,
 CASE WHEN n_nationkey % 5 IN (2,3) THEN 1 ELSE 0 END AS affected,
 CASE WHEN n_nationkey % 2 = 0 THEN 'female' ELSE 'male' END AS sex,
 'g' || (n_nationkey % 3) AS grp FROM {nation}
"""

VIEWS["fx_call"] = """
SELECT CAST(1 + l_suppkey % 22 AS STRING) AS chrom, CAST(1000 + l_partkey * 50 + l_linenumber AS BIGINT) AS pos,
 substr('ACGT', CAST(1 + l_partkey % 4 AS INT), 1) AS ref,
 substr('ACGT', CAST(1 + (l_partkey + 1 + l_linenumber % 3) % 4 AS INT), 1) AS alt,
 's' || (l_orderkey % 25) AS sample, CAST(l_quantity AS INT) AS depth,
 CAST(floor(l_quantity * round(l_discount * 100) / 10) AS INT) AS alt_reads,
 CAST(round(l_tax * 100) AS INT) * 10 AS qual FROM {lineitem}
"""

VIEWS["fx_point"] = """
SELECT chrom, pos AS start, pos AS "end", ref, alt, sample FROM {fx_call}
"""

VIEWS["fx_gene"] = """
SELECT CAST(1 + p_partkey % 22 AS STRING) AS chrom, CAST(1000 + p_partkey * 50 AS BIGINT) AS start,
 CAST(1000 + p_partkey * 50 + p_size * 10 AS BIGINT) AS "end", 'G' || p_partkey AS gene, p_brand AS descr FROM {part}
"""

VIEWS["fx_sv"] = """
SELECT CAST(1 + o_custkey % 22 AS STRING) AS chr1, CAST(1000 + o_orderkey * 40 AS BIGINT) AS coord1,
 CASE WHEN o_orderpriority = '5-LOW' THEN CAST(1 + (o_custkey + 3) % 22 AS STRING)
  ELSE CAST(1 + o_custkey % 22 AS STRING) END AS chr2,
 CAST(1000 + o_orderkey * 40 + 50 + CAST(floor(o_totalprice / 100) AS BIGINT) AS BIGINT) AS coord2,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'del' WHEN '2-HIGH' THEN 'dup' WHEN '3-MEDIUM' THEN 'inv'
  WHEN '5-LOW' THEN 'tra' ELSE 'ins' END AS sv_type,
 CASE WHEN o_orderkey % 2 = 0 THEN 'c1' ELSE 'c2' END AS caller, 'sv' || o_orderkey AS sv_id,
 's' || (o_custkey % 25) AS sample FROM {orders}
"""

VIEWS["fx_seq"] = """
SELECT doc_id, 'seq' || doc_id AS header,
 translate(md5(text) || md5(text || 'x') || md5(text || 'y'), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq
FROM {documents}
"""

VIEWS["fx_depth"] = """
SELECT chrom, pos, CAST(sum(depth) AS BIGINT) AS depth FROM {fx_call} GROUP BY chrom, pos
"""

VIEWS["fx_geno"] = """
SELECT chrom, pos, gene, 's' || n AS sample, CASE WHEN code < 5 THEN 'ref' WHEN code < 8 THEN 'het'
 WHEN code < 9 THEN 'hom' ELSE 'No data' END AS zyg
FROM (SELECT CAST(1 + p_partkey % 22 AS STRING) AS chrom, CAST(1000 + p_partkey * 50 AS BIGINT) AS pos,
  'G' || CAST(floor(p_partkey / 40) AS BIGINT) AS gene, n_nationkey AS n,
  (p_partkey * 7 + n_nationkey * 11 + p_size) % 10 AS code
 FROM (SELECT p_partkey, p_size, EACH(0,24) AS k FROM {part}) p JOIN {nation} ON n_nationkey = k) g
"""

VIEWS["fx_exon"] = """
SELECT CAST(1 + p_partkey % 22 AS STRING) AS chrom, CAST(1000 + p_partkey * 50 + k * 200 AS BIGINT) AS start,
 CAST(1000 + p_partkey * 50 + k * 200 + (p_size % 9 + 1) * 3 - 1 AS BIGINT) AS "end", 'G' || p_partkey AS gene,
 'G' || p_partkey || '_exon' || (k + 1) AS exon, CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand
FROM (SELECT p_partkey, p_size, EACH(0,2) AS k FROM {part}) e
"""

VIEWS["fx_vcf"] = """
SELECT concat_ws(chr(9), CAST(1 + l_suppkey % 22 AS STRING), CAST(1000 + l_partkey * 50 + l_linenumber AS STRING), '.',
 substr('ACGTACGT', CAST(1 + l_partkey % 4 AS INT), CAST(1 + l_linenumber % 3 AS INT)),
 CASE WHEN l_linenumber = 7 THEN 'T,*'
  ELSE substr('TGCATGCA', CAST(1 + l_partkey % 4 AS INT), CAST(1 + l_suppkey % 3 AS INT)) END,
 CAST(CAST(round(l_tax * 100) AS INT) * 10 AS STRING), 'PASS', 'AC=1;AN=2', 'GT:AD',
 '0/1:' || CAST(CAST(l_quantity AS INT) AS STRING) || ',' || CAST(CAST(round(l_discount * 100) AS INT) AS STRING))
 AS line FROM {lineitem}
"""

# Variants with caller fields, one per order: deletions, insertions and single-base changes.
VIEWS["fx_variant"] = """
SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(1 + o_custkey % 22 AS STRING) AS chrom,
 CAST(1000 + (o_orderkey % 5000) * 40 AS BIGINT) AS start,
 CAST(1000 + (o_orderkey % 5000) * 40 + CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey % 3 ELSE 0 END AS BIGINT) AS "end",
 CASE o_orderpriority WHEN '1-URGENT' THEN 'DEL' WHEN '2-HIGH' THEN 'INS' ELSE 'SNV' END AS var_type,
 CASE o_orderpriority WHEN '1-URGENT' THEN '-' || substr('ACGTACGT', CAST(1 + o_orderkey % 4 AS INT), CAST(1 + o_custkey % 3 AS INT))
  WHEN '2-HIGH' THEN '+' || substr('ACGTACGT', CAST(1 + o_orderkey % 4 AS INT), CAST(1 + o_custkey % 2 AS INT))
  ELSE substr('ACGT', CAST(1 + o_orderkey % 4 AS INT), 1) || '->' || substr('ACGT', CAST(1 + (o_orderkey + 1 + o_custkey % 3) % 4 AS INT), 1) END AS bases,
 CAST(floor(o_totalprice / 1000) % 100 AS INT) AS qual, CAST(floor(o_totalprice / 10) % 60 AS INT) AS depth,
 CASE WHEN o_orderkey % 7 = 0 THEN 'NO_CLR' ELSE 'CLR' || (o_custkey % 90) END AS clr,
 CASE o_orderstatus WHEN 'F' THEN 'SOMATIC' WHEN 'O' THEN 'GERMLINE' ELSE 'LOH' END AS snv_class,
 CASE WHEN o_custkey % 4 = 0 THEN 'LowQual' ELSE 'PASS' END AS filter,
 's' || (o_custkey % 25) AS sample, CAST(o_custkey AS BIGINT) AS run_id FROM {orders}
"""

# Filter outcomes, a few per variant and filter.
VIEWS["fx_filter"] = """
SELECT CAST(l_orderkey AS BIGINT) AS id, 'filter_' || substr('abcdefg', l_linenumber, 1) AS filter_name,
 CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS filtermatch, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS filterpass,
 'rs=rs' || l_partkey || ';gmaf=0.' || l_suppkey || ';exon=' || l_linenumber || '/7' AS attribute FROM {lineitem}
"""

# Pipeline runs of samples, with production marks.
VIEWS["fx_run"] = """
SELECT CAST(c_custkey AS BIGINT) AS run_id, 's' || (c_custkey % 25) AS sample, CAST(c_custkey * 7 % 1001 AS BIGINT) AS run_stamp,
 CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS production FROM {customer}
"""

# Gene lists keyed by name, written in mixed case and with quotes as in hand-kept files.
VIEWS["fx_gene_info"] = """
SELECT 'G' || p_partkey AS gene, chr(34) || lower('G' || p_partkey) || chr(34) AS raw_key, p_name AS descr, p_type AS family,
 'H' || (p_partkey % 500) AS homolog, CAST(p_size AS INT) AS aa_length FROM {part}
"""

# Population catalogue at call sites with allele frequencies.
VIEWS["fx_popfreq"] = """
SELECT DISTINCT chrom, pos, ref, substr('ACGT', CAST(1 + (pos %% 4) AS INT), 1) AS alt,
 CAST((pos * 7) %% 1000 AS DOUBLE) / 1000 AS freq FROM {fx_call} WHERE qual >= 20
""".replace("%%", "%")

# Pileup loci built from known read counts, so every expected token count is a column. The hint, a
# comment elsewhere, spreads the counts over the tasks before they are spelled out as read strings.
VIEWS["fx_pileup"] = """
SELECT chrom, pos, ref, alt, alt2, n_ref, n_alt, n_alt2, n_ins, n_del, n_star, n_start, n_end, depth,
 repeat('.', n_ref) || repeat(alt, n_alt) || repeat(lower(alt2), n_alt2) || repeat('.+2AG', n_ins) || repeat(',-1T', n_del)
  || repeat('*', n_star) || repeat('^].', n_start) || repeat('.$', n_end) AS bases,
 repeat(chr(40 + q1), depth - n_q2) || repeat(chr(40 + q2), n_q2) AS quals, q1, q2, n_q2,
 substr(repeat('T0,T1,T2,', 25), 1, CASE WHEN depth = 0 THEN 0 ELSE depth * 3 - 1 END) AS tags
FROM (SELECT *, CAST(n_ref + n_alt + n_alt2 + n_ins + n_del + n_star + n_start + n_end AS INT) AS depth,
  CAST(least(k5, n_ref + n_alt + n_alt2 + n_ins + n_del + n_star + n_start + n_end) AS INT) AS n_q2
 FROM (SELECT /*+ REPARTITION(chrom, pos) */ CAST(1 + o_custkey % 22 AS STRING) AS chrom, CAST(1000 + o_orderkey * 40 AS BIGINT) AS pos,
   substr('ACGT', CAST(1 + o_orderkey % 4 AS INT), 1) AS ref, substr('CGTA', CAST(1 + o_orderkey % 4 AS INT), 1) AS alt,
   substr('GTAC', CAST(1 + o_orderkey % 4 AS INT), 1) AS alt2, CAST(CASE WHEN o_custkey % 4 = 0 THEN 0 ELSE o_orderkey % 23 END AS INT) AS n_ref,
   CAST(CASE WHEN o_custkey % 5 = 0 THEN 0 ELSE o_custkey % 9 END AS INT) AS n_alt, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 4 ELSE 0 END AS INT) AS n_alt2,
   CAST(CASE WHEN o_custkey % 7 = 0 THEN o_custkey % 3 ELSE 0 END AS INT) AS n_ins, CAST(CASE WHEN o_custkey % 11 = 0 THEN 1 + o_orderkey % 2 ELSE 0 END AS INT) AS n_del,
   CAST(CASE WHEN o_custkey % 13 = 0 THEN 1 ELSE 0 END AS INT) AS n_star, CAST(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS INT) AS n_start,
   CAST(CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END AS INT) AS n_end,
   CAST(o_custkey % 30 AS INT) AS q1, CAST(o_orderkey % 40 AS INT) AS q2, CAST(o_orderkey % 5 AS INT) AS k5 FROM {orders}) a) b
"""

# Expected alleles of each locus, long: the truth the tokeniser has to reproduce.
VIEWS["fx_pile_truth"] = """
SELECT chrom, pos, ref, depth, allele, n FROM (
 SELECT chrom, pos, ref, depth, 'REF' AS allele, n_ref + n_start + n_end AS n FROM {fx_pileup}
 UNION ALL SELECT chrom, pos, ref, depth, alt, n_alt FROM {fx_pileup}
 UNION ALL SELECT chrom, pos, ref, depth, alt2, n_alt2 FROM {fx_pileup}
 UNION ALL SELECT chrom, pos, ref, depth, '+2AG', n_ins FROM {fx_pileup}
 UNION ALL SELECT chrom, pos, ref, depth, '-1T', n_del FROM {fx_pileup}
 UNION ALL SELECT chrom, pos, ref, depth, 'OTHER_DEL', n_star FROM {fx_pileup}) t WHERE n > 0
"""

# Three-sample records in the four evidence layouts, with the counts the fields were built from.
VIEWS["fx_vcfm"] = """
SELECT *, concat_ws(chr(9), chrom, CAST(pos AS STRING), '.', ref, alts, CAST(qual AS STRING), 'PASS', info, fmt, g1, g2, g3) AS line
FROM (SELECT *,
  CASE layout WHEN 'indel' THEN 'DP:TAR:TIR:TOR' WHEN 'base' THEN 'DP:AU:CU:GU:TU' WHEN 'depth' THEN 'GT:AD' END AS fmt,
  CASE layout WHEN 'info' THEN 'AC=3,1;AN=6;AF=0.25,0.125' ELSE 'AC=' || (1 + pos % 3) || ',2;AN=6' END AS info,
  CASE layout WHEN 'indel' THEN '9:' || r1 || ',1:' || v1 || ',2:' || w1 || ',0'
   WHEN 'base' THEN '9:' || CASE WHEN ref = 'A' THEN r1 ELSE v1 END || ',1:' || CASE WHEN ref = 'C' THEN r1 ELSE v1 END || ',2:'
    || CASE WHEN ref = 'G' THEN r1 ELSE v1 END || ',3:' || CASE WHEN ref = 'T' THEN r1 ELSE v1 END || ',4'
   WHEN 'depth' THEN '0/1:' || r1 || ',' || v1 || ',' || w1 END AS g1,
  CASE layout WHEN 'indel' THEN '9:' || r2 || ',1:' || v2 || ',2:' || w2 || ',0'
   WHEN 'base' THEN '9:' || CASE WHEN ref = 'A' THEN r2 ELSE v2 END || ',1:' || CASE WHEN ref = 'C' THEN r2 ELSE v2 END || ',2:'
    || CASE WHEN ref = 'G' THEN r2 ELSE v2 END || ',3:' || CASE WHEN ref = 'T' THEN r2 ELSE v2 END || ',4'
   WHEN 'depth' THEN '1/2:' || r2 || ',' || v2 || ',' || w2 END AS g2,
  CASE layout WHEN 'indel' THEN '.' WHEN 'base' THEN '.' WHEN 'depth' THEN './.' END AS g3
 FROM (SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(1 + o_custkey % 22 AS STRING) AS chrom, CAST(1000 + o_orderkey * 40 AS BIGINT) AS pos,
   CASE o_orderpriority WHEN '1-URGENT' THEN 'AC' ELSE substr('ACGT', CAST(1 + o_orderkey % 4 AS INT), 1) END AS ref,
   CASE o_orderpriority WHEN '1-URGENT' THEN 'A' WHEN '2-HIGH' THEN substr('CGTA', CAST(1 + o_orderkey % 4 AS INT), 1)
    ELSE substr('CGTA', CAST(1 + o_orderkey % 4 AS INT), 1) || ',' || CASE WHEN o_custkey % 5 = 0 THEN '*' ELSE substr('GTAC', CAST(1 + o_orderkey % 4 AS INT), 1) || 'G' END END AS alts,
   CASE o_orderpriority WHEN '1-URGENT' THEN 'indel' WHEN '2-HIGH' THEN 'base' WHEN '3-MEDIUM' THEN 'info' ELSE 'depth' END AS layout,
   CAST(o_custkey % 60 AS INT) AS qual, CAST((o_orderkey + 3) % 7 AS INT) AS v1, CAST((o_orderkey + 6) % 7 AS INT) AS v2,
   CAST((o_custkey + 1) % 11 AS INT) AS r1, CAST((o_custkey + 2) % 11 AS INT) AS r2,
   CAST((o_custkey + 2) % 5 AS INT) AS w1, CAST((o_custkey + 4) % 5 AS INT) AS w2 FROM {orders}) a) b
"""

# Aligned reads with flag bits.
VIEWS["fx_read"] = """
SELECT 'r' || l_orderkey AS read_id, 's' || (l_orderkey % 25) AS sample, CAST(1 + l_suppkey % 22 AS STRING) AS chrom,
 CAST(1000 + l_partkey * 50 + l_linenumber * 7 AS BIGINT) AS pos, CAST(1 + (l_suppkey + CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) % 22 AS STRING) AS mate_chrom,
 CAST(20 AS INT) AS read_length, 'bc' || l_suppkey AS barcode,
 CAST(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 1 + 2 END + CASE WHEN l_quantity > 45 THEN 4 ELSE 0 END
  + CASE WHEN l_quantity < 5 THEN 8 ELSE 0 END + CASE WHEN l_discount > 0.095 THEN 256 ELSE 0 END AS INT) AS flag,
 repeat(chr(CAST(CASE WHEN l_orderkey % 25 < 12 THEN 64 + l_linenumber ELSE 58 + l_linenumber END AS INT)), 8) AS quals FROM {lineitem}
"""

# dbSNP-style records; plus_* columns hold the plus-strand truth.
VIEWS["fx_dbsnp"] = """
SELECT chrom, start, "end", rs, strand, ref, CASE WHEN strand = '-' THEN reverse(translate(ref, 'ACGT', 'TGCA')) || '/' || reverse(translate(plus_alt, 'ACGT', 'TGCA'))
  ELSE ref || '/' || plus_alt END AS observed,
 CASE WHEN has_counts THEN CASE WHEN strand = '-' THEN reverse(translate(ref, 'ACGT', 'TGCA')) || ',' || reverse(translate(plus_alt, 'ACGT', 'TGCA')) || ','
  ELSE ref || ',' || plus_alt || ',' END ELSE '' END AS alleles,
 CASE WHEN has_counts THEN n1 || ',' || n2 || ',' ELSE '' END AS counts, plus_alt, kind, has_counts, n1, n2
FROM (SELECT *, CAST(start + CASE kind WHEN 'snv' THEN 1 WHEN 'ins' THEN 0 WHEN 'grow' THEN 1 ELSE 2 END AS BIGINT) AS "end",
  CASE kind WHEN 'ins' THEN '-' WHEN 'snv' THEN base WHEN 'grow' THEN base ELSE base || 'C' END AS ref,
  CASE kind WHEN 'snv' THEN nextbase WHEN 'ins' THEN nextbase || 'AC' WHEN 'grow' THEN base || nextbase || 'G' WHEN 'del' THEN '-' WHEN 'trim' THEN base ELSE nextbase || 'T' END AS plus_alt
 FROM (SELECT CAST(1 + o_custkey % 22 AS STRING) AS chrom, CAST(1000 + (o_custkey % 300) * 10 AS BIGINT) AS start, 'rs' || o_orderkey AS rs,
   CASE WHEN o_orderkey % 3 = 0 THEN '-' ELSE '+' END AS strand, substr('ACGT', CAST(1 + o_custkey % 4 AS INT), 1) AS base,
   substr('CGTA', CAST(1 + o_custkey % 4 AS INT), 1) AS nextbase,
   CASE o_orderpriority WHEN '1-URGENT' THEN 'del' WHEN '2-HIGH' THEN 'ins' WHEN '3-MEDIUM' THEN 'grow' WHEN '5-LOW' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'trim' ELSE 'mnv' END ELSE 'snv' END AS kind,
   o_orderkey % 4 <> 0 AS has_counts, CAST(o_custkey % 50 AS INT) AS n1, CAST(o_orderkey % 30 AS INT) AS n2 FROM {orders}) a) b
"""

# Population catalogue lines with one or two alternates.
VIEWS["fx_exac"] = """
SELECT chrom, pos, ref, alt1, alt2, ac1, ac2, an, qual,
 concat_ws(chr(9), chrom, CAST(pos AS STRING), '.', ref, alt1 || ',' || alt2, CAST(qual AS STRING), 'PASS',
  'AC=9,9;AC_Adj=' || ac1 || ',' || ac2 || ';AN=99;AN_Adj=' || an || ';DP=7') AS line
FROM (SELECT CAST(1 + o_custkey % 22 AS STRING) AS chrom, CAST(1000 + (o_orderkey % 3000) * 10 AS BIGINT) AS pos,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'ACG' WHEN o_orderpriority = '2-HIGH' THEN 'AC' ELSE 'A' END AS ref,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'A' WHEN o_orderpriority = '2-HIGH' THEN 'GC' ELSE 'T' END AS alt1,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'ATT' WHEN o_orderpriority = '2-HIGH' THEN 'ACT' ELSE 'AGG' END AS alt2,
  CAST(o_custkey % 90 AS INT) AS ac1, CAST(o_orderkey % 40 AS INT) AS ac2, CAST((o_custkey % 8) * 1000 AS INT) AS an,
  CAST(o_orderkey % 60 AS INT) AS qual FROM {orders}) a
"""

# Cancer-catalogue mutations; want_* columns hold the expected base and residue change.
VIEWS["fx_cosmic"] = """
SELECT 'G' || (o_custkey % 200) || CASE WHEN o_orderkey % 5 = 0 THEN '_ENST0001' ELSE '' END AS gene, 'G' || (o_custkey % 200) AS want_gene,
 CASE WHEN o_orderkey % 2 = 0 THEN 'skin' ELSE 'lung' END AS site, 'hist' || (o_custkey % 3) AS histology,
 CASE o_orderpriority WHEN '1-URGENT' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'c.12_14delACG' ELSE 'c.5_9del5' END
  WHEN '2-HIGH' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'c.12_13insTT' ELSE 'c.5_6ins12' END ELSE 'c.35G>T' END AS base_text,
 CASE o_orderpriority WHEN '1-URGENT' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'p.K5delK' ELSE 'p.?' END
  WHEN '2-HIGH' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'p.Q3_R4insW' ELSE 'p.(ins4)' END
  ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'p.G12V' ELSE 'p.L7L' END END AS aa_text,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'Deletion - In frame' WHEN '2-HIGH' THEN CASE WHEN o_custkey % 3 = 0 THEN 'Insertion - Frameshift' ELSE 'Insertion - In frame' END
  WHEN '5-LOW' THEN 'Unknown' ELSE 'Substitution - Missense' END AS mut_type,
 CASE WHEN o_custkey % 24 = 22 THEN '23' WHEN o_custkey % 24 = 23 THEN '24' ELSE CAST(1 + o_custkey % 24 AS STRING) END || ':' || (1000 + o_custkey % 400) || '-' || (1000 + o_custkey % 400 + o_orderkey % 2) AS coord,
 CASE WHEN o_custkey % 2 = 0 THEN '+' ELSE '-' END AS strand, 'somatic' AS status, 'carcinoma' AS tumour,
 CASE o_orderpriority WHEN '1-URGENT' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'ACG' ELSE 'del5' END WHEN '2-HIGH' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'TT' ELSE 'ins12' END ELSE 'G->T' END AS want_base,
 CASE o_orderpriority WHEN '1-URGENT' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'K' ELSE 'p.?' END
  WHEN '2-HIGH' THEN CASE WHEN o_custkey % 3 = 0 THEN 'frameshift' WHEN o_orderkey % 2 = 0 THEN 'W' ELSE 'ins4' END
  ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'G->V' ELSE 'SYN' END END AS want_aa,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'DEL' WHEN '2-HIGH' THEN 'INS' WHEN '5-LOW' THEN NULL ELSE 'SNV' END AS want_type,
 CASE WHEN o_custkey % 24 = 22 THEN 'X' WHEN o_custkey % 24 = 23 THEN 'Y' ELSE CAST(1 + o_custkey % 24 AS STRING) END AS want_chrom,
 CAST(1000 + o_custkey % 400 AS BIGINT) AS want_start,
 CAST(1000 + o_custkey % 400 + CASE WHEN o_orderpriority = '2-HIGH' THEN 0 ELSE o_orderkey % 2 END AS BIGINT) AS want_end FROM {orders}
"""

# Family members; families f1, f2 and f3 lack the father, the mother and both.
VIEWS["fx_member"] = """
SELECT * FROM {fx_sample} WHERE NOT (family = 'f1' AND relation = 'father') AND NOT (family = 'f2' AND relation = 'mother')
 AND NOT (family = 'f3' AND relation IN ('mother', 'father'))
"""

# Family genotypes; every third locus follows the affection status, the others are mixed.
VIEWS["fx_fam"] = """
SELECT m.family, m.sample, m.relation, m.affected, chrom, pos, gene, var_type, rare,
 CASE WHEN p % 3 = 0 THEN CASE WHEN m.affected = 1 THEN CASE (q + p_size) % 3 WHEN 0 THEN 'ref' WHEN 1 THEN 'het' ELSE 'hom' END
   WHEN m.relation = 'mother' THEN CASE WHEN q % 2 = 0 THEN 'ref' ELSE 'het' END
   WHEN m.relation = 'father' THEN CASE WHEN (q + p_size) % 2 = 0 THEN 'het' ELSE 'ref' END
   ELSE CASE WHEN p_size % 4 = 0 THEN 'het' ELSE 'ref' END END
  ELSE CASE WHEN code < 4 THEN 'ref' WHEN code < 7 THEN 'het' WHEN code < 9 THEN 'hom' ELSE 'No data' END END AS zyg
FROM (SELECT CAST(CASE WHEN p_partkey % 23 = 22 THEN 'X' ELSE CAST(1 + p_partkey % 23 AS STRING) END AS STRING) AS chrom,
  CAST(1000 + p_partkey * 150 AS BIGINT) AS pos, 'G' || CAST(floor(p_partkey / 12) AS BIGINT) AS gene, p_partkey AS p, p_size,
  CAST(floor(p_partkey / 3) AS BIGINT) AS q, CASE WHEN p_size % 5 = 0 THEN 'indel' ELSE 'snv' END AS var_type,
  p_size % 2 AS rare, k AS n, (p_partkey * (k + 3) + p_size * 7 + k * k) % 10 AS code
 FROM (SELECT p_partkey, p_size, EACH(0,24) AS k FROM {part}) a) g JOIN {fx_member} m ON m.sample_no = g.n
"""

# SV records as four callers write them. Translocations and inversions are breakends; every
# translocation also has its mate record.
_SV_BASE = """
SELECT *, CASE sv_type WHEN 'del' THEN 'DEL' WHEN 'dup' THEN 'DUP' WHEN 'ins' THEN 'INS' ELSE 'BND' END AS code,
 CAST(substr(sv_id, 3) AS BIGINT) AS n FROM {fx_sv}
"""

VIEWS["fx_lumpy"] = """
SELECT concat_ws(chr(9), 'chr' || chr1, CAST(coord1 AS STRING), CAST(n AS STRING) || '_1', 'N', CASE WHEN code = 'BND' THEN 'N]chr' || chr2 || ':' || coord2 || ']' ELSE '<' || code || '>' END, '.', '.',
 'SVTYPE=' || code || ';' || CASE WHEN sv_type = 'inv' THEN 'STRANDS=++:5;' ELSE 'STRANDS=+-:5;' END || CASE WHEN code <> 'BND' THEN 'SVLEN=-' || (coord2 - coord1) || ';END=' || coord2 || ';' ELSE '' END || 'SU=9;PE=' || (n % 7) || ';SR=' || (n % 5)) AS line
FROM (""" + _SV_BASE + """) b
UNION ALL SELECT concat_ws(chr(9), 'chr' || chr2, CAST(coord2 AS STRING), CAST(n AS STRING) || '_2', 'N', 'N]chr' || chr1 || ':' || coord1 || ']', '.', '.',
 'SVTYPE=BND;STRANDS=+-:5;' || CASE WHEN n % 2 = 0 THEN 'SECONDARY;' ELSE '' END || 'SU=9;PE=' || (n % 7) || ';SR=' || (n % 5)) FROM (""" + _SV_BASE + """) b WHERE sv_type = 'tra'
"""

VIEWS["fx_delly"] = """
SELECT concat_ws(chr(9), 'chr' || chr1, CAST(coord1 AS STRING), 'D' || n, 'N', CASE WHEN code = 'BND' THEN 'N]chr' || chr2 || ':' || coord2 || ']' ELSE '<' || code || '>' END, '.', CASE WHEN n % 10 = 0 THEN 'LowQual' ELSE 'PASS' END,
 'PRECISE;SVTYPE=' || code || ';CHR2=chr' || chr2 || ';END=' || coord2 || ';PE=' || (n % 7) || ';MAPQ=' || (n % 60) || CASE WHEN n % 3 = 0 THEN ';SR=' || (n % 5) ELSE '' END
  || CASE WHEN code = 'INS' THEN ';CONSENSUS=' || repeat('ACGT', CAST(1 + n % 300 AS INT)) ELSE '' END) AS line FROM (""" + _SV_BASE + """) b
"""

VIEWS["fx_manta"] = """
SELECT concat_ws(chr(9), CASE WHEN n % 50 = 7 THEN 'GL000' ELSE 'chr' || chr1 END, CAST(coord1 AS STRING), 'M' || n, 'A', CASE WHEN code = 'BND' THEN 'A]chr' || chr2 || ':' || coord2 || ']' WHEN code = 'INS' THEN 'AGG' ELSE '<' || code || '>' END,
 CAST(n % 999 AS STRING), CASE WHEN n % 6 = 0 THEN 'MinQUAL' ELSE 'PASS' END, 'X=1;SVTYPE=' || code || CASE WHEN code <> 'BND' THEN ';END=' || coord2 ELSE '' END || CASE WHEN code IN ('DEL', 'DUP') THEN ';SVLEN=-' || (coord2 - coord1) ELSE '' END
  || CASE WHEN code = 'INS' AND n % 2 = 0 THEN ';SEQ=' || repeat('AC', CAST(1 + n % 600 AS INT)) ELSE '' END, CASE WHEN n % 4 = 0 THEN 'GT:PR' ELSE 'GT:PR:SR' END,
 '0/1:9,' || (n % 8) || CASE WHEN n % 4 = 0 THEN '' ELSE ':7,' || (n % 9) END, '0/0:9,0' || CASE WHEN n % 4 = 0 THEN '' ELSE ':7,1' END, '1/1:0,' || (n % 6) || CASE WHEN n % 4 = 0 THEN '' ELSE ':0,' || (n % 3) END) AS line
FROM (""" + _SV_BASE + """) b
"""

VIEWS["fx_longread"] = """
SELECT concat_ws(chr(9), 'chr' || chr1, CAST(coord1 AS STRING), 'L' || n, 'A', CASE WHEN sv_type = 'tra' THEN 'A]chr' || chr2 || ':' || coord2 || ']' WHEN sv_type = 'ins' THEN repeat('ACGT', CAST(1 + n % 300 AS INT)) ELSE '<' || sv_type || '>' END,
 '60', CASE WHEN n % 6 = 0 THEN 'NEAR' ELSE 'PASS' END, 'PRECISE;SVTYPE=' || upper(CASE WHEN sv_type = 'tra' THEN 'bnd' ELSE sv_type END) || CASE WHEN sv_type = 'tra' THEN '' ELSE ';END=' || coord2 || ';SVLEN=-' || (coord2 - coord1) END,
 'GT:DR:DV', '0/1:' || (n % 11) || ':' || (n % 13)) AS line FROM (""" + _SV_BASE + """) b
UNION ALL SELECT concat_ws(chr(9), 'chr' || chr2, CAST(coord2 AS STRING), 'L' || n || 'm', 'A', 'A]chr' || chr1 || ':' || coord1 || ']', '60', CASE WHEN n % 6 = 0 THEN 'NEAR' ELSE 'PASS' END, 'PRECISE;SVTYPE=BND', 'GT:DR:DV', '0/1:' || (n % 11) || ':' || (n % 13))
FROM (""" + _SV_BASE + """) b WHERE sv_type = 'tra'
"""

# Known population events near the called ones.
VIEWS["fx_svpop"] = """
SELECT chr1 AS chrom, coord1 + (coord2 % 300) AS start, coord2 + (coord1 % 400) AS "end", sv_type, 'dgv' || sv_id || ' ' || (coord1 % 90) || '%' AS entry
FROM {fx_sv} WHERE sv_type <> 'tra' AND coord1 % 3 = 0
"""

# Family SVs: each proband event recurs, shifted, in one relative.
VIEWS["fx_famsv"] = """
SELECT 'p' || n AS sv_id, chr1, coord1, chr2, coord2, sv_type, 's' || (5 * (n % 5) + 2) AS sample FROM (""" + _SV_BASE + """) b
UNION ALL SELECT 'o' || n, CASE WHEN sv_type = 'tra' AND n % 2 = 0 THEN chr2 ELSE chr1 END, CASE WHEN sv_type = 'tra' AND n % 2 = 0 THEN coord2 ELSE coord1 END + (n % 700),
 CASE WHEN sv_type = 'tra' AND n % 2 = 0 THEN chr1 ELSE chr2 END, CASE WHEN sv_type = 'tra' AND n % 2 = 0 THEN coord1 ELSE coord2 END + (n % 300), sv_type, 's' || (5 * (n % 5) + CASE n % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 3 ELSE 4 END) FROM (""" + _SV_BASE + """) b
"""

# Reference bases under the exons, and coding SNVs on them.
VIEWS["fx_base"] = """
SELECT DISTINCT chrom, start + j AS pos, substr('ACGTTGCA', CAST(1 + ((start + j) * 7 + CAST(floor((start + j) / 8) AS BIGINT)) % 8 AS INT), 1) AS base
FROM (SELECT chrom, start, "end", EACH(0,26) AS j FROM {fx_exon}) e WHERE start + j <= "end"
"""

VIEWS["fx_csnv"] = """
SELECT chrom, pos, base AS ref, translate(base, 'ACGT', 'CTAG') AS alt FROM {fx_base} WHERE (pos * 13) % 7 < 3
"""

# Predictor rows: a canonical and a second transcript per variant.
VIEWS["fx_vep"] = """
SELECT *, concat_ws(chr(9), uploaded, location, allele, gene, transcript, 'Transcript', csq, '1', '2', '77', aa, 'cgA/cTa', existing, extra) AS line
FROM (SELECT *, CASE kind WHEN 'SNV' THEN chrom || '_' || pos || '_A/' || alt WHEN 'DEL' THEN chrom || '_' || pos || '_ACG/-' ELSE chrom || '_' || pos || '_A/A' || alt || 'T' END AS uploaded,
  CASE kind WHEN 'DEL' THEN chrom || ':' || pos || '-' || (pos + 2) ELSE chrom || ':' || pos END AS location,
  CASE kind WHEN 'SNV' THEN alt WHEN 'DEL' THEN '-' ELSE 'A' || alt || 'T' END AS allele,
  CASE kind WHEN 'SNV' THEN alt WHEN 'DEL' THEN '-ACG' ELSE '+' || alt || 'T' END AS want_base,
  CASE n % 3 WHEN 0 THEN 'R/Q' WHEN 1 THEN 'W/*' ELSE 'L' END AS aa, CASE WHEN n % 4 = 0 THEN '-' ELSE 'rs' || n END AS existing,
  'IMPACT=LOW;' || CASE WHEN k = 0 THEN 'CANONICAL=YES;SYMBOL=S' || (n % 90) || ';' || CASE WHEN n % 5 < 2 THEN 'EXON=' || (1 + n % 7) || '/9;' WHEN n % 5 = 2 THEN 'INTRON=2/8;' ELSE '' END ELSE 'EXON=9/9;' END
   || CASE WHEN n % 2 = 0 THEN 'PolyPhen=benign(0.' || (n % 10) || ');SIFT=tolerated_low(0.0' || (n % 7) || ');' ELSE '' END || 'AF=0.0' || (n % 30) || CASE WHEN n % 7 = 0 THEN ';CADD_PHRED=2' || (n % 9) ELSE '' END
   || CASE WHEN n % 6 = 0 THEN ';gnomAD_AF=0.00' || (n % 10) || ';CLIN_SIG=benign' ELSE '' END AS extra
 FROM (SELECT o_orderkey AS n, k, CAST(1 + o_custkey % 22 AS STRING) AS chrom, CAST(1000 + o_orderkey * 40 AS BIGINT) AS pos, substr('CGT', CAST(1 + o_custkey % 3 AS INT), 1) AS alt,
   CASE o_orderpriority WHEN '1-URGENT' THEN 'DEL' WHEN '2-HIGH' THEN 'INS' ELSE 'SNV' END AS kind, 'ENSG' || (o_custkey % 300) AS gene, 'ENST' || o_orderkey || k AS transcript,
   CASE WHEN o_custkey % 2 = 0 THEN 'missense_variant' ELSE 'stop_gained' END AS csq FROM (SELECT o_orderkey, o_custkey, o_orderpriority, EACH(0,1) AS k FROM {orders}) a) b) c
"""

# Report rows of one run, one per order.
VIEWS["fx_report"] = """
SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(1 + o_custkey % 22 AS STRING) AS chrom, CAST(1000 + o_orderkey * 40 AS BIGINT) AS start, CAST(1000 + o_orderkey * 40 AS BIGINT) AS "end",
 CASE o_orderpriority WHEN '1-URGENT' THEN 'DEL' WHEN '2-HIGH' THEN 'INS' ELSE 'SNV' END AS var_type, substr('ACGT', CAST(1 + o_orderkey % 4 AS INT), 1) AS ref, substr('CGTA', CAST(1 + o_orderkey % 4 AS INT), 1) AS alt,
 CASE o_orderkey % 5 WHEN 0 THEN 'PASS' WHEN 1 THEN 'N/A' ELSE 'FAIL' END AS filter_dbsnp,
 CASE WHEN o_orderkey % 5 < 2 OR o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 100 AS DOUBLE) / 100 END AS var_freq,
 CASE WHEN o_orderkey % 5 < 2 OR o_orderkey % 11 = 0 THEN NULL ELSE CAST(99 - o_custkey % 100 AS DOUBLE) / 100 END AS ref_freq,
 CAST(o_custkey % 40 AS INT) AS depth, CAST(o_orderkey % 45 AS INT) AS quality, 'G' || (o_custkey % 700) AS gene,
 CASE o_custkey % 6 WHEN 0 THEN 'SYN' WHEN 1 THEN 'NONSENSE' WHEN 2 THEN 'SPLICE (2)' WHEN 3 THEN 'SPLICE (7)' ELSE 'MISSENSE' END AS exon_type,
 CASE WHEN o_custkey % 8 = 0 THEN 'PREVIOUSLY_SEEN' ELSE 'NOT_SEEN' END AS filter_common, CASE WHEN o_custkey % 9 = 0 THEN 'FAIL' WHEN o_custkey % 9 = 1 THEN 'N/A' ELSE 'PASS' END AS filter_exac,
 CASE o_orderkey % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN 'No_freq' WHEN 2 THEN '0.00' || (1 + o_custkey % 9) ELSE '0.0' || (1 + o_custkey % 9) END AS freq_text,
 CASE WHEN o_custkey % 3 = 0 THEN 'N/A' ELSE 'A->G:0.0' || (o_custkey % 5) || ':99' END AS exac, CASE WHEN o_orderkey % 7 = 0 THEN 'N/A' ELSE '0.0' || (o_orderkey % 9) END AS sift_score,
 CASE WHEN o_orderkey % 13 = 0 THEN 'N/A' ELSE '0.' || (o_orderkey % 10) END AS polyphen_score, CASE WHEN o_orderkey % 6 = 0 THEN 'N/A' ELSE CAST(o_custkey % 30 AS STRING) END AS cadd_phred,
 CASE o_custkey % 4 WHEN 0 THEN 'NO_GO' WHEN 1 THEN 'immune response' ELSE 'cell cycle' END AS go, CASE o_custkey % 5 WHEN 0 THEN 'NO_PHENOTYPE' WHEN 1 THEN 'colitis in adults' ELSE 'short stature' END AS phenotype,
 's' || (o_custkey % 25) || ',s' || (o_orderkey % 25) AS samples, 's2' AS proband, CASE WHEN o_orderkey % 4 = 3 THEN 'FAIL REASONS: x' ELSE 'OVERALL_PASS' END AS given_status,
 CAST(o_custkey % 5 AS BIGINT) AS affected_carriers, CAST(o_orderkey % 3 AS BIGINT) AS unaffected_carriers FROM {orders}
"""

# Views whose rows are text lines or base strings, costly to parse.
