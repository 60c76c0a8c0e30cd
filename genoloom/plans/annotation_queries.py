"""ANN-* and SRC-5."""

from __future__ import annotations

from genoloom.functions import sequence as sq
from genoloom.operators import annotate as an
from genoloom.plans.registry import query
from genoloom.sources import readers as rd

@query("ann_1", """
SELECT s.chrom, s.start, s."end", s.sample, s.alt, coalesce(m.t, 'N/A') AS attribute, CASE WHEN m.t IS NULL THEN 0 ELSE 1 END AS filtermatch, CASE WHEN m.t IS NULL THEN 1 ELSE 0 END AS filterpass
FROM fx_point s LEFT JOIN (SELECT p.chrom, p.start, string_agg(DISTINCT g.gene, '^^^' ORDER BY g.gene) AS t FROM (SELECT DISTINCT chrom, start FROM fx_point) p JOIN fx_gene g
 ON g.chrom = p.chrom AND g.start <= p.start AND g."end" >= p.start GROUP BY p.chrom, p.start) m ON s.chrom = m.chrom AND s.start = m.start""")
def ann_1(t):
    calls = t.fx_point.select("chrom", "start", "end", "sample", "alt")
    return an.annotate_and_flag(calls, t.fx_gene.select("chrom", "start", "end", "gene"), "gene", match_passes=False)


# Catalogue entries at call sites, some without frequencies.
ENTRIES = """
SELECT chrom, pos, ref, alt, 'rs' || (pos + depth) AS rs, CASE WHEN depth % 3 = 0 THEN NULL ELSE CAST(depth AS DOUBLE) / 100 END AS ref_freq,
 CASE WHEN depth % 3 = 0 THEN NULL ELSE CAST(qual AS DOUBLE) / 100 END AS alt_freq FROM {fx_call} WHERE qual >= 40"""


@query("ann_2", f"""
WITH e AS ({ENTRIES.replace('{', '').replace('}', '')}),
 b AS (SELECT *, row_number() OVER (PARTITION BY chrom, pos, ref, alt ORDER BY ref_freq DESC, rs DESC, alt_freq DESC) AS rn FROM e WHERE ref_freq IS NOT NULL),
 n AS (SELECT chrom, pos, max(CASE WHEN ref_freq IS NULL THEN rs END) AS rs FROM e GROUP BY chrom, pos)
SELECT c.chrom, c.pos, c.ref, c.alt, c.sample, CASE WHEN b.rs IS NOT NULL THEN 'rs=' || b.rs || ';ref_allele_freq=' || CAST(b.ref_freq AS VARCHAR) || ';var_allele_freq=' || CAST(b.alt_freq AS VARCHAR)
 WHEN n.rs IS NOT NULL THEN 'rs=' || n.rs ELSE 'novel' END AS attribute, CASE WHEN n.chrom IS NULL THEN 0 ELSE 1 END AS filtermatch
FROM (SELECT chrom, pos, ref, alt, sample FROM fx_call WHERE qual < 40) c LEFT JOIN b ON b.chrom = c.chrom AND b.pos = c.pos AND b.ref = c.ref AND b.alt = c.alt AND b.rn = 1
LEFT JOIN n ON n.chrom = c.chrom AND n.pos = c.pos""")
def ann_2(t):
    calls = t.fx_call.where("qual < 40").select("chrom", "pos", "ref", "alt", "sample")
    return an.annotate_dbsnp_snv(calls, t.sql(ENTRIES))


INDELS = """
SELECT chrom, start, "end", var_type, substr(bases, 2) AS bases, 'rs' || id AS rs, CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(depth AS DOUBLE) / 100 END AS ref_freq,
 CASE WHEN id % 3 = 0 THEN NULL ELSE CAST(qual AS DOUBLE) / 100 END AS alt_freq FROM {fx_variant} WHERE var_type <> 'SNV' AND filter = 'PASS'"""


@query("ann_3", f"""
WITH e AS ({INDELS.replace('{', '').replace('}', '')}), b AS (SELECT *, row_number() OVER (PARTITION BY chrom, start, "end", var_type, bases ORDER BY ref_freq DESC, rs DESC, alt_freq DESC) AS rn FROM e WHERE ref_freq IS NOT NULL),
 n AS (SELECT chrom, start, "end", var_type, max(rs) AS rs FROM e GROUP BY 1, 2, 3, 4), c AS (SELECT id, chrom, start, "end", var_type, substr(bases, 2) AS bases FROM fx_variant WHERE var_type <> 'SNV')
SELECT c.*, CASE WHEN b.rs IS NOT NULL THEN 'rs=' || b.rs || ';ref_allele_freq=' || CAST(b.ref_freq AS VARCHAR) || ';var_allele_freq=' || CAST(b.alt_freq AS VARCHAR) WHEN n.rs IS NOT NULL THEN 'rs=' || n.rs ELSE 'novel' END AS attribute,
 CASE WHEN n.rs IS NULL THEN 0 ELSE 1 END AS filtermatch FROM c LEFT JOIN b ON b.chrom = c.chrom AND b.start = c.start AND b."end" = c."end" AND b.var_type = c.var_type AND b.bases = c.bases AND b.rn = 1
LEFT JOIN n ON n.chrom = c.chrom AND n.start = c.start AND n."end" = c."end" AND n.var_type = c.var_type""")
def ann_3(t):
    calls = t.fx_variant.where("var_type <> 'SNV'").selectExpr(
        "id", "chrom", "start", "`end`", "var_type", "substr(bases, 2) AS bases")
    return an.annotate_dbsnp_indel(calls, t.sql(INDELS))


@query("ann_4", """
WITH e AS (SELECT chrom, start, "end", CASE WHEN bases LIKE '+%' THEN 'INS' ELSE 'DEL' END AS var_type, max(bases || ':0.' || depth) AS x FROM fx_variant WHERE var_type <> 'SNV' AND filter = 'PASS' GROUP BY 1, 2, 3, 4)
SELECT v.id, v.chrom, v.start, v."end", v.var_type, 'exac=' || e.x AS attribute, CASE WHEN e.x IS NULL THEN 0 ELSE 1 END AS filtermatch
FROM (SELECT * FROM fx_variant WHERE var_type <> 'SNV') v LEFT JOIN e ON e.chrom = v.chrom AND e.start = v.start AND e."end" = v."end" AND e.var_type = v.var_type""")
def ann_4(t):
    v = t.fx_variant.where("var_type <> 'SNV'")
    entries = v.where("filter = 'PASS'").selectExpr("chrom", "start", "`end`", "start || ':' || bases || ':0.' || depth AS entry")
    return an.attach_attribute(v.select("id", "chrom", "start", "end", "var_type"), entries, "exac", by_type=True)


@query("ann_5", """
SELECT v.id, v.chrom, v.start, v."end", o.s AS seen_in, CASE WHEN o.s IS NULL THEN 1 ELSE 0 END AS filterpass FROM (SELECT * FROM fx_variant WHERE sample IN ('s1', 's2')) v
LEFT JOIN (SELECT chrom, start, "end", string_agg(DISTINCT sample, ',' ORDER BY sample) AS s FROM fx_variant WHERE sample NOT IN ('s1', 's2') GROUP BY 1, 2, 3) o
 ON o.chrom = v.chrom AND o.start = v.start AND o."end" = v."end\"""")
def ann_5(t):
    v = t.fx_variant
    return an.seen_before(v.where("sample IN ('s1', 's2')").select("id", "chrom", "start", "end"), v, ["s1", "s2"])


@query("ann_6", """
WITH s AS (SELECT chrom, start - d AS pos, d, replace(exon, '_exon', '_exon') || '_splice1_' || d AS nm FROM (SELECT *, unnest(range(1, 11)) AS d FROM fx_exon) a
 UNION ALL SELECT chrom, "end" + d, d, exon || '_splice2_' || d FROM (SELECT *, unnest(range(1, 11)) AS d FROM fx_exon) a), b AS (SELECT chrom, pos, d, nm, row_number() OVER (PARTITION BY chrom, pos ORDER BY nm DESC, d DESC) AS rn FROM s)
SELECT c.chrom, c.pos, b.d AS splice_distance FROM (SELECT DISTINCT chrom, pos FROM fx_call) c LEFT JOIN b ON b.chrom = c.chrom AND b.pos = c.pos AND b.rn = 1""")
def ann_6(t):
    return an.splice_distance(t.fx_call.select("chrom", "pos").distinct(), an.splice_sites(t.fx_exon))


@query("ann_7", 'SELECT DISTINCT chrom, unnest(range(start, "end" + 1)) AS pos FROM fx_exon')
def ann_7(t):
    return an.exon_bases(t.fx_exon)


CODING = """
SELECT x.*, sum("end" - start + 1) OVER (PARTITION BY gene ORDER BY CASE WHEN strand = '-' THEN -start ELSE start END ROWS UNBOUNDED PRECEDING) - ("end" - start + 1) AS off,
 sum("end" - start + 1) OVER (PARTITION BY gene) AS cds FROM fx_exon x"""
PLACED = f"""
SELECT b.chrom, b.pos, c.gene, c.strand, CAST((off + CASE WHEN strand = '-' THEN c."end" - b.pos ELSE b.pos - c.start END) // 3 + 1 AS BIGINT) AS aa_pos, CAST(cds // 3 - 1 AS BIGINT) AS aa_len, b.base
FROM fx_base b JOIN ({CODING}) c ON b.chrom = c.chrom AND b.pos BETWEEN c.start AND c."end\""""


@query("ann_8", f"WITH p AS ({PLACED}) SELECT v.chrom, v.pos, v.ref, v.alt, p.gene, p.strand, p.aa_pos, p.aa_len FROM fx_csnv v JOIN p ON v.chrom = p.chrom AND v.pos = p.pos")
def ann_8(t):
    return an.residue_position(t.fx_csnv, t.fx_exon)


@query("ann_9", """
SELECT chrom, pos AS start, CASE kind WHEN 'DEL' THEN pos + 2 ELSE pos END AS "end", kind AS var_type, want_base AS var_base, gene, transcript AS feature, csq AS consequence, split_part(aa, '/', 1) AS aa_ref,
 replace(split_part(aa, '/', 2), '*', 'Stop') AS aa_var, '77' AS aa_pos, CASE WHEN n % 2 = 0 THEN 'benign' ELSE 'N/A' END AS polyphen_pred, CASE WHEN n % 2 = 0 THEN '0.' || (n % 10) ELSE 'N/A' END AS polyphen_score,
 CASE WHEN n % 2 = 0 THEN 'tolerated_low' ELSE 'N/A' END AS sift_pred, CASE WHEN n % 2 = 0 THEN '0.0' || (n % 7) ELSE 'N/A' END AS sift_score, CASE WHEN n % 7 = 0 THEN '2' || (n % 9) ELSE 'N/A' END AS cadd_phred
FROM fx_vep WHERE k = 0 AND n % 3 <> 2""")
def ann_9(t):
    return an.coding_consequences(rd.parse_consequences(t.fx_vep.select("line")))


# The canonical row wins with an exon; the other transcript never counts an exon, so among rows
# without a place the larger row is kept.
@query("ann_10", """
WITH r AS (SELECT *, CASE WHEN k = 0 AND n % 5 < 2 THEN 'EXON->' || (1 + n % 7) || '/9' WHEN k = 0 AND n % 5 = 2 THEN 'INTRON->2/8' ELSE 'N/A' END AS ex, CASE WHEN existing = '-' THEN 'N/A' ELSE existing END AS rs,
  CASE WHEN k = 0 THEN 'S' || (n % 90) ELSE 'N/A' END AS sym FROM fx_vep), w AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY CASE WHEN ex LIKE 'EXON%' THEN 1 WHEN ex LIKE 'INTRON%' THEN 2 ELSE 3 END, transcript DESC) AS rn FROM r)
SELECT chrom, pos AS start, CASE kind WHEN 'DEL' THEN pos + 2 ELSE pos END AS "end", want_base AS var_base, kind AS var_type, csq AS consequence, rs, '0.0' || (n % 30) AS gmaf, 'N/A' AS domain, 'N/A' AS pubmed,
 CASE WHEN n % 6 = 0 THEN 'benign' ELSE 'N/A' END AS clinical, ex AS exon, gene, transcript AS feature, CASE WHEN n % 7 = 0 THEN '2' || (n % 9) ELSE 'N/A' END AS cadd_phred, CASE WHEN n % 6 = 0 THEN '0.00' || (n % 10) ELSE 'N/A' END AS gnomad, sym AS symbol
FROM w WHERE rn = 1""")
def ann_10(t):
    return an.all_consequences(rd.parse_consequences(t.fx_vep.select("line")))


@query("src_5", """
SELECT uploaded, chrom, pos AS start, CASE kind WHEN 'DEL' THEN pos + 2 ELSE pos END AS "end", allele, gene, transcript AS feature, csq AS consequence, '77' AS protein_pos, aa AS amino_acids, existing, extra FROM fx_vep""")
def src_5(t):
    return rd.parse_consequences(t.fx_vep.select("line")).select(
        "uploaded", "chrom", "start", "end", "allele", "gene", "feature", "consequence", "protein_pos", "amino_acids", "existing", "extra")


@query("ann_11", f"""
WITH p AS ({PLACED}), v AS (SELECT v.*, p.gene, p.aa_pos FROM fx_csnv v JOIN p ON v.chrom = p.chrom AND v.pos = p.pos),
 g AS (SELECT chrom, gene, aa_pos, min(pos) AS s, max(pos) AS e, count(*) AS n, string_agg(ref, '' ORDER BY pos) AS r, string_agg(alt, '' ORDER BY pos) AS a FROM v GROUP BY 1, 2, 3 HAVING count(*) > 1),
 t AS (SELECT g.*, CASE WHEN n = 2 AND e - s = 2 THEN r[1] || b.base || r[2] || '/' || a[1] || b.base || a[2] ELSE r || '/' || a END AS change FROM g LEFT JOIN fx_base b ON b.chrom = g.chrom AND b.pos = g.s + 1)
SELECT v.chrom, v.gene, v.aa_pos, t.s AS start, t.e AS "end", t.change, v.pos, v.ref, v.alt FROM v JOIN t ON v.chrom = t.chrom AND v.gene = t.gene AND v.aa_pos = t.aa_pos""")
def ann_11(t):
    placed = an.residue_position(t.fx_csnv, t.fx_exon)
    return an.codon_groups(placed, t.fx_base)


SCORES = """
SELECT chrom, CASE WHEN var_type = 'SNV' THEN start WHEN var_type = 'DEL' THEN start - 1 ELSE start END AS pos, CASE var_type WHEN 'SNV' THEN substr(bases, 1, 1) WHEN 'DEL' THEN 'A' || substr(bases, 2) ELSE 'A' END AS ref,
 CASE var_type WHEN 'SNV' THEN substr(bases, 4, 1) WHEN 'DEL' THEN 'A' ELSE 'A' || substr(bases, 2) END AS alt, CAST(depth AS DOUBLE) AS raw, CAST(qual AS DOUBLE) AS phred FROM {fx_variant} WHERE filter = 'PASS'"""


@query("ann_12", """
WITH s AS (SELECT chrom, start, "end", bases, max(struct_pack(p := CAST(qual AS DOUBLE), r := CAST(depth AS DOUBLE))) AS v FROM fx_variant WHERE filter = 'PASS' AND var_type <> 'INS' GROUP BY 1, 2, 3, 4)
SELECT c.id, c.chrom, c.start, c."end", CASE WHEN c.var_type = 'SNV' THEN substr(c.bases, 4, 1) ELSE '-' END AS allele, v.r AS cadd_raw, v.p AS cadd_phred FROM fx_variant c LEFT JOIN (SELECT chrom, start, "end", CASE WHEN bases LIKE '-%' THEN '-' ELSE substr(bases, 4, 1) END AS allele, max(v) AS v
 FROM s GROUP BY 1, 2, 3, 4) q ON q.chrom = c.chrom AND q.start = c.start AND q."end" = c."end" AND q.allele = CASE WHEN c.var_type = 'SNV' THEN substr(c.bases, 4, 1) ELSE '-' END WHERE c.var_type <> 'INS'""")
def ann_12(t):
    calls = t.fx_variant.where("var_type <> 'INS'").selectExpr(
        "id", "chrom", "start", "`end`", "CASE WHEN var_type = 'SNV' THEN substr(bases, 4, 1) ELSE '-' END AS allele")
    return an.lookup_score(calls, t.sql(SCORES))


@query("ann_13", """
SELECT id, CASE WHEN id % 5 = 0 THEN 'N/A' WHEN id % 3 = 0 THEN 'melanoma:SNV^^^Malignant Melanoma^^^' || id ELSE 'OTHERCANCER:SNV^^^lung^^^' || id END AS cosmic_coord FROM fx_variant""")
def ann_13(t):
    text = "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 3 = 0 THEN 'SNV^^^Malignant Melanoma^^^' || id ELSE 'SNV^^^lung^^^' || id END AS text"
    return an.cancer_label(t.fx_variant.selectExpr("id", text), "text").select("id", "cosmic_coord")


@query("ann_14", """
SELECT chrom, pos AS start, want_base AS var_base, concat_ws(';', CASE WHEN existing <> '-' THEN 'rs=' || existing END, 'gmaf=0.0' || (n % 30), CASE WHEN n % 6 = 0 THEN 'clinsig=benign' END,
 CASE WHEN n % 5 < 2 THEN 'exon=EXON->' || (1 + n % 7) || '/9' WHEN n % 5 = 2 THEN 'exon=INTRON->2/8' END) AS attribute FROM fx_vep WHERE k = 0""")
def ann_14(t):
    picked = an.all_consequences(rd.parse_consequences(t.fx_vep.select("line")))
    return an.consequence_attribute(picked).select("chrom", "start", "var_base", "attribute")


@query("ann_15", """
WITH s AS (SELECT chrom, pos, ref || '->' || alt AS ch, max(CASE WHEN depth % 2 = 0 THEN 'benign' ELSE 'damaging' END || ',0.' || depth) AS p FROM fx_call WHERE qual >= 40 GROUP BY 1, 2, 3)
SELECT c.chrom, c.pos, c.ref, c.alt, c.sample, s.p AS polyphen, d.depth AS polyphen_note FROM (SELECT chrom, pos, ref, alt, sample FROM fx_call WHERE qual < 40) c LEFT JOIN s ON s.chrom = c.chrom AND s.pos = c.pos AND s.ch = c.ref || '->' || c.alt
LEFT JOIN fx_depth d ON d.chrom = c.chrom AND d.pos = c.pos""")
def ann_15(t):
    scores = t.fx_call.where("qual >= 40").selectExpr(
        "chrom", "pos", "ref || '->' || alt AS change", "CASE WHEN depth % 2 = 0 THEN 'benign' ELSE 'damaging' END AS prediction", "'0.' || depth AS score")
    calls = t.fx_call.where("qual < 40").select("chrom", "pos", "ref", "alt", "sample")
    return an.attach_polyphen(calls, scores, t.fx_depth.withColumnRenamed("depth", "note"))


TYPES = """
SELECT id, CASE id % 4 WHEN 0 THEN 'aa_change=R->Q' WHEN 1 THEN 'aa_change=W->Stop' END AS aa_attribute, CASE WHEN qual % 3 = 0 THEN 1 + qual % 10 END AS splice_distance,
 CASE WHEN depth % 4 = 0 THEN 'INTRON->2/8' WHEN depth % 4 = 1 THEN 'EXON->1/8' END AS exon, CASE WHEN depth % 5 <> 0 THEN 'G1' END AS gene FROM {fx_variant}"""


@query("ann_16", f"""
WITH t AS ({TYPES.replace('{', '').replace('}', '')}) SELECT id, CASE WHEN aa_attribute LIKE '%Stop%' THEN 'NONSENSE' WHEN aa_attribute IS NOT NULL THEN 'MISSENSE' WHEN splice_distance IS NOT NULL THEN 'SPLICE (' || splice_distance || ')'
 WHEN exon LIKE '%INTRON%' OR gene IS NULL THEN 'N/A' ELSE 'SYN' END AS exon_type FROM t""")
def ann_16(t):
    return an.exon_type(t.sql(TYPES)).select("id", "exon_type")


RESIDUES = f"""
WITH p AS ({PLACED}), c AS (SELECT chrom, gene, aa_pos, string_agg(base, '' ORDER BY pos) AS codon, min(strand) AS strand, min(aa_len) AS aa_len FROM p GROUP BY 1, 2, 3)
SELECT p.chrom, p.pos, p.gene, c.strand, p.aa_pos AS aa_number, c.codon, p.base AS ref_base, CAST(row_number() OVER (PARTITION BY p.gene, p.aa_pos ORDER BY p.pos) - 1 AS INT) AS place
FROM p JOIN c ON p.gene = c.gene AND p.aa_pos = c.aa_pos WHERE p.aa_pos <= p.aa_len"""


@query("ann_17", RESIDUES)
def ann_17(t):
    return an.residue_table(t.fx_exon, t.fx_base)


CODE = "substr('" + sq.CODON_AMINO + "', CAST(16 * (strpos('TCAG', substr({c}, 1, 1)) - 1) + 4 * (strpos('TCAG', substr({c}, 2, 1)) - 1) + strpos('TCAG', substr({c}, 3, 1)) AS INT), 1)"


@query("ann_18", f"""
WITH r AS (SELECT * FROM ({RESIDUES}) q), j AS (SELECT v.*, r.gene, r.aa_number, r.strand, r.codon AS c0, substr(r.codon, 1, r.place) || v.alt || substr(r.codon, r.place + 2) AS c1 FROM fx_csnv v JOIN r ON v.chrom = r.chrom AND v.pos = r.pos AND v.ref = r.ref_base),
 o AS (SELECT *, CASE WHEN strand = '-' THEN reverse(translate(c0, 'ACGT', 'TGCA')) ELSE c0 END AS d0, CASE WHEN strand = '-' THEN reverse(translate(c1, 'ACGT', 'TGCA')) ELSE c1 END AS d1 FROM j),
 a AS (SELECT *, {CODE.format(c='d0')} AS aa_ref, {CODE.format(c='d1')} AS aa_new FROM o)
SELECT chrom, pos, ref, alt, gene, aa_number, aa_ref, aa_new FROM a WHERE aa_new <> '_' AND aa_new <> aa_ref""")
def ann_18(t):
    return an.recompute_residue(t.fx_csnv, an.called_residues(t.fx_csnv, t.fx_exon, t.fx_base))
