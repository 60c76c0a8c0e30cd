"""PED-* and FLT-14."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoloom.operators import filters as fl
from genoloom.operators import pedigree as pd
from genoloom.plans.registry import query
from genoloom.session import settle

ROLES = """
SELECT family, CAST(sum(affected) AS BIGINT) AS aff_total, CAST(sum(1 - affected) AS BIGINT) AS unaff_total,
 max(CASE WHEN relation = 'mother' THEN 1 ELSE 0 END) AS has_mother, max(CASE WHEN relation = 'father' THEN 1 ELSE 0 END) AS has_father,
 max(CASE WHEN relation = 'proband' THEN 1 ELSE 0 END) AS has_proband, min(CASE WHEN relation = 'proband' THEN sample END) AS proband FROM fx_member GROUP BY family"""

TRIO = f"""
SELECT g.family, g.chrom, g.pos, r.has_mother AS hm, r.has_father AS hf, max(CASE WHEN relation = 'mother' THEN zyg END) AS m,
 max(CASE WHEN relation = 'father' THEN zyg END) AS f, max(CASE WHEN relation = 'proband' THEN zyg END) AS c,
 bool_or(zyg = 'No data') AS gap FROM fx_fam g JOIN ({ROLES}) r ON g.family = r.family GROUP BY 1, 2, 3, 4, 5"""

MENDEL = f"""
WITH t AS ({TRIO}) SELECT family, chrom, pos, CASE WHEN hm = 1 AND hf = 1 THEN
  CASE WHEN gap THEN 'missing allele info' WHEN c || m = 'refhom' THEN 'hom_mother ref_child' WHEN c || f = 'refhom' THEN 'hom_father ref_child'
   WHEN c || m || f = 'hetrefref' THEN 'de novo (ref_parents het_child)' WHEN c || m || f = 'hethomhom' THEN 'hom_parents het_child'
   WHEN c || m = 'homref' THEN 'ref_mother hom_child' WHEN c || f = 'homref' THEN 'ref_father hom_child' ELSE 'mendelian_rules_followed' END
 WHEN hm + hf = 1 THEN CASE WHEN coalesce(m, f) = 'No data' THEN 'missing allele info' WHEN c || coalesce(m, f) = 'refhom' THEN 'hom_parent ref_child'
   WHEN c || coalesce(m, f) = 'homref' THEN 'ref_parent hom_child' ELSE 'mendelian_rules_followed' END ELSE 'No Parental info' END AS mendel FROM t"""


def roles(t):
    return pd.family_roles(t.fx_member)


@query("ped_1", ROLES)
def ped_1(t):
    return roles(t)


# Allele text as a pileup would give it; a het without a second allele is unknown.
ALLELES = """
SELECT *, CASE zyg WHEN 'hom' THEN 'G:20' WHEN 'ref' THEN 'ref:18' WHEN 'het' THEN CASE pos % 4 WHEN 0 THEN 'G:12_ref:3' WHEN 1 THEN 'ref:9_T:8'
 WHEN 2 THEN 'A:7_C:6_ref:1' ELSE 'G:5' END ELSE 'No data' END AS alleles FROM {fx_fam}"""


@query("ped_2", """
SELECT family, sample, chrom, pos, zyg, CASE zyg WHEN 'ref' THEN 'ref' WHEN 'hom' THEN 'G' WHEN 'het' THEN CASE pos % 4 WHEN 0 THEN 'ref' WHEN 1 THEN 'ref' WHEN 2 THEN 'A' ELSE '?' END ELSE '?' END AS first_allele,
 CASE zyg WHEN 'ref' THEN 'ref' WHEN 'hom' THEN 'G' WHEN 'het' THEN CASE pos % 4 WHEN 0 THEN 'G' WHEN 1 THEN 'T' WHEN 2 THEN 'C' ELSE '?' END ELSE '?' END AS second_allele FROM fx_fam""")
def ped_2(t):
    return pd.member_alleles(t.sql(ALLELES)).select("family", "sample", "chrom", "pos", "zyg", "first_allele", "second_allele")


@query("ped_3", MENDEL + " WHERE hm = 1 AND hf = 1")
def ped_3(t):
    two = roles(t).where("has_mother + has_father = 2")
    return pd.mendel(t.fx_fam, two)


@query("ped_4", MENDEL + " WHERE hm + hf < 2")
def ped_4(t):
    return pd.mendel(t.fx_fam, roles(t).where("has_mother + has_father < 2"))


INHERIT = f"""
WITH g AS (SELECT * FROM fx_fam WHERE zyg IN ('het', 'hom')),
 l AS (SELECT DISTINCT f.family, f.chrom, f.pos, r.aff_total, r.has_mother + r.has_father AS np FROM fx_fam f JOIN ({ROLES}) r ON f.family = r.family),
 s AS (SELECT l.family, l.chrom, l.pos, l.aff_total, l.np, count(CASE WHEN g.affected = 1 THEN 1 END) AS aff,
  coalesce(bool_and(CASE WHEN g.affected = 1 THEN g.zyg = 'hom' ELSE g.zyg <> 'hom' END), true) AS rec,
  coalesce(bool_and(g.affected = 1 AND g.zyg = 'het'), true) AS dom,
  coalesce(bool_or(relation = 'mother'), false) AS mv, coalesce(bool_or(relation = 'father'), false) AS fv,
  coalesce(bool_or(relation = 'mother' AND g.affected = 1), false) AS ma, coalesce(bool_or(relation = 'father' AND g.affected = 1), false) AS fa
  FROM l LEFT JOIN g ON g.family = l.family AND g.chrom = l.chrom AND g.pos = l.pos GROUP BY 1, 2, 3, 4, 5)
SELECT family, chrom, pos, CASE WHEN aff = aff_total AND rec THEN
  CASE WHEN np = 0 OR (np = 1 AND (mv OR fv)) OR (mv AND fv) THEN CASE WHEN chrom = 'X' THEN 'X' ELSE 'auto' END || '-recessive' ELSE 'none' END
 WHEN aff = aff_total AND dom THEN CASE WHEN np = 0 OR (NOT mv AND NOT fv) OR (mv AND fv AND ma AND fa) OR (mv AND NOT fv AND ma) OR (fv AND NOT mv AND fa)
  THEN CASE WHEN chrom = 'X' THEN 'X' ELSE 'auto' END || '-dominant' ELSE 'none' END ELSE 'none' END AS disease_inheritance FROM s"""


@query("ped_5", INHERIT)
def ped_5(t):
    return pd.disease_inheritance(t.fx_fam, roles(t))


# Rule tables of parental origin, written out: mother, father, child -> allele from each.
TWO = [("ref", "ref", "ref", "ref", "ref"), ("het", "ref", "ref", "ref", "ref"), ("ref", "het", "ref", "ref", "ref"),
       ("het", "het", "ref", "ref", "ref"), ("hom", "het", "hom", "var", "var"), ("het", "hom", "hom", "var", "var"),
       ("hom", "hom", "hom", "var", "var"), ("het", "het", "hom", "var", "var"), ("ref", "het", "het", "ref", "var"),
       ("ref", "hom", "het", "ref", "var"), ("het", "hom", "het", "ref", "var"), ("het", "ref", "het", "var", "ref"),
       ("hom", "ref", "het", "var", "ref"), ("hom", "het", "het", "var", "ref")]
ONE = [("ref", "ref", "ref"), ("het", "ref", "ref"), ("ref", "het", "ref"), ("het", "hom", "var"), ("hom", "het", "var"), ("hom", "hom", "var")]


def values(rows):
    return "(VALUES " + ", ".join("(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows) + ")"


CHILD = f"""
SELECT c.family, c.sample, c.affected, c.chrom, c.pos, c.gene, c.rare, c.zyg, p.hm, p.hf, p.m, p.f FROM fx_fam c JOIN ({TRIO}) p
 ON c.family = p.family AND c.chrom = p.chrom AND c.pos = p.pos WHERE c.relation NOT IN ('mother', 'father')"""
ORIGIN = f"""
SELECT c.*, CASE WHEN hm = 1 AND hf = 1 THEN coalesce(w.ma, '?') WHEN hm = 1 THEN coalesce(om.a, '?') ELSE '?' END AS mother_allele,
 CASE WHEN hm = 1 AND hf = 1 THEN coalesce(w.fa, '?') WHEN hf = 1 THEN coalesce(of_.a, '?') ELSE '?' END AS father_allele
FROM ({CHILD}) c LEFT JOIN {values(TWO)} w(m, f, z, ma, fa) ON c.m = w.m AND c.f = w.f AND c.zyg = w.z
LEFT JOIN {values(ONE)} om(p, z, a) ON c.m = om.p AND c.zyg = om.z LEFT JOIN {values(ONE)} of_(p, z, a) ON c.f = of_.p AND c.zyg = of_.z"""


@query("ped_6", f"WITH o AS ({ORIGIN}) SELECT family, sample, chrom, pos, zyg, mother_allele, father_allele FROM o WHERE hm = 1 AND hf = 1")
def ped_6(t):
    return pd.parental_origin(t.fx_fam, roles(t)).where("mz IS NOT NULL AND fz IS NOT NULL").select(
        "family", "sample", "chrom", "pos", "zyg", "mother_allele", "father_allele")


@query("ped_7", f"WITH o AS ({ORIGIN}) SELECT family, sample, chrom, pos, zyg, mother_allele, father_allele FROM o WHERE hm + hf = 1")
def ped_7(t):
    return pd.parental_origin(t.fx_fam, roles(t)).where("(mz IS NULL) <> (fz IS NULL)").select(
        "family", "sample", "chrom", "pos", "zyg", "mother_allele", "father_allele")


HET_FROM = [("het", "ref", "mother"), ("hom", "ref", "mother"), ("hom", "het", "mother"), ("ref", "het", "father"),
            ("ref", "hom", "father"), ("het", "hom", "father"), ("het", "het", "either")]
HET = f"""
SELECT o.*, CASE WHEN zyg <> 'het' THEN NULL WHEN hm = 1 AND hf = 1 THEN h.o WHEN hm = 1 THEN CASE o.m WHEN 'hom' THEN 'mother' WHEN 'ref' THEN 'father' WHEN 'het' THEN 'either' END
 WHEN hf = 1 THEN CASE o.f WHEN 'hom' THEN 'father' WHEN 'ref' THEN 'mother' WHEN 'het' THEN 'either' END END AS origin
FROM ({ORIGIN}) o LEFT JOIN {values(HET_FROM)} h(m, f, o) ON o.m = h.m AND o.f = h.f"""

GIVES = f"""
WITH c AS ({HET}), k AS (SELECT *, CASE WHEN hm = 1 AND hf = 1 THEN mother_allele = '?' OR father_allele = '?' WHEN hm = 1 THEN mother_allele = '?' ELSE father_allele = '?' END AS unk FROM c WHERE hm + hf > 0),
 s AS (SELECT family, chrom, pos, bool_or(unk) AS q, bool_or(CASE WHEN affected = 1 THEN hm + hf = 2 AND mother_allele = 'ref' AND father_allele = 'ref'
   ELSE zyg IN ('het', 'hom') AND NOT (hm + hf = 2 AND unk) END) AS n,
  count(DISTINCT CASE WHEN affected = 1 AND origin IN ('mother', 'father') THEN origin END) AS kinds, max(CASE WHEN affected = 1 AND origin IN ('mother', 'father') THEN origin END) AS who FROM k GROUP BY family, chrom, pos)
SELECT family, chrom, pos, CASE WHEN n THEN 'No' WHEN q THEN '?' WHEN kinds = 1 AND who = 'mother' THEN 'Mother gives affected allele'
 WHEN kinds = 1 THEN 'Father gives affected allele' ELSE 'No' END AS parent_allele FROM s"""


@query("ped_8", GIVES)
def ped_8(t):
    return pd.affected_allele_parent(t.fx_fam, roles(t))


@query("ped_9", f"""
WITH g AS ({GIVES}), v AS (SELECT DISTINCT family, chrom, pos, var_type FROM fx_fam), j AS (SELECT g.*, v.var_type FROM g JOIN v ON g.family = v.family AND g.chrom = v.chrom AND g.pos = v.pos),
 k AS (SELECT *, CASE substr(parent_allele, 1, 2) WHEN 'Mo' THEN 'Mother' WHEN 'Fa' THEN 'Father' ELSE 'No' END AS side FROM j WHERE parent_allele <> '?'),
 l AS (SELECT *, lag(side) OVER w AS prev FROM k WINDOW w AS (PARTITION BY family, var_type, chrom ORDER BY pos)),
 r AS (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> side THEN 1 ELSE 0 END) OVER (PARTITION BY family, var_type, chrom ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM l),
 b AS (SELECT family, var_type, chrom, run, side, count(*) AS n, min(pos) AS s, max(pos) AS e FROM r WHERE side <> 'No' GROUP BY 1, 2, 3, 4, 5 HAVING count(*) >= 2 AND max(pos) - min(pos) > 10000),
 m AS (SELECT r.family, r.var_type, r.chrom, r.pos, b.n || ' variants; ' || b.side || '; ' || b.chrom || ':' || b.s || '-' || b.e || '; ' || (b.e - b.s) || 'bp' AS t FROM r JOIN b
  ON r.family = b.family AND r.var_type = b.var_type AND r.chrom = b.chrom AND r.run = b.run)
SELECT j.family, j.var_type, j.chrom, j.pos, j.parent_allele, coalesce(m.t, 'No') AS phase_info FROM j
LEFT JOIN m ON m.family = j.family AND m.var_type = j.var_type AND m.chrom = j.chrom AND m.pos = j.pos""")
def ped_9(t):
    # One row per family and locus, read several times by the scan: written once.
    giving = pd.affected_allele_parent(t.fx_fam, roles(t), ["chrom", "pos", "var_type"])
    return pd.phase_blocks(settle(giving))


BUCKETS = f"SELECT family, gene, sample, affected, chrom, pos, origin, rare FROM ({HET}) h WHERE origin IS NOT NULL"
KEPT = f"""SELECT * FROM ({BUCKETS}) b WHERE NOT EXISTS (SELECT 1 FROM fx_fam x WHERE x.family = b.family AND x.chrom = b.chrom AND x.pos = b.pos
 AND x.relation NOT IN ('mother', 'father') AND ((x.affected = 1 AND x.zyg <> 'het') OR (x.affected = 0 AND x.zyg = 'hom')))"""


@query("ped_10", BUCKETS)
def ped_10(t):
    return pd.het_buckets(t.fx_fam, roles(t)).drop("contradicted")


def kept(t):
    return pd.drop_contradicted(pd.het_buckets(t.fx_fam, roles(t)))


@query("ped_11", KEPT)
def ped_11(t):
    return kept(t)


def compound(where: str) -> str:
    return f"""
WITH b AS (SELECT * FROM ({KEPT}) k {where}), s AS (SELECT family, gene, sample, string_agg(CASE WHEN origin = 'mother' THEN chrom || ':' || pos END, ',' ORDER BY chrom, pos) AS m,
  string_agg(CASE WHEN origin = 'father' THEN chrom || ':' || pos END, ',' ORDER BY chrom, pos) AS f, string_agg(CASE WHEN origin = 'either' THEN chrom || ':' || pos END, ',' ORDER BY chrom, pos) AS e,
  count(CASE WHEN origin = 'either' THEN 1 END) AS ne FROM b GROUP BY family, gene, sample),
 j AS (SELECT b.*, CASE WHEN s.m IS NOT NULL AND s.f IS NOT NULL AND origin IN ('mother', 'father') THEN 'M=' || s.m || ',F=' || s.f END AS d,
  CASE WHEN s.m IS NOT NULL AND s.e IS NOT NULL THEN CASE WHEN origin IN ('mother', 'either') THEN 'M=' || s.m || ',AMB=' || s.e END
   WHEN s.f IS NOT NULL AND s.e IS NOT NULL THEN CASE WHEN origin IN ('father', 'either') THEN 'F=' || s.f || ',AMB=' || s.e END
   WHEN s.ne > 1 THEN CASE WHEN origin = 'either' THEN 'AMB=' || s.e END END AS p
  FROM b JOIN s ON b.family = s.family AND b.gene = s.gene AND b.sample = s.sample),
 g AS (SELECT family, gene, chrom, pos, count(DISTINCT d) AS nd, count(DISTINCT p) AS np, coalesce(bool_or(d IS NOT NULL AND affected = 0), false) AS ud, coalesce(bool_or(p IS NOT NULL AND affected = 0), false) AS up,
  string_agg(DISTINCT CASE WHEN d IS NOT NULL THEN sample END, ',' ORDER BY CASE WHEN d IS NOT NULL THEN sample END) AS ds, string_agg(DISTINCT CASE WHEN p IS NOT NULL THEN sample END, ',' ORDER BY CASE WHEN p IS NOT NULL THEN sample END) AS ps FROM j GROUP BY 1, 2, 3, 4)
SELECT family, gene, chrom, pos, CASE WHEN nd = 0 OR (nd = 1 AND ud) THEN 'No' ELSE ds END AS def_com_het, CASE WHEN np = 0 OR (np = 1 AND up) THEN 'No' ELSE ps END AS pos_com_het FROM g"""


def with_forms(kind: str) -> str:
    """Rows of one compound-het column with the children of each form and its contents."""
    col, text = f"{kind}_com_het", kind[0]
    wanted = {"d": "s.m IS NOT NULL AND s.f IS NOT NULL AND b.origin <> 'either'",
              "p": "s.e IS NOT NULL AND CASE WHEN s.m IS NOT NULL THEN b.origin <> 'father' WHEN s.f IS NOT NULL THEN b.origin <> 'mother' ELSE s.ne > 1 AND b.origin = 'either' END"}[text]
    form = {"d": "'(M=' || s.m || ',F=' || s.f || ')'",
            "p": "'(' || CASE WHEN s.m IS NOT NULL THEN 'M=' || s.m || ',' WHEN s.f IS NOT NULL THEN 'F=' || s.f || ',' ELSE '' END || 'AMB=' || s.e || ')'"}[text]
    def bucket(origin: str) -> str:
        return f"string_agg(chrom || ':' || pos, ',' ORDER BY chrom, pos) FILTER (origin = '{origin}')"
    return f"""
WITH ch AS (SELECT * FROM ({compound('')}) c WHERE {col} <> 'No'), b AS (SELECT * FROM ({KEPT}) k),
 s AS (SELECT family, gene, sample, {bucket('mother')} AS m, {bucket('father')} AS f, {bucket('either')} AS e, count(*) FILTER (origin = 'either') AS ne FROM b GROUP BY 1, 2, 3),
 w AS (SELECT b.family, b.gene, b.chrom, b.pos, {form} AS form, string_agg(b.sample, ',' ORDER BY b.sample) AS who FROM b JOIN s ON b.family = s.family AND b.gene = s.gene AND b.sample = s.sample WHERE {wanted} GROUP BY 1, 2, 3, 4, 5)
SELECT ch.family, ch.gene, ch.chrom, ch.pos, {col}, string_agg(who || form, ',' ORDER BY form) AS {col}_forms FROM ch JOIN w ON ch.family = w.family AND ch.gene = w.gene AND ch.chrom = w.chrom AND ch.pos = w.pos GROUP BY 1, 2, 3, 4, 5"""


def shown_forms(t, col: str):
    hets = pd.compound_hets(kept(t), contents=True)
    return hets.where(F.col(col) != "No").select("family", "gene", "chrom", "pos", col, f"{col}_forms")


@query("ped_12", with_forms("def"))
def ped_12(t):
    return shown_forms(t, "def_com_het")


@query("ped_13", with_forms("pos"))
def ped_13(t):
    return shown_forms(t, "pos_com_het")


APPENDED = f"""
WITH i AS (SELECT * FROM ({INHERIT}) q), c AS (SELECT * FROM ({compound('')}) q), r AS (SELECT * FROM ({compound('WHERE rare = 1')}) q)
SELECT i.family, i.chrom, i.pos, coalesce(c.def_com_het, 'No') AS def_com_het, coalesce(c.pos_com_het, 'No') AS pos_com_het,
 coalesce(r.def_com_het, 'No') AS def_com_rare_het, coalesce(r.pos_com_het, 'No') AS pos_com_rare_het,
 coalesce(nullif(concat_ws(',', nullif(disease_inheritance, 'none'), CASE WHEN c.def_com_het <> 'No' THEN 'def_compound_het' END, CASE WHEN c.pos_com_het <> 'No' THEN 'pos_compound_het' END,
  CASE WHEN r.def_com_het <> 'No' THEN 'def_compound_rare_het' END, CASE WHEN r.pos_com_het <> 'No' THEN 'pos_compound_rare_het' END), ''), 'none') AS disease_inheritance
FROM i LEFT JOIN c ON i.family = c.family AND i.chrom = c.chrom AND i.pos = c.pos LEFT JOIN r ON i.family = r.family AND i.chrom = r.chrom AND i.pos = r.pos"""


def appended(t):
    return pd.append_inheritance(pd.disease_inheritance(t.fx_fam, roles(t)), pd.compound_hets(kept(t)))


@query("ped_14", APPENDED)
def ped_14(t):
    return appended(t)


@query("ped_15", """
WITH g AS (SELECT DISTINCT s.family, c.chrom, c.pos, c.sample FROM fx_call c JOIN fx_sample s ON c.sample = s.sample)
SELECT l.family, l.chrom, l.pos, s.sample, CASE WHEN g.sample IS NULL THEN 'No data' ELSE 'het' END AS zyg
FROM (SELECT DISTINCT family, chrom, pos FROM g) l JOIN fx_sample s ON l.family = s.family
LEFT JOIN g ON g.family = l.family AND g.chrom = l.chrom AND g.pos = l.pos AND g.sample = s.sample""")
def ped_15(t):
    seen = t.fx_call.select("sample", "chrom", "pos").distinct().withColumn("zyg", F.lit("het"))
    return pd.fill_missing(seen, t.fx_sample)


@query("ped_16", """
WITH d AS (SELECT chrom, pos, affected, CASE zyg WHEN 'ref' THEN 0 WHEN 'het' THEN 1 WHEN 'hom' THEN 2 END AS a FROM fx_fam),
 s AS (SELECT chrom, pos, CAST(coalesce(sum(CASE WHEN affected = 1 THEN a END), 0) AS BIGINT) AS case_alt, CAST(coalesce(sum(CASE WHEN affected = 1 THEN 2 - a END), 0) AS BIGINT) AS case_ref,
  CAST(coalesce(sum(CASE WHEN affected = 0 THEN a END), 0) AS BIGINT) AS control_alt, CAST(coalesce(sum(CASE WHEN affected = 0 THEN 2 - a END), 0) AS BIGINT) AS control_ref FROM d GROUP BY chrom, pos),
 l AS (SELECT *, CASE WHEN least(case_alt, case_ref, control_alt, control_ref) > 0 THEN ln(CAST(case_alt * control_ref AS DOUBLE) / (case_ref * control_alt)) END AS lo,
  CASE WHEN least(case_alt, case_ref, control_alt, control_ref) > 0 THEN sqrt(1 / case_alt + 1 / case_ref + 1 / control_alt + 1 / control_ref) END AS se FROM s)
SELECT chrom, pos, case_alt, case_ref, control_alt, control_ref, round(exp(lo), 6) AS odds_ratio, round(exp(lo - 1.959963984540054 * se), 6) AS ci_low, round(exp(lo + 1.959963984540054 * se), 6) AS ci_high FROM l""")
def ped_16(t):
    out = pd.association(t.fx_fam)
    return out.withColumns({c: F.round(c, 6) for c in ("odds_ratio", "ci_low", "ci_high")})


@query("ped_17", """
SELECT chrom, pos, alt, count(DISTINCT c.sample) AS carriers FROM fx_call c JOIN fx_sample s ON c.sample = s.sample WHERE alt_reads > 0
GROUP BY chrom, pos, alt HAVING bool_and(s.grp = 'g2')""")
def ped_17(t):
    geno = t.fx_call.where("alt_reads > 0").select("chrom", "pos", "alt", "sample").distinct().withColumn("zyg", F.lit("het"))
    return pd.group_specific(geno, t.fx_sample, "g2", ["chrom", "pos", "alt"])


@query("flt_14", f"""
WITH a AS (SELECT * FROM ({APPENDED}) q), m AS (SELECT * FROM ({MENDEL}) q), n AS (SELECT family, chrom, pos, count(*) AS k FROM fx_fam WHERE affected = 1 AND zyg IN ('het', 'hom') GROUP BY 1, 2, 3)
SELECT a.family, a.chrom, a.pos, n.k AS affected_carriers, m.mendel, a.def_com_het FROM a JOIN m ON a.family = m.family AND a.chrom = m.chrom AND a.pos = m.pos
JOIN n ON a.family = n.family AND a.chrom = n.chrom AND a.pos = n.pos WHERE n.k >= 2 AND (m.mendel LIKE '%de novo%' OR a.def_com_het <> 'No')""")
def flt_14(t):
    at = ["family", "chrom", "pos"]
    n = t.fx_fam.where("affected = 1 AND zyg IN ('het', 'hom')").groupBy(at).agg(F.count("*").alias("affected_carriers"))
    rows = appended(t).join(pd.mendel(t.fx_fam, roles(t)), at).join(n, at).select(*at, "affected_carriers", "mendel", "def_com_het")
    novo = fl.pedigree_filter(rows, min_affected=2, de_novo=True)
    return novo.union(fl.pedigree_filter(rows, min_affected=2, compound_het=True)).distinct()
