"""Family genotypes: Mendelian checks, inheritance, phase blocks, compound hets (PED-*).

Input is long: one row per family member and variant, with ``family, sample, relation,
affected, zyg`` and the variant key. A member without a row at a variant counts as reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.functions.stats import count_if, sorted_text
from genoloom.functions.zygosity import NO_DATA, allele_pair, carries
from genoloom.operators.chunks import CHUNK, once, run_ids

LOCUS = ("chrom", "pos")


def family_roles(samples: DataFrame) -> DataFrame:
    """PED-1: affected and unaffected totals, parents present, and the proband (else the first sample).

    ``has_proband`` tells a proband from a first sample that stands for one.
    """
    def has(role: str) -> Column:
        return F.max((F.col("relation") == role).cast("int"))

    return samples.groupBy("family").agg(
        F.sum("affected").cast("bigint").alias("aff_total"), F.sum(1 - F.col("affected")).cast("bigint").alias("unaff_total"),
        has("mother").alias("has_mother"), has("father").alias("has_father"), has("proband").alias("has_proband"),
        F.coalesce(F.min(F.when(F.col("relation") == "proband", F.col("sample"))), F.min("sample")).alias("proband"))


def member_alleles(geno: DataFrame) -> DataFrame:
    """PED-2: the two alleles of each genotype from its allele text (``alleles``)."""
    return geno.withColumn("_p", allele_pair(F.col("zyg"), F.col("alleles"))).select(
        *geno.columns, F.col("_p.first").alias("first_allele"), F.col("_p.second").alias("second_allele"))


def _zyg_of(role: str) -> Column:
    return F.max(F.when(F.col("relation") == role, F.col("zyg")))


def mendel(geno: DataFrame, roles: DataFrame, keys: Sequence[str] = LOCUS) -> DataFrame:
    """PED-3, PED-4: whether the proband's genotype follows from the sequenced parents'.

    A member without a row at a locus of the family is ref there. Only a proband breaks the rules: a
    family without one follows them wherever its genotypes are known.
    """
    per = geno.groupBy("family", *keys).agg(
        _zyg_of("mother").alias("m"), _zyg_of("father").alias("f"), _zyg_of("proband").alias("c"),
        F.max((F.col("zyg") == NO_DATA).cast("int")).alias("gap"))
    full = per.join(roles.select("family", "has_mother", "has_father", "has_proband"), "family").withColumns(
        {"m": F.coalesce("m", F.lit("ref")), "f": F.coalesce("f", F.lit("ref")), "c": F.coalesce("c", F.when(F.col("has_proband") == 1, "ref"))})
    m, f, c = F.col("m"), F.col("f"), F.col("c")
    both = (F.col("has_mother") == 1) & (F.col("has_father") == 1)
    one = F.when(F.col("has_mother") == 1, m).otherwise(f)
    two_parents = (
        F.when(F.col("gap") == 1, "missing allele info")
        .when((c == "ref") & (m == "hom"), "hom_mother ref_child").when((c == "ref") & (f == "hom"), "hom_father ref_child")
        .when((c == "het") & (m == "ref") & (f == "ref"), "de novo (ref_parents het_child)")
        .when((c == "het") & (m == "hom") & (f == "hom"), "hom_parents het_child")
        .when((c == "hom") & (m == "ref"), "ref_mother hom_child").when((c == "hom") & (f == "ref"), "ref_father hom_child"))
    one_parent = (
        F.when(one == NO_DATA, "missing allele info").when((c == "ref") & (one == "hom"), "hom_parent ref_child")
        .when((c == "hom") & (one == "ref"), "ref_parent hom_child"))
    label = F.when(both, two_parents).when((F.col("has_mother") == 1) | (F.col("has_father") == 1), one_parent).otherwise(
        "No Parental info")
    return full.select("family", *keys, F.coalesce(label, F.lit("mendelian_rules_followed")).alias("mendel"))


def disease_inheritance(geno: DataFrame, roles: DataFrame, keys: Sequence[str] = LOCUS) -> DataFrame:
    """PED-5: auto / X recessive or dominant pattern, or ``none``.

    Every affected member must carry the variant. Recessive: carriers who are affected are hom,
    no unaffected is hom, and the sequenced parents carry (both, or the one there is).
    Dominant: affected are het, no unaffected carries, and each carrying parent is affected
    (with one sequenced parent, that parent).
    """
    var = carries(F.col("zyg"))
    aff = F.col("affected") == 1

    def any_of(cond: Column) -> Column:
        return F.max(cond.cast("int"))

    per = geno.groupBy("family", *keys).agg(
        count_if(var & aff).alias("aff"), any_of(var & aff & (F.col("zyg") != "hom")).alias("aff_not_hom"),
        any_of(var & aff & (F.col("zyg") != "het")).alias("aff_not_het"),
        any_of(~aff & (F.col("zyg") == "hom")).alias("unaff_hom"), any_of(var & ~aff).alias("unaff_var"),
        any_of(var & (F.col("relation") == "mother")).alias("mv"), any_of(var & (F.col("relation") == "father")).alias("fv"),
        any_of(var & aff & (F.col("relation") == "mother")).alias("ma"),
        any_of(var & aff & (F.col("relation") == "father")).alias("fa"))
    j = per.join(roles, "family")
    mv, fv, ma, fa = (F.col(c) == 1 for c in ("mv", "fv", "ma", "fa"))
    parents = F.col("has_mother") + F.col("has_father")
    all_carry = F.col("aff") == F.col("aff_total")
    recessive = all_carry & (F.col("aff_not_hom") == 0) & (F.col("unaff_hom") == 0)
    dominant = all_carry & (F.col("aff_not_het") == 0) & (F.col("unaff_var") == 0)
    rec_ok = F.when(parents == 2, mv & fv).when(parents == 1, mv | fv).otherwise(True)
    dom_ok = (F.when(parents == 2, (~mv | ma) & (~fv | fa))
              .when(parents == 1, F.when(mv, ma).when(fv, fa).otherwise(True)).otherwise(True))
    place = F.when(F.col("chrom") == "X", "X").otherwise("auto")
    # A family without affected carriers satisfies both patterns; recessive is tested first.
    label = F.when(recessive, F.when(rec_ok, F.concat(place, F.lit("-recessive")))).when(
        dominant, F.when(dom_ok, F.concat(place, F.lit("-dominant"))))
    return j.select("family", *keys, F.coalesce(label, F.lit("none")).alias("disease_inheritance"))


def with_parents(geno: DataFrame, roles: DataFrame, keys: Sequence[str] = LOCUS) -> DataFrame:
    """Children's rows with the parents' zygosities (``mz``, ``fz``, null when not sequenced).

    One grouping per family and locus gathers the parents and the children together; such a
    group is no larger than the family. ``contradicted`` says that an unaffected child is hom or
    an affected child is not het there (PED-11).
    """
    at = ["family", *keys]
    is_child = ~F.col("relation").isin("mother", "father")
    rest = [c for c in geno.columns if c not in at]
    against = F.when(F.col("affected") == 1, F.col("zyg") != "het").otherwise(F.col("zyg") == "hom")
    per = geno.groupBy(*at).agg(
        _zyg_of("mother").alias("_m"), _zyg_of("father").alias("_f"),
        F.max((is_child & against).cast("int")).alias("contradicted"),
        F.collect_set(F.when(is_child, F.struct(*rest))).alias("_children"))
    parents = roles.select("family", "has_mother", "has_father")
    return per.join(parents, "family").select(
        *at, "contradicted",
        F.when(F.col("has_mother") == 1, F.coalesce("_m", F.lit("ref"))).alias("mz"),
        F.when(F.col("has_father") == 1, F.coalesce("_f", F.lit("ref"))).alias("fz"),
        F.inline("_children"))


def _state_two(own: str, other: str) -> Column:
    """ref / var / ? of the allele received from the parent ``own`` when both are known."""
    z, a, b = F.col("zyg"), F.col(own), F.col(other)
    ref_ok, var_ok = a.isin("ref", "het"), a.isin("het", "hom")
    return (
        F.when((z == "ref") & ref_ok & b.isin("ref", "het"), "ref")
        .when((z == "hom") & var_ok & b.isin("het", "hom"), "var")
        .when((z == "het") & (((a == "ref") & b.isin("het", "hom")) | ((a == "het") & (b == "hom"))), "ref")
        .when((z == "het") & (((b == "ref") & a.isin("het", "hom")) | ((a == "hom") & (b == "het"))), "var")
        .otherwise("?"))


def _state_one(own: str) -> Column:
    """The same when only that parent is known."""
    z, a = F.col("zyg"), F.col(own)
    return (
        F.when(((z == "ref") & a.isin("ref", "het")) | ((z == "het") & (a == "ref")), "ref")
        .when(((z == "hom") & a.isin("het", "hom")) | ((z == "het") & (a == "hom")), "var").otherwise("?"))


def parental_origin(geno: DataFrame, roles: DataFrame, keys: Sequence[str] = LOCUS) -> DataFrame:
    """PED-6, PED-7: ``mother_allele`` and ``father_allele`` of each child: ref, var or ?."""
    c = with_parents(geno, roles, keys)
    both = F.col("mz").isNotNull() & F.col("fz").isNotNull()
    return c.withColumn(
        "mother_allele", F.when(both, _state_two("mz", "fz")).when(F.col("mz").isNotNull(), _state_one("mz")).otherwise("?")
    ).withColumn(
        "father_allele", F.when(both, _state_two("fz", "mz")).when(F.col("fz").isNotNull(), _state_one("fz")).otherwise("?"))


def _het_origin() -> Column:
    """Parent a het child's variant allele came from: mother, father or either."""
    mz, fz = F.col("mz"), F.col("fz")
    both = mz.isNotNull() & fz.isNotNull()
    two = (
        F.when(((mz == "het") & (fz == "ref")) | ((mz == "hom") & fz.isin("ref", "het")), "mother")
        .when(((fz == "het") & (mz == "ref")) | ((fz == "hom") & mz.isin("ref", "het")), "father")
        .when((mz == "het") & (fz == "het"), "either"))
    mother_only = F.when(mz == "hom", "mother").when(mz == "ref", "father").when(mz == "het", "either")
    father_only = F.when(fz == "hom", "father").when(fz == "ref", "mother").when(fz == "het", "either")
    return F.when(F.col("zyg") == "het", F.when(both, two).when(mz.isNotNull(), mother_only).when(fz.isNotNull(), father_only))


def affected_allele_parent(geno: DataFrame, roles: DataFrame, keys: Sequence[str] = LOCUS) -> DataFrame:
    """PED-8: which parent gives the variant allele to all affected children.

    ``No`` when a child contradicts it or no single parent gives it, ``?`` when nothing
    contradicts but some child's origin is unknown. The outcome does not depend on the order of
    the children.
    """
    c = parental_origin(geno, roles, keys).withColumn("_o", _het_origin())
    both = F.col("mz").isNotNull() & F.col("fz").isNotNull()
    m, f, z = F.col("mother_allele"), F.col("father_allele"), F.col("zyg")
    unknown = F.when(both, (m == "?") | (f == "?")).when(F.col("mz").isNotNull(), m == "?").otherwise(f == "?")
    aff = F.col("affected") == 1
    against = F.when(aff, both & (m == "ref") & (f == "ref")).otherwise(z.isin("het", "hom") & (~both | ~unknown))
    gives = F.when(aff & F.col("_o").isin("mother", "father"), F.col("_o"))
    per = c.where(F.col("mz").isNotNull() | F.col("fz").isNotNull()).groupBy("family", *keys).agg(
        F.max(against.cast("int")).alias("_no"), F.max(unknown.cast("int")).alias("_q"),
        F.min(gives).alias("_lo"), F.max(gives).alias("_hi"))
    single = F.col("_lo") == F.col("_hi")
    return per.select(
        "family", *keys,
        F.when(F.col("_no") == 1, "No").when(F.col("_q") == 1, "?")
        .when(single & (F.col("_lo") == "mother"), "Mother gives affected allele")
        .when(single & (F.col("_lo") == "father"), "Father gives affected allele").otherwise("No").alias("parent_allele"))


def phase_blocks(giving: DataFrame, min_variants: int = 2, min_span: int = 10_000) -> DataFrame:
    """PED-9: runs of variants of one chromosome and type whose allele comes from the same parent.

    ``?`` neither breaks nor extends a run. A block needs enough variants and a span above the
    minimum; its text is written to all members, on the block's own chromosome.
    """
    part = ["family", "var_type", "chrom"]
    side = F.when(F.col("parent_allele").startswith("Mother"), "Mother").when(
        F.col("parent_allele").startswith("Father"), "Father").otherwise("No")
    known = giving.where(F.col("parent_allele") != "?").select(*part, "pos", side.alias("side"))
    runs = run_ids(known, part, ["pos"], ["side"], F.floor(F.col("pos") / CHUNK),
                   lambda prev, cur: prev["side"] != cur["side"])
    blocks = runs.where("side <> 'No'").groupBy(*part, "run", "side").agg(
        F.count("*").alias("_n"), F.min("pos").alias("_s"), F.max("pos").alias("_e"))
    blocks = blocks.where((F.col("_n") >= min_variants) & (F.col("_e") - F.col("_s") > min_span)).withColumn(
        "phase_info", F.concat(
            F.col("_n").cast("string"), F.lit(" variants; "), F.col("side"), F.lit("; "), F.col("chrom"), F.lit(":"),
            F.col("_s").cast("string"), F.lit("-"), F.col("_e").cast("string"), F.lit("; "),
            (F.col("_e") - F.col("_s")).cast("string"), F.lit("bp"))).select(*part, "run", "phase_info")
    member = runs.where("side <> 'No'").join(blocks, [*part, "run"]).select(*part, "pos", "phase_info")
    return giving.join(member, [*part, "pos"], "left").withColumn("phase_info", F.coalesce("phase_info", F.lit("No")))


def het_buckets(geno: DataFrame, roles: DataFrame, keys: Sequence[str] = LOCUS) -> DataFrame:
    """PED-10: one row per het child variant inside a gene, with the parent of origin.

    Buckets stay long (family, gene, sample, origin, variant) instead of lists per gene.
    """
    c = with_parents(geno, roles, keys).withColumn("origin", _het_origin())
    return c.where(F.col("origin").isNotNull() & F.col("gene").isNotNull()).select(
        "family", "gene", "sample", "affected", *keys, "origin", "rare", "contradicted")


def drop_contradicted(buckets: DataFrame) -> DataFrame:
    """PED-11: remove a variant where an unaffected child is hom or an affected child is not het."""
    return buckets.where("contradicted = 0").drop("contradicted")


def _child_forms(bucket: Column) -> Column:
    """Texts of a child's definite and possible form in one scope, and the origins that take part."""
    def of(origin: str) -> Column:
        return F.transform(F.filter(bucket, lambda v: v["origin"] == origin), lambda v: v["label"])

    def text(**parts: Column) -> Column:
        return F.concat_ws(",", *[F.concat(F.lit(f"{name}="), F.array_join(items, ",")) for name, items in parts.items()])

    mother, father, either = of("mother"), of("father"), of("either")
    has = {k: F.size(x) > 0 for k, x in (("m", mother), ("f", father), ("e", either))}
    possible = (
        F.when(has["m"] & has["e"], F.struct(text(M=mother, AMB=either).alias("text"), F.array(F.lit("mother"), F.lit("either")).alias("of")))
        .when(has["f"] & has["e"], F.struct(text(F=father, AMB=either).alias("text"), F.array(F.lit("father"), F.lit("either")).alias("of")))
        .when(F.size(either) > 1, F.struct(text(AMB=either).alias("text"), F.array(F.lit("either")).alias("of"))))
    definite = F.when(has["m"] & has["f"], F.struct(
        text(M=mother, F=father).alias("text"), F.array(F.lit("mother"), F.lit("father")).alias("of")))
    return F.struct(definite.alias("def"), possible.alias("pos"))


def compound_hets(buckets: DataFrame, keys: Sequence[str] = LOCUS, contents: bool = False) -> DataFrame:
    """PED-12, PED-13, PED-14: definite and possible compound hets per variant, over all and over rare variants.

    Definite: the child has variants from the mother and from the father in the gene. Possible:
    mother and either, else father and either, else two or more of either. The variant itself
    must be in one of the buckets involved. The columns list the children, or say ``No`` when
    none or when the only form occurs in an unaffected child. With ``contents`` further columns
    ``..._forms`` name each form after its children, as ``c1,c2(M=1:100,F=1:250)``, sorted by content.

    A family's variants of a gene meet once: grouped by child they give its forms, grouped by family
    the forms are numbered by their content (equal text, equal number), and the variants then carry
    numbers, not texts. All groupings use the one exchange by family and gene.
    """
    at = ["family", "gene"]
    variant = F.struct(*keys, "origin", "rare", F.concat_ws(":", *keys).alias("label"))
    child = buckets.repartition(*at).groupBy(*at, "sample").agg(
        F.max("affected").alias("affected"), F.sort_array(F.collect_set(variant)).alias("v"))
    judged = once(child, all=_child_forms(F.col("v")), rare_=_child_forms(F.filter("v", lambda v: v["rare"] == 1)))
    families = judged.groupBy(*at).agg(F.collect_list(F.struct("sample", "affected", "v", "all", "rare_")).alias("c"))
    columns = {f"{kind}_com_{scope}het": (scope or "all", kind) for scope in ("", "rare_") for kind in ("def", "pos")}
    numbered = once(families, _t=F.struct(*[
        F.array_distinct(F.transform("c", lambda c: c[scope][kind]["text"])).alias(col) for col, (scope, kind) in columns.items()]))
    members = numbered.select(*at, "_t", F.explode("c").alias("c"))
    own = members.select(
        *at, F.col("c.sample").alias("sample"), F.col("c.affected").alias("affected"), F.col("c.v").alias("v"),
        *[F.struct(F.array_position(F.col(f"_t.{col}"), F.col(f"c.{scope}.{kind}.text")).alias("n"), F.col(f"c.{scope}.{kind}.of").alias("of"),
                   *([F.col(f"c.{scope}.{kind}.text").alias("text")] if contents else [])).alias(col)
          for col, (scope, kind) in columns.items()])
    rows = own.select(*at, "sample", "affected", *columns, F.explode("v").alias("v"))
    shown = []
    for col, (scope, _) in columns.items():
        inside = F.array_contains(F.col(f"{col}.of"), F.col("v.origin"))
        hit = F.coalesce(inside & (F.col("v.rare") == 1) if scope == "rare_" else inside, F.lit(False))
        shown += [sorted_text(F.when(hit, F.col("sample"))).alias(f"_s_{col}"),
                  F.size(F.collect_set(F.when(hit, F.col(f"{col}.n")))).alias(f"_n_{col}"),
                  F.coalesce(F.max(F.when(hit, 1 - F.col("affected"))), F.lit(0)).alias(f"_u_{col}")]
        if contents:
            shown.append(F.sort_array(F.collect_set(F.when(hit, F.struct(f"{col}.text", "sample")))).alias(f"_f_{col}"))
    per = rows.groupBy(*at, *[F.col(f"v.{k}").alias(k) for k in keys]).agg(*shown)

    def unless_hidden(col: str, value: Column) -> Column:
        forms = F.col(f"_n_{col}")
        return F.when((forms == 0) | ((forms == 1) & (F.col(f"_u_{col}") == 1)), "No").otherwise(value)

    def by_content(col: str) -> Column:
        items = F.col(f"_f_{col}")
        return F.array_join(F.transform(F.array_distinct(F.transform(items, lambda x: x["text"])), lambda t: F.concat(
            F.array_join(F.transform(F.filter(items, lambda x: x["text"] == t), lambda x: x["sample"]), ","),
            F.lit("("), t, F.lit(")"))), ",")

    return per.select(*at, *keys, *[unless_hidden(c, F.col(f"_s_{c}")).alias(c) for c in columns],
                      *([unless_hidden(c, by_content(c)).alias(f"{c}_forms") for c in columns] if contents else []))


# Column of the compound-het forms and the label appended to the inheritance text.
COMPOUND_LABELS = {"def_com_het": "def_compound_het", "pos_com_het": "pos_compound_het",
                   "def_com_rare_het": "def_compound_rare_het", "pos_com_rare_het": "pos_compound_rare_het"}


def append_inheritance(inheritance: DataFrame, hets: DataFrame, keys: Sequence[str] = LOCUS) -> DataFrame:
    """PED-14: append the compound-het forms to the inheritance text; ``none`` is replaced."""
    at = ["family", *keys]
    cols = list(COMPOUND_LABELS)
    out = inheritance.join(hets.select(*at, *cols), at, "left").fillna("No", subset=cols)
    base = F.when(F.col("disease_inheritance") != "none", F.col("disease_inheritance"))
    text = F.concat_ws(",", base, *[F.when(F.col(c) != "No", F.lit(label)) for c, label in COMPOUND_LABELS.items()])
    return out.withColumn("disease_inheritance", F.when(text == "", "none").otherwise(text))


def fill_missing(geno: DataFrame, samples: DataFrame, keys: Sequence[str] = LOCUS) -> DataFrame:
    """PED-15: a ``No data`` row for every member of a family that has no genotype at a locus of the family.

    Members are carried as one short array per family, so a locus is spread by an equi-join and
    an explode.
    """
    members = samples.groupBy("family").agg(F.collect_set("sample").alias("_members"))
    placed = geno.select("sample", *keys, "zyg").join(samples.select("sample", "family"), "sample")
    loci = placed.select("family", *keys).distinct()
    every = loci.join(members, "family").select("family", *keys, F.explode("_members").alias("sample"))
    return every.join(placed, ["family", *keys, "sample"], "left").withColumn("zyg", F.coalesce("zyg", F.lit(NO_DATA)))


def association(geno: DataFrame, keys: Sequence[str] = LOCUS, z: float = 1.959963984540054) -> DataFrame:
    """PED-16: allele counts in cases and controls, odds ratio and its confidence limits.

    The ratio is null when a cell of the 2 x 2 table is empty.
    """
    alt = F.when(F.col("zyg") == "het", 1).when(F.col("zyg") == "hom", 2).when(F.col("zyg") == "ref", 0)
    case = F.col("affected") == 1

    def total(x: Column, cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, x)), F.lit(0)).cast("bigint")

    per = geno.groupBy(*keys).agg(
        total(alt, case).alias("case_alt"), total(2 - alt, case).alias("case_ref"),
        total(alt, ~case).alias("control_alt"), total(2 - alt, ~case).alias("control_ref"))
    a, b, c, d = (F.col(x) for x in ("case_alt", "case_ref", "control_alt", "control_ref"))
    ok = F.least(a, b, c, d) > 0
    log_or = F.when(ok, F.log((a * d) / (b * c)))
    se = F.when(ok, F.sqrt(1 / a + 1 / b + 1 / c + 1 / d))
    return once(per, _l=log_or, _s=se).select(
        *keys, "case_alt", "case_ref", "control_alt", "control_ref", F.exp("_l").alias("odds_ratio"),
        F.exp(F.col("_l") - z * F.col("_s")).alias("ci_low"), F.exp(F.col("_l") + z * F.col("_s")).alias("ci_high"))


def group_specific(geno: DataFrame, groups: DataFrame, wanted: str, keys: Sequence[str] = LOCUS) -> DataFrame:
    """PED-17: variants carried inside one group and by nobody outside it, with the carrier count."""
    g = geno.join(groups.select("sample", "grp"), "sample")
    per = g.where(carries(F.col("zyg"))).groupBy(*keys).agg(
        count_if(F.col("grp") == wanted).alias("carriers"), count_if(F.col("grp") != wanted).alias("_out"))
    return per.where((F.col("carriers") > 0) & (F.col("_out") == 0)).drop("_out")
