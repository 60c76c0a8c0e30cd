"""Annotation of calls from catalogues, exons and consequence predictions (ANN-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoloom.functions.sequence import amino, revcomp
from genoloom.functions.stats import sorted_text
from genoloom.functions.text import attr_map, matched
from genoloom.operators.chunks import merged, once
from genoloom.operators.intervals import overlap_matches

VARIANT = ("chrom", "start", "end", "bases")


def annotate_and_flag(calls: DataFrame, coord: DataFrame, name: str = "name", match_passes: bool = True, **kw) -> DataFrame:
    """ANN-1: ``filtermatch`` by overlap, ``filterpass`` by policy, ``attribute`` from the matched text."""
    hit = overlap_matches(calls, coord, name, keep_unmatched="N/A", **kw)
    matchflag = (F.col("n_matches") > 0).cast("int")
    return hit.withColumn("filtermatch", matchflag).withColumn(
        "filterpass", matchflag if match_passes else 1 - matchflag).withColumnRenamed("matches", "attribute").drop("n_matches")


def _freq_attribute(best: str, named: str) -> Column:
    return (
        F.when(F.col(best).isNotNull(), F.concat(
            F.lit("rs="), F.col(f"{best}.rs"), F.lit(";ref_allele_freq="), F.col(f"{best}.ref_freq").cast("string"),
            F.lit(";var_allele_freq="), F.col(f"{best}.alt_freq").cast("string")))
        .when(F.col(named).isNotNull(), F.concat(F.lit("rs="), F.col(named))).otherwise("novel"))


def annotate_dbsnp_snv(calls: DataFrame, entries: DataFrame) -> DataFrame:
    """ANN-2: id and frequencies of the same base change with the highest reference frequency.

    Without such an entry, the id of an entry that has no frequency at the position; else
    ``novel``. ``filtermatch`` says whether the position is known at all. ``entries`` carries
    ``chrom, pos, ref, alt, rs`` (first id) and frequencies that may be null.
    """
    same = entries.where(F.col("ref_freq").isNotNull()).groupBy("chrom", "pos", "ref", "alt").agg(
        F.max(F.struct("ref_freq", "rs", "alt_freq")).alias("_best"))
    site = entries.groupBy("chrom", "pos").agg(
        F.max(F.when(F.col("ref_freq").isNull(), F.col("rs"))).alias("_named"), F.lit(1).alias("_site"))
    return (
        calls.join(same, ["chrom", "pos", "ref", "alt"], "left").join(site, ["chrom", "pos"], "left")
        .withColumn("attribute", _freq_attribute("_best", "_named"))
        .withColumn("filtermatch", F.coalesce("_site", F.lit(0))).drop("_best", "_named", "_site"))


def annotate_dbsnp_indel(calls: DataFrame, entries: DataFrame) -> DataFrame:
    """ANN-3: exact coordinates and type; frequency of the same inserted bases, or of the deletion.

    ``calls`` and ``entries`` carry ``chrom, start, end, var_type, bases`` (bases without sign).
    """
    at = ["chrom", "start", "end", "var_type"]
    same = entries.where(F.col("ref_freq").isNotNull()).groupBy(*at, "bases").agg(
        F.max(F.struct("ref_freq", "rs", "alt_freq")).alias("_best"))
    site = entries.groupBy(*at).agg(F.max("rs").alias("_named"))
    return (
        calls.join(same, [*at, "bases"], "left").join(site, at, "left")
        .withColumn("attribute", _freq_attribute("_best", "_named"))
        .withColumn("filtermatch", F.col("_named").isNotNull().cast("int")).drop("_best", "_named"))


def attach_attribute(calls: DataFrame, entries: DataFrame, label: str, by_type: bool = False) -> DataFrame:
    """ANN-4: ``label=text`` of the exact-coordinate entry, its leading coordinate removed.

    With ``by_type`` an insertion only takes entries of inserted bases (``+``) and a deletion
    the others. Of several entries the last in text order is used.
    """
    text = F.regexp_replace("entry", r"^\d+:", "")
    side = entries.select("chrom", "start", "end", text.alias("_text"))
    at = ["chrom", "start", "end"]
    if by_type:
        side = side.withColumn("var_type", F.when(F.col("_text").startswith("+"), "INS").otherwise("DEL"))
        at = [*at, "var_type"]
    best = side.groupBy(*at).agg(F.max("_text").alias("_text"))
    return calls.join(best, at, "left").withColumn(
        "attribute", F.when(F.col("_text").isNotNull(), F.concat(F.lit(label + "="), F.col("_text")))).withColumn(
        "filtermatch", F.col("_text").isNotNull().cast("int")).drop("_text")


def seen_before(calls: DataFrame, cohort: DataFrame, own: Sequence[str]) -> DataFrame:
    """ANN-5: other samples with a variant at the same coordinates; being seen fails the filter."""
    at = ["chrom", "start", "end"]
    others = cohort.where(~F.col("sample").isin(*own)).groupBy(*at).agg(
        sorted_text(F.col("sample")).alias("seen_in"))
    return calls.join(others, at, "left").withColumn(
        "filterpass", F.col("seen_in").isNull().cast("int"))


def splice_sites(exons: DataFrame, n: int = 10, name: str = "exon") -> DataFrame:
    """ANN-6: the ``n`` bases beside each exon edge with their distance, named by side."""
    step = F.explode(F.sequence(F.lit(1), F.lit(n)))
    ranges = exons.groupBy("chrom", "start", "end").agg(sorted_text(F.col(name)).alias("_n"))

    def side(pos: Column, no: int) -> DataFrame:
        label = F.concat(F.regexp_replace("_n", r"(exon\d+)", rf"$1_splice{no}"), F.lit("_"), F.col("distance").cast("string"))
        return ranges.withColumn("distance", step).select("chrom", pos.alias("pos"), "distance", label.alias("splice"))

    return side(F.col("start") - F.col("distance"), 1).unionByName(side(F.col("end") + F.col("distance"), 2))


def splice_distance(calls: DataFrame, sites: DataFrame) -> DataFrame:
    """ANN-6: distance of a call to an exon edge, by position; the last name in order decides."""
    best = sites.groupBy("chrom", "pos").agg(F.max(F.struct("splice", "distance")).alias("_b"))
    return calls.join(best, ["chrom", "pos"], "left").withColumn("splice_distance", F.col("_b.distance")).drop("_b")


def exon_bases(exons: DataFrame) -> DataFrame:
    """ANN-7: one row per exon base and chromosome.

    Intervals are made distinct before they are spread, and duplicates can only come from
    overlapping exons.
    """
    lone = exons.select("chrom", "start", "end").distinct()
    return lone.select("chrom", F.explode(F.sequence("start", "end")).alias("pos")).distinct()


def coding_offsets(exons: DataFrame) -> DataFrame:
    """Exons with the coding bases before them in reading direction, and the gene's coding length.

    The window covers one gene's exons, at most a few hundred rows.
    """
    length = F.col("end") - F.col("start") + 1
    direction = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    in_order = Window.partitionBy("chrom", "gene").orderBy(direction)
    lone = exons.select("chrom", "gene", "strand", "start", "end").distinct()
    return lone.withColumn(
        "offset", F.coalesce(F.sum(length).over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn(
        "cds_length", F.sum(length).over(Window.partitionBy("chrom", "gene")))


def _coding_base() -> Column:
    """0-based place of ``pos`` in the coding sequence."""
    inside = F.when(F.col("strand") == "-", F.col("end") - F.col("pos")).otherwise(F.col("pos") - F.col("start"))
    return F.col("offset") + inside


def residue_position(calls: DataFrame, exons: DataFrame, bin_width: int = 1000) -> DataFrame:
    """ANN-8: ``aa_pos`` of a call in its gene's protein and ``aa_len`` without the stop codon."""
    from genoloom.operators.intervals import locus_pairs

    sites = calls.select("chrom", F.col("pos").alias("start"), F.col("pos").alias("end")).distinct()
    hits = locus_pairs(sites, coding_offsets(exons), bin_width=bin_width, longest=0)
    at = hits.select(
        "chrom", F.col("start").alias("pos"), "gene", "strand", "offset", "cds_length",
        F.col("c_start").alias("start"), F.col("c_end").alias("end"))
    placed = at.select(
        "chrom", "pos", "gene", "strand", (F.floor(_coding_base() / 3) + 1).alias("aa_pos"),
        (F.floor(F.col("cds_length") / 3) - 1).alias("aa_len"))
    return calls.join(merged(placed), ["chrom", "pos"])


# Predictor names of variants: insertion, deletion, substitution of up to three bases.
def _vep_variant(rows: DataFrame) -> DataFrame:
    name = F.col("uploaded")
    ins, dele = matched(name, r"/[ACTG]([ACTG]+)$"), matched(name, r"_([A-Z]+)/-$")
    sub = name.rlike(r"_[TCGA]{1,3}/[TCGA]{1,3}$") & ~name.rlike(r"/[ACTG][ACTG]+$")
    v = rows.withColumn("var_type", F.when(ins.isNotNull(), "INS").when(dele.isNotNull(), "DEL").when(sub, "SNV")).withColumn(
        "var_base", F.when(ins.isNotNull(), F.concat(F.lit("+"), ins)).when(dele.isNotNull(), F.concat(F.lit("-"), dele))
        .otherwise(F.col("allele")))
    shift = (F.col("var_type") == "INS") & (F.col("end") > F.col("start"))
    return v.where(F.col("var_type").isNotNull()).withColumn("start", F.when(shift, F.col("start") + 1).otherwise(F.col("start")))


def _called(text: Column) -> tuple[Column, Column]:
    """Prediction and score of ``name(score)``."""
    return (F.coalesce(matched(text, r"^(.+)\(([0-9.]+)\)", 1), F.lit("N/A")),
            F.coalesce(matched(text, r"^(.+)\(([0-9.]+)\)", 2), F.lit("N/A")))


def coding_consequences(rows: DataFrame) -> DataFrame:
    """ANN-9: residue changes on canonical transcripts, ``*`` spelled Stop, predictions split."""
    v = once(_vep_variant(rows), a=attr_map(F.col("extra"))).where(F.col("extra").contains("CANONICAL"))
    change = r"([A-Z*])/([A-Z*])"
    v = v.where(F.col("amino_acids").rlike(change))

    def residue(i: int) -> Column:
        aa = F.regexp_extract("amino_acids", change, i)
        return F.when(aa == "*", "Stop").otherwise(aa)

    poly, sift = _called(F.col("a")["PolyPhen"]), _called(F.col("a")["SIFT"])
    out = v.select(
        "chrom", "start", "end", "var_type", "var_base", "gene", "feature", "consequence", residue(1).alias("aa_ref"),
        residue(2).alias("aa_var"), F.col("protein_pos").alias("aa_pos"), poly[0].alias("polyphen_pred"),
        poly[1].alias("polyphen_score"), sift[0].alias("sift_pred"), sift[1].alias("sift_score"),
        F.coalesce(F.col("a")["CADD_PHRED"], F.lit("N/A")).alias("cadd_phred"))
    return _one(out, ["chrom", "start", "end", "var_base", "aa_ref", "aa_var"])


def _one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the largest in column order."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def all_consequences(rows: DataFrame) -> DataFrame:
    """ANN-10: one row per variant, an exon row before an intron row before neither.

    Domain, publications, exon number and symbol are read on canonical transcripts only.
    """
    v = once(_vep_variant(rows), a=attr_map(F.col("extra")))
    canonical = F.col("extra").contains("CANONICAL")

    def val(name: str, only_canonical: bool = False) -> Column:
        got = F.col("a")[name]
        return F.coalesce(F.when(canonical, got) if only_canonical else got, F.lit("N/A"))

    exon, intron = F.when(canonical, F.col("a")["EXON"]), F.when(canonical, F.col("a")["INTRON"])
    rank = F.when(intron.isNotNull(), 2).when(exon.isNotNull(), 1).otherwise(3)
    place = F.when(intron.isNotNull(), F.concat(F.lit("INTRON->"), intron)).when(
        exon.isNotNull(), F.concat(F.lit("EXON->"), exon)).otherwise("N/A")
    out = v.select(
        "chrom", "start", "end", "var_base", (-rank).alias("_rank"), "var_type", "consequence",
        F.when(F.col("existing") == "-", "N/A").otherwise(F.col("existing")).alias("rs"), val("AF").alias("gmaf"),
        val("DOMAINS", True).alias("domain"), val("PUBMED", True).alias("pubmed"), val("CLIN_SIG").alias("clinical"),
        place.alias("exon"), "gene", "feature", val("CADD_PHRED").alias("cadd_phred"), val("gnomAD_AF").alias("gnomad"),
        val("SYMBOL", True).alias("symbol"))
    return _one(out, ["chrom", "start", "end", "var_base"]).drop("_rank")


def codon_groups(calls: DataFrame, bases: DataFrame) -> DataFrame:
    """ANN-11: neighbouring SNVs of one codon combined into one change, written to each member.

    ``calls`` carries ``chrom, pos, ref, alt, gene, aa_pos``. Two members with one base between
    them are joined over that base of the reference table. A codon holds three positions, so a
    group cannot grow; one alternate per position is kept.
    """
    lone = calls.groupBy("chrom", "gene", "aa_pos", "pos", "ref").agg(F.min("alt").alias("alt"))
    grouped = lone.groupBy("chrom", "gene", "aa_pos").agg(
        F.array_sort(F.collect_list(F.struct("pos", "ref", "alt"))).alias("m")).where(F.size("m") > 1)
    gap = (F.size("m") == 2) & (F.col("m")[1]["pos"] - F.col("m")[0]["pos"] == 2)
    wide = grouped.withColumn("_mid", F.when(gap, F.col("m")[0]["pos"] + 1)).join(
        merged(bases.select("chrom", F.col("pos").alias("_mid"), F.col("base").alias("_base"))), ["chrom", "_mid"], "left")

    def text(part: str) -> Column:
        bridged = F.concat(F.col("m")[0][part], F.coalesce("_base", F.lit("N")), F.col("m")[1][part])
        return F.when(gap, bridged).otherwise(F.array_join(F.transform("m", lambda x: x[part]), ""))

    combined = wide.select(
        "chrom", "gene", "aa_pos", F.col("m")[0]["pos"].alias("start"), F.try_element_at("m", F.lit(-1))["pos"].alias("end"),
        F.concat_ws("/", text("ref"), text("alt")).alias("change"), F.explode("m").alias("x"))
    return combined.select("chrom", "gene", "aa_pos", "start", "end", "change", F.col("x.pos").alias("pos"),
                           F.col("x.ref").alias("ref"), F.col("x.alt").alias("alt"))


def score_alleles(scores: DataFrame) -> DataFrame:
    """Score-table alleles in variant coordinates: unequal alleles lose their first base, ``-`` for none."""
    uneven = F.length("ref") != F.length("alt")

    def cut(c: str) -> Column:
        rest = F.substr(F.col(c), F.lit(2), F.length(c))
        return F.when(uneven, F.when(rest == "", "-").otherwise(rest)).otherwise(F.col(c))

    return scores.select(
        "chrom", F.when(uneven, F.col("pos") + 1).otherwise(F.col("pos")).alias("start"),
        (F.col("pos") + F.length("ref") - 1).alias("end"), cut("alt").alias("allele"), "raw", "phred")


def lookup_score(calls: DataFrame, scores: DataFrame) -> DataFrame:
    """ANN-12: precomputed scores by locus and allele; alleles other than one base or ``-`` have none."""
    best = score_alleles(scores).groupBy("chrom", "start", "end", "allele").agg(
        F.max(F.struct("phred", "raw")).alias("_s"))
    fit = F.col("allele").rlike("^[ACGT-]$")
    return calls.join(best, ["chrom", "start", "end", "allele"], "left").withColumn(
        "cadd_raw", F.when(fit, F.col("_s.raw"))).withColumn("cadd_phred", F.when(fit, F.col("_s.phred"))).drop("_s")


def cancer_label(df: DataFrame, text: str, cancer_type: str = "melanoma") -> DataFrame:
    """ANN-13: the catalogue text behind its own cancer type, or OTHERCANCER."""
    own = F.lower(text).contains(cancer_type.lower())
    return df.withColumn("cosmic_coord", F.when(own, F.concat(F.lit(cancer_type + ":"), F.col(text))).when(
        F.col(text).isNotNull(), F.concat(F.lit("OTHERCANCER:"), F.col(text))).otherwise("N/A"))


ATTRIBUTE_PARTS = {"rs": "rs", "gmaf": "gmaf", "domain": "domain", "pubmed": "pubmed", "clinsig": "clinical", "exon": "exon"}


def consequence_attribute(df: DataFrame) -> DataFrame:
    """ANN-14: ``k=v`` parts that are present, in a fixed order, or N/A."""
    parts = [F.when(F.col(c) != "N/A", F.concat(F.lit(k + "="), F.col(c))) for k, c in ATTRIBUTE_PARTS.items()]
    text = F.concat_ws(";", *parts)
    return df.withColumn("attribute", F.when(text == "", "N/A").otherwise(text))


def attach_polyphen(calls: DataFrame, scores: DataFrame, notes: DataFrame | None = None) -> DataFrame:
    """ANN-15: prediction and score by position and base change, and the note by position."""
    change = F.concat_ws("->", "ref", "alt")
    best = scores.groupBy("chrom", "pos", "change").agg(
        F.max(F.concat_ws(",", "prediction", "score")).alias("polyphen"))
    out = calls.withColumn("change", change).join(best, ["chrom", "pos", "change"], "left").drop("change")
    if notes is not None:
        out = out.join(notes.groupBy("chrom", "pos").agg(F.max("note").alias("polyphen_note")), ["chrom", "pos"], "left")
    return out


def exon_type(df: DataFrame) -> DataFrame:
    """ANN-16: NONSENSE, MISSENSE or SYN; SYN gives way to a splice match, introns and no gene to N/A.

    Reads ``aa_attribute`` (null when there is no coding change), ``splice_distance``,
    ``exon`` and ``gene``.
    """
    coding = F.when(F.col("aa_attribute").contains("Stop"), "NONSENSE").when(F.col("aa_attribute").isNotNull(), "MISSENSE")
    splice = F.when(F.col("splice_distance").isNotNull(),
                    F.concat(F.lit("SPLICE ("), F.col("splice_distance").cast("string"), F.lit(")")))
    outside = F.coalesce(F.col("exon").contains("INTRON"), F.lit(False)) | F.col("gene").isNull()
    return df.withColumn("exon_type", F.coalesce(coding, splice, F.when(outside, "N/A"), F.lit("SYN")))


def _coding_halo(exons: DataFrame) -> DataFrame:
    """``coding_offsets`` with the two coding positions before (``b1, b2``) and after (``a1, a2``) each exon.

    ``first`` and ``step`` give the exon in reading direction. A codon that crosses one or two exon
    borders is thus placed from the row of any of its exons.
    """
    minus = F.col("strand") == "-"
    lone = coding_offsets(exons).select(
        "*", F.when(minus, F.col("end")).otherwise(F.col("start")).alias("first"),
        F.when(minus, F.col("start")).otherwise(F.col("end")).alias("last"), F.when(minus, -1).otherwise(1).alias("step"),
        (F.col("end") - F.col("start") + 1).alias("len"))
    order = Window.partitionBy("chrom", "gene").orderBy("offset")

    def two(shift, near: str, inward: int) -> tuple[Column, Column]:
        at, size = shift(near, 1).over(order), shift("len", 1).over(order)
        return at, F.when(size > 1, at + shift("step", 1).over(order) * inward).otherwise(shift(near, 2).over(order))

    (b1, b2), (a1, a2) = two(F.lag, "last", -1), two(F.lead, "first", 1)
    return lone.select("*", b1.alias("b1"), b2.alias("b2"), a1.alias("a1"), a2.alias("a2")).drop("last")


def _codon_texts(named: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole codons from rows of ``pos`` and ``base``: their text in genome order and their members ``c``."""
    codons = named.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "base"))).alias("c")).where(F.size("c") == 3)
    return codons.select(*keys, F.concat(*[F.col("c")[i]["base"] for i in range(3)]).alias("codon"), "c")


def residue_table(exons: DataFrame, bases: DataFrame) -> DataFrame:
    """ANN-17: coding bases with residue number, codon (in genome order), place in it and strand.

    The place of a base comes from its exon's offset, so no ordering over bases is needed. The
    last codon of a gene is left out, as is a partial one.
    """
    spread = coding_offsets(exons).withColumn("pos", F.explode(F.sequence("start", "end")))
    placed = spread.withColumn("n", _coding_base()).withColumn("aa_number", F.floor(F.col("n") / 3) + 1).where(
        F.col("aa_number") < F.ceil(F.col("cds_length") / 3))
    named = placed.join(merged(bases.select("chrom", "pos", "base")), ["chrom", "pos"]).select(
        "chrom", "pos", "gene", "strand", "aa_number", "base")
    out = _codon_texts(named, ["chrom", "gene", "aa_number", "strand"]).select(
        "chrom", "gene", "aa_number", "strand", "codon", F.posexplode("c").alias("place", "x"))
    return out.select("chrom", F.col("x.pos").alias("pos"), "gene", "strand", "aa_number", "codon",
                      F.col("x.base").alias("ref_base"), "place")


def called_residues(calls: DataFrame, exons: DataFrame, bases: DataFrame, bin_width: int = 1000) -> DataFrame:
    """ANN-18: the rows of ``residue_table`` at called positions, without spreading the coding bases.

    A called position finds its exon by interval; the exon's offset gives the residue, and the
    residue's three places give three positions, across exon borders too. At most three rows of
    the base table are fetched per position and gene.
    """
    from genoloom.operators.intervals import locus_pairs

    sites = calls.select("chrom", F.col("pos").alias("start"), F.col("pos").alias("end")).distinct()
    hits = locus_pairs(sites, _coding_halo(exons), bin_width=bin_width, longest=0)
    n = F.col("offset") + (F.col("start") - F.col("first")) * F.col("step")
    placed = hits.withColumn("aa_number", F.floor(n / 3) + 1).where(F.col("aa_number") < F.ceil(F.col("cds_length") / 3))

    def position(i: int) -> Column:
        d = (F.col("aa_number") - 1) * 3 + i - F.col("offset")
        over = d - F.col("len")
        return F.when(d == -1, F.col("b1")).when(d == -2, F.col("b2")).when(over == 0, F.col("a1")).when(
            over == 1, F.col("a2")).otherwise(F.col("first") + F.col("step") * d)

    wanted = placed.select("chrom", F.col("start").alias("site"), "gene", "strand", "aa_number",
                           F.explode(F.array(*[position(i) for i in range(3)])).alias("pos"))
    named = wanted.join(merged(bases.select("chrom", "pos", "base")), ["chrom", "pos"])
    # Partitioned by place, so that the grouping and a join with the calls need no exchange of their own.
    codons = _codon_texts(named.repartition("chrom", "site"), ["chrom", "site", "gene", "aa_number", "strand"])
    place = F.array_position(F.transform("c", lambda x: x["pos"]), F.col("site")).cast("int") - 1
    return codons.select("chrom", F.col("site").alias("pos"), "gene", "strand", "aa_number", "codon",
                         F.get("c", place)["base"].alias("ref_base"), place.alias("place"))


def recompute_residue(calls: DataFrame, table: DataFrame) -> DataFrame:
    """ANN-18: put the called base into its codon and translate; stop, unchanged and mismatching rows drop out."""
    j = calls.join(merged(table), ["chrom", "pos"]).where(F.col("ref") == F.col("ref_base"))
    changed = F.overlay("codon", "alt", F.col("place") + 1)

    def residue(codon: Column) -> Column:
        return amino(F.when(F.col("strand") == "-", revcomp(codon)).otherwise(codon))

    out = once(j, aa_ref=residue(F.col("codon")), aa_new=residue(changed))
    return out.where((F.col("aa_new") != "_") & (F.col("aa_new") != F.col("aa_ref"))).select(
        *calls.columns, "gene", "aa_number", "aa_ref", "aa_new")
