"""Classification, scoring, ordering and report layout (RPT-*)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.functions.stats import count_if, ratio, sorted_text
from genoloom.functions.text import chrom_rank, sentinel
from genoloom.operators.aggregates import median_by
from genoloom.operators.chunks import with_totals
from genoloom.operators.ordering import with_rank

PASS = "OVERALL_PASS"


def population_class(df: DataFrame, cutoff: float = 0.02) -> DataFrame:
    """RPT-1: NOVEL, RARE_ALLELE, RARE_REF, NO_FREQ or common, and whether the class fails.

    Reads ``filter_dbsnp`` (PASS means not in the catalogue) and the frequencies, which are
    null when the catalogue has none.
    """
    novel = F.col("filter_dbsnp").isin("PASS", "NOVEL", "N/A")
    label = (
        F.when(novel, F.when(F.col("filter_dbsnp") == "N/A", "N/A").otherwise("NOVEL"))
        .when(F.col("var_freq").isNull(), "NO_FREQ").when(F.col("var_freq") < cutoff, "RARE_ALLELE")
        .when(F.col("ref_freq") < cutoff, "RARE_REF").otherwise("COMMON"))
    return df.withColumn("population_class", label).withColumn(
        "population_fail", (~novel & ~F.col("population_class").isin("RARE_ALLELE")).cast("int"))


def sv_population_class(df: DataFrame, cutoff: float = 0.02) -> DataFrame:
    """RPT-1 for structural variants: match status ``filter_dgv`` and one frequency ``dgv_freq``.

    An event the catalogue does not hold is NOVEL, one whose status is N/A stays so; both pass. A
    matched one is judged by the frequency and its complement; without a frequency it is NO_FREQ and fails.
    """
    f = F.col("dgv_freq")
    novel = F.coalesce(F.col("filter_dgv").isin("PASS", "NOVEL", "N/A"), F.lit(False))
    label = (F.when(novel, F.when(F.col("filter_dgv") == "N/A", "N/A").otherwise("NOVEL")).when(f.isNull(), "NO_FREQ")
             .when(f < cutoff, "RARE_ALLELE").when(1 - f < cutoff, "RARE_REF").otherwise("COMMON"))
    return df.withColumn("population_class", label).withColumn(
        "population_fail", F.col("population_class").isin("NO_FREQ", "RARE_REF", "COMMON").cast("int"))


def apply_rules(df: DataFrame, minimum: dict[str, float] | None = None, not_changes: Sequence[str] = (),
                status_columns: Sequence[str] = (), population_reason: str = "filter_dbsnp", min_support: int | None = None) -> DataFrame:
    """RPT-2: ``final_status`` is OVERALL_PASS or the failed rules in rule order.

    Rules: a population class that fails (the reason is ``filter_dgv`` for structural variants), a
    column below its minimum, an excluded base change, fewer split and paired reads (``sr``, ``pe``,
    null for none) than ``min_support``, a status column that says FAIL or PREVIOUSLY_SEEN.
    """
    reasons = [F.when(F.col("population_fail") == 1, population_reason)]
    reasons += [F.when(F.col(c).try_cast("double") < v, f"{c} < {v:g}") for c, v in (minimum or {}).items()]
    if not_changes:
        reasons.append(F.when(F.concat_ws("->", "ref", "alt").isin(*not_changes), "base_change"))
    if min_support is not None:
        support = F.coalesce("sr", F.lit(0)) + F.coalesce("pe", F.lit(0))
        reasons.append(F.when(support < min_support, "Not enough supporting reads"))
    reasons += [F.when(F.col(c).rlike("FAIL|PREVIOUSLY_SEEN"), c) for c in status_columns]
    text = F.concat_ws(" , ", *reasons)
    return df.withColumn("final_status", F.when(text == "", PASS).otherwise(F.concat(F.lit("FAIL REASONS: "), text)))


def fail_synonymous(df: DataFrame) -> DataFrame:
    """RPT-3: a passing SNV without a protein change fails."""
    syn = (F.col("final_status") == PASS) & (F.col("exon_type") == "SYN") & (F.col("var_type") == "SNV")
    return df.withColumn("final_status", F.when(syn, "synonomous FAIL").otherwise(F.col("final_status")))


def filter_counts(df: DataFrame, filters: Sequence[str]) -> DataFrame:
    """RPT-4: pass and fail counts per filter column; N/A and empty cells are not counted."""
    long = df.select(*[F.col(f).cast("string") for f in filters]).unpivot([], list(filters), "filter", "outcome")
    return long.groupBy("filter").agg(
        count_if(F.col("outcome").isin("PASS", "1")).alias("pass"), count_if(F.col("outcome").isin("FAIL", "0")).alias("fail"))


def run_summary(df: DataFrame) -> DataFrame:
    """RPT-5: (section, item, n, percent) rows of a run.

    Counts by class and exon type with percentages of all variants, splice and exonic totals,
    and for passing rows the exonic / splice split, distinct genes, genes hit more than once and
    the medians of depth and quality. One grouping of the input feeds all counts.
    """
    cube = df.groupBy("var_class", "exon_type", (F.col("final_status") == PASS).alias("ok")).agg(F.count("*").alias("n"))
    splice = F.col("exon_type").contains("SPLICE")
    passing = df.where(F.col("final_status") == PASS)
    total = F.col("_all")
    sized = cube.withColumn("_all", cube.agg(F.sum("n")).scalar())

    def block(rows: DataFrame, section: str, item: Column) -> DataFrame:
        return rows.groupBy(item.alias("item")).agg(F.sum("n").alias("n"), F.max("_all").alias("_all")).select(
            F.lit(section).alias("section"), "item", F.col("n").cast("double").alias("n"),
            (F.col("n") / total * 100).alias("percent"))

    none = F.lit(None).cast("double")
    genes = passing.groupBy("gene").agg(F.count("*").alias("n"))
    repeated = genes.where("n > 1").select(F.lit("genes_hit_again").alias("section"), F.col("gene").alias("item"),
                                           F.col("n").cast("double").alias("n"), none.alias("percent"))
    n_genes = genes.agg(F.count("*").alias("n")).select(
        F.lit("passed").alias("section"), F.lit("distinct_genes").alias("item"), F.col("n").cast("double").alias("n"),
        none.alias("percent"))

    def median(col: str, item: str) -> DataFrame:
        one = passing.withColumn("_g", F.lit(1))
        return median_by(one, ["_g"], col).select(F.lit("passed").alias("section"), F.lit(item).alias("item"),
                                                  F.col("median").alias("n"), none.alias("percent"))

    parts = [
        block(sized, "class", F.lower("var_class")),
        block(sized.where(~splice), "exon_type", F.lower("exon_type")),
        block(sized.where(splice), "splice", F.col("exon_type")),
        block(sized, "place", F.when(splice, "splice").otherwise("exonic")),
        block(sized.where("ok"), "passed", F.when(splice, "splice").otherwise("exonic")),
        n_genes, median("depth", "median_depth"), median("quality", "median_quality"), repeated,
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def order_report(df: DataFrame) -> DataFrame:
    """RPT-6: type, splice rows last, depth descending, chromosome, coordinate; adds ``rank``.

    Rows that tie are ordered by their other columns from the left.
    """
    return with_rank(df, [F.col("var_type"), F.col("exon_type").contains("SPLICE").cast("int"), F.desc("depth"),
                          F.col("chrom"), F.col("start")]).orderBy("rank")


def order_cohort(df: DataFrame) -> DataFrame:
    """RPT-7: passing rows first, affected carriers descending, unaffected ascending, frequency, position; adds ``rank``.

    Rows that tie are ordered by their other columns from the left.
    """
    return with_rank(df, [
        (F.col("final_status") != PASS).cast("int"), F.desc("affected_carriers"), F.col("unaffected_carriers"),
        F.coalesce(F.col("var_freq"), F.lit(0.0)), chrom_rank(F.col("chrom")), F.col("start")]).orderBy("rank")


def tiers(df: DataFrame) -> DataFrame:
    """RPT-8: report tier of each row.

    With the catalogue rule on, rows without a frequency have already failed, so NO_FREQ stays
    empty unless that rule is off.
    """
    ok = F.col("final_status") == PASS
    return df.withColumn(
        "tier", F.when(~ok, "LOW_PRIORITY").when(F.col("population_class") == "RARE_ALLELE", "RARE")
        .when(F.col("population_class") == "NO_FREQ", "NO_FREQ").otherwise("NOVEL"))


# Markers shown for missing values in the cohort report (fixed values).
REPORT_MARKERS = {
    "aa_change": "NO_AA_CHANGE", "ens_trans": "NO_ENS_TRANS", "ens_gene": "NO_ENS_GENE", "poly_cat": "NO_POLY_CAT",
    "poly_score": "NO_POLY_SCORE", "sift_cat": "NO_SIFT_CAT", "sift_score": "NO_SIFT_SCORE", "cadd_phred": "NO_CADD_SCORE",
    "var_consequence": "N/A", "gnomad": "NO_GNOMAD", "domain": "NO_DOMAIN", "pubmed": "NO_PUBMED", "clin": "NO_CLIN",
    "rs": "NO_DBSNP", "gmaf": "NO_GMAF", "mean_af": "NO_MEAN_AF", "median_af": "NO_MEDIAN_AF",
    "var_read_count": "NO_VAR_READ_COUNT", "mgrb": "NO_MGRB",
}


def fill_sentinels(df: DataFrame, markers: dict[str, str] | None = None) -> DataFrame:
    """RPT-9: missing values shown by the column's marker."""
    marks = REPORT_MARKERS if markers is None else markers
    return df.withColumns({c: sentinel(F.col(c).cast("string"), m) for c, m in marks.items() if c in df.columns})


# Frequency points add up over every threshold passed (fixed values).
FREQ_POINTS = {0.05: 0.5, 0.02: 1.0, 0.005: 0.5}
UNKNOWN_FREQ_POINTS = {"N/A": 3.0, "No_freq": 3.0}
SNV_EXON_TYPES = ("MISSENSE", "NONSENSE", "SPLICE (1)", "SPLICE (2)", "SPLICE (3)")
INDEL_EXON_TYPES = ("EXON", "SPLICE (1)", "SPLICE (2)", "SPLICE (3)")


def variant_score(df: DataFrame, keywords: Sequence[str], gene_list: Sequence[str] = (),
                  exon_types: Sequence[str] = SNV_EXON_TYPES, damaging: bool = True, max_exac: float = 0.02,
                  sift_cutoff: float = 0.05, polyphen_cutoff: float = 0.7, cadd_cutoff: float = 10.0) -> DataFrame:
    """RPT-10: frequency + damaging + GO + phenotype points, for carried passing variants only.

    Reads text columns ``samples, proband, exon_type, final_status, exac, var_freq, sift_score,
    polyphen_score, cadd_phred, go, phenotype, gene`` with ``N/A`` for missing.
    """
    f = F.col("var_freq")
    freq = F.lit(0.0)
    for mark, points in UNKNOWN_FREQ_POINTS.items():
        freq = freq + F.when(f == mark, points).otherwise(0.0)
    for cutoff, points in FREQ_POINTS.items():
        freq = freq + F.when(f.try_cast("double") < cutoff, points).otherwise(0.0)
    harm = F.lit(0.0)
    if damaging:
        sift, poly, cadd = F.col("sift_score"), F.col("polyphen_score"), F.col("cadd_phred")
        harm = F.when((sift == "N/A") | (poly == "N/A") | (sift.try_cast("double") < sift_cutoff)
                      | (poly.try_cast("double") > polyphen_cutoff), 1.0).otherwise(0.0) + F.when(
            (cadd == "N/A") | (cadd.try_cast("double") > cadd_cutoff), 1.0).otherwise(0.0)
    words = F.array(*[F.lit(k) for k in keywords])
    go = F.when((F.col("go") == "NO_GO") | F.exists(words, lambda w: F.contains(F.col("go"), w)), 1.0).otherwise(0.0)
    pheno = F.when(F.exists(words, lambda w: F.contains(F.col("phenotype"), w)), 2.0).when(
        F.col("phenotype") == "NO_PHENOTYPE", 1.0).otherwise(0.0)
    exac_freq = F.get(F.split("exac", ":"), F.lit(1)).try_cast("double")
    eligible = (
        F.contains(F.col("samples"), F.col("proband")) & F.col("exon_type").isin(*exon_types) & (F.col("final_status") == PASS)
        & ((F.col("exac") == "N/A") | F.coalesce(exac_freq < max_exac, F.lit(False))))
    return df.withColumn("variant_score_total", F.when(eligible, freq + harm + go + pheno).otherwise(0.0)).withColumn(
        "gene_filter", F.col("gene").isin(*gene_list).cast("int") if gene_list else F.lit(0))


def indel_score(df: DataFrame, keywords: Sequence[str], gene_list: Sequence[str] = (), max_exac: float = 0.02) -> DataFrame:
    """RPT-11: the score without the damaging part, on the exon types of indels."""
    return variant_score(df, keywords, gene_list, INDEL_EXON_TYPES, damaging=False, max_exac=max_exac)


def collapse_samples(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """RPT-12: distinct values of each column over the samples of a variant, joined by ``; ``."""
    return df.groupBy(*keys).agg(*[sorted_text(F.col(c).cast("string"), "; ").alias(c) for c in cols])


def genotype_matrix(geno: DataFrame, keys: Sequence[str], samples: Sequence[str], absent: str = "?") -> DataFrame:
    """RPT-13: one column per listed sample. Pivot only at the end, with the list given."""
    wide = geno.groupBy(*keys).pivot("sample", list(samples)).agg(F.max("zyg"))
    return wide.fillna(absent, subset=list(samples))


def join_genotype_files(parts: dict[str, DataFrame], keys: Sequence[str], absent: str = "NA") -> DataFrame:
    """RPT-13, per-sample genotype files joined by marker: one long union, then one pivot."""
    long = None
    for sample, df in parts.items():
        one = df.select(*keys, F.lit(sample).alias("sample"), F.col("genotype").alias("zyg"))
        long = one if long is None else long.unionByName(one)
    return genotype_matrix(long, keys, list(parts), absent)


def cell_matrix(geno: DataFrame, pools: Sequence[str], known: DataFrame, keys: Sequence[str], cells: Sequence[str],
                max_gnomad: float = 0.001, max_no_call: int = 30) -> DataFrame:
    """RPT-14: cells coded 0 ref, 1 variant, 3 no call, for clean somatic variants.

    Kept: reference in every pool, no catalogue id, rare, and fewer than ``max_no_call`` cells
    without a call. ``known`` carries ``rs`` and ``gnomad`` per variant.
    """
    code = F.when(F.col("zyg") == "ref", 0).when(F.col("zyg") == "No data", 3).otherwise(1)
    in_pool, in_cells = F.col("sample").isin(*pools), F.col("sample").isin(*cells)
    # The choice of variants is made on the long form, so only kept variants are pivoted.
    per = geno.groupBy(*keys).agg(
        count_if(in_pool & (F.col("zyg") == "ref")).alias("_r"), count_if(in_cells & (code != 3)).alias("_called"))
    keep = per.where((F.col("_r") == len(pools)) & (F.lit(len(cells)) - F.col("_called") < max_no_call)).select(*keys)
    listed = known.where(F.col("rs").isNotNull() | (F.col("gnomad") > max_gnomad)).select(*keys)
    clean = keep.join(listed, list(keys), "left_anti")
    body = geno.where(in_cells).withColumn("_c", code).join(clean, list(keys), "left_semi")
    return body.groupBy(*keys).pivot("sample", list(cells)).agg(F.max("_c")).fillna(3, subset=list(cells))


def sort_by_column(df: DataFrame, column: str) -> DataFrame:
    """RPT-15: any report column, numeric descending; adds ``rank``.

    Text and missing values count as 0 and follow the numbers that are 0. Rows that tie are ordered
    by chromosome and position where the report has them, then by their columns from the left, so a
    column of text alone still fills every range of the sort.
    """
    number = F.col(column).try_cast("double")
    locus = ([chrom_rank(F.col("chrom"))] if "chrom" in df.columns else []) + ([F.col("start")] if "start" in df.columns else [])
    return with_rank(df, [F.desc(F.coalesce(number, F.lit(0.0))), number.isNull().cast("int"), *locus]).orderBy("rank")


def filter_ledger(results: DataFrame) -> DataFrame:
    """RPT-16: matched and unmatched results per filter."""
    return results.groupBy("filter_name").agg(
        count_if(F.col("filtermatch") == 1).alias("match"), count_if(F.col("filtermatch") == 0).alias("nomatch"))


def average_quality(df: DataFrame) -> DataFrame:
    """RPT-17: quality per allele, by the record's own count or else by the total of the site."""
    site = with_totals(df, ["chrom", "start", "end"], _site=F.sum(F.coalesce("ac", F.lit(0))))
    own = F.when(F.col("total_ac") > 0, F.col("total_ac"))
    by = F.coalesce(own, F.when(F.col("_site") > 0, F.col("_site")))
    return site.withColumn("average_quality", F.col("qual") / by).drop("_site")


def group_listing(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """RPT-18: priority variants keyed by position, gene and change, with the counts per group."""
    change = F.coalesce("aa_change", "consequence")
    key = F.concat_ws(":", "chrom", "start", "end", "bases", "gene", change)
    return df.where("priority").select(key.alias("variant"), *groups)


def assemble_lines(calls: DataFrame, genes: DataFrame, filters: DataFrame, gene_columns: Sequence[str],
                   filter_columns: Sequence[str], headers: Sequence[str]) -> DataFrame:
    """RPT-19: report lines from calls, gene columns by locus and filter columns by call id.

    Several genes are joined by commas; a call outside every gene says so. Each side is one
    row per key before the join. ``headers`` chooses and orders the output.
    """
    at = ["chrom", "start", "end"]
    per_locus = genes.groupBy(*at).agg(*[sorted_text(F.col(c)).alias(c) for c in gene_columns])
    per_call = filters.select("id", *filter_columns)
    out = calls.join(per_locus, at, "left").join(per_call, "id", "left")
    fill = {c: F.coalesce(F.col(c), F.lit("No gene overlap")) for c in gene_columns}
    fill |= {c: F.coalesce(F.col(c).cast("string"), F.lit("N/A")) for c in filter_columns}
    return out.withColumns(fill).select(*headers)


def pass_counts(geno: DataFrame, keys: Sequence[str]) -> DataFrame:
    """RPT-20: samples that pass (a genotype with allele 1), samples without a pass (``.``), and the carriers.

    Any other genotype is an error.
    """
    carrier = F.when(F.col("gt").rlike("(^|[/|])1($|[/|])"), True).when(F.col("gt") == ".", False).otherwise(
        F.raise_error(F.concat(F.lit("genotype without allele 1: "), F.coalesce("gt", F.lit("null")))).cast("boolean"))
    per = geno.groupBy(*keys).agg(
        count_if(carrier).alias("pass_count"), count_if(~carrier).alias("nopass_count"),
        sorted_text(F.when(carrier, F.col("sample"))).alias("carriers"))
    return per.withColumn("pass_percent", ratio(F.col("pass_count"), F.col("pass_count") + F.col("nopass_count"), 100.0))
