"""Row filters and flags (FLT-*). Thresholds are arguments; aggregates come from other operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.functions.zygosity import carries
from genoloom.operators.intervals import overlap_any

# Chromosome lengths used by the completeness check (fixed values: human GRCh37, mouse GRCm38).
HUMAN_LENGTHS = {
    "1": 249250621, "2": 243199373, "3": 198022430, "4": 191154276, "5": 180915260, "6": 171115067,
    "7": 159138663, "8": 146364022, "9": 141213431, "10": 135534747, "11": 135006516, "12": 133851895,
    "13": 115169878, "14": 107349540, "15": 102531392, "16": 90354753, "17": 81195210, "18": 78077248,
    "19": 59128983, "20": 63025520, "21": 48129895, "22": 51304566, "X": 155270560, "Y": 59373566,
}
MOUSE_LENGTHS = {
    "1": 195471971, "2": 182113224, "3": 160039680, "4": 156508116, "5": 151834684, "6": 149736546,
    "7": 145441459, "8": 129401213, "9": 124595110, "10": 130694993, "11": 122082543, "12": 120129022,
    "13": 120421639, "14": 124902244, "15": 104043685, "16": 98207768, "17": 94987271, "18": 90702639,
    "19": 61431566, "X": 171031299, "Y": 91744698,
}
# Human chromosomes whose unsequenced start makes the first-call test meaningless (fixed values).
LATE_START = ("13", "14", "15", "21", "22")


def call_filter(calls: DataFrame, min_depth: int, max_depth: int, min_quality: dict[str, int], min_clr: int = 0,
                targeted: bool = False, tumour: bool = False, caller_pass: bool = False,
                classes: Sequence[str] = ("ALL",)) -> DataFrame:
    """FLT-1: depth window, per-type quality, tumour score, or the caller's own PASS mark."""
    keep = F.lit(True) if "ALL" in classes else F.col("snv_class").isin(*classes)
    if caller_pass and not tumour:
        return calls.where(keep & F.col("filter").contains("PASS"))
    quality = F.lit(None)
    for kind, cutoff in min_quality.items():
        quality = F.when(F.col("var_type") == kind, F.lit(cutoff)).otherwise(quality)
    keep &= (F.col("depth") >= min_depth) & (F.col("qual") >= quality)
    if not targeted:
        keep &= F.col("depth") <= max_depth
    if tumour:
        score = F.regexp_extract("clr", r"(\d+)", 1).try_cast("int")
        keep &= (F.col("clr") != "NO_CLR") & (score >= min_clr)
    return calls.where(keep)


def drop_unknown_bases(df: DataFrame, *cols: str) -> DataFrame:
    """FLT-2."""
    keep = F.lit(True)
    for c in cols:
        keep &= ~F.upper(F.col(c)).contains("N")
    return df.where(keep)


def in_region(df: DataFrame, chrom: str, start: int | None = None, end: int | None = None,
              pos: str = "start") -> DataFrame:
    """FLT-3: a literal predicate, so partitions and row groups are pruned."""
    out = df.where(F.col("chrom") == chrom)
    if start is not None:
        out = out.where(F.col(pos) >= start)
    if end is not None:
        out = out.where(F.col(pos) <= end)
    return out


def gene_include(df: DataFrame, genes: DataFrame) -> DataFrame:
    """FLT-4."""
    return df.join(genes.select("gene").distinct(), "gene", "left_semi")


def gene_exclude(df: DataFrame, problem: DataFrame) -> DataFrame:
    """FLT-5: rows of problem genes are marked, the others pass."""
    marked = problem.select("gene", F.lit("problem_gene FAIL").alias("gene_status")).distinct()
    return df.join(marked, "gene", "left").withColumn("gene_status", F.coalesce("gene_status", F.lit("PASS")))


def prediction_filter(df: DataFrame, polyphen: str | None = None, sift: str | None = None,
                      max_allele_freq: float | None = None) -> DataFrame:
    """FLT-6: a frequency that is not a number fails the frequency rule."""
    out = df
    if polyphen is not None:
        out = out.where(F.col("polyphen_prediction") == polyphen)
    if sift is not None:
        out = out.where(F.col("sift_prediction") == sift)
    if max_allele_freq is not None:
        out = out.where(F.col("var_allele_freq").try_cast("double") <= max_allele_freq)
    return out


def quality_preset(name: str, n_samples: int) -> dict[str, float]:
    """The two presets of the cohort filter: few samples, or a large cohort."""
    if name == "strict":
        return {"min_mean_af": 0.3, "max_nocall": 10, "min_samples": n_samples // 2}
    return {"min_mean_af": 0.1, "max_nocall": 2, "min_samples": n_samples // 10}


def cohort_filter(df: DataFrame, min_mean_af: float = 0.0, max_nocall: int | None = None,
                  min_samples: int = 0) -> DataFrame:
    """FLT-7 on the counts of a cohort; a missing mean AF is not held against a variant."""
    keep = F.coalesce(F.col("mean_af") >= min_mean_af, F.lit(True)) & (F.col("var_count") >= min_samples)
    if max_nocall is not None:
        keep &= F.col("no_call_count") <= max_nocall
    return df.where(keep)


def seen_in_samples(df: DataFrame, carriers: DataFrame, samples: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """FLT-8: variants carried by at least one chosen sample."""
    return df.join(carriers.where(F.col("sample").isin(*samples)).select(*keys), list(keys), "left_semi")


def somatic_only(df: DataFrame, carriers: DataFrame, samples: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """FLT-9: variants that a sample of the list carries and none outside it."""
    return seen_in_samples(df, carriers, samples, keys).join(carriers.where(~F.col("sample").isin(*samples)).select(*keys), list(keys), "left_anti")


def subtract_controls(df: DataFrame, carriers: DataFrame, controls: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """FLT-10."""
    return df.join(carriers.where(F.col("sample").isin(*controls)).select(*keys), list(keys), "left_anti")


def rare_damaging(df: DataFrame, cutoff: float = 0.02) -> DataFrame:
    """FLT-11: ``priority`` flag from amino-acid change, consequence and all listed frequencies."""
    damaging = F.col("aa_change").isNotNull() | F.coalesce(
        F.col("consequence").rlike("frameshift|stop_gained"), F.lit(False))
    rare_gmaf = F.coalesce(
        F.forall(F.split("gmaf", ","), lambda x: F.coalesce(x.try_cast("double") <= cutoff, F.lit(True))), F.lit(True))
    rare_pop = F.coalesce(F.col("gnomad").try_cast("double") <= cutoff, F.lit(True))
    return df.withColumn("priority", damaging & rare_gmaf & rare_pop)


def priority_gene(df: DataFrame, genes: DataFrame, only: bool = False) -> DataFrame:
    """FLT-12: YES / NO flag, or only the rows of priority genes."""
    listed = genes.select("gene").distinct()
    if only:
        return df.join(listed, "gene", "left_semi").withColumn("priority_gene", F.lit("YES"))
    flagged = listed.withColumn("priority_gene", F.lit("YES"))
    return df.join(flagged, "gene", "left").withColumn("priority_gene", F.coalesce("priority_gene", F.lit("NO")))


def single_cell_support(df: DataFrame, min_total: float = -1, min_var: float = -1, min_portion: float = -1) -> DataFrame:
    """FLT-13: total (variant + reference cells), variant cells and portion, all strictly above."""
    return df.where(
        (F.col("var_cells") + F.col("ref_cells") > min_total) & (F.col("var_cells") > min_var)
        & (F.round(F.col("pct_variant").cast("int") / 100, 2) > min_portion))


def pedigree_filter(df: DataFrame, min_affected: int | None = None, inheritance: str | None = None,
                    de_novo: bool = False, compound_het: bool = False) -> DataFrame:
    """FLT-14."""
    keep = F.lit(True)
    if min_affected is not None:
        keep &= F.col("affected_carriers") >= min_affected
    if inheritance is not None:
        keep &= F.col("disease_inheritance") == inheritance
    if de_novo:
        keep &= F.col("mendel").contains("de novo")
    if compound_het:
        keep &= F.col("def_com_het") != "No"
    return df.where(keep)


def pileup_threshold(df: DataFrame, min_freq: float = 0.0, min_reads: int = 1) -> DataFrame:
    """FLT-15 on the allele table of a pileup."""
    return df.where((F.col("max_alt_freq") >= min_freq) & (F.col("max_alt_reads") >= min_reads))


def sv_length_status(df: DataFrame, max_length: int = 100_000) -> DataFrame:
    """FLT-16: append the length reason to the status of long events other than inversions."""
    long = (F.col("length") > max_length) & (F.col("sv_type") != "inv")
    return df.withColumn(
        "final_status",
        F.when(long & F.col("final_status").contains("PASS"), "FAIL_REASONS: length_fail")
        .when(long, F.concat(F.col("final_status"), F.lit(",length_fail"))).otherwise(F.col("final_status")))


def sv_min_length(df: DataFrame, floor: int = 100) -> DataFrame:
    """FLT-16, size floor."""
    return df.where(F.col("length") >= floor)


def genotype_qc(df: DataFrame, min_qual: float = 40, min_gq: float | None = None) -> DataFrame:
    """FLT-17: quality strictly above the cutoff unless missing; a low GQ only removes equal-allele calls."""
    out = df.where(F.col("qual").isNull() | (F.col("qual") > min_qual))
    if min_gq is not None:
        alleles = F.split("gt", r"[/|]")
        out = out.where((F.col("gq") >= min_gq) | (alleles[0] != alleles[1]))
    return out


def sample_allele_only(df: DataFrame) -> DataFrame:
    """FLT-17: keep the row of the last non-reference allele of the chosen sample's genotype."""
    numbers = F.filter(F.split("gt", r"[/|]"), lambda x: ~x.isin("0", "."))
    return df.where(F.try_element_at(numbers, F.lit(-1)).try_cast("int") == F.col("allele_no"))


def callset_qc(geno: DataFrame, keys: Sequence[str], min_call_rate: float = 0.9, min_maf: float = 0.01) -> DataFrame:
    """FLT-18: variants genotyped in enough samples with a minor allele that is frequent enough."""
    called = F.col("zyg") != "No data"
    dose = F.when(F.col("zyg") == "het", 1).when(F.col("zyg") == "hom", 2).otherwise(0)
    per = geno.groupBy(*keys).agg(
        F.count("*").alias("n_samples"), F.count(F.when(called, 1)).alias("n_called"), F.sum(dose).alias("alt_alleles"))
    af = F.col("alt_alleles") / (2 * F.col("n_called"))
    per = per.withColumn("maf", F.when(F.col("n_called") > 0, F.least(af, 1 - af)))
    return per.where((F.col("n_called") / F.col("n_samples") > min_call_rate) & (F.col("maf") > min_maf))


def support_ratio(df: DataFrame, total: str, support: str, min_reads: int = 2, min_fraction: float = 0.8) -> DataFrame:
    """FLT-19."""
    return df.where((F.col(total) >= min_reads) & (F.col(support) / F.col(total) >= min_fraction))


def variant_class(df: DataFrame, kinds: Sequence[str], regions: DataFrame | None = None) -> DataFrame:
    """FLT-20: variant types, and optionally only inside a region list."""
    out = df.where(F.col("var_type").isin(*kinds))
    return out if regions is None else overlap_any(out, regions)


def exists_in(df: DataFrame, store: DataFrame, with_bases: bool = False, sv: bool = False) -> DataFrame:
    """FLT-21: rows found in a variant store by coordinates, with bases, or with SV caller and type."""
    keys = ["chrom", "start", "end"] + (["bases"] if with_bases else []) + (["caller", "sv_type"] if sv else [])
    return df.join(store.select(*keys), keys, "left_semi")


def completeness(calls: DataFrame, organism: str = "human", sequence_type: str = "genome", chrom: str = "all",
                 pos: str = "pos") -> DataFrame:
    """FLT-22: first failed test per chromosome, ``ok`` or ``skipped``, and whether the set is complete.

    ``targeted`` and ``exome`` sets are not tested. X and Y are skipped. ``enough_chromosomes``
    compares the number of chromosomes seen with the organism's.
    """
    lengths = HUMAN_LENGTHS if organism == "human" else MOUSE_LENGTHS
    expected = 23 if organism == "human" else 20
    table = F.create_map(*[F.lit(x) for kv in lengths.items() for x in kv])
    stats = calls.groupBy("chrom").agg(
        F.min(pos).alias("first"), F.max(pos).alias("last"), F.count("*").alias("n"))
    seen = calls.agg(F.count_distinct("chrom")).scalar()
    length = F.element_at(table, F.col("chrom"))
    late = F.lit(0.01 if organism == "human" else 0.1)
    exempt = F.col("chrom").isin(*LATE_START) if organism == "human" else F.lit(False)
    skip = F.col("chrom").isin("X", "Y") | length.isNull() | F.lit(sequence_type in ("targeted", "exome"))
    if chrom != "all":
        skip |= F.col("chrom") != chrom
    sparse = (F.col("n") / length < 0.0001) & F.lit(sequence_type == "genome")
    verdict = (
        F.when(skip, "skipped").when(sparse, "too_sparse")
        .when((F.col("first") / length > late) & ~exempt, "late_start")
        .when(F.col("last") / length < 0.99, "early_end").otherwise("ok"))
    enough = F.lit(True) if chrom != "all" or sequence_type in ("targeted", "exome") else seen >= expected
    return stats.withColumn("verdict", verdict).withColumn("enough_chromosomes", enough)


def reads_for_coverage(genome_size: int, read_span: int, coverage: float) -> int:
    """Reads needed for a mean coverage."""
    return int(genome_size / read_span) * int(coverage)


def downsample(reads: DataFrame, read_id: str, wanted: Column | int, total: Column | int) -> DataFrame:
    """FLT-23: keep about ``wanted`` of ``total`` reads by a hash of the read id.

    Mates share an id and stay together, and the choice is the same on every run and cluster.
    """
    share = F.lit(wanted) / (F.lit(total) if isinstance(total, int) else total)
    place = F.conv(F.substring(F.md5(F.col(read_id).cast("string")), 1, 8), 16, 10).cast("bigint")
    return reads.where(place < share * F.lit(2**32))


def carriers_only(geno: DataFrame) -> DataFrame:
    return geno.where(carries(F.col("zyg")))
