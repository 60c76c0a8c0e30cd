"""Jobs over sequence and feature tables (SEQ-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoloom.functions.sequence import revcomp, translate_codons
from genoloom.operators.chunks import once, running_sum


def assembly_stats(seqs: DataFrame, seq: str = "seq") -> DataFrame:
    """SEQ-1: one row of assembly figures.

    N50 is the length at which the longest contigs reach half of the total; L50 counts the
    contigs before that one. Contigs are counted per length first, so the cumulative sum runs
    over distinct lengths, in chunks.
    """
    base = seqs.select(F.length(seq).cast("bigint").alias("len"),
                       F.length(F.regexp_replace(seq, "[Nn]", "")).cast("bigint").alias("nfree"))
    plain = base.agg(
        F.count("*").alias("contigs"), F.sum("len").alias("total"), F.sum("nfree").alias("n_free"), F.max("len").alias("longest"),
        *[F.count(F.when(F.col("len") > n, 1)).alias(f"over_{tag}") for n, tag in ((100_000, "100k"), (1_000_000, "1m"), (10_000_000, "10m"))])
    by_len = base.groupBy("len").agg(F.count("*").alias("n")).withColumn("_mass", F.col("len") * F.col("n"))
    chunk = -F.floor(F.col("len") / 1024)
    cum = running_sum(by_len, [], [F.desc("len")], chunk, "_mass", "_upto")
    cum = running_sum(cum, [], [F.desc("len")], chunk, "n", "_count")
    half = base.agg((F.sum("len") / 2).alias("h")).scalar()
    reach = cum.withColumn("_half", half).where(F.col("_upto") >= F.col("_half"))
    # Empty contigs come last and reach the half too; dividing by their length gives null, which leaves the 1.
    need = F.greatest(F.ceil(F.try_divide(F.col("_half") - (F.col("_upto") - F.col("_mass")), F.col("len"))), F.lit(1))
    best = reach.agg(F.max(F.struct("len", (F.col("_count") - F.col("n") + need - 1).alias("l50"))).alias("b"))
    return plain.withColumn("n50", best.select("b.len").scalar()).withColumn("l50", best.select("b.l50").scalar())


def edit_sequences(seqs: DataFrame, start: int, end: int, mode: str, headers: DataFrame | None = None) -> DataFrame:
    """SEQ-2: ``extract`` a range, ``cut`` it out, ``mask`` it with N, or ``remove`` whole sequences.

    With a header list only those sequences are edited and the others pass unchanged
    (``extract`` then returns the listed ones only). ``removed`` holds what was taken out.
    """
    size = end - start + 1
    s = F.col("seq")
    part = F.substr(s, F.lit(start), F.lit(size))
    before, after = F.substr(s, F.lit(1), F.lit(start - 1)), F.substr(s, F.lit(end + 1), F.length(s))
    edited = {"extract": part, "cut": F.concat(before, after), "mask": F.concat(before, F.lit("N" * size), after),
              "remove": F.lit(None).cast("string")}[mode]
    taken = {"extract": F.lit(None).cast("string"), "cut": part, "mask": part, "remove": s}[mode]
    if headers is None:
        out = seqs.select("header", edited.alias("seq"), taken.alias("removed"))
    else:
        on = headers.select("header", F.lit(1).alias("_on")).distinct()
        tagged = seqs.join(on, "header", "left_semi" if mode == "extract" else "left")
        if mode == "extract":
            return tagged.select("header", edited.alias("seq"), taken.alias("removed"))
        hit = F.col("_on") == 1
        out = tagged.select("header", F.when(hit, edited).otherwise(s).alias("seq"), F.when(hit, taken).alias("removed"))
    return out


def reverse_complement(seqs: DataFrame, seq: str = "seq") -> DataFrame:
    """SEQ-3."""
    return seqs.withColumn("revcomp", revcomp(F.col(seq)))


def translate(seqs: DataFrame, seq: str = "seq") -> DataFrame:
    """SEQ-4: protein of the first frame, stop as ``_``."""
    return seqs.withColumn("protein", translate_codons(F.col(seq)))


FRAMES = ("f1", "f2", "f3", "r1", "r2", "r3")


def six_frames(seqs: DataFrame, seq: str = "seq") -> DataFrame:
    """SEQ-5: proteins of all six frames (``*`` is a stop), in frame order as an array of structs."""
    def frame(i: int) -> Column:
        strand = F.col(seq) if i < 3 else F.col("_rev")
        text = F.substr(strand, F.lit(i % 3 + 1), F.length(strand))
        return F.struct(F.lit(FRAMES[i]).alias("frame"), F.translate(translate_codons(text), "_", "*").alias("protein"))

    turned = once(seqs, _rev=revcomp(F.col(seq)))
    return once(turned, frames=F.array(*[frame(i) for i in range(6)])).drop("_rev")


def best_frame(seqs: DataFrame, seq: str = "seq") -> DataFrame:
    """SEQ-5: the frame with fewest stops (first in order on a tie), from its first M; longer than one residue."""
    scored = F.transform("frames", lambda f, i: F.struct(
        (F.length(f["protein"]) - F.length(F.translate(f["protein"], "*", ""))).alias("stops"), i.alias("i"),
        f["frame"].alias("frame"), f["protein"].alias("protein")))
    best = once(six_frames(seqs, seq), b=F.array_min(scored))
    orf = F.regexp_extract("b.protein", r"(M.*)", 1)
    return best.select("header", F.col("b.frame").alias("frame"), F.col("b.stops").alias("stops"), orf.alias("protein")).where(
        F.length("protein") > 1)


def pairwise_contrasts(counts: DataFrame, taxonomy: DataFrame, pseudo: float = 1.0) -> DataFrame:
    """SEQ-6: every pair of conditions per feature with base mean and log2 ratio, joined with taxonomy.

    ``counts`` is long (feature, condition, value). Means are taken first, so a feature has one
    row per condition and pairs are bounded by the conditions.
    """
    means = counts.groupBy("feature", "condition").agg(F.avg("value").alias("mean"))
    a = means.select("feature", F.col("condition").alias("first"), F.col("mean").alias("_a"))
    b = means.select("feature", F.col("condition").alias("second"), F.col("mean").alias("_b"))
    pairs = a.join(b, "feature").where(F.col("first") < F.col("second"))
    return pairs.select(
        F.concat_ws("_vs_", "first", "second").alias("pair"), "feature", ((F.col("_a") + F.col("_b")) / 2).alias("base_mean"),
        F.log2((F.col("_a") + pseudo) / (F.col("_b") + pseudo)).alias("log2_fold")).join(taxonomy, "feature", "left")


def fold_direction(df: DataFrame, first: str, second: str, min_sum: float = 10, pseudo: float = 0.1) -> DataFrame:
    """SEQ-7: UP or DOWN between two conditions with its ratio; all-zero and low rows drop out."""
    a, b = F.col(first), F.col(second)
    return df.where(((a != 0) | (b != 0)) & (a + b > min_sum)).withColumn(
        "direction", F.when(a >= b, "DOWN").otherwise("UP")).withColumn(
        "ratio", F.when(a >= b, a / (b + pseudo)).otherwise(b / (a + pseudo)))
