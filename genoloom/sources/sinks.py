"""SNK-*: writers. Layout decisions are made here; no writer gathers data on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoloom.functions.alleles import key_text
from genoloom.functions.text import norm_chrom


def format_normalised(calls: DataFrame) -> DataFrame:
    """SNK-1: the text line of each normalised call, genotypes last."""
    fixed = F.concat_ws(
        ";", "var_type", key_text(F.col("chrom"), F.col("start"), F.col("end"), F.col("bases")),
        F.concat(F.lit("Q="), F.coalesce(F.regexp_replace(F.col("qual").cast("string"), r"\.0$", ""), F.lit("N/A"))),
        F.concat(F.lit("AC="), F.coalesce(F.col("ac"), F.lit(0)).cast("string")),
        F.concat(F.lit("ZC="), F.col("allele_no").cast("string")),
        F.concat(F.lit("ALLELE="), F.col("allele")),
        F.concat(F.lit("MEANAF="), F.format_string("%.3f", "mean_af")),
        F.concat(F.lit("MEDAF="), F.format_string("%.3f", "median_af")),
        F.concat(F.lit("VAR_READ_COUNTS="), F.col("var_read_counts")),
        F.when(F.col("var_type") == "INS", F.concat(F.lit("REF="), F.col("ref_base"))))
    return calls.select(F.concat_ws(
        "\t", norm_chrom(F.col("chrom")), F.col("start").cast("string"), F.col("end").cast("string"), fixed,
        F.array_join("samples", "\t")).alias("line"))


def write_normalised(calls: DataFrame, path: str) -> None:
    """SNK-1."""
    format_normalised(calls).write.mode("error").text(path)


def _laid_out(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range-partitioned and sorted by the keys: a partition value is split over as many tasks as
    its size needs, and each task opens few output folders."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_by_chrom(df: DataFrame, path: str, sep: str = "\t") -> None:
    """SNK-2: one folder per chromosome, sorted by position inside."""
    _laid_out(df, ["chrom", "start"]).write.partitionBy("chrom").option("sep", sep).csv(path)


def write_variant_store(df: DataFrame, path: str) -> None:
    """SNK-3: variant x filter x attribute rows, by chromosome and filter, sorted for row-group pruning."""
    _laid_out(df, ["chrom", "filter", "start"]).write.partitionBy("chrom", "filter").parquet(path)


def write_report_tiers(df: DataFrame, path: str) -> None:
    """SNK-4: one folder per report tier."""
    _laid_out(df, ["tier", "chrom", "start"]).write.partitionBy("tier").parquet(path)


def bulk_insert(df: DataFrame, path: str) -> None:
    """SNK-5: append rows to a table folder."""
    df.write.mode("append").parquet(path)


def without_filter(results: DataFrame, run_id: int, filter_name: str) -> DataFrame:
    """SNK-6: all results but those of one filter of one run."""
    gone = (F.col("run_id") == run_id) & (F.col("filter_name") == filter_name)
    return results.where(~F.coalesce(gone, F.lit(False)))


def delete_filter(spark, path: str, new_path: str, run_id: int, filter_name: str) -> None:
    """SNK-6: write the store without one filter's rows of a run as a new version.

    A lost executor or a failed job leaves the old version whole; the caller switches paths.
    """
    kept = without_filter(spark.read.parquet(path), run_id, filter_name)
    kept.write.partitionBy("filter_name").parquet(new_path)


def append_new(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """SNK-7: append the entries whose keys are not in the table yet.

    The anti-join reads the table as it is before the append.
    """
    spark = df.sparkSession
    have = spark.read.schema(df.schema).parquet(path).select(*keys)
    df.dropDuplicates(list(keys)).join(have, list(keys), "left_anti").write.mode("append").parquet(path)


def route_by_group(reads: DataFrame, groups: DataFrame, barcode: str = "barcode", group: str = "cell_type") -> DataFrame:
    """SNK-8: reads with the group of their barcode; reads of unlisted barcodes are left out."""
    lone = groups.groupBy(barcode).agg(F.min(group).alias(group))
    return reads.join(lone, barcode)


def write_by_group(reads: DataFrame, groups: DataFrame, path: str, barcode: str = "barcode",
                   group: str = "cell_type") -> None:
    """SNK-8: one output folder per group."""
    _laid_out(route_by_group(reads, groups, barcode, group), [group, "chrom", "pos"]).write.partitionBy(group).parquet(path)


def report_to_long(report: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """SNK-9: (keys, column_number, column_name, column_value) rows; single quotes become double."""
    text = report.select(*keys, *[F.regexp_replace(F.col(c).cast("string"), "'", '"').alias(c) for c in columns])
    long = text.unpivot(list(keys), list(columns), "column_name", "column_value")
    numbers = F.create_map(*[F.lit(x) for i, c in enumerate(columns) for x in (c, i)])
    return long.withColumn("column_number", F.element_at(numbers, F.col("column_name")))


def write_report_rows(report: DataFrame, path: str, keys: Sequence[str], columns: Sequence[str]) -> None:
    """SNK-9: the long rows, one folder per column so that one column can be read alone."""
    _laid_out(report_to_long(report, keys, columns), ["column_name", *keys]).write.partitionBy("column_name").parquet(path)
