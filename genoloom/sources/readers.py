"""SRC-*: text inputs as typed frames.

Each reader is ``spark.read.text`` plus a line parser that takes a frame with a ``line``
column. Nothing is inferred from the data, so a reader is one narrow pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoloom.functions import alleles
from genoloom.functions.text import norm_chrom
from genoloom.operators.chunks import once


ORIGIN = ("path",)  # where a line comes from, kept by the parsers where the rows have it


def _origin(rows: DataFrame) -> list[str]:
    return [c for c in ORIGIN if c in rows.columns]


def _cells(rows: DataFrame, sep: str = "\t") -> DataFrame:
    """Fields of each data line as ``f``, split once; header and blank lines are dropped."""
    return once(rows.select("line", *_origin(rows)), f=F.split("line", sep)).where(
        (F.size("f") > 1) & ~F.startswith(F.get("f", F.lit(0)), F.lit("#"))).drop("line")


def lines(spark: SparkSession, path) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "line")


def file_lines(spark: SparkSession, path) -> DataFrame:
    """Lines with the ``path`` of their file, for inputs of many files that must be told apart."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path"))


def parse_vcf(rows: DataFrame) -> DataFrame:
    """SRC-1: one row per usable alternate allele, with its key and the untouched genotype fields.

    Header and blank lines, records with N or a ``.`` alternate, ``*`` alleles and alleles equal
    to REF are dropped. Allele counts are taken by allele number. A ``path`` column is kept.
    """
    f = F.col("f")
    body = _cells(rows).select(
        *_origin(rows), norm_chrom(f[0]).alias("chrom"), f[1].cast("bigint").alias("pos"), f[3].alias("ref"), f[4].alias("alts"),
        F.when(f[5] != ".", f[5].try_cast("double")).alias("qual"), F.get(f, F.lit(6)).alias("filter"),
        F.get(f, F.lit(7)).alias("info"), F.get(f, F.lit(8)).alias("format"),
        F.slice(f, 10, F.greatest(F.size(f) - 9, F.lit(0))).alias("samples"),
    )
    kept = body.where(~F.col("ref").contains("N") & ~F.col("alts").contains("N") & (F.col("alts") != "."))
    one = kept.select("*", F.posexplode(F.split("alts", ",")).alias("_i", "alt")).withColumn(
        "allele_no", F.col("_i") + 1).drop("_i")
    ac_text = F.regexp_extract("info", r"(?:^|;)AC=([0-9,]+)", 1)
    ac = F.transform(F.filter(F.split(ac_text, ","), lambda x: x != ""), lambda x: x.cast("bigint"))
    af = F.split(F.regexp_extract("info", r"(?:^|;)AF=([^;]+)", 1), ",")
    usable = one.where((F.col("alt") != "*") & (F.col("alt") != F.col("ref")))
    placed = once(usable, _d=alleles.first_difference(F.col("ref"), F.col("alt")))
    return (
        once(placed, _k=alleles.vcf_key(F.col("pos"), F.col("ref"), F.col("alt"), F.col("_d")))
        .withColumn("ac", F.get(ac, F.col("allele_no") - 1))
        .withColumn("total_ac", F.aggregate(ac, F.lit(0).cast("bigint"), lambda a, x: a + x))
        .withColumn("an", F.coalesce(F.regexp_extract("info", r"AN=(\d+)", 1).try_cast("bigint"), F.lit(0)))
        .withColumn("info_af", F.get(af, F.col("allele_no") - 1).try_cast("double"))
        .select(*_origin(rows), "chrom", "_k.*", "pos", "ref", "alt", "allele_no", "qual", "filter", "info", "format", "samples",
                "ac", "total_ac", "an", "info_af")
    )


def read_vcf(spark: SparkSession, path) -> DataFrame:
    """SRC-1."""
    return parse_vcf(lines(spark, path))


VCF_FIXED = 9  # columns before the first sample


def sample_names(rows: DataFrame) -> DataFrame:
    """SRC-1: (path, names) of files, from their ``#CHROM`` line; a file with two different ones is an error."""
    heads = rows.where(F.startswith("line", F.lit("#CHROM"))).select("path", F.split(F.rtrim("line"), "\t").alias("f"))
    named = heads.select("path", F.slice("f", VCF_FIXED + 1, F.greatest(F.size("f") - VCF_FIXED, F.lit(1))).alias("names"))
    one = named.groupBy("path").agg(F.min("names").alias("names"), F.max("names").alias("_other"))
    clash = F.raise_error(F.concat(F.lit("different #CHROM lines in "), F.col("path")))
    return one.select("path", F.when(F.col("names") == F.col("_other"), F.col("names")).otherwise(clash).alias("names"))


def parse_vcf_genotypes(rows: DataFrame) -> DataFrame:
    """SRC-1 for files with samples: one row per file, allele and sample, under the sample's name.

    ``rows`` has ``line`` and ``path``. The records of a file are joined with its header: one row
    for each file, which Spark broadcasts where it is small, and splits the records of a large file
    where it is not. Adds ``sample``, ``fields`` (its genotype column) and ``gt``. A file with genotypes
    but no ``#CHROM`` line, or with another number of names than genotypes, is an error; a name that
    occurs twice in a file is one sample listed twice, and one name in two files is told apart by ``path``.
    Files without genotype columns give no rows.
    """
    records = parse_vcf(rows).where(F.size("samples") > 0)
    joined = records.join(sample_names(rows), "path", "left")
    found = F.coalesce(F.size("names"), F.lit(0))
    wrong = F.raise_error(F.concat(F.lit("genotypes and sample names differ in "), F.col("path"))).cast("array<string>")
    names = F.when(found == F.size("samples"), F.col("names")).otherwise(wrong)
    each = joined.select("*", F.explode(F.arrays_zip(names.alias("sample"), F.col("samples").alias("fields"))).alias("_g"))
    at = F.array_position(F.split("format", ":"), "GT").cast("int")
    text = F.split("fields", ":")
    return each.select("path", "_g.sample", *[c for c in joined.columns if c not in ("path", "samples", "names")], "_g.fields").withColumn(
        "gt", F.when(at > 0, F.get(text, at - 1)))


def read_vcf_genotypes(spark: SparkSession, path) -> DataFrame:
    """SRC-1 over files of any sample lists."""
    return parse_vcf_genotypes(file_lines(spark, path))


def parse_intervals(rows: DataFrame) -> DataFrame:
    """SRC-2: the four layouts of a coordinate line; a missing end equals the start.

    A line without a name gets its number of the reading order as name (unique, not dense).
    A line in no layout has null coordinates and is caught by ``validate_intervals``.
    """
    line = F.col("line")
    three, two = r"^(\S+)\s+(\d+)\s+(\d+)(?:\s+(.*))?$", r"^(\S+)\s+(\d+)(?:\s+(\S+).*)?\s*$"
    is3 = line.rlike(three)

    def pick(g3: int, g2: int) -> Column:
        return F.when(is3, F.regexp_extract(line, three, g3)).otherwise(F.regexp_extract(line, two, g2))

    start = pick(2, 2).try_cast("bigint")
    end = F.when(is3, F.regexp_extract(line, three, 3).try_cast("bigint")).otherwise(start)
    name = F.when(is3, F.regexp_extract(line, three, 4)).otherwise(F.regexp_extract(line, two, 3))
    return rows.where(line.rlike(r"\S") & ~line.contains("OVERLAP COUNT")).select(
        F.when(pick(1, 1) != "", pick(1, 1)).alias("chrom"), start.alias("start"), end.alias("end"),
        F.when(name != "", name).otherwise((F.monotonically_increasing_id() + 1).cast("string")).alias("name"))


def read_intervals(spark: SparkSession, path, chrom: str | None = None) -> DataFrame:
    """SRC-2, optionally restricted to one chromosome."""
    out = parse_intervals(lines(spark, path))
    return out if chrom is None else out.where(F.col("chrom") == chrom)


def parse_ped(rows: DataFrame) -> DataFrame:
    """SRC-3: pedigree lines; fewer than six columns or a code other than 1/2 is an error."""
    f = F.split(F.trim("line"), r"\s+")
    sex, status = F.get(f, F.lit(4)), F.get(f, F.lit(5))
    good = (F.size(f) >= 6) & sex.isin("1", "2") & status.isin("1", "2")
    return rows.where(F.trim("line") != "").select(
        F.when(good, f[0]).otherwise(F.raise_error(F.concat(F.lit("bad pedigree line: "), F.col("line")))).alias("family"),
        F.get(f, F.lit(1)).alias("sample"), F.get(f, F.lit(2)).alias("father"), F.get(f, F.lit(3)).alias("mother"),
        F.when(sex == "1", "male").otherwise("female").alias("sex"),
        F.when(status == "2", 1).otherwise(0).alias("affected"))


def read_ped(spark: SparkSession, path) -> DataFrame:
    """SRC-3."""
    return parse_ped(lines(spark, path))


def parse_pileup(rows: DataFrame) -> DataFrame:
    """SRC-4: chromosome, position, reference, depth, bases, qualities and an optional tag list. A
    ``path`` column is kept."""
    f = F.col("f")
    return _cells(rows).select(
        *_origin(rows), norm_chrom(f[0]).alias("chrom"), f[1].cast("bigint").alias("pos"), F.upper(f[2]).alias("ref"),
        f[3].cast("int").alias("depth"), F.get(f, F.lit(4)).alias("bases"), F.get(f, F.lit(5)).alias("quals"),
        F.get(f, F.lit(6)).alias("tags"))


def read_pileup(spark: SparkSession, path) -> DataFrame:
    """SRC-4. Every row has the ``path`` of its file, so pileups of several samples stay apart."""
    return parse_pileup(file_lines(spark, path))


CONSEQUENCE_COLUMNS = ("uploaded", "location", "allele", "gene", "feature", "feature_type", "consequence",
                       "cdna_pos", "cds_pos", "protein_pos", "amino_acids", "codons", "existing", "extra")


def parse_consequences(rows: DataFrame) -> DataFrame:
    """SRC-5: predictor output; the location becomes chrom / start / end, the rest stays text. A ``path``
    column is kept."""
    cols = [F.get("f", F.lit(i)).alias(c) for i, c in enumerate(CONSEQUENCE_COLUMNS)]
    loc = F.split("location", "[:-]")
    return (
        _cells(rows).select(*_origin(rows), *cols)
        .withColumn("chrom", norm_chrom(loc[0])).withColumn("start", loc[1].cast("bigint"))
        .withColumn("end", F.coalesce(F.get(loc, F.lit(2)).cast("bigint"), F.col("start")))
    )


def read_consequences(spark: SparkSession, path) -> DataFrame:
    """SRC-5. Every row has the ``path`` of its file."""
    return parse_consequences(file_lines(spark, path))


def merge_headers(reports: Sequence[DataFrame], missing: str = "No Data") -> DataFrame:
    """SRC-7: union of all columns in order of first appearance; a column a report lacks shows ``missing``."""
    order = list(dict.fromkeys(c for r in reports for c in r.columns))
    out = None
    for r in reports:
        full = r.select(*[F.col(c).cast("string").alias(c) if c in r.columns else F.lit(missing).alias(c)
                          for c in order])
        out = full if out is None else out.unionByName(full)
    return out


def parse_dbsnp(rows: DataFrame) -> DataFrame:
    """SRC-8, dbSNP table dump: unusable allele texts and unplaced contigs are dropped."""
    f = F.col("f")
    return _cells(rows).select(
        norm_chrom(f[1]).alias("chrom"), f[2].cast("bigint").alias("start"), f[3].cast("bigint").alias("end"),
        f[4].alias("rs"), f[6].alias("strand"), f[8].alias("ref"), f[9].alias("observed"),
        F.get(f, F.lit(22)).alias("alleles"), F.get(f, F.lit(23)).alias("counts"),
    ).where(~F.col("chrom").contains("random") & ~F.col("observed").contains("(")
            & ~F.col("observed").contains("lengthTooLong") & ~F.col("ref").contains("("))


def parse_population(rows: DataFrame, ac_field: str = "AC_Adj", an_field: str = "AN_Adj") -> DataFrame:
    """SRC-8, population VCF: one row per alternate with its allele count; no allele number, no row.

    An AC list that does not match the alternates is an error.
    """
    f = F.col("f")
    acs = F.split(F.regexp_extract("info", rf"(?:^|;){ac_field}=([0-9,]+)", 1), ",")
    body = _cells(rows).select(
        norm_chrom(f[0]).alias("chrom"), f[1].cast("bigint").alias("pos"), f[3].alias("ref"), f[4].alias("alts"),
        f[5].alias("qual"), f[7].alias("info"),
    ).where(~F.col("ref").contains("N") & ~F.col("alts").contains("N") & (F.col("alts") != "."))
    body = body.withColumn("an", F.regexp_extract("info", rf"(?:^|;){an_field}=(\d+)", 1).try_cast("bigint")).where("an > 0")
    body = body.withColumn("_acs", F.when(F.size(acs) == F.size(F.split("alts", ",")), acs)
                           .otherwise(F.raise_error(F.lit("allele counts do not match the alternates"))))
    return (
        body.select("*", F.posexplode(F.split("alts", ",")).alias("_i", "alt"))
        .withColumn("ac", F.get("_acs", F.col("_i")).cast("bigint"))
        .select("chrom", "pos", "ref", "alt", "qual", "ac", "an")
    )


# Column numbers of the cancer catalogue export that are used (fixed values, zero based).
COSMIC_FIELDS = {"gene": 0, "site": 7, "histology": 11, "base_text": 17, "aa_text": 18, "mut_type": 19,
                 "coord": 23, "strand": 24, "status": 29, "tumour": 33}


def parse_cosmic_export(rows: DataFrame) -> DataFrame:
    """SRC-8, cancer catalogue export: the used columns; rows without a coordinate are dropped."""
    cols = [F.get("f", F.lit(i)).alias(c) for c, i in COSMIC_FIELDS.items()]
    return _cells(rows).where(~F.startswith(F.get("f", F.lit(0)), F.lit("Gene name"))).select(*cols).where(F.col("coord").contains(":"))


def read_catalogue(spark: SparkSession, path, kind: str) -> DataFrame:
    """SRC-8: ``kind`` is ``dbsnp``, ``population`` or ``cosmic``."""
    parser = {"dbsnp": parse_dbsnp, "population": parse_population, "cosmic": parse_cosmic_export}[kind]
    return parser(lines(spark, path))


def read_sv_calls(spark: SparkSession, path, caller: str) -> DataFrame:
    """SRC-9: ``caller`` is ``lumpy``, ``delly``, ``manta``, ``sniffles`` or ``pbsv``. Every event has
    the ``path`` of its file; files of a cohort are read together without mixing their events."""
    from genoloom.operators import structural

    return structural.normalise(spark.read.text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("path")), caller)


def parse_fasta(records: DataFrame) -> DataFrame:
    """SRC-10: whole records (``line`` holds header and sequence lines) as header and joined sequence."""
    text = F.regexp_replace("line", r"^\s*>", "")
    head = F.substring_index(text, "\n", 1)
    body = F.substr(text, F.length(head) + F.lit(1), F.length(text))
    return records.where(F.col("line").rlike(r"\S")).select(
        F.trim(head).alias("header"), F.regexp_replace(body, r"\s+", "").alias("seq"))


def read_fasta(spark: SparkSession, path) -> DataFrame:
    """SRC-10: records are split at ``>``; one record is one row."""
    return parse_fasta(spark.read.text(path, lineSep="\n>").withColumnRenamed("value", "line"))


def concat_by_chrom(spark: SparkSession, paths: dict[str, str], reader) -> DataFrame:
    """SRC-11: one call set from per-chromosome files; a missing file fails the read."""
    return reader(spark, list(paths.values()))
