"""Finite rules enumerated against tables written by hand, and properties of the operators."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from genoloom.functions import alleles, pileup, zygosity
from genoloom.functions.sequence import amino, revcomp, translate_codons
from genoloom.functions.text import attr_map, chrom_rank, norm_chrom, safe_name
from genoloom.operators import aggregates as ag
from genoloom.operators import chunks
from genoloom.operators import coverage as cv
from genoloom.operators import filters as fl
from genoloom.operators import intervals as iv
from genoloom.operators import pedigree as pd
from genoloom.operators import sequences as sq
from genoloom.operators import sets as st
from genoloom.operators import structural as sv
from genoloom.sources import readers as rd
from genoloom.sources import sinks as sk


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def overlap(a, b):
    return a[0] == b[0] and b[1] <= a[2] and b[2] >= a[1]


def random_intervals(seed, n, top, longest):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.randint(0, top)
        size = rng.choice([0, 0, 1, 9, 99, 1000, longest])
        out.append((rng.choice(["1", "2"]), start, start + rng.randint(0, size), f"n{i}"))
    return out


@pytest.mark.parametrize("width", [1, 10, 1000])
@pytest.mark.parametrize("mode", ["any", "full", "full_rev", "fifty_pct"])
def test_binned_join_equals_range_join(spark, width, mode):
    a, b = random_intervals(1, 120, 5000, 4000), random_intervals(2, 120, 5000, 9000)
    ref = spark.createDataFrame(a, "chrom string, start long, end long, id string")
    coord = spark.createDataFrame(b, "chrom string, start long, end long, name string")
    got = {(r["id"], r["name"]) for r in iv.overlap_pairs(ref, coord, mode=mode, bin_width=width).collect()}
    test = {
        "any": lambda x, y: True, "full": lambda x, y: y[1] <= x[1] and y[2] >= x[2],
        "full_rev": lambda x, y: y[1] >= x[1] and y[2] <= x[2],
        "fifty_pct": lambda x, y: 2 * (min(x[2], y[2]) - max(x[1], y[1])) >= x[2] - x[1]}[mode]
    want = {(x[3], y[3]) for x in a for y in b if overlap(x, y) and test(x, y)}
    assert got == want
    assert iv.overlap_pairs(ref, coord, mode=mode, bin_width=width).count() == len(want)


@pytest.mark.parametrize("d", [0, 1, 50, 700])
def test_distance_join_equals_definition(spark, d):
    a, b = random_intervals(3, 100, 3000, 2000), random_intervals(4, 100, 3000, 2000)
    ref = spark.createDataFrame(a, "chrom string, start long, end long, id string")
    coord = spark.createDataFrame(b, "chrom string, start long, end long, name string")
    got = sorted((r["id"], r["name"]) for r in iv.overlap_pairs(ref, coord, max_distance=d).collect())
    want = sorted(
        (x[3], y[3]) for x in a for y in b if x[0] == y[0] and (
            (overlap(x, y) and abs(x[1] - y[1]) <= d and abs(x[2] - y[2]) <= d) or (abs(x[1] - y[1]) < d and abs(x[2] - y[2]) < d)))
    assert got == want


def test_overlap_with_empty_sides(spark):
    ref = spark.createDataFrame([("1", 1, 2, "a")], "chrom string, start long, end long, id string")
    coord = spark.createDataFrame([], "chrom string, start long, end long, name string")
    assert iv.overlap_pairs(ref, coord).count() == 0
    assert iv.overlap_unmatched(ref, coord).count() == 1
    assert iv.overlap_matches(ref, coord, keep_unmatched="NO_MATCH").first()["matches"] == "NO_MATCH"
    assert iv.merge_intervals(coord).count() == 0


def test_matched_and_unmatched_make_up_all(spark):
    ref = spark.createDataFrame(random_intervals(5, 80, 4000, 100), "chrom string, start long, end long, id string")
    coord = spark.createDataFrame(random_intervals(6, 40, 4000, 100), "chrom string, start long, end long, name string")
    every = iv.overlap_matches(ref, coord, keep_unmatched="-").select("id")
    parts = iv.overlap_matches(ref, coord).select("id").union(iv.overlap_unmatched(ref, coord).select("id"))
    assert rows(every) == rows(parts) and every.count() == 80


def test_merge_crosses_chunks(spark):
    big = chunks.CHUNK
    data = [("1", 0, 5), ("1", 6, 9), ("1", 11, 12), ("1", big - 2, 3 * big), ("1", 2 * big, 2 * big + 1),
            ("1", 3 * big + 1, 3 * big + 4), ("1", 5 * big, 5 * big), ("2", 1, 1)]
    df = spark.createDataFrame(data, "chrom string, start long, end long")
    assert rows(iv.merge_intervals(df)) == [
        ("1", 0, 9), ("1", 11, 12), ("1", big - 2, 3 * big + 4), ("1", 5 * big, 5 * big), ("2", 1, 1)]


def test_run_ids_cross_chunks(spark):
    data = [(i, "ab"[(i // 7) % 2]) for i in range(100)]
    df = spark.createDataFrame(data, "i long, s string").withColumn("p", F.lit(1))
    got = chunks.run_ids(df, ["p"], ["i"], ["s"], F.floor(F.col("i") / 5), lambda a, b: a["s"] != b["s"])
    assert [r["run"] for r in got.orderBy("i").collect()] == [i // 7 + 1 for i in range(100)]


def test_running_sum_crosses_chunks(spark):
    df = spark.range(50).withColumn("p", F.col("id") % 2)
    got = chunks.running_sum(df, ["p"], [F.col("id")], F.floor(F.col("id") / 4), "id", "s")
    want = {i: sum(j for j in range(i + 1) if j % 2 == i % 2) for i in range(50)}
    assert {r["id"]: r["s"] for r in got.collect()} == want


@pytest.mark.parametrize("values", [[1, 2, 3, 4], [5, 1, 4, 2, 3], [1, 2, 3, 4, 5, 6], [7, 7, 7, 1, 2, 9, 4], [130, 2, 65, 64, 63, 300, 1, 9]])
def test_five_numbers(spark, values):
    df = spark.createDataFrame([("k", v) for v in values], "k string, v long")
    got = ag.five_numbers(df, ["k"], "v").first()
    s, n = sorted(values), len(values)

    def med(x):
        m = len(x) // 2
        return float(x[m]) if len(x) % 2 else (x[m - 1] + x[m]) / 2

    if n <= 4:
        assert got["min"] is None and got["q2"] is None
    else:
        low = s[: n // 2 - 1] if n % 2 == 0 else s[: n // 2]
        high = s[n // 2:] if n % 2 == 0 else s[n // 2 + 1:]
        assert [got[c] for c in ("min", "q1", "q2", "q3", "max")] == [s[0], med(low), med(s), med(high), s[-1]]


# position, reference, alternate -> start, end, bases, type
VCF_KEYS = [
    (100, "A", "G", 100, 100, "A->G", "SNV"), (100, "ACG", "A", 101, 102, "-CG", "DEL"), (100, "A", "ACC", 100, 100, "+CC", "INS"),
    (100, "AT", "AC", 101, 101, "T->C", "SNV"), (100, "ATATA", "CTATA", 100, 100, "A->C", "SNV"), (100, "ACGT", "ACGA", 103, 103, "T->A", "SNV"),
]


@pytest.mark.parametrize("case", VCF_KEYS)
def test_vcf_key(spark, case):
    pos, ref, alt, *want = case
    k = one(spark, alleles.vcf_key(F.lit(pos), F.lit(ref), F.lit(alt)))
    assert [k["start"], k["end"], k["bases"], k["var_type"]] == want


@pytest.mark.parametrize("case", [
    (100, "-", "AC", 99, 99, "+AC", "INS"), (100, "ACG", "-", 100, 102, "-ACG", "DEL"), (100, "A", "T", 100, 100, "A->T", "SNV"),
    (100, "A", "ACC", 99, 99, "+AC", "INS"), (100, "ACC", "A", 100, 101, "-AC", "DEL")])
def test_dashed_key(spark, case):
    pos, ref, alt, *want = case
    k = one(spark, alleles.dashed_key(F.lit(pos), F.lit(ref), F.lit(alt)))
    assert [k["start"], k["end"], k["bases"], k["var_type"]] == want


@pytest.mark.parametrize("bases,want", [
    ("..,,", {"REF": 4}), ("A.t", {"A": 1, "REF": 1, "T": 1}), ("^].A$", {"REF": 1, "A": 1}),
    (".+2AG.", {"+2AG": 1, "REF": 1}), (".+2AG,-1T*", {"+2AG": 1, "-1T": 1, "OTHER_DEL": 1}), ("<>", {"REFSKIP": 2}),
    (".+12ACGTACGTACGTC", {"+12ACGTACGTACGT": 1, "C": 1}), ("", {}), ("^+.C", {"REF": 1, "C": 1})])
def test_pileup_tokens(spark, bases, want):
    got = {}
    for tok in one(spark, pileup.tokens(F.lit(bases))):
        got[tok] = got.get(tok, 0) + 1
    assert got == want


def test_genotype_classes(spark):
    cases = {"0/0": "ref", "0|1": "het", "1/1": "hom", "./.": "no_call", "1/2": "het", "2/2": "other", "0/2": "other", "2|1": "het"}
    got = {gt: one(spark, zygosity.genotype_class(F.lit(gt), F.lit(1))) for gt in cases}
    assert got == cases


def test_fraction_zygosity(spark):
    for var, total, want in [(0, 0, "ref"), (1, 100, "ref"), (2, 100, "het"), (74, 100, "het"), (75, 100, "hom")]:
        assert one(spark, zygosity.from_fraction(F.lit(var), F.lit(total))) == want


def test_call_zygosity_rule(spark):
    for r, a, b, want in [(0.1, 0.8, None, "hom"), (0.4, 0.4, None, "het"), (0.29, 0.6, None, "other"), (0.0, 0.45, 0.4, "het"),
                          (0.5, 0.25, 0.1, "other"), (0.1, 0.5, 0.29, "other")]:
        got = one(spark, zygosity.from_call_fractions(F.lit(r), F.lit(a), F.lit(b).cast("double")))
        assert got == want


# Mother, father, child -> label; the rule table of two sequenced parents.
def expected_mendel(m, f, c):
    if "No data" in (m, f, c):
        return "missing allele info"
    if c == "ref" and m == "hom":
        return "hom_mother ref_child"
    if c == "ref" and f == "hom":
        return "hom_father ref_child"
    if c == "het" and m == f == "ref":
        return "de novo (ref_parents het_child)"
    if c == "het" and m == f == "hom":
        return "hom_parents het_child"
    if c == "hom" and m == "ref":
        return "ref_mother hom_child"
    if c == "hom" and f == "ref":
        return "ref_father hom_child"
    return "mendelian_rules_followed"


def test_all_trios(spark):
    zs = ["ref", "het", "hom", "No data"]
    data, want = [], {}
    for i, (m, f, c) in enumerate(itertools.product(zs, zs, zs)):
        for rel, z, aff in (("mother", m, 0), ("father", f, 0), ("proband", c, 1)):
            data.append(("f", rel, rel, aff, "1", i, z))
        want[i] = expected_mendel(m, f, c)
    geno = spark.createDataFrame(data, "family string, sample string, relation string, affected int, chrom string, pos long, zyg string")
    roles = pd.family_roles(geno.select("family", "sample", "relation", "affected").distinct())
    assert {r["pos"]: r["mendel"] for r in pd.mendel(geno, roles).collect()} == want


def test_missing_family_row_counts_as_reference(spark):
    geno = spark.createDataFrame([("f", "c", "proband", 1, "1", 5, "het")],
                                 "family string, sample string, relation string, affected int, chrom string, pos long, zyg string")
    members = spark.createDataFrame([("f", "m", "mother", 0), ("f", "p", "father", 0), ("f", "c", "proband", 1)],
                                    "family string, sample string, relation string, affected int")
    assert pd.mendel(geno, pd.family_roles(members)).first()["mendel"].startswith("de novo")


def test_phase_blocks(spark):
    m, f = "Mother gives affected allele", "Father gives affected allele"
    data = [("f", "snv", "1", p, x) for p, x in [
        (1, m), (5000, "?"), (9000, m), (20000, m), (30000, "No"), (31000, f), (60000, f), (61000, m), (62000, m)]]
    df = spark.createDataFrame(data, "family string, var_type string, chrom string, pos long, parent_allele string")
    got = {r["pos"]: r["phase_info"] for r in pd.phase_blocks(df).collect()}
    mother, father = "3 variants; Mother; 1:1-20000; 19999bp", "2 variants; Father; 1:31000-60000; 29000bp"
    assert got == {1: mother, 5000: "No", 9000: mother, 20000: mother, 30000: "No", 31000: father, 60000: father,
                   61000: "No", 62000: "No"}


def test_set_identities(spark):
    data = [(s, k) for s, ks in {"a": "123", "b": "234", "c": "345"}.items() for k in ks]
    sets = st.load_sets(spark.createDataFrame(data, "s string, k string"), "s", ["k"])
    assert rows(st.intersect(sets, ["k"])) == [("3",)]
    for k in (1, 2, 3):
        union = rows(st.in_at_least(sets, ["k"], k).union(st.in_at_most(sets, ["k"], k - 1)))
        assert union == rows(st.union(sets, ["k"]))


def test_reverse_complement_twice(spark):
    s = "ACGTTGCAacgtN"
    assert one(spark, revcomp(revcomp(F.lit(s)))) == s


def test_codon_table(spark):
    assert [one(spark, amino(F.lit(c))) for c in ("ATG", "TAA", "TGG", "GGG", "TTT", "ANN")] == ["M", "_", "W", "G", "F", ""]
    assert one(spark, translate_codons(F.lit("ATGTAAGG"))) == "M_" and one(spark, translate_codons(F.lit("AT"))) == ""


def test_exon_status_forms(spark):
    exons = spark.createDataFrame([("1", 10, 14, "a"), ("1", 20, 24, "b"), ("1", 30, 34, "c"), ("1", 40, 44, "d")],
                                  "chrom string, start long, end long, exon string")
    depth = spark.createDataFrame([("1", p, 9) for p in range(10, 15)] + [("1", 21, 9), ("1", 22, 9)] + [("1", 31, 1)],
                                  "chrom string, pos long, depth long")
    got = {r["exons"]: (r["status"], r["missing_bases"]) for r in cv.exon_status(exons, depth, 5).collect()}
    assert got == {"a": ("FULL_COVER", 0), "b": ("20,23-24", 3), "c": ("ONLY_LOW_COVER", 4), "d": ("NO_COVER", 4)}


def test_assembly_stats_small(spark):
    df = spark.createDataFrame([("A" * n,) for n in (8, 8, 4, 3, 3, 2, 2, 2)], "seq string")
    got = sq.assembly_stats(df).first()
    assert (got["contigs"], got["total"], got["n50"], got["l50"]) == (8, 32, 8, 1)


def test_text_helpers(spark):
    assert one(spark, norm_chrom(F.lit("chrMT"))) == "M" and one(spark, chrom_rank(F.lit("X"))) == 23
    assert one(spark, attr_map(F.lit("a=1;b;a=2;"))) == {"a": "2", "b": None}
    assert safe_name("% of (x)/y") == "percentof_x__of_y"


def test_completeness_tests_are_ordered(spark):
    data = [("21", 9_411_318)] * 5000 + [("21", 48_119_000)] + [("1", 10_000_000)] * 30_000 + [("1", 249_240_000)]
    df = spark.createDataFrame(data, "chrom string, pos long")
    got = {r["chrom"]: r["verdict"] for r in fl.completeness(df).collect()}
    assert got == {"21": "ok", "1": "late_start"}


def test_translocation_reported_from_both_ends_is_kept_once(spark):
    info = "SVTYPE=BND;STRANDS=+-:9;PE=3;SR=1"
    lines = ["\t".join(["chr2", "500", "7_1", "N", "N]chr10:900]", ".", ".", info]),
             "\t".join(["chr10", "900", "7_2", "N", "N]chr2:500]", ".", ".", info])]
    got = sv.normalise_lumpy(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    assert len(got) == 1 and (got[0]["chr1"], got[0]["chr2"], got[0]["sv_type"]) == ("10", "2", "tra")


@pytest.mark.parametrize("caller, info", [("lumpy", "SVTYPE=BND;STRANDS=+-:9;PE=3;SR=1"), ("manta", "X=1;SVTYPE=BND"), ("sniffles", "PRECISE;SVTYPE=BND"), ("delly", "SVTYPE=BND;CHR2=chr10;END=900;PE=3;MAPQ=9")])
def test_same_translocation_in_two_samples_is_kept_twice(spark, tmp_path, caller, info):
    fields = ("GT:DR:DV", "0/1:9:3") if caller == "sniffles" else ("GT:PR:SR", "0/1:9,3:7,2")

    def ends(n, more=("", "")):
        return ["\t".join(["chr2", "500", f"{n}_1", "N", "N]chr10:900]", "9", "PASS", info + more[0], *fields]),
                "\t".join(["chr10", "900", f"{n}_2", "N", "N]chr2:500]", "9", "PASS", info + more[1], *fields])][: 1 if caller == "delly" else 2]

    lines = [(x, s) for s in ("a", "b") for x in ends(7)]
    got = sv.normalise(spark.createDataFrame(lines, "line string, sample string"), caller).collect()
    assert sorted(r["sample"] for r in got) == ["a", "b"]
    for s in "ab":
        (tmp_path / f"{s}.vcf").write_text("\n".join(["##x", *ends(7)]) + "\n")
    got = rd.read_sv_calls(spark, str(tmp_path), caller).collect()
    assert sorted(r["path"][-5:] for r in got) == ["a.vcf", "b.vcf"]
    mates = [(f";MATEID={n}_2", f";MATEID={n}_1") for n in (7, 8)]
    lines = [(x,) for n, m in zip((7, 8), mates, strict=True) for x in ends(n, m)]
    assert sv.normalise(spark.createDataFrame(lines, "line string"), caller).count() == 2


def test_files_round_trip(spark, tmp_path):
    vcf = tmp_path / "a.vcf"
    vcf.write_text("##x\n#CHROM\tPOS\n\nchrMT\t5\t.\tA\tG,*\t.\tPASS\tAC=3,1;AN=4;AF=0.5,0.1\n1\t7\t.\tN\tA\t9\tPASS\tAC=1\n")
    got = rd.read_vcf(spark, str(vcf)).collect()
    assert len(got) == 1 and got[0]["chrom"] == "M" and got[0]["qual"] is None and got[0]["ac"] == 3 and got[0]["info_af"] == 0.5
    fasta = tmp_path / "a.fa"
    fasta.write_text(">one x\nAC\nGT\n>two\nTT\n")
    assert rows(rd.read_fasta(spark, str(fasta))) == [("one x", "ACGT"), ("two", "TT")]
    ped = tmp_path / "a.ped"
    ped.write_text("f a 0 0 1 2\nf b 0 0 2 1\n")
    assert rows(rd.read_ped(spark, str(ped)).select("sample", "sex", "affected")) == [("a", "male", 1), ("b", "female", 0)]
    ped.write_text("f a 0 0 3 2\n")
    with pytest.raises(Exception, match="bad pedigree line"):
        rd.read_ped(spark, str(ped)).collect()
    iv_file = tmp_path / "a.bed"
    iv_file.write_text("1 10 20 some gene\n1 30 40\n1 50 name\n1 60\nOVERLAP COUNT 3\nbroken\n")
    good, bad = iv.validate_intervals(rd.read_intervals(spark, str(iv_file)))
    assert [tuple(r)[:3] for r in good.orderBy("start").collect()] == [("1", 10, 20), ("1", 30, 40), ("1", 50, 50), ("1", 60, 60)]
    assert bad.count() == 1
    with pytest.raises(Exception, match="end coordinate less than start"):
        iv.require_valid(spark.createDataFrame([("1", 5, 4)], "chrom string, start long, end long")).collect()


def test_append_only_new(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    first.write.parquet(path)
    sk.append_new(spark.createDataFrame([("b", 9), ("c", 3), ("c", 3)], "k string, v long"), path, ["k"])
    assert rows(spark.read.parquet(path)) == [("a", 1), ("b", 2), ("c", 3)]


def test_missing_per_chromosome_file_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        rd.concat_by_chrom(spark, {"1": str(tmp_path / "none")}, rd.read_intervals).count()


def test_cluster_needs_a_shared_folder(monkeypatch):
    from genoloom import session

    class Conf:
        def get(self, key, default):
            return default

    class Fake:
        conf = Conf()
        sparkContext = type("C", (), {"master": "spark://host:7077"})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Fake())
