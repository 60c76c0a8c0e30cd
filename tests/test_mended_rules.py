"""Rules on hand-written cases."""

from genoloom.operators import frequencies as fq
from genoloom.operators import pedigree as pd
from genoloom.operators import reports as rp
from genoloom.operators import structural as sv


def test_family_without_a_proband_breaks_no_rule(spark):
    schema = "family string, sample string, relation string, affected int, chrom string, pos long, zyg string"
    rows = [("a", "m", "mother", 0, "1", 5, "hom"), ("a", "f", "father", 0, "1", 5, "het"), ("a", "s", "sister", 0, "1", 5, "ref"),
            ("b", "m2", "mother", 0, "1", 5, "hom"), ("b", "f2", "father", 0, "1", 5, "het"), ("b", "c2", "proband", 1, "1", 5, "ref"),
            ("b", "m2", "mother", 0, "1", 6, "hom"), ("c", "m3", "mother", 0, "1", 5, "hom"), ("c", "s3", "sister", 0, "1", 5, "ref"),
            ("a", "m", "mother", 0, "1", 7, "No data")]
    geno = spark.createDataFrame(rows, schema)
    roles = pd.family_roles(geno.select("family", "sample", "relation", "affected").distinct())
    got = {(r.family, r.pos): r.mendel for r in pd.mendel(geno, roles).collect()}
    assert got == {("a", 5): "mendelian_rules_followed", ("a", 7): "missing allele info", ("b", 5): "hom_mother ref_child",
                   ("b", 6): "hom_mother ref_child", ("c", 5): "mendelian_rules_followed"}


def test_structural_variants_by_match_status_and_support(spark):
    rows = [(1, "FAIL", None, 9, 0), (2, "PASS", None, 9, 0), (3, "FAIL", 0.01, 1, 2), (4, "FAIL", 0.5, 2, 2), (5, "FAIL", 0.99, None, None),
            (6, "N/A", None, 4, None), (7, "NOVEL", 0.5, 2, 2), (8, None, None, 9, 9)]
    df = spark.createDataFrame(rows, "id int, filter_dgv string, dgv_freq double, sr int, pe int")
    out = rp.apply_rules(rp.sv_population_class(df), population_reason="filter_dgv", min_support=4)
    got = {r.id: (r.population_class, r.final_status) for r in out.collect()}
    few = "Not enough supporting reads"
    assert got == {1: ("NO_FREQ", "FAIL REASONS: filter_dgv"), 2: ("NOVEL", rp.PASS), 3: ("RARE_ALLELE", f"FAIL REASONS: {few}"),
                   4: ("COMMON", "FAIL REASONS: filter_dgv"), 5: ("RARE_REF", f"FAIL REASONS: filter_dgv , {few}"), 6: ("N/A", rp.PASS),
                   7: ("NOVEL", rp.PASS), 8: ("NO_FREQ", "FAIL REASONS: filter_dgv")}


def test_compound_hets_are_told_apart_by_content(spark):
    rows = [  # family, gene, sample, affected, pos, origin, rare
        ("a", "G", "c1", 1, 1, "mother", 1), ("a", "G", "c1", 1, 2, "father", 0), ("a", "G", "u1", 0, 1, "mother", 1),
        ("a", "G", "u1", 0, 2, "father", 0),  # the same form in an unaffected child only hides it where it is the only one
        ("b", "G", "c1", 1, 1, "mother", 1), ("b", "G", "c1", 1, 2, "father", 1), ("b", "G", "u1", 0, 1, "mother", 1),
        ("b", "G", "u1", 0, 3, "father", 1),
        ("c", "G", "c1", 1, 1, "either", 1), ("c", "G", "c1", 1, 2, "either", 0), ("c", "G", "c2", 1, 1, "father", 1),
        ("c", "G", "c2", 1, 2, "either", 1), ("d", "G", "c1", 1, 10, "mother", 1)]
    buckets = spark.createDataFrame(
        [(f, g, s, a, "1", p, o, r) for f, g, s, a, p, o, r in rows],
        "family string, gene string, sample string, affected int, chrom string, pos long, origin string, rare int")
    got = {(r.family, r.pos): r for r in pd.compound_hets(buckets, contents=True).collect()}
    assert {k: r.def_com_het_forms for k, r in got.items()} == {
        ("a", 1): "No", ("a", 2): "No", ("b", 1): "c1(M=1:1,F=1:2),u1(M=1:1,F=1:3)", ("b", 2): "c1(M=1:1,F=1:2)",
        ("b", 3): "No", ("c", 1): "No", ("c", 2): "No", ("d", 10): "No"}
    assert got["b", 1].def_com_het == "c1,u1" and got["b", 1].def_com_rare_het_forms == "c1(M=1:1,F=1:2),u1(M=1:1,F=1:3)"
    assert got["c", 1].pos_com_het_forms == "c1(AMB=1:1,1:2),c2(F=1:1,AMB=1:2)"
    assert got["c", 1].pos_com_rare_het_forms == "c2(F=1:1,AMB=1:2)" and got["c", 1].pos_com_rare_het == "c2"
    assert "pos_com_het_forms" not in pd.compound_hets(buckets).columns


def test_notation_of_catalogue_mutations(spark):
    cases = [  # type, base and residue notation, expected base and residue change
        ("Substitution - Missense", "c.35G>T", "p.G12V", "G->T", "G->V"), ("Substitution - Missense", "c.35G>R", "p.G12>V", "G->R", "G->V"),
        ("Substitution - coding silent", "c.1A>T", "p.?", "A->T", "SYN"), ("Substitution - Nonsense", "c.4C>T", "p.Q2*", "C->T", "Q->*"),
        ("Substitution - Missense", "c.?", "p.KL3V", "c.?", "p.KL3V"), ("Insertion - In frame", "c.1_2insNA", "p.K1_L2>WW", "NA", "WW"),
        ("Insertion - In frame", "c.1_2AC>TTT", "p.K1_L2", "AC>TTT", "K..L"), ("Insertion - In frame", "c.1_2>TTT", "p.(ins4)", "TTT", "ins4"),
        ("Insertion - Frameshift", "c.5_6ins12", "p.K1fs", "ins12", "frameshift"), ("Deletion - In frame", "c.5_7del3", "p.K5", "del3", "K"),
        ("Deletion - In frame", "c.5_7delACG", "p.K5_L6", "ACG", "K"), ("Deletion - In frame", "c.5_10del6", "p.K5_L6", "del6", "K..L"),
        ("Deletion - In frame", "c.5_10>A", "p.K5_L6del*", "A", "*"), ("Deletion - In frame", "c.5_10", "p.?", "c.5_10", "p.?"),
        ("Deletion - In frame", None, None, None, None)]
    rows = spark.createDataFrame([(i, "G", m, b, a, "23:5-6") for i, (m, b, a, _, _) in enumerate(cases)],
                                 "i int, gene string, mut_type string, base_text string, aa_text string, coord string")
    got = fq.cosmic_change(rows).orderBy("i").collect()
    assert [(r.base_change, r.aa_change) for r in got] == [c[3:] for c in cases]
    assert {(r.chrom, r.start, r.end) for r in got if r.var_type == "INS"} == {("X", 5, 5)}
    assert fq.cosmic_change(rows.withColumn("mut_type", rows.coord)).count() == 0


def test_breakends_of_any_contig_name(spark):
    alts = ["N[chr2:123[", "]7:5]N", "N]HLA-A*01:01:99]", "[<ctg.1>:8[N", "<DEL>", "ACG", None, "N[2:x["]
    got = spark.createDataFrame([(a,) for a in alts], "alt string").select(sv._mate().alias("m")).select("m.*").collect()
    assert [tuple(r) for r in got] == [("2", 123), ("7", 5), ("HLA-A*01:01", 99), ("ctg.1", 8), (None, None), (None, None), (None, None), ("2", None)]
