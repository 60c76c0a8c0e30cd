"""Readers of many files."""

import pytest

from genoloom.sources import readers as rd

HEAD = "##fileformat=VCFv4.2\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"


def _write(path, name, text):
    (path / name).write_text(text)


def test_samples_of_files_with_different_lists(spark, tmp_path):
    _write(tmp_path, "a.vcf", f"{HEAD}\ts1\ts2\nchr1\t10\t.\tA\tG,T\t50\tPASS\tAC=1,2;AN=4\tDP:GT\t7:0/1\t8:2/2\n1\t11\t.\tC\tT\t9\tPASS\tAC=1\tDP\t3\t4\n")
    _write(tmp_path, "b.vcf", f"{HEAD}\ts2\n\n1\t10\t.\tA\tG\t50\tPASS\tAC=1;AN=2\tGT\t1/1\n")
    _write(tmp_path, "c.vcf", f"{HEAD}\n1\t10\t.\tA\tG\t50\tPASS\tAC=1;AN=2\tGT\n")
    got = sorted((r.path[-5:], r.sample, r.pos, r.alt, r.allele_no, r.fields, r.gt or "") for r in rd.read_vcf_genotypes(spark, str(tmp_path)).collect())
    assert got == [("a.vcf", "s1", 10, "G", 1, "7:0/1", "0/1"), ("a.vcf", "s1", 10, "T", 2, "7:0/1", "0/1"), ("a.vcf", "s1", 11, "T", 1, "3", ""),
                   ("a.vcf", "s2", 10, "G", 1, "8:2/2", "2/2"), ("a.vcf", "s2", 10, "T", 2, "8:2/2", "2/2"), ("a.vcf", "s2", 11, "T", 1, "4", ""),
                   ("b.vcf", "s2", 10, "G", 1, "1/1", "1/1")]


@pytest.mark.parametrize("text", ["1\t10\t.\tA\tG\t50\tPASS\t.\tGT\t0/1\n", f"{HEAD}\ts1\n1\t10\t.\tA\tG\t50\tPASS\t.\tGT\t0/1\t0/0\n",
                                  f"{HEAD}\ts1\n{HEAD}\ts2\n1\t10\t.\tA\tG\t50\tPASS\t.\tGT\t0/1\n"])
def test_genotypes_without_fitting_names_are_an_error(spark, tmp_path, text):
    _write(tmp_path, "a.vcf", text)
    with pytest.raises(Exception, match="genotypes and sample names differ|different #CHROM"):
        rd.read_vcf_genotypes(spark, str(tmp_path)).collect()


def test_pileups_and_consequences_keep_their_file(spark, tmp_path):
    _write(tmp_path, "s1.pileup", "1\t5\ta\t2\t..\tII\n")
    _write(tmp_path, "s2.pileup", "1\t5\ta\t1\tG\tI\n")
    assert sorted((r.path[-9:], r.bases) for r in rd.read_pileup(spark, str(tmp_path)).collect()) == [("s1.pileup"[-9:], ".."), ("s2.pileup"[-9:], "G")]
    (tmp_path / "vep").mkdir()
    _write(tmp_path / "vep", "x.txt", "#head\nv\t1:5-7\tA\tG1\tT1\tTranscript\tmissense\n")
    row = rd.read_consequences(spark, str(tmp_path / "vep")).first()
    assert row.path.endswith("x.txt") and (row.chrom, row.start, row.end) == ("1", 5, 7)
