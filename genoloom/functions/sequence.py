"""Nucleotide text: reverse complement and codon translation."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# Standard genetic code: amino acids in the order of codons over the alphabet TCAG
# (first base slowest). The stop mark is "_".
CODON_ORDER = "TCAG"
CODON_AMINO = "FFLLSSSSYY__CC_WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def revcomp(c: Column) -> Column:
    return F.translate(F.reverse(c), "ACGTacgt", "TGCAtgca")


# All codons in that order, one every four characters, so that a codon's place is one search.
CODON_PLACES = "|".join("".join(c) for c in product(CODON_ORDER, repeat=3))


def amino(codon: Column) -> Column:
    """Residue of a codon, found by its place in the fixed order; empty text if not a codon."""
    place = F.shiftright(F.instr(F.lit(CODON_PLACES), codon) + 3, 2)
    residue = F.get(F.lit(["", *CODON_AMINO]), place)
    return F.when(F.length(codon) == 3, residue).otherwise("")


def translate_codons(c: Column) -> Column:
    """Protein of a sequence read from its first base; a trailing partial codon is ignored.

    The codons are cut in one pass over the text, so the cost is linear in its length.
    """
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit("(...)"), F.lit(1)), amino), "")
