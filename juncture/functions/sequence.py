"""Sequence expressions: composition, complexity, reverse complement, windows, translation."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..criteria import DEFAULT, Criteria

#: The standard genetic code, amino acids by codon with bases in the order T, C, A, G.
BASES, AMINO = "TCAG", "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = dict(zip((a + b + c for a in BASES for b in BASES for c in BASES), AMINO, strict=True))
#: All codons in one text, and the amino acid of what begins at each place of it; X at place 0 and where no codon begins.
_CODES, _ACIDS = " ".join(CODONS), "X" + "XXX".join(CODONS.values())
#: Codons up to the first stop.
_CODING = re.compile("(?:(?!TA[AG]|TGA)...)*+", re.S)


def _letters(s: Column) -> Column:
    return F.array_distinct(F.filter(F.split(s, ""), lambda c: c != ""))


def _count(s: Column, letter: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, letter, F.lit("")))


def entropy(s: Column) -> Column:
    """Shannon entropy of the letters in bits; 0 for an empty string, null for null."""
    share = F.transform(_letters(s), lambda c: _count(s, c) / F.length(s))
    return F.aggregate(share, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))


def distinct_letters(s: Column) -> Column:
    return F.size(_letters(s))


def largest_share(s: Column) -> Column:
    return F.array_max(F.transform(_letters(s), lambda c: _count(s, c))) / F.nullif(F.length(s), F.lit(0))


def longest_run(s: Column) -> Column:
    """Length of the longest run of one letter."""
    state = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, c: Column) -> Column:
        run = F.when(c == acc["last"], acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(c.alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(F.filter(F.split(s, ""), lambda c: c != ""), state, step, lambda acc: acc["best"])


def has_run(s: Column, length: int) -> Column:
    return s.rlike(rf"(.)\1{{{length - 1}}}")


def is_low_complexity(s: Column, criteria: Criteria = DEFAULT) -> Column:
    """Few letters, one dominant letter, a long run or low entropy; an empty string is of low complexity."""
    return (
        (F.length(s) == 0)
        | (distinct_letters(s) <= criteria.min_residues)
        | F.coalesce(largest_share(s) >= criteria.max_residue_share, F.lit(False))
        | has_run(s, criteria.max_run)
        | (F.round(entropy(s), 12) < criteria.min_entropy)
    )


def composition(s: Column) -> Column:
    """length, gc, entropy and longest run of a nucleotide string."""
    gc = (_count(F.upper(s), F.lit("G")) + _count(F.upper(s), F.lit("C"))) / F.nullif(F.length(s), F.lit(0))
    return F.struct(F.length(s).alias("length"), gc.alias("gc"), entropy(s).alias("entropy"), longest_run(s).alias("longest_run"))


def reverse_complement(s: Column) -> Column:
    return F.reverse(F.translate(s, "ACGTacgt", "TGCAtgca"))


def windows(s: Column, lengths: Sequence[int] = DEFAULT.peptide_lengths) -> Column:
    """Array of (start, length, peptide) of every window; none where the string is shorter."""
    kind = "array<struct<start:int,length:int,peptide:string>>"

    def of(k: int) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.length(s) - k), lambda i: F.struct(i.alias("start"), F.lit(k).alias("length"), F.substring(s, i + 1, F.lit(k)).alias("peptide")))
        return F.when(F.length(s) >= k, every).otherwise(F.array().cast(kind))

    return F.concat(*[of(k) for k in lengths])


def translate(nucleotides: Column) -> Column:
    """Amino acids up to the first stop; a codon with another letter is X; a last partial codon is left out."""
    # Cut into codons first: a lookup in a map, or a substring from the start, for each codon costs many times as much.
    codons = F.regexp_extract_all(nucleotides, F.lit("(?s)..."), F.lit(0))
    acids = F.transform(codons, lambda c: F.substring(F.lit(_ACIDS), F.instr(F.lit(_CODES), F.upper(c)) + 1, F.lit(1)))
    return F.substring_index(F.array_join(acids, ""), "*", 1)


def translated(nucleotides: str) -> str:
    """`translate` of one text, for work inside tasks."""
    text = nucleotides.upper() if nucleotides.isascii() else "".join([c.upper() if c.isascii() else "N" for c in nucleotides])
    end = _CODING.match(text).end()
    return "".join([CODONS.get(text[i : i + 3], "X") for i in range(0, end, 3)])


def spans_junction(start: Column, length: Column, junction_nt: Column) -> Column:
    """A window of residues holds the junction, in nucleotides; null where the junction is unknown."""
    return (start * 3 < junction_nt) & (junction_nt < (start + length) * 3)


def peptide_spans(protein: Column, peptide: Column, junction_nt: Column) -> Column:
    """Any occurrence of the peptide in the protein spans the junction; null where the junction is unknown."""
    last = F.length(protein) - F.length(peptide)
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    hit = F.exists(starts, lambda i: (F.substring(protein, i + 1, F.length(peptide)) == peptide) & spans_junction(i, F.length(peptide), F.coalesce(junction_nt, F.lit(-1))))
    return F.when(junction_nt.isNotNull(), hit)


def junction_offset(head_nt: Column, inserted: Column) -> tuple[Column, Column]:
    """(nucleotides before the junction, residue it falls in) from the 5' head and the inserted bases; null if unknown."""
    nt = F.length(head_nt) + F.length(inserted)
    return nt, F.floor(nt / 3).cast("int")
