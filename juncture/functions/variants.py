"""Expressions over variant records: sizes, mates, classes, loci, frequencies, text forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def info(text: Column, key: str, kind: str = "string") -> Column:
    """Value of an INFO key, cast; null where it is absent or does not cast."""
    return F.nullif(F.regexp_extract(text, rf"(?:^|;){key}=([^;]+)", 1), F.lit("")).try_cast(kind)


def info_flag(text: Column, key: str) -> Column:
    return text.rlike(rf"(?:^|;){key}(?:;|=|$)")


def normal_chrom(chrom: Column) -> Column:
    return F.upper(F.regexp_replace(F.trim(chrom), "(?i)^chr", ""))


def inserted_bases(ref: Column, alt: Column) -> Column:
    """Bases between the bracket part of a breakend ALT and its REF anchor, in either case and at either end."""
    bases = F.regexp_replace(alt, r"[\[\]][^\[\]]*[\[\]]", "")
    n, upper, anchor = F.length(ref), F.upper(bases), F.upper(ref)
    after = F.startswith(alt, F.lit("[")) | F.startswith(alt, F.lit("]"))
    rest = F.when(~after & F.startswith(upper, anchor), F.substring(bases, n + 1, F.length(bases))).when(
        after & F.endswith(upper, anchor), F.substring(bases, F.lit(1), F.length(bases) - n)
    )
    return F.coalesce(rest, F.when(F.startswith(upper, anchor), F.substring(bases, n + 1, F.length(bases))), bases)


def mate_chrom(alt: Column) -> Column:
    return F.nullif(normal_chrom(F.regexp_extract(alt, r"[\[\]]([^:\[\]]+):(\d+)", 1)), F.lit(""))


def mate_pos(alt: Column) -> Column:
    return F.regexp_extract(alt, r"[\[\]]([^:\[\]]+):(\d+)", 2).try_cast("long")


def keeps_left(alt: Column) -> Column:
    """The record's own sequence stands before the bracket."""
    return ~(F.startswith(alt, F.lit("[")) | F.startswith(alt, F.lit("]")))


def event_size(svtype: Column, pos1: Column, pos2: Column, insert_len: Column) -> Column:
    """Type-aware size: none for translocations, the insert of an insertion, the bases between a deletion's ends."""
    span, kind = F.abs(pos2 - pos1), F.upper(svtype)
    return (
        F.when(kind.isin("BND", "TRA", "SGL"), F.lit(None))
        .when(kind == "INS", F.nullif(insert_len, F.lit(0)))
        .when(kind == "DEL", F.greatest(span - 1, F.lit(0)))
        .otherwise(span)
    )


def orientation_class(chrom1: Column, left1: Column, chrom2: Column, left2: Column) -> Column:
    """SV class from which side each breakend keeps; the first breakend is the one of smaller position."""
    return F.when(chrom1 != chrom2, F.lit("BND")).when(left1 & ~left2, F.lit("DEL")).when(~left1 & left2, F.lit("DUP")).otherwise(F.lit("INV"))


def fraction(vf: Column, ref: Column) -> Column:
    """Variant fraction at four decimals; null without reads."""
    return F.round(vf / F.nullif(vf + ref, F.lit(0)), 4)


def per_thousand(matches: Column, candidates: Column) -> Column:
    return F.round(1000.0 * matches / F.nullif(candidates, F.lit(0)), 3)


def ancestry_maximum(frequencies: dict[str, Column]) -> Column:
    """(af, population) of the highest frequency; null if every group is null."""
    pairs = F.filter(F.array(*[F.struct(c.alias("af"), F.lit(n).alias("population")) for n, c in frequencies.items()]), lambda s: s["af"].isNotNull())
    return F.array_max(pairs)


def fold_spread(values: Sequence[Column]) -> Column:
    """Largest over smallest positive value."""
    positive = [F.when(v > 0, v) for v in values]
    return F.greatest(*positive) / F.least(*positive)


def locus(chrom1: Column, pos1: Column, chrom2: Column, pos2: Column) -> Column:
    """Browser locus: one padded window (a quarter of the size, 200 to 5,000), or two windows for a translocation."""

    def window(chrom: Column, a: Column, b: Column, pad: Column) -> Column:
        text = [F.translate(F.format_number(x, 0), ",", "") for x in (F.greatest(a - pad, F.lit(1)), b + pad)]
        return F.concat(F.lit("chr"), chrom, F.lit(":"), text[0], F.lit("-"), text[1])

    size = F.abs(pos2 - pos1)
    pad = F.least(F.greatest(F.floor(size / 4), F.lit(200)), F.lit(5000))
    wide = F.lit(5000)
    return F.when(chrom1 == chrom2, window(chrom1, F.least(pos1, pos2), F.greatest(pos1, pos2), pad)).otherwise(
        F.concat_ws(" ", window(chrom1, pos1, pos1, wide), window(chrom2, pos2, pos2, wide))
    )


def junction_text(text: Column) -> Column:
    """(chrom1, pos1, chrom2, pos2) of `chr1:a-chr1:b`; other text raises."""
    pattern = r"^(?:chr)?([^:]+):(\d+)-(?:chr)?([^:]+):(\d+)$"
    part = [F.regexp_extract(text, pattern, k) for k in range(1, 5)]
    good = F.when(text.rlike(pattern), text).otherwise(F.raise_error(F.concat(F.lit("not a junction: "), F.coalesce(text, F.lit("null")))))
    return F.when(
        good.isNotNull(), F.struct(part[0].alias("chrom1"), part[1].try_cast("long").alias("pos1"), part[2].alias("chrom2"), part[3].try_cast("long").alias("pos2"))
    )


def region(pos: Column, start: Column, end: Column, exons: Column, coding: Column) -> Column:
    """CDS, UTR, intron or outside for a position in a transcript."""

    def within(blocks: Column) -> Column:
        return F.exists(blocks, lambda b: (pos >= b["start"]) & (pos <= b["end"]))

    return F.when(within(coding), "CDS").when(within(exons), "UTR").when((pos >= start) & (pos <= end), "intron").otherwise("outside")


#: Fixed values of the column junction_model; the last stands behind the names of two other regions.
INTER_GENE = "inter-gene fusion"
CODING_JOIN = "coding join"
WHOLE_EXON = "whole-exon change (or no change, same intron)"
EXON_INTRON = "exon-intron: splice outcome uncertain"
UNCERTAIN = ": splice outcome uncertain"


def junction_model(gene1: Column, gene2: Column, region1: Column, region2: Column) -> Column:
    """How the two ends meet: between genes, inside coding sequence, between introns, or with a splice outcome that no
    rule decides; the last names the two regions."""
    both = F.array_sort(F.array(region1, region2))
    return (
        F.when(~gene1.eqNullSafe(gene2), INTER_GENE)
        .when((region1 == "CDS") & (region2 == "CDS"), CODING_JOIN)
        .when((region1 == "intron") & (region2 == "intron"), WHOLE_EXON)
        .when(both == F.array(F.lit("CDS"), F.lit("intron")), EXON_INTRON)
        .otherwise(F.concat(F.coalesce(region1, F.lit("")), F.lit("-"), F.coalesce(region2, F.lit("")), F.lit(UNCERTAIN)))
    )


def transcript_rule(rank: Column) -> Column:
    names = F.create_map(F.lit(0), F.lit("mane_select"), F.lit(1), F.lit("canonical"))
    return F.coalesce(F.element_at(names, rank), F.lit("longest"))


def normal_allele(allele: Column) -> Column:
    """HLA-A02:01, A*02:01 and A0201 spellings as A02:01."""
    short = F.regexp_replace(F.regexp_replace(F.upper(F.trim(allele)), "^HLA-", ""), r"\*", "")
    return F.regexp_replace(short, r"^([A-Z]+)(\d{2})(\d{2,3}[A-Z]?)$", "$1$2:$3")


def two_field(allele: Column) -> Column:
    """First two fields of an allele, an expression suffix kept."""
    pattern = r"^([A-Z]+\d*:\d+)(?::\d+)*([A-Z]?)$"
    return F.when(normal_allele(allele).rlike(pattern), F.concat(F.regexp_extract(normal_allele(allele), pattern, 1), F.regexp_extract(normal_allele(allele), pattern, 2))).otherwise(normal_allele(allele))


def text_flag(text: Column) -> Column:
    """Boolean from a text source; null stays null."""
    return F.lower(F.trim(text)).isin("true", "1", "yes")


def is_absent(number: Column) -> Column:
    """Null or not a number."""
    return number.isNull() | F.isnan(number)
