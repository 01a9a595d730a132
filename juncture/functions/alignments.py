"""Expressions over read alignments: CIGAR walks, partner tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..criteria import DEFAULT


def _steps(cigar: Column) -> Column:
    n = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1))
    op = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2))
    return F.zip_with(n, op, lambda a, b: F.struct(a.cast("int").alias("n"), b.alias("op")))


def _walk(start: Column, cigar: Column, wanted: tuple[str, ...]) -> Column:
    """(start, length) of every step of the wanted kinds, with a cursor over M, D, N, = and X."""
    kind = "array<struct<start:bigint,length:int>>"
    zero = F.struct(start.cast("long").alias("at"), F.array().cast(kind).alias("found"))

    def step(acc: Column, s: Column) -> Column:
        found = F.when(s["op"].isin(*wanted), F.concat(acc["found"], F.array(F.struct(acc["at"].alias("start"), s["n"].alias("length"))))).otherwise(acc["found"])
        return F.struct((acc["at"] + F.when(s["op"].isin("M", "D", "N", "=", "X"), s["n"]).otherwise(0)).alias("at"), found.alias("found"))

    return F.aggregate(_steps(cigar), zero, step, lambda acc: acc["found"])


def gaps(start: Column, cigar: Column) -> Column:
    """Skipped stretches (N) of an alignment."""
    return _walk(start, cigar, ("N",))


def aligned_blocks(start: Column, cigar: Column) -> Column:
    return _walk(start, cigar, ("M", "=", "X"))


def reference_end(start: Column, cigar: Column) -> Column:
    return F.aggregate(_steps(cigar), start.cast("long"), lambda acc, s: acc + F.when(s["op"].isin("M", "D", "N", "=", "X"), s["n"]).otherwise(0))


def span(cigar: Column) -> Column:
    """Places of the reference that an alignment reaches over: its end without a walk."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit("([0-9]+)[MDN=X]"), F.lit(1)), F.lit(0).cast("long"), lambda acc, n: acc + n.cast("int"))


def longest_softclip(cigar: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(F.filter(_steps(cigar), lambda s: s["op"] == "S"), lambda s: s["n"])), F.lit(0))


def walk(start: Column, cigar: Column) -> Column:
    """struct(end0, gaps, softclip) of an alignment, all from one walk over its CIGAR; null where that is null."""
    kind = "array<struct<start:bigint,length:int>>"
    zero = F.struct(start.cast("long").alias("end0"), F.array().cast(kind).alias("gaps"), F.lit(0).alias("softclip"))

    def step(acc: Column, s: Column) -> Column:
        n, op = F.substring(s, F.lit(1), F.length(s) - 1).cast("int"), F.right(s, F.lit(1))
        return (
            F.when(op.isin("M", "D", "=", "X"), F.struct((acc["end0"] + n).alias("end0"), acc["gaps"].alias("gaps"), acc["softclip"].alias("softclip")))
            .when(op == "N", F.struct((acc["end0"] + n).alias("end0"), F.concat(acc["gaps"], F.array(F.struct(acc["end0"].alias("start"), n.alias("length")))).alias("gaps"), acc["softclip"].alias("softclip")))
            .when(op == "S", F.struct(acc["end0"].alias("end0"), acc["gaps"].alias("gaps"), F.greatest(acc["softclip"], n).alias("softclip"))).otherwise(acc)
        )

    return F.aggregate(F.regexp_extract_all(cigar, F.lit("[0-9]+[MIDNSHP=X]"), F.lit(0)), zero, step)


def partner_hit(sa_tag: Column, chrom: Column, pos: Column, tolerance: int = DEFAULT.partner_tolerance) -> Column:
    """A supplementary alignment lies on the partner's chromosome within the tolerance; short records are passed over."""
    hit = F.exists(
        F.split(F.coalesce(sa_tag, F.lit("")), ";"),
        lambda r: F.coalesce((F.regexp_replace(F.get(F.split(r, ","), F.lit(0)), "^chr", "") == chrom) & (F.abs(F.get(F.split(r, ","), F.lit(1)).try_cast("long") - pos) <= tolerance), F.lit(False)),
    )
    return hit
