"""Region catalogues: which breakends lie in a region, and how two catalogues agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cross import breakpoints, first_of
from .ranges import points_in_intervals


def region_of(ends: DataFrame, regions: DataFrame, width: int = 1_000_000) -> DataFrame:
    """(chrom, pos, region): the first catalogue row (file_row) that holds each distinct breakend, half-open [start, end)."""
    distinct = ends.select("chrom", "pos").distinct()
    closed = regions.select("chrom", "start", (F.col("end") - 1).alias("last"), "name", "file_row").filter("last >= start")
    hits = points_in_intervals(distinct, closed, ["chrom"], "pos", "start", "last", width)
    return first_of(hits, ["chrom", "pos"], ["file_row"]).select("chrom", "pos", F.col("name").alias("region"))


def end_status(first: Column, second: Column) -> Column:
    """none, bp1, bp2 or both ends in a region."""
    return F.when(first.isNotNull() & second.isNotNull(), "both").when(first.isNotNull(), "bp1").when(second.isNotNull(), "bp2").otherwise("none")


def with_regions(junctions: DataFrame, regions: DataFrame, key: str, width: int = 1_000_000) -> DataFrame:
    """junctions with region1, region2 and region_status; each distinct breakend is looked up once."""
    ends = breakpoints(junctions, [key])
    named = ends.join(region_of(ends, regions, width), ["chrom", "pos"], "left")
    per = named.groupBy(key).agg(*[F.max(F.when(F.col("side") == s, F.col("region"))).alias(f"region{s}") for s in (1, 2)])
    return junctions.join(per, key, "left").withColumn("region_status", end_status(F.col("region1"), F.col("region2")))


def agreement(one: Column, other: Column) -> Column:
    """How the statuses of two catalogues agree."""
    hit = lambda c: c != "none"
    return F.when(hit(one) & hit(other), "both_catalogues").when(hit(one), "first_only").when(hit(other), "second_only").otherwise("neither")
