"""Lineages of samples: closure, order, attribution of events to the earliest carrier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..criteria import DEFAULT
from .ranges import nearest


def closure(samples: DataFrame, name: str = "name", parent: str = "parent", most: int = 1000) -> DataFrame:
    """(sample, ancestor, depth) for every proper ancestor; depth 1 is the parent.

    A parent that is not a sample makes a root; a cycle ends where a sample would repeat. Levels are joined until one
    is empty, so the work follows the depth of the tree.
    """
    edges = samples.select(F.col(name).alias("sample"), F.col(parent).alias("ancestor")).join(samples.select(F.col(name).alias("ancestor")), "ancestor", "left_semi")
    level = edges.filter("sample <> ancestor").select("sample", "ancestor", F.lit(1).alias("depth"), F.array("sample", "ancestor").alias("path"))
    up = edges.select(F.col("sample").alias("ancestor"), F.col("ancestor").alias("up"))
    out = level
    for _ in range(most):
        level = level.join(up, "ancestor").filter(~F.array_contains("path", F.col("up"))).select("sample", F.col("up").alias("ancestor"), (F.col("depth") + 1).alias("depth"), F.concat("path", F.array("up")).alias("path"))
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out.select("sample", "ancestor", "depth")


def processing_order(samples: DataFrame) -> DataFrame:
    """Samples with their depth from the root; parents come before children."""
    depth = closure(samples).groupBy("sample").agg(F.max("depth").alias("level"))
    return samples.join(depth.withColumnRenamed("sample", "name"), "name", "left").withColumn("level", F.coalesce("level", F.lit(0)))


def attribute(events: DataFrame, breakpoints: DataFrame, ancestors: DataFrame, key: str, tolerance: int = DEFAULT.attribution_tolerance, width: int = 100_000) -> DataFrame:
    """key, sample, attributed_to, checked, acquired: the root-most ancestor with both breakpoints of an event.

    breakpoints has (sample, chrom, pos); the two ends may be of different junctions of the ancestor. checked lists
    the ancestors from the root up to the one found, `name:yes` or `name:no`. An end is held against the nearest breakpoint
    of an ancestor only, so it meets one place however many lie around it.
    """
    ask = events.select(key, "sample", "chrom1", "pos1", "chrom2", "pos2").join(ancestors, "sample")
    hits = []
    for s in (1, 2):
        side = ask.select(key, "sample", "ancestor", F.col(f"chrom{s}").alias("chrom"), F.col(f"pos{s}").alias("pos"))
        known = breakpoints.select(F.col("sample").alias("ancestor"), "chrom", "pos")
        near = nearest(side, known, ["ancestor", "chrom"], "pos", [], width).filter(F.col("near_distance") <= tolerance)
        hits.append(near.select(key, "sample", "ancestor").distinct().withColumn(f"hit{s}", F.lit(True)))
    both = ask.select(key, "sample", "ancestor", "depth")
    for h in hits:
        both = both.join(h, [key, "sample", "ancestor"], "left")
    both = both.withColumn("hit", F.coalesce(F.col("hit1") & F.col("hit2"), F.lit(False)))
    per = both.groupBy(key, "sample").agg(
        F.max_by(F.when(F.col("hit"), F.col("ancestor")), F.when(F.col("hit"), F.col("depth"))).alias("found"), F.max(F.when(F.col("hit"), F.col("depth"))).alias("at"),
        F.array_sort(F.collect_list(F.struct((-F.col("depth")).alias("order"), "ancestor", "hit"))).alias("all"),
    )
    seen = F.transform(F.filter("all", lambda s: F.col("at").isNull() | (-s["order"] >= F.col("at"))), lambda s: F.concat(s["ancestor"], F.when(s["hit"], ":yes").otherwise(":no")))
    out = events.select(key, "sample").join(per.withColumn("checked", F.concat_ws(";", seen)), [key, "sample"], "left")
    return out.select(key, "sample", F.coalesce("found", "sample").alias("attributed_to"), F.coalesce("checked", F.lit("root sample")).alias("checked"), F.col("found").isNull().alias("acquired"))
