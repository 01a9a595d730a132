"""Expression context of events: TPM of both genes, background, novel splice junctions, fusions, retained introns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..criteria import DEFAULT, Criteria
from ..functions.variants import normal_chrom
from .cross import breakpoints
from .ranges import least_within, nearest


def tpm_background(genes: DataFrame, criteria: Criteria = DEFAULT) -> DataFrame:
    """Number of genes and the percentage above each TPM cut, in one row."""
    return genes.agg(F.count("*").alias("genes"), *[F.round(100 * F.avg((F.col("tpm") > t).cast("double")), 6).alias(f"above_{t:g}".replace(".", "_")) for t in criteria.tpm_gradient])


def event_expression(annotation: DataFrame, genes: DataFrame, isoforms: DataFrame, has_expression: bool = True, criteria: Criteria = DEFAULT) -> DataFrame:
    """TPM of each side (transcript, else gene), the smaller one, how many sides are measured, and expressed.

    The smaller of the measured sides counts; without any, or for a sample without expression, expressed is null.
    """
    out = annotation
    for s in (1, 2):
        g = genes.groupBy(F.col("gene").alias(f"gene{s}")).agg(F.max("tpm").alias(f"_g{s}"))
        t = isoforms.groupBy(F.col("transcript").alias(f"transcript_id{s}")).agg(F.max("tpm").alias(f"_t{s}"))
        out = out.join(g, f"gene{s}", "left").join(t, f"transcript_id{s}", "left").withColumn(f"tpm{s}", F.coalesce(f"_t{s}", f"_g{s}")).drop(f"_g{s}", f"_t{s}")
    if not has_expression:
        out = out.withColumns({f"tpm{s}": F.lit(None).cast("double") for s in (1, 2)})
    least = F.least("tpm1", "tpm2")
    return out.withColumns({"tpm_min": least, "n_sides_measured": F.col("tpm1").isNotNull().cast("int") + F.col("tpm2").isNotNull().cast("int"), "expressed": least > criteria.tpm_expressed})


def nearest_splice(events: DataFrame, calls: DataFrame, key: str, criteria: Criteria = DEFAULT, width: int = 100_000) -> DataFrame:
    """Per event the nearest end of a novel splice junction over both breakends, its fragments and type."""
    ends = calls.select(normal_chrom(F.col("Chromosome")).alias("chrom"), F.explode(F.array("SjStart", "SjEnd")).alias("pos"), F.col("FragCount").alias("fragments"), F.col("Type").alias("type"))
    near = nearest(breakpoints(events, [key]), ends, ["chrom"], "pos", ["fragments", "type"], width)
    best = near.filter("near_distance is not null").groupBy(key).agg(F.min_by(F.struct("near_distance", "near_fragments", "near_type"), F.struct("near_distance", "side")).alias("b"))
    return events.select(key).join(best, key, "left").select(key, F.col("b.near_distance").alias("alt_sj_distance"), F.col("b.near_fragments").alias("alt_sj_fragments"), F.col("b.near_type").alias("alt_sj_type"),
                       F.coalesce(F.col("b.near_distance") <= criteria.splice_window, F.lit(False)).alias("alt_sj_within_window"))


def fusion_at(events: DataFrame, calls: DataFrame, key: str, tolerance: int = 1000) -> DataFrame:
    """First fusion call on an event's two chromosomes, in either order, whose upstream end is near either breakend.

    First is by call_row, the calls' order in their file, where there is one, then by id. Support is the first of
    TotalFragments, SplitFrags and CoverageUp that the calls have.
    """
    pair = lambda a, b: F.array_sort(F.array(normal_chrom(F.col(a)), normal_chrom(F.col(b))))
    support = next((c for c in ("TotalFragments", "SplitFrags", "CoverageUp") if c in calls.columns), None)
    order = ["call_row", "FusionId"] if "call_row" in calls.columns else ["FusionId"]
    ends = breakpoints(events.withColumn("chroms", pair("chrom1", "chrom2")), [key, "chroms"]).drop("chrom")
    ups = calls.select(pair("ChrUp", "ChrDown").alias("chroms"), F.col("PosUp").alias("up"), F.struct(*order).alias("_order"), "FusionId", (F.col(support) if support else F.lit(None).cast("long")).alias("_support"))
    hits = least_within(ends, ups, ["chroms"], "pos", "up", tolerance, F.struct("_order", "FusionId", "_support"), "_call")
    return hits.groupBy(key).agg(F.min("_call").alias("f")).select(key, F.col("f.FusionId").alias("fusion_id"), F.col("f._support").alias("fusion_fragments"))


def retained_introns(events: DataFrame, calls: DataFrame, key: str) -> DataFrame:
    """Calls at either gene of an event; null where there is none."""
    genes = events.select(key, F.explode(F.array_distinct(F.array("gene1", "gene2"))).alias("GeneName"))
    n = genes.join(calls.groupBy("GeneName").count(), "GeneName").groupBy(key).agg(F.sum("count").alias("retained_introns"))
    return events.select(key).join(n, key, "left")
