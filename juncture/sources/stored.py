"""Stored layouts: alignments by chromosome, region and nested bin, population records by chromosome; reads that prune."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.alignments import span, walk
from ..operators.ranges import CELL, LEVELS, _meets, in_cells, level_widths, levels_in_use, nested_asks, nested_place, parts_of

#: Base width of the stored bins; a region, one folder of a chromosome, is as wide as the widest of them.
WIDTH = 1000
REGION = level_widths(WIDTH)[-1]
#: Loci that are sent to every task, each a few dozen bytes for each level; beyond it both sides are shuffled.
BROADCAST_LOCI = 20_000


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir); where none is set, a temporary one if all runs on this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="juncture-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def _region() -> Column:
    widths = F.array(*[F.lit(w) for w in [*level_widths(WIDTH), REGION]])
    return F.floor(F.col("_bin") * F.get(widths, F.col("_level")) / REGION)


def write_alignments(alignments: DataFrame, path: str, files: int | None = None) -> None:
    """Alignments as Parquet by chrom and region, with end0, gaps, softclip, _level and _bin, and sorted by these within a file.

    A read has one row, however long its gaps are; only a span of more than REGION bases has one for each region that it
    touches. Rows go to files by ranges, so a region with most of the reads has many files, not one task. They are
    shuffled and sorted as they come; the CIGAR is walked where a row is written.
    """
    ends = alignments.withColumn("_end", F.col("start0") + span(F.col("cigar")))
    placed = ends.select(*alignments.columns, F.inline_outer(nested_place(F.col("start0"), F.col("_end"), WIDTH)))
    order = [F.col("chrom"), _region(), F.col("_level"), F.col("_bin"), F.col("start0")]
    ranged = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    ordered = ranged.withColumn("region", _region()).sortWithinPartitions("chrom", "region", "_level", "_bin", "start0")
    walked = ordered.withColumn("_w", walk(F.col("start0"), F.col("cigar"))).select(*alignments.columns, "_w.end0", "_w.gaps", "_w.softclip", "_level", "_bin", "region")
    walked.write.mode("overwrite").partitionBy("chrom", "region").parquet(path, compression="zstd")


def alignments_at(spark: SparkSession, path: str, loci: DataFrame, start: str, end: str, keys: Sequence[str] = (), broadcast_loci: int = BROADCAST_LOCI, reach: int | None = None) -> DataFrame:
    """loci (chrom, [start, end], keys to be equal too) with the stored alignments that overlap them; each pair once.

    Up to broadcast_loci loci are sent to the tasks that read, so stored rows are never shuffled: only folders of regions
    that a locus asks for are read, and in them only row groups of its bins. More are joined by a shuffle of both sides.

    reach: loci are no longer than this. Where both sides are shuffled and no stored read is longer than WIDTH, the pairs
    are those of `in_cells` and keep its `_cell`.
    """
    stored = spark.read.parquet(path).withColumn("chrom", F.col("chrom").cast(loci.schema["chrom"].dataType))
    few = loci.limit(broadcast_loci + 1).count() <= broadcast_loci
    levels = levels_in_use(stored.select("_level"))
    if reach is not None and not few and levels == [0]:
        return in_cells(loci, stored.drop("region", "_level", "_bin"), ["chrom", *keys], (start, end), ("start0", "end0"), CELL * WIDTH, reach, parts=parts_of(stored))
    spots = nested_asks(F.col(start), F.col(end), WIDTH, levels)
    asks = (loci.repartition("chrom", start) if few else loci).select("*", F.inline_outer(spots)).withColumn("region", _region()).filter(F.col("_bin") >= 0)
    joined = stored.alias("b").join(F.broadcast(asks.alias("a")) if few else asks.alias("a").hint("merge"), [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ["chrom", "region", "_level", "_bin", *keys]])
    hit = joined.filter(_meets(start, end, "start0", "end0", WIDTH))
    return hit.select(*[F.col(f"a.{c}").alias(c) for c in loci.columns], *[F.col(f"b.{c}").alias(c) for c in stored.columns if c not in {"chrom", "region", "_level", "_bin", *keys}])


def write_population(records: DataFrame, path: str) -> None:
    """Population records as Parquet by chrom, sorted by start within a file: a query of some chromosomes reads theirs."""
    records.repartitionByRange("chrom", "start").sortWithinPartitions("chrom", "start").write.mode("overwrite").partitionBy("chrom").parquet(path)


def read_population(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("chrom", F.col("chrom").cast("string"))


__all__ = ["LEVELS", "REGION", "WIDTH", "alignments_at", "read_population", "shared_folder", "write_alignments", "write_population"]
