"""Typing results: allele evidence, concordance of callers, copy number against reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.variants import two_field


def allele_evidence(typing: DataFrame) -> DataFrame:
    """Shares of an allele's fragments within (sample, gene) and the flags lost, expressed and low_expression."""
    w = W.partitionBy("sample", "gene")
    share = lambda c: F.col(c) / F.nullif(F.sum(c).over(w), F.lit(0))
    out = typing.withColumns({"dna_share": share("TumorTotal"), "rna_share": share("RnaTotal")})
    return out.withColumns({"lost": F.col("dna_share") < 0.10, "expressed": F.col("RnaTotal") >= 10, "low_expression": F.col("rna_share") < 0.15})


def concordance(calls: DataFrame) -> DataFrame:
    """Per (sample, gene): allele pairs of every caller (two fields), and whether all callers that called agree."""
    pairs = calls.groupBy("sample", "gene", "caller").agg(F.sort_array(F.collect_list(two_field(F.col("allele")))).alias("pair"))
    return pairs.groupBy("sample", "gene").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("caller", "pair")))).alias("pairs"), (F.count_distinct("pair") == 1).alias("agree"), F.count("*").alias("callers"))


def against_root(concordant: DataFrame, roots: DataFrame) -> DataFrame:
    """Typing of a sample next to that of its lineage root (roots: sample, root)."""
    root = concordant.select(F.col("sample").alias("root"), "gene", F.col("pairs").alias("root_pairs"))
    same = F.array_distinct(F.flatten(F.map_values("pairs")))
    return concordant.join(roots, "sample").join(root, ["root", "gene"], "left").withColumn("same_as_root", F.array_sort(same) == F.array_sort(F.array_distinct(F.flatten(F.map_values("root_pairs")))))


def cohort_alleles(genotypes: DataFrame, supported: DataFrame) -> DataFrame:
    """One row: samples, distinct alleles, median distinct alleles a sample, alleles no predictor supports."""
    per = genotypes.groupBy("patient").agg(F.count_distinct("allele").alias("n"))
    unsupported = genotypes.select("allele").distinct().join(supported, "allele", "left_anti").agg(F.count("*").alias("unsupported"))
    totals = genotypes.agg(F.count_distinct("patient").alias("samples"), F.count_distinct("allele").alias("alleles"))
    key = F.lit(0).alias("_k")
    return totals.select("*", key).join(per.agg(F.median("n").alias("median_per_sample")).select("*", key), "_k").join(unsupported.select("*", key), "_k").drop("_k")


def copy_number_gap(typing: DataFrame) -> DataFrame:
    """Per (sample, gene): expected minor share from copy numbers, observed one from reads, and their gap."""
    return typing.groupBy("sample", "gene").agg(
        (F.min("TumorCopyNumber") / F.nullif(F.sum("TumorCopyNumber"), F.lit(0.0))).alias("expected"), (F.min("TumorTotal") / F.nullif(F.sum("TumorTotal"), F.lit(0))).alias("observed")
    ).withColumn("gap", F.abs(F.col("expected") - F.col("observed")))
