"""Permutation null of exact matches: shuffled residues against the catalogue, which they meet by signature first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..criteria import DEFAULT
from ..functions.variants import per_thousand


#: Catalogue texts of one signature that a candidate carries in a row; more of them take more rows.
TARGETS = 1000


def signature(text: Column) -> Column:
    """Letters of a text in order: a text can be shuffled into another one if both have the same."""
    return F.array_join(F.array_sort(F.split(text, "")), "")


def shuffle(text: Column, perm: Column, seed: int = 0) -> Column:
    """The letters of a text in the order of md5(seed|perm|text|place)."""
    order = F.transform(
        F.sequence(F.lit(1), F.length(text)),
        lambda i: F.struct(F.md5(F.concat_ws("|", F.lit(str(seed)), perm.cast("string"), text, i.cast("string")).cast("binary")).alias("k"), F.substring(text, i, F.lit(1)).alias("c")),
    )
    return F.array_join(F.transform(F.array_sort(order), lambda s: s["c"]), "")


def shuffled_hits(candidates: DataFrame, catalogue: DataFrame, column: str, permutations: int, seed: int = 0) -> DataFrame:
    """(perm, shuffled), distinct: the shuffled candidates that are in the catalogue.

    Candidates meet the catalogue by signature first: one without a catalogue text of its letters can never hit and isn't
    shuffled. The others carry the catalogue texts that they could become, so a shuffle is compared where it is made, and
    only hits are sent on.
    """
    rows = candidates.select(F.col(column).alias("_p")).filter(F.length("_p") > 0).distinct().withColumn("_s", signature(F.col("_p")))
    known = catalogue.select(F.col(column).alias("_t")).filter(F.length("_t") > 0).distinct().withColumn("_s", signature(F.col("_t")))
    # The signatures that candidates have; then slices of the catalogue's texts by signature.
    known = known.join(rows.select("_s").distinct(), "_s", "left_semi").withColumn("_slice", F.pmod(F.xxhash64("_t"), F.lit(1 << 20)))
    n = known.groupBy("_s").agg(F.ceil(F.count("*") / TARGETS).alias("_slices"))
    slices = known.join(n, "_s").groupBy("_s", (F.col("_slice") % F.col("_slices")).alias("_slice")).agg(F.collect_set("_t").alias("_targets"))
    tried = rows.join(slices, "_s").select("_p", "_targets", F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("perm"))
    hits = tried.withColumn("shuffled", shuffle(F.col("_p"), F.col("perm"), seed)).filter(F.array_contains("_targets", F.col("shuffled")))
    return hits.select("perm", "shuffled").distinct()


def permutation_counts(candidates: DataFrame, catalogue: DataFrame, column: str, permutations: int = DEFAULT.permutations, seed: int = 0) -> DataFrame:
    """(perm, hits) for every permutation, zero included."""
    hits = shuffled_hits(candidates, catalogue, column, permutations, seed).groupBy("perm").agg(F.count("*").alias("hits"))
    every = candidates.sparkSession.range(1, permutations + 1).select(F.col("id").cast("int").alias("perm"))
    return every.join(hits, "perm", "left").select("perm", F.coalesce("hits", F.lit(0)).alias("hits"))


def null_summary(counts: DataFrame, observed: DataFrame) -> DataFrame:
    """One row: observed, null mean, sd and max, p, whether p is only a bound, enrichment. observed has one row (observed)."""
    null = counts.agg(F.avg("hits").alias("null_mean"), F.stddev_pop("hits").alias("null_sd"), F.max("hits").alias("null_max"), F.count("*").alias("permutations"), F.sort_array(F.collect_list("hits")).alias("_all"))
    at_least = F.size(F.filter("_all", lambda h: h >= F.col("observed")))
    return observed.withColumn("_k", F.lit(0)).join(null.withColumn("_k", F.lit(0)), "_k").select(
        "observed", "null_mean", "null_sd", "null_max", "permutations", (at_least / F.col("permutations")).alias("p_value"), (at_least == 0).alias("p_bounded"),
        F.round(F.col("observed") / F.nullif("null_mean", F.lit(0.0)), 3).alias("enrichment"),
    )


def observed_matches(candidates: DataFrame, catalogue: DataFrame, column: str) -> DataFrame:
    return candidates.select(column).distinct().join(catalogue.select(column).distinct(), column, "left_semi").agg(F.count("*").alias("observed"))


def rate_table(samples: DataFrame) -> DataFrame:
    """Rows (sample, candidates, matches, …) with the rate per 1,000 candidates."""
    return samples.withColumn("per_1000", per_thousand(F.col("matches"), F.col("candidates")))
