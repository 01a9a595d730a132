"""Wide tables: stage outputs joined on the event, peptide rows to events, modality gates, own-sample catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..criteria import DEFAULT, Criteria
from ..functions.sequence import is_low_complexity
from .cross import self_peptides
from .universe import origin


def left_joined(base: DataFrame, tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """base with the columns of each table that are new, by left joins; the first table to bring a column wins."""
    for t in tables:
        fresh = [c for c in t.columns if c not in base.columns]
        base = base.join(t.select(*keys, *fresh), list(keys), "left")
    return base


def with_distinct_count(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """On every row the number of distinct values of its key."""
    return df.join(df.groupBy(*keys).agg(F.count_distinct(column).alias(name)), list(keys), "left")


def peptide_rows_to_events(rows: DataFrame, keys: Sequence[str], flags: Sequence[str], best: Sequence[str], facts: Sequence[str]) -> DataFrame:
    """One row per event: peptides, any of the flags, least of the ranks, and the facts of its first peptide.

    Rows of one peptide are brought together first, so that distinct peptides are plain counts. `first` is by peptide, so
    the result does not depend on row order.
    """
    held = [F.bool_or(F.coalesce(c, F.lit(False))).alias(f"any_{c}") for c in flags]
    own = rows.groupBy(*keys, "peptide").agg(*held, *[F.min(c).alias(c) for c in best], *([F.first(F.struct(*facts)).alias("_facts")] if facts else []))
    there = F.col("peptide").isNotNull()
    out = own.groupBy(*keys).agg(
        F.count("peptide").alias("n_peptides"), F.sort_array(F.collect_list("peptide")).alias("peptides"), *[F.bool_or(f"any_{c}").alias(f"any_{c}") for c in flags],
        *[F.count_if(F.col(f"any_{c}") & there).alias(f"n_{c}") for c in flags], *[F.min(c).alias(f"best_{c}") for c in best], *([F.min_by("_facts", "peptide").alias("_facts")] if facts else []),
    )
    return out.select("*", "_facts.*").drop("_facts") if facts else out


def gate(value: Column, measured: Column) -> Column:
    """The value where its modality was measured, else null."""
    return F.when(F.coalesce(measured, F.lit(False)), value)


def with_modalities(df: DataFrame, samples: DataFrame) -> DataFrame:
    """df with has_rna and has_expression of its sample; an unlisted sample has neither."""
    kept = samples.select(F.col("name").alias("sample"), "has_rna", "has_expression")
    return df.join(kept, "sample", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("has_rna", "has_expression")})


def own_catalogue(somatic: DataFrame, parental: DataFrame, proteome: DataFrame | None, criteria: Criteria = DEFAULT) -> DataFrame:
    """Own-sample candidates (neopeptide, origin, low_complexity, is_self, usable) of two runs."""
    both = somatic.select("neopeptide", F.lit("somatic").alias("origin")).unionByName(parental.select("neopeptide", F.lit("parental").alias("origin")))
    marked = self_peptides(origin(both, "neopeptide", "origin"), proteome, "neopeptide", criteria.peptide_lengths).withColumn("low_complexity", is_low_complexity(F.col("neopeptide"), criteria))
    return marked.withColumn("usable", ~F.col("low_complexity") & ~F.coalesce("is_self", F.lit(False)))


def stack(parts: dict[str, DataFrame], name: str) -> DataFrame:
    """Tables of samples, runs or lines under one another, the key of each in column `name`; a column that a table
    lacks is null there."""
    if not parts:
        raise ValueError("no tables")
    out = None
    for key, df in parts.items():
        one = df.withColumn(name, F.lit(key))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out
