"""Matches of candidates with the catalogue, sequence quality, events, proximity of breakpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..criteria import DEFAULT, Criteria
from ..functions.sequence import is_low_complexity, windows
from .ranges import nearest


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key in a stated order."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def level1_identical(peptides: DataFrame, annotation: DataFrame, catalogue: DataFrame, require_spanning: bool = False) -> DataFrame:
    """Candidates whose peptide is in the catalogue, with the genes of their variant and two concordance flags.

    Gene concordance is with either side, null where a gene is unknown. Rows of annotation are one per variant first.
    """
    if require_spanning:
        peptides = peptides.filter(F.coalesce("spans_junction", F.lit(False)))
    keep = [c for c in ("spans_junction", "frame_effect") if c in peptides.columns]
    made = peptides.select("sample", "sample_sv_id", F.upper(F.trim("neopeptide")).alias("ref_peptide"), *keep).join(catalogue.select("ref_peptide").distinct(), "ref_peptide", "left_semi")
    about = first_of(annotation, ["sample", "sample_sv_id"], ["gene1", "gene2"]).select("sample", "sample_sv_id", "gene1", "gene2", "svtype")
    # The variant is joined before the catalogue: of a peptide with many catalogue rows one row is shuffled, not one for each.
    found = made.join(about, ["sample", "sample_sv_id"], "left").join(catalogue, "ref_peptide")
    ref = F.upper(F.trim("ref_gene"))
    sides = [ref == F.upper(F.trim(c)) for c in ("gene1", "gene2")]
    order = ["sample", "sample_sv_id", "ref_peptide", *keep, *[c for c in catalogue.columns if c != "ref_peptide"], "gene1", "gene2", "svtype"]
    return found.select(*order).withColumns(
        {"gene_concordant": sides[0] | sides[1], "svtype_concordant": F.upper("ref_svtype") == F.upper("svtype")}
    )


def level2_gene_svtype(annotation: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Variants whose first gene has a catalogue row, with whether the class agrees."""
    ref = catalogue.select(F.upper(F.trim("ref_gene")).alias("gene"), "ref_peptide", "ref_svtype")
    own = annotation.withColumn("gene", F.upper(F.trim("gene1")))
    return own.join(ref, "gene").withColumn("svtype_match", F.upper("svtype") == F.upper("ref_svtype"))


def level2_variants(annotation: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The flags of each variant's catalogue rows. A gene's classes count, not its peptides, so no row is made for each."""
    classes = catalogue.select(F.upper(F.trim("ref_gene")).alias("ref_gene"), F.lit(None).cast("string").alias("ref_peptide"), F.upper("ref_svtype").alias("ref_svtype")).distinct()
    return level2_flags(level2_gene_svtype(annotation, classes))


def breakpoints(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per end: keep, side, chrom, pos."""
    ends = F.array(*[F.struct(F.lit(s).alias("side"), F.col(f"chrom{s}").alias("chrom"), F.col(f"pos{s}").alias("pos")) for s in (1, 2)])
    return df.select(*keep, F.inline(ends))


def level3_proximity(pool: DataFrame, junctions: DataFrame, key: str, windows_kb: Sequence[int] = DEFAULT.windows_kb, width: int = 100_000) -> DataFrame:
    """Per pool row the distance of each end to the nearest junction end, and whether any or both lie in each window."""
    near = nearest(breakpoints(pool, [key]), breakpoints(junctions, []).select("chrom", "pos"), ["chrom"], "pos", [], width)
    ends = near.groupBy(key).agg(*[F.max(F.when(F.col("side") == s, F.col("near_distance"))).alias(f"dist_bp{s}") for s in (1, 2)])
    flags = {}
    for kb in windows_kb:
        inside = [F.coalesce(F.col(f"dist_bp{s}") <= kb * 1000, F.lit(False)) for s in (1, 2)]
        flags |= {f"any_within_{kb}kb": inside[0] | inside[1], f"both_within_{kb}kb": inside[0] & inside[1]}
    return ends.withColumns(flags)


def junction_recurrence(junctions: DataFrame, pool: DataFrame, key: str = "sample_sv_id", width: int = 100_000) -> DataFrame:
    """Per junction the nearest pool breakpoint of each end, with its class and gene; the nearer end names them."""
    refs = breakpoints(pool, ["svtype", "gene1"]).select("chrom", "pos", "svtype", "gene1")
    near = nearest(breakpoints(junctions, [key]), refs, ["chrom"], "pos", ["svtype", "gene1"], width)
    end = lambda s, c: F.max(F.when(F.col("side") == s, F.col(c)))
    both = near.groupBy(key).agg(*[end(s, f"near_{c}").alias(f"{c}{s}") for s in (1, 2) for c in ("distance", "svtype", "gene1")])
    closest = F.least("distance1", "distance2")
    first = F.col("distance1") == closest
    return both.select(
        key, closest.alias("patient_bp_dist_bp"), F.col("distance1").alias("patient_bp_dist_bp1"), F.col("distance2").alias("patient_bp_dist_bp2"),
        F.coalesce((F.col("distance1") <= 10_000) & (F.col("distance2") <= 10_000), F.lit(False)).alias("patient_bp_both_within_10kb"),
        F.when(first, F.col("svtype1")).otherwise(F.col("svtype2")).alias("patient_svtype"), F.when(first, F.col("gene11")).otherwise(F.col("gene12")).alias("patient_gene"),
    )


def self_peptides(peptides: DataFrame, proteome: DataFrame | None, column: str, lengths: Sequence[int] = DEFAULT.peptide_lengths) -> DataFrame:
    """peptides with is_self: the peptide lies in one protein; null without a proteome. An equi-join on k-mers."""
    if proteome is None:
        return peptides.withColumn("is_self", F.lit(None).cast("boolean"))
    kmers = proteome.select(F.explode(windows(F.col("sequence"), lengths)).alias("w")).select(F.col("w.peptide").alias(column)).distinct().withColumn("_self", F.lit(True))
    return peptides.join(kmers, column, "left").withColumn("is_self", F.coalesce("_self", F.lit(False))).drop("_self")


def sequence_quality(matches: DataFrame, proteome: DataFrame | None, criteria: Criteria = DEFAULT) -> DataFrame:
    """low_complexity, is_self and credible; an unknown self test counts as not self, an unknown concordance as false."""
    marked = self_peptides(matches, proteome, "ref_peptide", criteria.peptide_lengths).withColumn("low_complexity", is_low_complexity(F.col("ref_peptide"), criteria))
    credible = ~F.col("low_complexity") & ~F.coalesce("is_self", F.lit(False)) & F.coalesce("gene_concordant", F.lit(False))
    return marked.withColumn("credible", credible)


def collapse_events(matches: DataFrame, keys: Sequence[str], peptide: str, gene: str) -> DataFrame:
    """Credible matches to events: distinct peptides and genes as sorted arrays, and their numbers."""
    return matches.groupBy(*keys).agg(
        F.count_distinct(peptide).cast("long").alias("n_peptides"), F.sort_array(F.collect_set(peptide)).alias("peptides"), F.sort_array(F.collect_set(gene)).alias("genes"), F.count("*").alias("n_rows")
    )


def counts_per_variant(variants: DataFrame, peptides: DataFrame, matches: DataFrame) -> DataFrame:
    """Generated, matched and credible peptides and catalogue genes of every variant, zero where none."""
    keys = ["sample", "sample_sv_id"]
    made = peptides.select(*keys, "neopeptide").distinct().groupBy(*keys).agg(F.count("neopeptide").alias("n_generated"))
    own = matches.groupBy(*keys, "ref_peptide").agg(F.coalesce(F.bool_or("credible"), F.lit(False)).alias("_credible"), F.collect_set("ref_gene").alias("_genes"))
    there = F.col("ref_peptide").isNotNull()
    hit = own.groupBy(*keys).agg(F.count("ref_peptide").alias("n_matched"), F.count_if(F.col("_credible") & there).alias("n_credible"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_genes")))).alias("catalogue_genes"))
    return variants.join(made, keys, "left").join(hit, keys, "left").fillna(0, ["n_generated", "n_matched", "n_credible"])


def level2_flags(level2: DataFrame) -> DataFrame:
    """Per variant: does any class agree, and the first five gene names."""
    return level2.groupBy("sample", "sample_sv_id").agg(F.bool_or("svtype_match").alias("any_svtype_match"), F.slice(F.sort_array(F.collect_set("gene")), 1, 5).alias("genes"))
