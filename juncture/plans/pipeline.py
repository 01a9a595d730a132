"""The whole evidence pipeline as one plan over all samples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..criteria import DEFAULT, Criteria
from ..operators import admission, confidence, cross, expression, reads


@dataclass
class Inputs:
    breakends: DataFrame
    peptides: DataFrame
    annotation: DataFrame
    catalogue: DataFrame
    proteome: DataFrame | None = None
    population: DataFrame | None = None
    alignments: DataFrame | None = None
    genes: DataFrame | None = None
    isoforms: DataFrame | None = None


@dataclass
class Evidence:
    junctions: DataFrame
    matches: DataFrame
    events: DataFrame
    every: DataFrame


def evidence(inputs: Inputs, kind: str, pon_max: int | None = None, has_rna: Column | None = None, has_expression: bool = False, criteria: Criteria = DEFAULT) -> Evidence:
    """Admission, pairing, matching, quality, events; then confidence, privacy and reads for every junction once.

    Events take the stage 6 to 8 columns of their junction by a join on (sample, sample_sv_id).
    """
    keys = ["sample", "sample_sv_id"]
    junctions = admission.pair_junctions(admission.admit(inputs.breakends, kind, pon_max, criteria=criteria))
    matches = cross.sequence_quality(cross.level1_identical(inputs.peptides, inputs.annotation, inputs.catalogue), inputs.proteome, criteria)
    events = cross.collapse_events(matches.filter("credible"), keys, "ref_peptide", "ref_gene")
    every = junctions.withColumn("high_confidence", confidence.high_confidence(criteria)).withColumn("event_key", F.concat_ws("|", *keys))
    frequency = None if inputs.population is None else confidence.population_frequency(every, inputs.population, "event_key", criteria)
    every = confidence.with_privacy(every, frequency, "event_key", criteria=criteria)
    rna = F.lit(False) if has_rna is None else has_rna
    if inputs.alignments is not None:
        every = reads.event_evidence(every, reads.fragment_evidence(reads.reads_at_breakends(junctions, inputs.alignments, criteria=criteria), criteria), rna, criteria)
    else:
        every = every.withColumn("rna_tier", F.lit("NA"))
    if inputs.genes is not None and inputs.isoforms is not None:
        about = expression.event_expression(cross.first_of(inputs.annotation, keys, ["gene1", "gene2"]), inputs.genes, inputs.isoforms, has_expression, criteria)
        every = every.join(about.select(*keys, "tpm1", "tpm2", "tpm_min", "n_sides_measured", "expressed"), keys, "left")
    every = every.withColumn("rna_supported", F.col("rna_tier").isin("STRONG", "SUGGESTIVE", "WEAK"))
    return Evidence(junctions, matches, events.join(every, keys, "left"), every)
