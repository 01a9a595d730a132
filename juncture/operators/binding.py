"""Binding predictions: rules, margins, panel and autologous presentation, funnels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cross import first_of

#: Cut sets by rule name; every column must be at most its cut.
RULES: dict[str, dict[str, float]] = {
    "three_way": {"rank_EL": 2.0, "rank_BA": 2.0, "affinity_nM": 500.0},
    "neo_strong": {"rank_Neo": 0.5},
    "neo_weak": {"rank_Neo": 2.0},
    "mhcflurry": {"affinity_nM": 500.0, "presentation_percentile": 2.0},
}


def passes(cuts: dict[str, float]) -> Column:
    return reduce(lambda a, b: a & b, [F.coalesce(F.col(c) <= most, F.lit(False)) for c, most in cuts.items()])


def margin(cuts: dict[str, float]) -> Column:
    """(margin, cut): the least relative distance below a cut, and the cut that limits it (first named on ties)."""
    each = [F.struct(((most - F.col(c)) / most).alias("margin"), F.lit(k).alias("place"), F.lit(c).alias("cut")) for k, (c, most) in enumerate(cuts.items())]
    return F.array_min(F.array(*each))


def margin_bin(m: Column) -> Column:
    return F.when(m <= 0.10, "flippable").when(m <= 0.25, "marginal").when(m <= 0.50, "solid").when(m.isNotNull(), "robust")


def autologous_verdict(binds: Column, n_typed: Column, n_outside: Column) -> Column:
    return (
        F.when(binds, "binder").when(F.coalesce(n_typed, F.lit(0)) == 0, "unevaluable_no_typed_patient")
        .when(F.coalesce(n_outside, F.lit(0)) > 0, "unevaluable_allele_outside_panel").otherwise("non_binder")
    )


def peptide_summary(predictions: DataFrame, cuts: dict[str, float], peptide: str = "peptide", allele: str = "allele") -> DataFrame:
    """Per peptide: best value of each column, alleles tested and binding, share of the panel, best margin and allele."""
    # One row a peptide and allele first: then alleles are counted, not distinct names.
    m = margin(cuts)
    passing = passes(cuts)
    own = predictions.groupBy(peptide, allele).agg(*[F.min(c).alias(c) for c in cuts], F.bool_or(passing).alias("_pass"), F.max(F.when(passing, m["margin"])).alias("_m"))
    there = F.col(allele).isNotNull()
    return own.groupBy(peptide).agg(
        *[F.min(c).alias(f"best_{c}") for c in cuts], F.count(allele).alias("alleles"), F.count_if(F.col("_pass") & there).alias("alleles_binding"),
        F.max_by(F.when(F.col("_pass"), F.col(allele)), F.when(F.col("_pass"), F.struct("_m", allele))).alias("best_allele"), F.max("_m").alias("best_margin"),
    ).withColumn("panel_share", F.round(F.col("alleles_binding") / F.col("alleles"), 6)).withColumn("margin_bin", margin_bin(F.col("best_margin")))


def cut_attrition(predictions: DataFrame, cuts: dict[str, float]) -> DataFrame:
    """Rows that pass each cut alone, and all of them."""
    return predictions.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c) <= most).alias(f"pass_{c}") for c, most in cuts.items()], F.count_if(passes(cuts)).alias("pass_all"))


def check_submitted(peptides: DataFrame, predictions: DataFrame, panel: DataFrame | None = None) -> None:
    """Refuse when a peptide was never predicted, or when no prediction allele is spelled as in the panel."""
    missing = peptides.select("peptide").join(predictions.select("peptide"), "peptide", "left_anti")
    if not missing.isEmpty():
        raise ValueError(f"peptides without predictions, for example {missing.first()['peptide']}")
    if panel is not None and predictions.select("allele").join(panel.select("allele"), "allele", "left_semi").isEmpty():
        raise ValueError("no prediction allele is in the panel; compare the spellings")


def autologous(patient_peptides: DataFrame, genotypes: DataFrame, binding: DataFrame, panel: DataFrame) -> DataFrame:
    """Per peptide: patients that carry it, typed ones, those whose own alleles present it, alleles outside the panel.

    binding holds the (peptide, allele) pairs that pass the rule.
    """
    carried = patient_peptides.select("patient", F.col("neoantigen").alias("peptide")).distinct()
    # Alleles stay in the row of their patient, and those that present a peptide in the peptide's: what a patient carries is
    # one row, not one for each allele, and is shuffled by the peptide only.
    own = genotypes.select("patient", "allele").filter("allele is not null").distinct().join(panel.select("allele").distinct().withColumn("_in", F.lit(True)), "allele", "left")
    own = own.groupBy("patient").agg(F.collect_list(F.struct("allele", F.col("_in").isNull().alias("_outside"))).alias("_own"))
    presenting = binding.groupBy("peptide").agg(F.collect_set("allele").alias("_binding"))
    rows = carried.join(own, "patient", "left").join(presenting, "peptide", "left")
    there, presents = F.col("patient").isNotNull(), F.coalesce(F.arrays_overlap("_own.allele", "_binding"), F.lit(False))
    patients = rows.groupBy("peptide").agg(F.count("patient").alias("patients"), F.count_if(F.col("_own").isNotNull() & there).alias("patients_typed"), F.count_if(presents & there).alias("patients_presenting"))
    of_allele = rows.select("peptide", "_binding", F.inline("_own")).groupBy("peptide", "allele").agg(F.bool_or("_outside").alias("outside"), F.bool_or(F.coalesce(F.array_contains("_binding", F.col("allele")), F.lit(False))).alias("binds"))
    alleles = of_allele.groupBy("peptide").agg(F.count_if("outside").alias("alleles_outside"), F.sort_array(F.collect_list(F.when(F.col("binds"), F.col("allele")))).alias("presenting_alleles"))
    out = patients.join(alleles, "peptide", "left").withColumns({"alleles_outside": F.coalesce("alleles_outside", F.lit(0)), "presenting_alleles": F.coalesce("presenting_alleles", F.array().cast("array<string>"))})
    return out.withColumn("verdict", autologous_verdict(F.col("patients_presenting") > 0, F.col("patients_typed"), F.col("alleles_outside")))


def event_binding(events: DataFrame, peptides: DataFrame, key: str) -> DataFrame:
    """Per event over its peptides (full array): how many bind, bind with a robust margin, and whether any does."""
    rows = events.select(key, F.explode("peptides").alias("peptide")).join(peptides, "peptide", "left")
    binds = F.coalesce(F.col("alleles_binding") > 0, F.lit(False))
    n = rows.groupBy(key).agg(F.count("*").alias("n_peptides"), F.count_if(binds).alias("n_binding"), F.count_if(binds & (F.col("margin_bin") == "robust")).alias("n_robust"), F.bool_or(binds).alias("any_binding"))
    return n


def binding_funnel(event_counts: DataFrame) -> DataFrame:
    """(step, n): events, with a binder, with a robust one."""
    one = event_counts.agg(F.count("*").alias("events"), F.count_if("any_binding").alias("events_binding"), F.count_if(F.col("n_robust") > 0).alias("events_robust"))
    return one.unpivot([], one.columns, "step", "n")


def own_presentability(predictions: dict[str, DataFrame], genotype: DataFrame, rules: dict[str, dict[str, float]]) -> DataFrame:
    """Per peptide and predictor the best own allele by margin, and whether the predictors agree on presentation."""
    out = None
    for name, table in predictions.items():
        cuts = rules[name]
        own = table.join(genotype.select("allele").distinct(), "allele", "left_semi").withColumns({"_m": margin(cuts), "_pass": passes(cuts)})
        best = own.groupBy("peptide").agg(F.bool_or("_pass").alias(f"{name}_presented"), F.max_by("allele", F.struct("_m.margin", "allele")).alias(f"{name}_allele"), F.max("_m.margin").alias(f"{name}_margin"))
        out = best if out is None else out.join(best, "peptide", "full")
    flags = [F.col(f"{n}_presented") for n in predictions]
    return out.withColumn("predictors_agree", reduce(lambda a, b: a & b, [flags[0] == f for f in flags[1:]], F.lit(True)))


def version_concordance(old: DataFrame, new: DataFrame, cuts: dict[str, float]) -> DataFrame:
    """One row: shared (peptide, allele) pairs, agreement per cut and in all, largest change of each column."""
    keys = ["peptide", "allele"]
    a, b = (first_of(t, keys, list(cuts)).select(*keys, *[F.col(c).alias(f"{c}_{s}") for c in cuts]) for t, s in ((old, "old"), (new, "new")))
    both = a.join(b, keys)
    ok = {s: reduce(lambda x, y: x & y, [F.col(f"{c}_{s}") <= m for c, m in cuts.items()]) for s in ("old", "new")}
    return both.agg(
        F.count("*").alias("shared"), *[F.count_if((F.col(f"{c}_old") <= m) == (F.col(f"{c}_new") <= m)).alias(f"agree_{c}") for c, m in cuts.items()],
        F.count_if(ok["old"] == ok["new"]).alias("agree_all"), *[F.max(F.abs(F.col(f"{c}_old") - F.col(f"{c}_new"))).alias(f"max_delta_{c}") for c in cuts],
    )


def self_disagreement(predictions: DataFrame, cuts: dict[str, float]) -> DataFrame:
    """(peptide, allele) pairs predicted more than once with different verdicts."""
    return predictions.withColumn("_p", passes(cuts)).groupBy("peptide", "allele").agg(F.count("*").alias("n"), F.count_if("_p").alias("n_pass")).filter("n > 1 and n_pass > 0 and n_pass < n")


def predictable(peptides: DataFrame, column: str) -> DataFrame:
    """peptides with drop_reason: too short, too long, non-standard residue, or null where it can be predicted."""
    n = F.length(column)
    return peptides.withColumn("drop_reason", F.when(n < 8, "too_short").when(n > 14, "too_long").when(~F.col(column).rlike("^[ACDEFGHIKLMNPQRSTVWY]+$"), "non_standard_residue"))
