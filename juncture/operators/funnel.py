"""Funnels, ledgers, crosstabs and verdicts; a stage that did not run is null, never 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed order of the evidence funnel.
FUNNEL = (
    "vcf_records", "admitted", "junctions", "candidate_peptides", "matches_identical", "matches_unique_peptides", "matches_gene_concordant",
    "matches_credible", "events", "events_private", "events_hc", "events_rna_supported", "events_hc_and_rna", "events_private_hc_and_rna",
)


def event_funnel(events: DataFrame, keys: Sequence[str], has_rna: Column) -> DataFrame:
    """(keys, step, n) of the event steps over private, high_confidence and rna_supported; RNA steps null without RNA."""
    p, h, r = (F.coalesce(F.col(c), F.lit(False)) for c in ("private", "high_confidence", "rna_supported"))
    rna = F.bool_or(has_rna)
    steps = {"events": F.count("*"), "events_private": F.count_if(p), "events_hc": F.count_if(h), "events_rna_supported": F.when(rna, F.count_if(r)), "events_hc_and_rna": F.when(rna, F.count_if(h & r)), "events_private_hc_and_rna": F.when(rna, F.count_if(p & h & r))}
    return events.groupBy(*keys).agg(*[c.alias(n) for n, c in steps.items()]).unpivot(list(keys), list(steps), "step", "n")


def complete_funnel(counts: DataFrame) -> DataFrame:
    """All fourteen steps of every sample in order (sample, place, step, n); a step without a count is null."""
    steps = F.array(*[F.struct(F.lit(k).alias("place"), F.lit(s).alias("step")) for k, s in enumerate(FUNNEL, 1)])
    every = counts.select("sample").distinct().select("sample", F.inline(steps))
    return every.join(counts, ["sample", "step"], "left").select("sample", "place", "step", "n")


def compare_samples(funnel: DataFrame, steps: Sequence[str] = FUNNEL) -> DataFrame:
    """One row per sample, a column per step."""
    return funnel.groupBy("sample").pivot("step", list(steps)).agg(F.first("n"))


def ledger(df: DataFrame, rules: dict[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """(keys, place, filter, entered, passed, removed) of filters applied in order, from one pass."""
    left, columns = F.lit(True), [F.count("*").alias("c0")]
    for k, rule in enumerate(rules.values(), 1):
        left = left & F.coalesce(rule, F.lit(False))
        columns.append(F.count_if(left).alias(f"c{k}"))
    one = df.groupBy(*keys).agg(*columns)
    rows = F.array(*[F.struct(F.lit(k).alias("place"), F.lit(n).alias("filter"), F.col(f"c{k - 1}").alias("entered"), F.col(f"c{k}").alias("passed"), (F.col(f"c{k - 1}") - F.col(f"c{k}")).alias("removed")) for k, n in enumerate(rules, 1)])
    return one.select(*keys, F.inline(rows))


def grain_ledger(df: DataFrame, rules: dict[str, Column], grain: str, keys: Sequence[str] = (), reported: Sequence[str] = ()) -> DataFrame:
    """(keys, grain, place, filter, applied, entered, passed, removed): a ledger of what each row stands for (breakend,
    junction, peptide row, event). Filters in `reported` say what they would remove, and pass everything on."""
    left, columns = F.lit(True), []
    for k, (name, rule) in enumerate(rules.items()):
        own = left & F.coalesce(rule, F.lit(False))
        columns += [F.count_if(left).alias(f"e{k}"), F.count_if(own).alias(f"p{k}")]
        left = left if name in reported else own
    one = df.groupBy(*keys).agg(*columns)
    rows = F.array(*[
        F.struct(F.lit(k + 1).alias("place"), F.lit(n).alias("filter"), F.lit(n not in reported).alias("applied"), F.col(f"e{k}").alias("entered"), F.col(f"p{k}").alias("passed"), (F.col(f"e{k}") - F.col(f"p{k}")).alias("removed"))
        for k, n in enumerate(rules)])
    return one.select(*keys, F.lit(grain).alias("grain"), F.inline(rows))


def named_losses(df: DataFrame, rule: Column, order: Sequence[Column | str], limit: int = 40) -> DataFrame:
    """The first rows that a filter removes, in a total order: a report of examples."""
    return df.filter(~F.coalesce(rule, F.lit(False))).orderBy(*order).limit(limit)


def marginal_funnel(df: DataFrame, rules: dict[str, Column], group: str) -> DataFrame:
    """(kind, step, group, n): cumulative and marginal counts of rules and their conjunction, by group."""
    left, cols, names = F.lit(True), [], []
    for n, rule in rules.items():
        ok = F.coalesce(rule, F.lit(False))
        left = left & ok
        names += [("marginal", n), ("cumulative", n)]
        cols += [F.count_if(ok), F.count_if(left)]
    names.append(("conjunction", "all"))
    cols.append(F.count_if(left))
    one = df.groupBy(group).agg(*[c.alias(f"c{k}") for k, c in enumerate(cols)])
    return one.select(group, F.inline(F.array(*[F.struct(F.lit(a).alias("kind"), F.lit(b).alias("step"), F.col(f"c{k}").alias("n")) for k, (a, b) in enumerate(names)])))


def line_funnel(universe: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(basis, line, step, n) of cumulative rules per line, on the acquired and the carried basis."""
    parts = [universe.withColumn("line", F.explode(c)).withColumn("basis", F.lit(b)) for b, c in (("acquired", "acquired_in"), ("carried", "present_in"))]
    left, cols = F.lit(True), {"all": F.count("*")}
    for n, rule in rules.items():
        left = left & F.coalesce(rule, F.lit(False))
        cols[n] = F.count_if(left)
    both = parts[0].unionByName(parts[1])
    return both.groupBy("basis", "line").agg(*[c.alias(n) for n, c in cols.items()]).unpivot(["basis", "line"], list(cols), "step", "n")


def near_misses(df: DataFrame, criteria: dict[str, Column], surviving: DataFrame | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Rows that fail exactly one criterion, named in failed; events that survive elsewhere are left out."""
    names = F.array_compact(F.array(*[F.when(~F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in criteria.items()]))
    out = df.withColumn("_failed", names).filter(F.size("_failed") == 1).withColumn("failed", F.col("_failed")[0]).drop("_failed")
    return out if surviving is None else out.join(surviving, list(keys), "left_anti")


def strongest_evidence(identical: Column, gene_and_type: Column, gene: Column, distance: Column) -> Column:
    """Strongest patient evidence in order of precedence."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    return (
        F.when(yes(identical), "identical_peptide").when(yes(gene_and_type), "same_gene_and_svtype").when(yes(gene), "same_gene")
        .when(distance <= 1_000, "within_1kb").when(distance <= 10_000, "within_10kb").when(distance <= 100_000, "within_100kb").otherwise("not_seen")
    )


def crosstab(df: DataFrame, level: str, line: str) -> DataFrame:
    """(level, line, n) with totals of both, `total` standing for all."""
    rolled = df.cube(level, line).agg(F.count("*").alias("n"), F.grouping(level).alias("_a"), F.grouping(line).alias("_b"))
    return rolled.select(F.when(F.col("_a") == 1, "total").otherwise(F.col(level)).alias(level), F.when(F.col("_b") == 1, "total").otherwise(F.col(line)).alias(line), "n")


def locus_versus_peptide(df: DataFrame, close: int = 10_000) -> DataFrame:
    """One row: junctions near a patient breakpoint, with a matching peptide, with both, and medians."""
    near, match = F.coalesce(F.col("distance") <= close, F.lit(False)), F.coalesce(F.col("n_matched") > 0, F.lit(False))
    return df.agg(
        F.count("*").alias("junctions"), F.count_if(near).alias("near_locus"), F.count_if(match).alias("with_match"), F.count_if(near & match).alias("near_and_match"),
        F.round(F.count_if(near & match) / F.nullif(F.count_if(near), F.lit(0)), 6).alias("match_share_near"), F.round(F.count_if(~near & match) / F.nullif(F.count_if(~near), F.lit(0)), 6).alias("match_share_far"),
        F.median("distance").alias("median_distance"), F.median(F.when(match, F.col("distance"))).alias("median_distance_match"),
    )


#: Evidence levels that place an event at a patient locus without an identical peptide.
LOCUS_LEVELS = ("same_gene_and_svtype", "same_gene", "within_1kb", "within_10kb", "within_100kb")


def derivation_steps(df: DataFrame, close: int = 1_000) -> DataFrame:
    """(place, step, n): the steps from all junctions to those that share a peptide, each counted on its own set.

    Needs n_generated, n_matched, distance (of the nearest patient breakpoint), insert_len, evidence, svtype and
    patient_svtype. A missing count is 0, a missing distance is not near.
    """
    made, hit = (F.coalesce(F.col(c), F.lit(0)) > 0 for c in ("n_generated", "n_matched"))
    near, exact = (F.coalesce(x, F.lit(False)) for x in (F.col("distance") <= close, F.col("distance") == 0))
    same_type = F.coalesce(F.col("svtype") == F.col("patient_svtype"), F.lit(False))
    steps = {
        "junctions": F.lit(True), "distance known": F.col("distance").isNotNull(), "evidence level": F.col("evidence").isNotNull(), "locus only": F.coalesce(F.col("evidence").isin(*LOCUS_LEVELS), F.lit(False)),
        "identical peptide": F.coalesce(F.col("evidence") == "identical_peptide", F.lit(False)), "near": near, "near, no peptide": near & ~made, "near, no match": near & made & ~hit, "near, match": near & made & hit,
        "same coordinate": exact, "same coordinate and class": exact & same_type, "same coordinate, inserted": exact & (F.coalesce("insert_len", F.lit(0)) > 0), "same coordinate, peptides": exact & made, "same coordinate, match": exact & made & hit,
    }
    one = df.agg(*[F.count_if(c).alias(n) for n, c in steps.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("place"), F.lit(n).alias("step"), F.col(f"`{n}`").alias("n")) for k, n in enumerate(steps)])
    return one.select(F.inline(rows))


def derivation_medians(df: DataFrame) -> DataFrame:
    """One row: locus junctions for each one with an identical peptide, median inserted lengths at a patient's very
    coordinate without and with a match, and the median and least share of its peptides that a matching junction has."""
    made, hit = F.coalesce(F.col("n_generated"), F.lit(0)), F.coalesce(F.col("n_matched"), F.lit(0))
    there = F.coalesce(F.col("distance") == 0, F.lit(False)) & (made > 0)
    inserted = F.coalesce(F.col("insert_len"), F.lit(0))
    share = F.when(hit > 0, hit / F.nullif(made, F.lit(0)))
    locus = F.count_if(F.coalesce(F.col("evidence").isin(*LOCUS_LEVELS), F.lit(False)))
    return df.agg(
        F.round(locus / F.nullif(F.count_if(F.coalesce(F.col("evidence") == "identical_peptide", F.lit(False))), F.lit(0)), 6).alias("locus_per_identical"),
        F.median(F.when(F.coalesce(F.col("distance") == 0, F.lit(False)) & (inserted > 0), inserted)).alias("insert_median"), F.median(F.when(there & (hit == 0), inserted)).alias("insert_median_unmatched"),
        F.median(F.when(there & (hit > 0), inserted)).alias("insert_median_matched"), F.round(F.median(share), 6).alias("match_share_median"), F.round(F.min(share), 6).alias("match_share_least"),
    )


def by_tier(events: DataFrame, *ties: str) -> DataFrame:
    """Events, the strongest read evidence first, then private ones, then by gene and the given columns."""
    rank = F.when(F.col("rna_tier") == "STRONG", 0).when(F.col("rna_tier") == "SUGGESTIVE", 1).when(F.col("rna_tier") == "WEAK", 2).otherwise(3)
    return events.orderBy(rank, ~F.coalesce(F.col("private"), F.lit(False)), "gene", *ties)


def admission_table(counts: DataFrame, line: str, steps: Sequence[str]) -> DataFrame:
    """Attrition (line, step, n) as one row per line with a column per step."""
    return counts.groupBy(line).pivot("step", list(steps)).agg(F.first("n"))


def run_verdict(df: DataFrame, criteria: dict[str, Column]) -> DataFrame:
    """One row: events, survivors, failures per criterion (overlapping) and a verdict in words."""
    every = F.lit(True)
    for c in criteria.values():
        every = every & F.coalesce(c, F.lit(False))
    one = df.agg(F.count("*").alias("events"), F.count_if(every).alias("survivors"), *[F.count_if(~F.coalesce(c, F.lit(False))).alias(f"fail_{n}") for n, c in criteria.items()])
    return one.withColumn("verdict", F.when(F.col("events") == 0, "emptied before matching").when(F.col("survivors") == 0, "no event meets all criteria").otherwise(F.format_string("%d events survive", "survivors")))


def emptied(counts: DataFrame, key: str, last: str) -> DataFrame:
    """Per run (key): events (n of the step `last`), emptied_by, the first step (by place) that left nothing, and a verdict.

    counts: key, place, step, n; a step that was not run has a null n and empties nothing.
    """
    out = counts.groupBy(key).agg(F.max(F.when(F.col("step") == last, F.col("n"))).alias("events"), F.min_by("step", F.when(F.col("n") == 0, F.col("place"))).alias("_first"), F.count_if(F.col("n") == 0).alias("_none"))
    by = F.when(F.col("_none") > 0, F.col("_first"))
    return out.withColumn("emptied_by", by).withColumn("verdict", F.when(F.col("emptied_by").isNotNull(), F.concat(F.lit("emptied before matching by "), "emptied_by")).otherwise(F.format_string("%d events survive", "events"))).drop("_first", "_none")


def notes(counts: dict[str, Column]) -> Column:
    """Interpretation notes whose condition holds, as an array."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in counts.items()]))


def rank_cohort(rows: DataFrame, peptide: str, patient: str, sets: Sequence[str]) -> DataFrame:
    """Per peptide: patients, rows and sorted sets; order by patients, rows, peptide where it is shown."""
    return rows.groupBy(peptide).agg(F.count_distinct(patient).alias("n_patients"), F.count("*").alias("n_rows"), *[F.sort_array(F.collect_set(c)).alias(f"{c}s") for c in sets])


def top(df: DataFrame, order: Sequence[Column | str], n: int) -> DataFrame:
    """A top-n report."""
    return df.orderBy(*order).limit(n)


def line_verdict(events: DataFrame, judgements: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per line: conjunction peptides, events, kept after judgement, confirmed in DNA, and not common."""
    joined = events.join(judgements, list(keys), "left")
    kept = F.coalesce(F.col("judgement"), F.lit("keep")) != "reject"
    dna, rare = F.coalesce(F.col("dna_confirmed"), F.lit(False)), ~F.coalesce(F.col("common_in_population"), F.lit(False))
    return joined.groupBy("line").agg(F.sum("n_peptides").alias("peptides"), F.count("*").alias("events"), F.count_if(kept).alias("after_judgement"), F.count_if(kept & dna).alias("dna_confirmed"), F.count_if(kept & dna & rare).alias("not_common"))
