"""Candidate universe over a lineage: who acquired and who carries a peptide, enrichment, named views."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def collapse_lines(rows: DataFrame, peptide: str, line: str, order: str) -> DataFrame:
    """One row per peptide: sorted array of lines, and the attributes of its first row by (order, line)."""
    rest = [c for c in rows.columns if c not in (peptide, line, order)]
    aggregates = [F.sort_array(F.collect_set(line)).alias("acquired_in")]
    if rest:
        aggregates.append(F.min_by(F.struct(*rest), F.struct(order, line, *rest)).alias("_first"))
    out = rows.groupBy(peptide).agg(*aggregates)
    return out.select(peptide, "acquired_in", *(["_first.*"] if rest else []))


def origin(rows: DataFrame, peptide: str, column: str) -> DataFrame:
    """Per peptide its one origin, or both."""
    return rows.groupBy(peptide).agg(F.when(F.count_distinct(column) > 1, "both").otherwise(F.min(column)).alias("origin"))


def with_presence(universe: DataFrame, closure: DataFrame, peptide: str) -> DataFrame:
    """present_in: the acquiring lines and all their descendants (closure: sample, ancestor)."""
    lines = universe.select(peptide, F.explode("acquired_in").alias("ancestor")).join(closure.select("sample", "ancestor"), "ancestor")
    more = lines.groupBy(peptide).agg(F.collect_set("sample").alias("_more"))
    return universe.join(more, peptide, "left").withColumn("present_in", F.sort_array(F.array_union("acquired_in", F.coalesce("_more", F.array().cast("array<string>"))))).drop("_more")


def with_matches(candidates: DataFrame, matches: DataFrame, key: str, names: dict[str, str]) -> DataFrame:
    """candidates with matched (true or null) and renamed cohort columns."""
    right = matches.select(key, *[F.col(a).alias(b) for a, b in names.items()]).dropDuplicates([key]).withColumn("matched", F.lit(True))
    return candidates.join(right, key, "left")


def enrich(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Many-to-one left join that refuses columns df already has, and a table with two rows of one key."""
    clash = sorted(set(df.columns) & (set(table.columns) - {key}))
    if clash:
        raise ValueError(f"columns exist already: {', '.join(clash)}")
    double = table.groupBy(key).count().filter("count > 1")
    if not double.isEmpty():
        raise ValueError(f"more than one row for {key} {double.first()[key]}")
    return df.join(table, key, "left")




def views() -> dict[str, Column]:
    c = F.col
    credible, private = F.coalesce(c("credible"), F.lit(False)), ~F.coalesce(c("common_in_population"), F.lit(False))
    matched, binder = F.coalesce(c("matched"), F.lit(False)), F.coalesce(c("binder"), F.lit(False))
    hc, rna = F.coalesce(c("high_confidence"), F.lit(False)), c("rna_tier").isin("STRONG", "SUGGESTIVE", "WEAK")
    return {
        "all": F.lit(True), "matched": matched, "unmatched": ~matched, "credible": credible, "credible_private": credible & private, "binders": credible & binder,
        "private_binders": credible & private & binder, "transcribed": credible & rna, "confident": credible & hc, "conjunction": credible & private & binder & hc & rna,
    }


def view(universe: DataFrame, name: str, line: str | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """Rows of a named view; of a line (present there), or acquired in no line outside `only`."""
    known = views()
    if name not in known:
        raise ValueError(f"unknown view {name}; known: {', '.join(known)}")
    out = universe.filter(known[name])
    if line is not None:
        out = out.filter(F.array_contains("present_in", line))
    if only is not None:
        out = out.filter(F.forall("acquired_in", lambda x: x.isin(*only)))
    return out


class Step:
    """One enrichment of a chain: its function and the columns it needs, adds and drops."""

    def __init__(self, name: str, run: Callable[[DataFrame], DataFrame], requires: Sequence[str] = (), adds: Sequence[str] = (), drops: Sequence[str] = ()) -> None:
        self.name, self.run, self.requires, self.adds, self.drops = name, run, set(requires), set(adds), set(drops)


def annotate(universe: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Run steps in order; refuse one whose columns are missing or would be overwritten, before anything runs."""
    have = set(universe.columns)
    for s in steps:
        if missing := sorted(s.requires - have):
            raise ValueError(f"{s.name} needs {', '.join(missing)}")
        if clash := sorted((s.adds & have) - s.drops):
            raise ValueError(f"{s.name} would overwrite {', '.join(clash)}")
        have = (have - s.drops) | s.adds
    for s in steps:
        universe = universe.transform(s.run)
    return universe
