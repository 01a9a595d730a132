"""Admission of breakends and pairing into junctions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..criteria import DEFAULT, Criteria
from ..functions.variants import event_size, inserted_bases, mate_chrom, mate_pos


def passes_panel(pon_count: Column, pon_max: int) -> Column:
    """An absent count passes."""
    return F.coalesce(pon_count, F.lit(0)) < pon_max


def admission_rules(kind: str, pon_max: int | None, admit_panel_filtered: bool, criteria: Criteria = DEFAULT) -> dict[str, Column]:
    """Rules by name, in order; each is counted on what the ones before it left."""
    keep = criteria.somatic_filters_with_panel if admit_panel_filtered else criteria.somatic_filters
    rules = {"filter": F.coalesce(F.col("filter"), F.lit("")).isin(*keep) if kind == "somatic" else F.lit(True), "paired": F.col("mateid").isNotNull() | mate_pos(F.col("alt")).isNotNull()}
    if pon_max is not None:
        rules["panel"] = passes_panel(F.col("pon_count"), pon_max)
    return rules


def admit(breakends: DataFrame, kind: str, pon_max: int | None = None, admit_panel_filtered: bool = False, criteria: Criteria = DEFAULT) -> DataFrame:
    rule = F.lit(True)
    for r in admission_rules(kind, pon_max, admit_panel_filtered, criteria).values():
        rule = rule & r
    return breakends.filter(rule)


def attrition(df: DataFrame, rules: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """Rows left after each rule, in one pass: (keys, step, n) with `records` first."""
    left, counts = F.lit(True), [F.count("*").alias("records")]
    for name, rule in rules.items():
        left = left & F.coalesce(rule, F.lit(False))
        counts.append(F.count_if(left).alias(name))
    return df.groupBy(*(keys or [])).agg(*counts).unpivot(keys or [], ["records", *rules], "step", "n")


def panel_admitted(breakends: DataFrame) -> DataFrame:
    """Per sample the records that the caller's own panel filter marked."""
    return breakends.groupBy("sample").agg(F.count_if(F.array_contains(F.split("filter", ";"), "PON")).alias("caller_pon_admitted"))


def pair_junctions(admitted: DataFrame) -> DataFrame:
    """One row per junction: each breakend with its mate by id, else with the coordinate in its ALT.

    A junction is known by the sorted pair of its record's id and its mate's id, or the mate's coordinate where there
    is no mate record; the first record in file order gives side 1, and records with neither go. Where the mate was
    not admitted, side 2 has the record's own evidence. The panel count is the largest of the ends, the inserted bases
    the longer of the ends; ends on two chromosomes have no size.
    """
    a = admitted.withColumn("insert_seq", inserted_bases(F.col("ref"), F.col("alt"))).alias("a")
    b = admitted.withColumn("insert_seq", inserted_bases(F.col("ref"), F.col("alt"))).alias("b")
    both = a.join(b, (F.col("a.sample") == F.col("b.sample")) & (F.col("a.mateid") == F.col("b.id")), "left")
    there = F.concat(mate_chrom(F.col("a.alt")), F.lit(":"), mate_pos(F.col("a.alt")).cast("string"))
    key = F.array_sort(F.array(F.col("a.id"), F.coalesce("b.id", there)))
    one, two = F.coalesce(F.length("a.insert_seq"), F.lit(0)), F.coalesce(F.length("b.insert_seq"), F.lit(0))
    side2 = lambda c: F.when(F.col("b.id").isNull(), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}"))
    evidence = ("qual", "vf", "sf", "df", "ref_reads", "segmapq")
    rows = both.filter(F.col("b.id").isNotNull() | mate_pos(F.col("a.alt")).isNotNull()).select(
        F.col("a.sample").alias("sample"), key.alias("pair"), F.col("a.id").alias("sample_sv_id"), F.col("b.id").alias("mate_id"), F.col("a.file_row").alias("file_row"),
        F.col("a.chrom").alias("chrom1"), F.col("a.pos").alias("pos1"), F.coalesce(F.col("b.chrom"), mate_chrom(F.col("a.alt"))).alias("chrom2"),
        F.coalesce(F.col("b.pos"), mate_pos(F.col("a.alt"))).alias("pos2"), F.col("a.svtype").alias("svtype"),
        F.greatest("a.pon_count", "b.pon_count").alias("pon_count"), F.greatest(one, two).alias("insert_len"), F.when(one >= two, F.col("a.insert_seq")).otherwise(F.col("b.insert_seq")).alias("insert_seq"),
        *[x for c in evidence for x in (F.col(f"a.{c}").alias(f"{c}1"), side2(c).alias(f"{c}2"))],
    )
    first = rows.withColumn("_n", F.row_number().over(W.partitionBy("sample", "pair").orderBy("file_row"))).filter("_n = 1").drop("_n", "pair")
    size = event_size(F.col("svtype"), F.col("pos1"), F.col("pos2"), F.col("insert_len"))
    return first.withColumn("event_size", F.when(F.col("chrom1") == F.col("chrom2"), size))


def panel_size(breakends: DataFrame) -> DataFrame:
    """Estimated panel size of a sample: the largest count seen."""
    return breakends.groupBy("sample").agg(F.max("pon_count").alias("panel_size"))


def with_panel_fraction(df: DataFrame, sizes: DataFrame) -> DataFrame:
    return df.join(sizes, "sample", "left").withColumn("pon_fraction", F.col("pon_count") / F.nullif("panel_size", F.lit(0)))
