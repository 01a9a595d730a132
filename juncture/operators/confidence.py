"""Call confidence, panel and population frequency, privacy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..criteria import DEFAULT, Criteria
from ..functions.variants import ancestry_maximum
from .admission import passes_panel
from .ranges import reciprocal_best


def high_confidence(criteria: Criteria = DEFAULT) -> Column:
    """Both ends well mapped, supported and called; size matters inside a chromosome where it is known."""
    ends = F.lit(True)
    for s in (1, 2):
        for c, least in (("segmapq", criteria.hc_segmapq), ("vf", criteria.hc_vf), ("qual", criteria.hc_qual)):
            ends = ends & F.coalesce(F.col(f"{c}{s}") >= least, F.lit(False))
    size = (F.col("chrom1") != F.col("chrom2")) | F.col("event_size").isNull() | (F.col("event_size") >= criteria.hc_size)
    return ends & size


def population_frequency(events: DataFrame, records: DataFrame, key: str, criteria: Criteria = DEFAULT) -> DataFrame:
    """key, af, popmax, popmax_population of the best reciprocal overlap of sized events on one chromosome.

    Best is the highest af; of equal ones the highest frequency of the first ancestry, then of the next, in the order of
    the columns, a missing one before any.
    """
    own = events.filter("chrom1 = chrom2 and event_size is not null").select(key, F.col("chrom1").alias("chrom"), F.least("pos1", "pos2").alias("e0"), F.greatest("pos1", "pos2").alias("e1"))
    cols = [c for c in records.columns if c.startswith("af")]
    ancestries = [x for c in cols if c != "af" for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(c))]
    known = records.filter("af is not null")
    best = reciprocal_best(own, known, ["chrom"], ("e0", "e1"), ("start", "end"), criteria.reciprocal_overlap, F.struct("af", *ancestries))
    best = best.groupBy(key).agg(F.max("_best").alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in cols])
    groups = {c[3:]: F.col(c) for c in cols if c.startswith("af_")}
    top = ancestry_maximum(groups) if groups else F.struct(F.col("af"), F.lit("global").alias("population"))
    return best.withColumn("_top", top).select(key, *cols, F.col("_top.af").alias("popmax"), F.col("_top.population").alias("popmax_population"))


def with_privacy(events: DataFrame, frequency: DataFrame | None, key: str, field: str = "popmax", pon_in_privacy: bool = True, pon_max: int | None = None, gnomad_max_af: float | None = None, criteria: Criteria = DEFAULT) -> DataFrame:
    """pass_pon, pass_population, private and privacy_note; an absent frequency passes and the note says which kind."""
    limit = criteria.gnomad_max_af if gnomad_max_af is None else gnomad_max_af
    if frequency is None:
        joined = events.withColumn("_af", F.lit(None).cast("double"))
        note = F.lit("population frequency not evaluated")
    else:
        column = "af" if field == "global" else field if field == "popmax" else f"af_{field}"
        joined = events.join(frequency.withColumn("_af", F.col(column)), key, "left")
        sized = (F.col("chrom1") == F.col("chrom2")) & F.col("event_size").isNotNull()
        note = F.when(F.col("_af").isNotNull(), "population frequency evaluated").when(sized, "not in the population catalogue").otherwise("population frequency not evaluable for this event")
    panel = passes_panel(F.col("pon_count"), criteria.pon_max if pon_max is None else pon_max)
    common = F.coalesce(F.col("_af") < limit, F.lit(True))
    return joined.withColumns({"pass_pon": panel, "pass_population": common, "privacy_note": note}).withColumn(
        "private", F.col("pass_population") & (F.col("pass_pon") if pon_in_privacy else F.lit(True))
    ).drop("_af")


def panel_lookup(queries: DataFrame, panel: DataFrame, key: str, slop: int = 0, widths: Sequence[int] = (1_000, 30_000, 1_000_000)) -> DataFrame:
    """Per query the largest panel count of a record that holds both ends, in either orientation; 0 if none does.

    Records and queries meet in cells over both ends: a record goes to the grid of the first width that its longer
    interval fits, so to four cells at most (beyond the last width, to every cell that it covers); a query asks one cell
    of each grid. So records that share one end meet only queries near their other end too.
    """
    side = lambda a, b: panel.select(*[F.col(f"{c}{x}").alias(f"{c}{n}") for x, n in ((a, 1), (b, 2)) for c in ("chrom", "start", "end")], "count")
    both = side(1, 2).unionByName(side(2, 1))
    both = both.withColumns({f"{n}{k}": F.col(f"{c}{k}") + d for k in (1, 2) for n, c, d in (("lo", "start", -slop), ("hi", "end", slop))})
    longest = F.greatest(F.col("hi1") - F.col("lo1"), F.col("hi2") - F.col("lo2"))
    grid = F.lit(len(widths) - 1)
    for k in range(len(widths) - 2, -1, -1):
        grid = F.when(longest <= widths[k], F.lit(k)).otherwise(grid)
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / F.col("_width")), F.floor(F.col(hi) / F.col("_width"))))
    wide = F.array(*[F.lit(w) for w in widths])
    both = both.withColumn("_grid", grid).withColumn("_width", F.get(wide, F.col("_grid"))).withColumn("_cell1", cells("lo1", "hi1")).withColumn("_cell2", cells("lo2", "hi2")).drop("_width")
    ask = queries.select(key, "chrom1", "pos1", "chrom2", "pos2", F.posexplode(wide).alias("_grid", "_width"))
    ask = ask.withColumns({f"_cell{k}": F.floor(F.col(f"pos{k}") / F.col("_width")) for k in (1, 2)}).drop("_width")
    hits = ask.join(both, ["chrom1", "chrom2", "_grid", "_cell1", "_cell2"]).filter(F.col("pos1").between(F.col("lo1"), F.col("hi1")) & F.col("pos2").between(F.col("lo2"), F.col("hi2")))
    best = hits.groupBy(key).agg(F.max("count").alias("panel_count"))
    return queries.join(best, key, "left").withColumns({"panel_count": F.coalesce("panel_count", F.lit(0)), "in_panel": F.col("panel_count").isNotNull()})


def describe_panel(panel: DataFrame) -> DataFrame:
    return panel.agg(F.count("*").alias("records"), F.max("count").alias("largest_count"))


def common_in_population(df: DataFrame, criteria: Criteria = DEFAULT) -> DataFrame:
    """common_in_population from popmax, unknown as false; an earlier verdict column is replaced."""
    return df.drop("common_in_population").withColumn("common_in_population", F.coalesce(F.col("popmax") >= criteria.common_af, F.lit(False)))
