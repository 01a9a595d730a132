"""Range joins as equi-joins: bins for points and intervals, nested bins for intervals of any length, size classes for
reciprocal overlap, two-level nearest neighbours and islands."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _bins(start: Column, end: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(start / width), F.floor(end / width)))


def points_in_intervals(points: DataFrame, intervals: DataFrame, keys: Sequence[str], pos: str, start: str, end: str, width: int, how: str = "inner") -> DataFrame:
    """Pairs of a point and an interval [start, end] (both included) with equal keys; each pair once.

    Choose width near the usual interval length: an interval takes one row per bin it touches.
    """
    binned = intervals.withColumn("_bin", _bins(F.col(start), F.col(end), width))
    probe = points.withColumn("_bin", F.floor(F.col(pos) / width))
    left, right = probe.alias("p"), binned.alias("i")
    on = [F.col(f"p.{k}") == F.col(f"i.{k}") for k in [*keys, "_bin"]] + [F.col(f"p.{pos}") >= F.col(f"i.{start}"), F.col(f"p.{pos}") <= F.col(f"i.{end}")]
    return left.join(right, on, how).select("p.*", *[F.col(f"i.{c}") for c in intervals.columns if c not in keys]).drop("_bin")


#: Nested bins: widths grow by this factor from level to level; the last level takes whatever is longer.
LEVEL_FACTOR, LEVELS = 8, 5
#: Cells that a bin with more than this many places is cut into, and places of a part.
FINE, PART_ROWS = 1024, 250_000
#: Widths of the first level that a cell of `in_cells` has, and rows of the larger side that a task gets there: each may
#: meet many, and what a task groups then should fit its memory.
CELL, CELL_ROWS = 2, 250_000


def level_widths(width: int) -> list[int]:
    return [width * LEVEL_FACTOR**k for k in range(LEVELS)]


def nested_place(start: Column, end: Column, width: int) -> Column:
    """Array of (_level, _bin) where an interval is kept: one place, its start's bin on the first level whose bins are as
    wide as it is long. Only what is longer than the widest bin is kept in every one of these that it touches."""
    widths = level_widths(width)
    place = lambda level, bin_: F.struct(F.lit(level).alias("_level"), bin_.cast("long").alias("_bin"))
    top = widths[-1]
    out = F.transform(F.sequence(F.floor(start / top), F.floor(end / top)), lambda b: place(LEVELS, b))
    for level in range(LEVELS - 1, -1, -1):
        out = F.when(end - start <= widths[level], F.array(place(level, F.floor(start / widths[level])))).otherwise(out)
    return out


def nested_level(start: Column, end: Column, width: int) -> Column:
    """The level that an interval is kept on; LEVELS for what is longer than the widest bin. The length is found once:
    as the variable of a lambda, else Spark would walk a CIGAR again for every level."""
    def level(length: Column) -> Column:
        out = F.lit(LEVELS)
        for k, w in reversed(list(enumerate(level_widths(width)))):
            out = F.when(length <= w, F.lit(k)).otherwise(out)
        return out

    return F.get(F.transform(F.array(end - start), level), F.lit(0))


def levels_in_use(levels: DataFrame) -> list[int]:
    """Levels that hold an interval at all, of a table of them: six rows at most."""
    return sorted(r[0] for r in levels.distinct().collect() if r[0] is not None)


def nested_asks(start: Column, end: Column, width: int, levels: Sequence[int] | None = None) -> Column:
    """Array of (_level, _bin) where intervals that overlap [start, end] can be kept; of the stated levels only, if given."""
    place = lambda level, low, high: F.transform(F.sequence(F.floor(low), F.floor(high)), lambda b: F.struct(F.lit(level).alias("_level"), b.cast("long").alias("_bin")))
    widths = level_widths(width)
    places = [place(k, (start - w) / w, end / w) for k, w in enumerate(widths)] + [place(LEVELS, start / widths[-1], end / widths[-1])]
    return F.concat(*[places[k] for k in (range(LEVELS + 1) if levels is None else levels or [0])])


def overlapping(a: DataFrame, b: DataFrame, keys: Sequence[str], a_range: tuple[str, str], b_range: tuple[str, str], width: int, few: int | None = None, reach: int | None = None, levels: list[int] | None = None) -> DataFrame:
    """Pairs of closed intervals with equal keys that overlap; each pair once. A missing end counts as the start.

    b, the larger side, goes to nested bins: one row an interval, however long it is (beyond the widest bins, width *
    8^4, one for each of them). a asks for the bins in which a partner's start can lie, on every level that b's lengths
    use (they are looked up first); choose width near the usual length of b, and a's intervals short beside it where they
    are many. few: a, which is counted, is spread and goes to every task if it has no more rows than this; else, and
    without it, both sides are shuffled, as Spark's estimate does not know of the rows on every level.

    reach: a's intervals are no longer than this. Where both sides are shuffled and all of b are on the first level, the
    pairs are those of `in_cells` and keep its `_cell`. levels: those in use, if they are known.
    """
    (a0, a1), (b0, b1) = a_range, b_range
    # Outer, though no array is empty: else Spark asks of every row whether it is, and walks again to know.
    spots = lambda df, array: df.select("*", F.inline_outer(array))
    if levels is None:
        levels = levels_in_use(b.select(nested_level(F.col(b0), F.col(b1), width).alias("_level")))
    small = few is not None and a.limit(few + 1).count() <= few
    if reach is not None and not small and levels == [0]:
        return in_cells(a, b, keys, a_range, b_range, CELL * width, reach, parts=parts_of(b))
    left = spots(a.repartition(*keys, a0) if small else a, nested_asks(F.col(a0), F.col(a1), width, levels)).alias("a")
    right = spots(b, nested_place(F.col(b0), F.col(b1), width)).alias("b")
    left, right = (F.broadcast(left), right) if small else (left, right.hint("merge"))
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_level", "_bin"]]
    return left.join(right, on).filter(_meets(a0, a1, b0, b1, width)).select("a.*", *[F.col(f"b.{c}") for c in b.columns if c not in keys]).drop("_level", "_bin")


def parts_of(b: DataFrame) -> int | None:
    """Into how many parts `in_cells` deals rows, which are counted; None where Spark's own choice has as many tasks."""
    parts = b.count() // CELL_ROWS
    return parts if parts > b.sparkSession.sparkContext.defaultParallelism else None


def in_cells(a: DataFrame, b: DataFrame, keys: Sequence[str], a_range: tuple[str, str], b_range: tuple[str, str], cell: int, reach: int, how: str = "inner", parts: int | None = None) -> DataFrame:
    """Pairs of closed intervals with equal keys that overlap, each once, with the `_cell` of a's start; how: inner or left.
    parts: both sides are dealt into so many at least, which Spark does not put together by their bytes.

    a, no longer than `reach`, is in one cell; b, short beside a cell, in those that a partner can start in. So all that
    a row of a meets is in one task, and what is grouped by the keys, `_cell` and more is not shuffled again.
    """
    (a0, a1), (b0, b1) = a_range, b_range
    dealt = lambda df: df.repartition(parts, *keys, "_cell") if parts else df
    left = dealt(a.withColumn("_cell", F.floor(F.col(a0) / cell))).alias("a")
    # Outer for the same reason as in `overlapping`.
    right = dealt(b.select("*", F.explode_outer(F.sequence(F.floor((F.col(b0) - reach) / cell), F.floor(F.col(b1) / cell))).alias("_cell"))).alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_cell"]]
    meets = (F.col(f"a.{a0}") <= F.coalesce(F.col(f"b.{b1}"), F.col(f"b.{b0}"))) & (F.col(f"b.{b0}") <= F.col(f"a.{a1}"))
    return left.join(right.hint("merge"), [*on, meets], how).select("a.*", *[F.col(f"b.{c}") for c in b.columns if c not in keys])


def _meets(a0: str, a1: str, b0: str, b1: str, width: int) -> Column:
    """Overlap of a pair that met in a nested bin; of the widest bins that an interval is kept in, the first counts."""
    top = level_widths(width)[-1]
    first = F.greatest(F.floor(F.col(f"a.{a0}") / top), F.floor(F.col(f"b.{b0}") / top))
    # Without the coalesce Spark would ask first whether the end is there, and find it twice.
    return (F.col(f"a.{a0}") <= F.coalesce(F.col(f"b.{b1}"), F.col(f"b.{b0}"))) & (F.col(f"b.{b0}") <= F.col(f"a.{a1}")) & ((F.col("a._level") < LEVELS) | (F.col("a._bin") == first))


def reciprocal_overlaps(a: DataFrame, b: DataFrame, keys: Sequence[str], a_range: tuple[str, str], b_range: tuple[str, str], least: float) -> DataFrame:
    """Pairs whose overlap is at least `least` of either length; lengths are end - start, 1 at least.

    Such lengths differ by a factor of 1/least at most. b goes to a cell, a quarter of its size class wide, by its
    start; a probes the cells of the neighbouring classes that a partner's start can lie in: at most
    (1 - least) * size_a after its own start, and as far before it as the longest partner of that class allows. So an
    interval takes a few rows, however long it is.
    """
    (a0, a1), (b0, b1) = a_range, b_range
    reach = math.ceil(math.log2(1 / least))
    size_a, size_b = F.greatest(F.col(a1) - F.col(a0), F.lit(1)), F.greatest(F.col(b1) - F.col(b0), F.lit(1))
    cell = F.greatest(F.pow(F.lit(2.0), F.col("_class") - 1), F.lit(1.0))
    right = b.withColumn("_class", F.floor(F.log2(size_b)).cast("int")).withColumn("_bin", F.floor(F.col(b0) / cell)).alias("b")
    own = F.floor(F.log2(size_a)).cast("int")
    left = a.withColumn("_class", F.explode(F.sequence(F.greatest(own - reach, F.lit(0)), own + reach)))
    longest_b = F.least(F.pow(F.lit(2.0), F.col("_class") + 1), size_a / least)
    before, after = longest_b - least * F.greatest(longest_b, size_a), (1 - least) * size_a
    left = left.filter(before >= 0).withColumn("_bin", F.explode(F.sequence(F.floor((F.col(a0) - before) / cell), F.floor((F.col(a0) + after) / cell)))).alias("a")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_class", "_bin"]]
    shared = F.least(F.col(f"a.{a1}"), F.col(f"b.{b1}")) - F.greatest(F.col(f"a.{a0}"), F.col(f"b.{b0}"))
    longest = F.greatest(F.col(f"a.{a1}") - F.col(f"a.{a0}"), F.col(f"b.{b1}") - F.col(f"b.{b0}"), F.lit(1))
    return left.join(right.hint("merge"), on).filter(shared >= least * longest).select("a.*", *[F.col(f"b.{c}") for c in b.columns if c not in keys]).drop("_class", "_bin")


def reciprocal_best(a: DataFrame, b: DataFrame, keys: Sequence[str], a_range: tuple[str, str], b_range: tuple[str, str], least: float, best: Column) -> DataFrame:
    """Rows of a that have a reciprocal overlap in b, with _n, how many, and _best, the greatest `best` (of b) among them.

    Equal intervals of either side count once: they have the same partners. So pairs grow with the different intervals,
    not with the rows that share them. The join is by shuffle, as Spark's estimate does not know of the rows on each cell.
    """
    (a0, a1), (b0, b1) = a_range, b_range
    asks = a.select(*keys, a0, a1).distinct()
    known = b.select(*keys, F.col(b0).alias("_b0"), F.col(b1).alias("_b1"), best.alias("_best")).groupBy(*keys, "_b0", "_b1").agg(F.count("*").alias("_n"), F.max("_best").alias("_best"))
    found = reciprocal_overlaps(asks, known, keys, a_range, ("_b0", "_b1"), least).groupBy(*keys, a0, a1).agg(F.sum("_n").alias("_n"), F.max("_best").alias("_best"))
    return a.join(found, [*keys, a0, a1])


def within_distance(a: DataFrame, b: DataFrame, keys: Sequence[str], pos: str, other: str, tolerance: int) -> DataFrame:
    """Pairs with equal keys and |pos - other| <= tolerance, by cells of tolerance + 1 and their neighbours."""
    cell = tolerance + 1
    left = a.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(pos) / cell) - 1, F.floor(F.col(pos) / cell) + 1))).alias("a")
    right = b.withColumn("_cell", F.floor(F.col(other) / cell)).alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "_cell"]] + [F.abs(F.col(f"a.{pos}") - F.col(f"b.{other}")) <= tolerance]
    return left.join(right, on).select("a.*", *[F.col(f"b.{c}") for c in b.columns if c not in keys]).drop("_cell")


def least_within(a: DataFrame, b: DataFrame, keys: Sequence[str], pos: str, other: str, tolerance: int, least: Column, name: str) -> DataFrame:
    """Rows of a with a row of b at |pos - other| <= tolerance (above 0), and the smallest `least` (of b) of those as `name`.

    Rows of one place count once. A stretch of twice the tolerance ends in the cell after the one that it starts in, so
    it is the rest of one cell and the beginning of the next: two running minima, however many rows lie in it.
    """
    cell = 2 * tolerance
    known = b.select(*keys, F.col(other).alias("_at"), least.alias("_least")).filter("_at is not null").groupBy(*keys, "_at").agg(F.min("_least").alias("_least"))
    at = F.col(pos)
    side = lambda rest, place: F.struct(F.floor(place / cell).alias("_cell"), place.alias("_at"), F.lit(rest).alias("_rest"))
    asks = a.select(*keys, pos).filter(at.isNotNull()).distinct().select(*keys, pos, F.inline(F.array(side(True, at - tolerance), side(False, at + tolerance))))
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType)
    both = known.select(*keys, none(asks, pos).alias(pos), F.floor(F.col("_at") / cell).alias("_cell"), "_at", none(asks, "_rest").alias("_rest"), "_least").unionByName(asks.withColumn("_least", none(known, "_least")))
    # References of a place come before the asks there: both ends are included.
    own = lambda order: W.partitionBy(*keys, "_cell").orderBy(order, F.col("_rest").asc_nulls_first(), pos).rowsBetween(W.unboundedPreceding, W.currentRow)
    met = both.select(*keys, pos, "_rest", F.min("_least").over(own(F.asc("_at"))).alias("_begin"), F.min("_least").over(own(F.desc("_at"))).alias("_end")).filter("_rest is not null")
    found = met.groupBy(*keys, pos).agg(F.min(F.when(F.col("_rest"), F.col("_end")).otherwise(F.col("_begin"))).alias(name)).filter(F.col(name).isNotNull())
    return a.join(found, [*keys, pos])


def dyadic_cover(start: Column, end: Column, levels: int) -> Column:
    """Array of (_level, _node): the fewest aligned stretches of 2^level whole-number places that make up [start, end],
    at most two a level; a place p lies in node p >> level of each level."""
    node = lambda there, level, at: F.when(there, F.array(F.struct(level.alias("_level"), at.alias("_node")))).otherwise(F.array().cast("array<struct<_level:int,_node:bigint>>"))
    odd = lambda c: c.bitwiseAND(F.lit(1).cast("long")) == 1
    zero = F.struct(start.cast("long").alias("low"), (end.cast("long") + 1).alias("high"), F.array().cast("array<struct<_level:int,_node:bigint>>").alias("nodes"))

    def step(acc: Column, level: Column) -> Column:
        low, high = acc["low"], acc["high"]
        first = (low < high) & odd(low)
        after = low + first.cast("long")
        last = (after < high) & odd(high)
        return F.struct(F.shiftright(after, 1).alias("low"), F.shiftright(high - last.cast("long"), 1).alias("high"), F.concat(acc["nodes"], node(first, level, low), node(last, level, high - 1)).alias("nodes"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels - 1)), zero, step, lambda acc: acc["nodes"])


def covering(points: DataFrame, intervals: DataFrame, keys: Sequence[str], pos: str, start: str, end: str, aggs: dict[str, tuple[Column, Callable[[str], Column]]]) -> DataFrame:
    """Rows of points that lie in an interval [start, end], with aggregates over all that they lie in; whole-number places.

    aggs: name to (aggregate over intervals, how such parts are put together). An interval is cut into aligned stretches,
    two for each doubling of its length at most; intervals of one stretch are aggregated, and a place puts together the
    few stretches it lies in. So no pair of a point and an interval is made, however many lie over each other.
    """
    longest = intervals.agg(F.max(F.col(end) - F.col(start))).first()[0]
    levels = max(1, int(longest or 0) + 1).bit_length()
    nodes = intervals.filter(F.col(start) <= F.col(end)).select("*", F.inline(dyadic_cover(F.col(start), F.col(end), levels))).groupBy(*keys, "_level", "_node").agg(*[part.alias(n) for n, (part, _) in aggs.items()])
    places = points.select(*keys, pos).filter(F.col(pos).isNotNull()).distinct().select("*", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("_level"))
    places = places.withColumn("_node", F.expr(f"shiftright(cast(`{pos}` as bigint), _level)"))
    found = places.join(nodes.hint("merge"), [*keys, "_level", "_node"]).groupBy(*keys, pos).agg(*[join(n).alias(n) for n, (_, join) in aggs.items()])
    return points.join(found, [*keys, pos])


def _fine(pos: Column, width: int) -> Column:
    """Which of the FINE cells of its bin a place lies in."""
    return F.floor(F.pmod(pos, F.lit(width)) * FINE / width).cast("int")


def _parts(places: DataFrame, keys: Sequence[str], pos: str, width: int, part_rows: int) -> DataFrame:
    """(keys, _bin, _cell, _part) for bins with more than part_rows places: their fine cells dealt to parts of about
    part_rows places, in order. Counts are exact, so every plan that uses them has the same parts."""
    n = places.groupBy(*keys, F.floor(F.col(pos) / width).alias("_bin"), _fine(F.col(pos), width).alias("_cell")).agg(F.count("*").alias("_n"))
    own = W.partitionBy(*keys, "_bin")
    upto = F.sum("_n").over(own.orderBy("_cell").rowsBetween(W.unboundedPreceding, W.currentRow))
    cut = n.withColumn("_all", F.sum("_n").over(own)).withColumn("_part", F.floor((upto - F.col("_n")) / part_rows)).filter(F.col("_all") > part_rows)
    return cut.select(*keys, "_bin", "_cell", "_part")


def _placed(df: DataFrame, keys: Sequence[str], pos: str, width: int, part_rows: int, repeats: int = 1) -> DataFrame:
    """df, with each place at most `repeats` times, with _bin and _part. A bin of fewer whole-number places than part_rows
    can't be dense, so then nothing is counted."""
    out = df.withColumn("_bin", F.floor(F.col(pos) / width))
    if dict(df.dtypes)[pos] in ("bigint", "int", "smallint", "tinyint") and repeats * width <= part_rows:
        return out.withColumn("_part", F.lit(0))
    parts = _parts(df.select(*keys, pos), keys, pos, width, part_rows)
    out = out.withColumn("_cell", _fine(F.col(pos), width)).join(parts, [*keys, "_bin", "_cell"], "left")
    return out.withColumn("_part", F.coalesce("_part", F.lit(0))).drop("_cell")


def nearest(points: DataFrame, reference: DataFrame, keys: Sequence[str], pos: str, payload: Sequence[str], width: int, part_rows: int = PART_ROWS) -> DataFrame:
    """points with distance and payload columns (prefix near_) of the nearest reference row with equal keys.

    reference has keys, pos and the payload. The candidates are the last reference before the point and the first at
    or after it; the earlier one wins an equal distance; of rows at one place the greatest payload before and the
    least after. Null without any reference or position.

    Rows of one place are brought together first, so a place counts once however many rows it has. Places go to bins of
    `width`, and a bin with more than part_rows places is cut by a count of its fine cells; a part's first and last
    reference are carried over the parts beside it, so a window holds one part, not a key.
    """
    item = F.struct(F.col(pos).alias("pos"), *payload)
    refs = reference.filter(F.col(pos).isNotNull()).select(*keys, F.col(pos), item.alias("_ref")).groupBy(*keys, pos).agg(F.min("_ref").alias("_least"), F.max("_ref").alias("_most"))
    asks = points.filter(F.col(pos).isNotNull()).select(*keys, pos).distinct()
    none = F.lit(None).cast(refs.schema["_least"].dataType)
    both = refs.withColumn("_asked", F.lit(False)).unionByName(asks.select(*keys, pos, none.alias("_least"), none.alias("_most"), F.lit(True).alias("_asked")))
    both = _placed(both, keys, pos, width, part_rows, 2)
    cell = [*keys, "_bin", "_part"]
    # Empty parts that hold asks only are in the table too, so that the carry reaches them.
    table = both.groupBy(*cell).agg(F.min("_least").alias("_first"), F.max("_most").alias("_last"))
    # What follows is what came before in the reverse order: a frame that ends at the last row would be summed anew for each row.
    line, back = W.partitionBy(*keys).orderBy("_bin", "_part"), W.partitionBy(*keys).orderBy(F.desc("_bin"), F.desc("_part"))
    table = table.select(
        *cell, F.last("_last", ignorenulls=True).over(line.rowsBetween(W.unboundedPreceding, -1)).alias("_before"),
        F.last("_first", ignorenulls=True).over(back.rowsBetween(W.unboundedPreceding, -1)).alias("_after"),
    )
    # An ask stands before the references of its place, so those count as at or after it.
    own, back = W.partitionBy(*cell).orderBy(pos, F.col("_asked").desc()), W.partitionBy(*cell).orderBy(F.desc(pos), "_asked")
    here = both.select(
        *cell, pos, "_asked", F.last("_most", ignorenulls=True).over(own.rowsBetween(W.unboundedPreceding, -1)).alias("_low"),
        F.last("_least", ignorenulls=True).over(back.rowsBetween(W.unboundedPreceding, -1)).alias("_high"),
    )
    found = here.filter("_asked").join(table, cell, "left").select(*keys, pos, F.coalesce("_low", "_before").alias("_low"), F.coalesce("_high", "_after").alias("_high"))
    at = F.col(pos)
    low, high = at - F.col("_low.pos"), F.col("_high.pos") - at
    best = F.when(F.col("_high").isNull() | (low <= high), F.col("_low")).otherwise(F.col("_high"))
    found = found.select(*keys, pos, best.alias("_best"))
    out = points.join(found, [*keys, pos], "left")
    return out.select(*[F.col(c) for c in points.columns], F.abs(F.col("_best.pos") - at).alias("near_distance"), *[F.col(f"_best.{c}").alias(f"near_{c}") for c in ["pos", *payload]])


def sums_upto(asks: DataFrame, rows: DataFrame, keys: Sequence[str], pos: str, values: Sequence[str], width: int, part_rows: int = PART_ROWS) -> DataFrame:
    """Distinct (keys, pos) of asks with the sum of each value over the rows at or before pos; 0 where there is none.

    Rows of one place are added first, and places go to parts as in `nearest`; the sums of the parts before are carried.
    Sums of doubles are exact for whole numbers; else use decimals.
    """
    added = rows.filter(F.col(pos).isNotNull()).groupBy(*keys, pos).agg(*[F.sum(v).alias(v) for v in values])
    places = asks.select(*keys, pos).filter(F.col(pos).isNotNull()).distinct()
    both = added.withColumn("_asked", F.lit(False)).unionByName(places.select(*keys, pos, *[F.lit(None).cast(added.schema[v].dataType).alias(v) for v in values], F.lit(True).alias("_asked")))
    both = _placed(both, keys, pos, width, part_rows, 2)
    cell = [*keys, "_bin", "_part"]
    before = W.partitionBy(*keys).orderBy("_bin", "_part").rowsBetween(W.unboundedPreceding, -1)
    carried = both.groupBy(*cell).agg(*[F.sum(v).alias(v) for v in values]).select(*cell, *[F.sum(v).over(before).alias(f"_{v}") for v in values])
    own = W.partitionBy(*cell).orderBy(pos, "_asked").rowsBetween(W.unboundedPreceding, W.currentRow)
    upto = both.select(*cell, pos, "_asked", *[F.sum(v).over(own).alias(v) for v in values]).filter("_asked")
    zero = {v: F.lit(0).cast(added.schema[v].dataType) for v in values}
    return upto.join(carried, cell).select(*keys, pos, *[(F.coalesce(v, zero[v]) + F.coalesce(f"_{v}", zero[v])).alias(v) for v in values])


def sums_inside(intervals: DataFrame, points: DataFrame, keys: Sequence[str], start: str, end: str, pos: str, values: Sequence[str], width: int) -> DataFrame:
    """Rows of intervals with _n, the points in [start, end] (whole numbers), and the sum of each value over them: what
    lies at or before the end less what lies before the start, so no pair of an interval and a point is made."""
    asks = intervals.select(*keys, F.explode(F.array(F.col(start) - 1, F.col(end))).alias(pos))
    upto = sums_upto(asks, points.select(*keys, pos, *values, F.lit(1).cast("long").alias("_n")), keys, pos, ["_n", *values], width)
    names = ["_n", *values]
    side = lambda place, mark: upto.select(*keys, F.col(pos).alias(place), *[F.col(v).alias(f"{mark}{v}") for v in names])
    both = intervals.withColumn("_s", F.col(start) - 1).join(side("_s", "_lo_"), [*keys, "_s"]).join(side(end, "_hi_"), [*keys, end])
    return both.select(*[F.col(c) for c in intervals.columns], *[(F.col(f"_hi_{v}") - F.col(f"_lo_{v}")).alias(v) for v in names])


def merge_intervals(df: DataFrame, keys: Sequence[str], start: str, end: str, width: int = PART_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """Union of intervals per key: overlapping or touching ones become one island (keys, start, end).

    Intervals of one start count as the longest of them. They go to bins of `width` by their start (dense ones cut as in
    `nearest`); how far the parts before reach, and where their last island begins, is carried over the table of parts.
    So a window holds one part, and an island may span any number of them. Rows without a start or end are left out.
    """
    rows = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull()).groupBy(*keys, start).agg(F.max(end).alias(end))
    rows = _placed(rows, keys, start, width, part_rows)
    cell = [*keys, "_bin", "_part"]
    before = W.partitionBy(*keys).orderBy("_bin", "_part").rowsBetween(W.unboundedPreceding, -1)
    reach = rows.groupBy(*cell).agg(F.max(end).alias("_reach")).select(*cell, F.max("_reach").over(before).alias("_carried"))
    own = W.partitionBy(*cell).orderBy(start)
    upto = F.greatest(F.max(end).over(own.rowsBetween(W.unboundedPreceding, -1)), F.col("_carried"))
    # An island is known by its start; rows before a part's first one belong to the last island of the parts before.
    marked = rows.join(reach, cell).withColumn("_new", F.when(upto.isNull() | (F.col(start) > upto), F.col(start)))
    marked = marked.withColumn("_island", F.last("_new", ignorenulls=True).over(own.rowsBetween(W.unboundedPreceding, W.currentRow)))
    local = marked.groupBy(*cell, "_island").agg(F.max(end).alias(end))
    last = local.groupBy(*cell).agg(F.max("_island").alias("_last")).select(*cell, F.last("_last", ignorenulls=True).over(before).alias("_open"))
    return local.join(last, cell).groupBy(*keys, F.coalesce("_island", "_open").alias(start)).agg(F.max(end).alias(end))


def interval_coverage(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Per key: islands and the length they cover."""
    return merge_intervals(df, keys, start, end).groupBy(*keys).agg(F.count("*").alias("islands"), F.sum(F.col(end) - F.col(start)).alias("covered"))


def chance_hit_rate(covered: Column, total: Column) -> Column:
    """Probability that one of two random ends falls in a share of the genome."""
    return 1 - F.pow(1 - covered / total, 2)
