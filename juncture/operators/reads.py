"""Read evidence at breakends: choice of test, fragments by mechanism, tiers, junction use, depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..criteria import DEFAULT, Criteria
from ..functions.alignments import aligned_blocks, partner_hit, reference_end, span, walk
from ..functions.sequence import reverse_complement
from .cross import breakpoints
from .ranges import levels_in_use, nested_level, overlapping, sums_upto


#: Loci that go to every task that reads alignments; each takes a dozen rows of some 150 bytes.
FEW_LOCI = 20_000


def select_test(svtype: Column, chrom1: Column, chrom2: Column, size: Column, insert_len: Column, criteria: Criteria = DEFAULT) -> tuple[Column, Column]:
    """(test, reason): insertion, else chimeric, else none for small or unsized events, else sizegap."""
    long_insert = F.coalesce(insert_len, F.lit(0)) >= criteria.min_insert
    apart = (chrom1 != chrom2) | F.coalesce(F.upper(svtype).isin("BND", "TRA"), F.lit(False))
    small = size.isNull() | (size < criteria.min_gap)
    test = F.when(long_insert, "insertion").when(apart, "chimeric").when(small, "none").otherwise("sizegap")
    reason = (
        F.when(long_insert, F.format_string("%d inserted bases", insert_len.cast("int")))
        .when(apart, F.lit("ends on different chromosomes or a translocation"))
        .when(size.isNull(), F.lit("no size"))
        .when(small, F.format_string("a gap of %d is below the smallest testable one", size.cast("int")))
        .otherwise(F.format_string("gap of %d", size.cast("int")))
    )
    return test, reason


def tier(reads: Column, testable: Column, has_reads: Column, criteria: Criteria = DEFAULT) -> Column:
    """Tier from crossing fragments; NA where the sample has no reads, UNTESTABLE where no test applies."""
    return (
        F.when(~F.coalesce(has_reads, F.lit(False)), "NA").when(~F.coalesce(testable, F.lit(False)), "UNTESTABLE")
        .when(reads >= criteria.strong_reads, "STRONG").when(reads >= criteria.suggestive_reads, "SUGGESTIVE").when(reads >= 1, "WEAK").otherwise("NONE")
    )


def no_support_reason(test: Column, min_coverage: Column) -> Column:
    return F.when(test == "none", "test not applicable").when(F.coalesce(min_coverage, F.lit(0)) == 0, "locus not transcribed").otherwise("expressed but nothing crosses")


def breakend_windows(junctions: DataFrame, criteria: Criteria = DEFAULT) -> DataFrame:
    """A window (w0, w1) around each breakend with the event's facts, its test and the partner's place; one row per (event, side)."""
    keep = ["sample", "sample_sv_id", "svtype", "event_size", "insert_len", "insert_seq"]
    ends = breakpoints(junctions, [*keep, "chrom1", "pos1", "chrom2", "pos2"])
    other = F.col("side") == 1
    ends = ends.withColumns({
        "partner_chrom": F.when(other, F.col("chrom2")).otherwise(F.col("chrom1")), "partner_pos": F.when(other, F.col("pos2")).otherwise(F.col("pos1")),
        "w0": F.col("pos") - criteria.coverage_window, "w1": F.col("pos") + criteria.coverage_window, "first_pos": F.least("pos1", "pos2"),
        "test": select_test(F.col("svtype"), F.col("chrom1"), F.col("chrom2"), F.col("event_size"), F.col("insert_len"), criteria)[0],
    })
    return ends.drop("chrom1", "chrom2", "pos1", "pos2")


def with_walks(alignments: DataFrame) -> DataFrame:
    """Alignments with end0, gaps and softclip: CIGAR walks happen once per read, before a read meets many breakends."""
    return alignments.select("*", walk(F.col("start0"), F.col("cigar")).alias("_w")).select(*alignments.columns, "_w.end0", "_w.gaps", "_w.softclip")


def window_reach(junctions: DataFrame, criteria: Criteria = DEFAULT) -> int | None:
    """Length of the windows around breakends; None where events share ids, whose rows may then lie in several cells."""
    return None if not junctions.groupBy("sample", "sample_sv_id").count().filter("count > 1").isEmpty() else 2 * criteria.coverage_window


def reads_at_breakends(junctions: DataFrame, alignments: DataFrame, width: int = 1000, criteria: Criteria = DEFAULT) -> DataFrame:
    """Alignments that overlap a window around each breakend of their sample; one row per (event, side, alignment). Where
    no alignment is longer than width and each event has an id of its own, all rows of a breakend lie in one `_cell`."""
    reach = window_reach(junctions, criteria)
    levels = levels_in_use(alignments.select(nested_level(F.lit(0), span(F.col("cigar")), width).alias("_level")))
    return overlapping(breakend_windows(junctions, criteria), with_walks(alignments), ["sample", "chrom"], ("w0", "w1"), ("start0", "end0"), width, FEW_LOCI, reach, levels)


def _place(pairs: DataFrame) -> list[str]:
    """Columns by which pairs are dealt out, if all pairs of a breakend are in one place: grouped by them too, they stay."""
    return ["chrom", "_cell"] if "_cell" in pairs.columns else []


def fragment_evidence(pairs: DataFrame, criteria: Criteria = DEFAULT) -> DataFrame:
    """Per event and side: coverage, alignments, low mapping quality, soft clips, distinct fragments by mechanism."""
    good = F.col("mapq") >= criteria.min_mapq
    gap = F.exists(
        F.col("gaps"),
        lambda g: (F.abs(g["length"] - F.col("event_size")) <= criteria.gap_size_tolerance) & (F.abs(g["start"] - F.col("first_pos")) <= criteria.gap_position_tolerance),
    )
    hits = {
        "sizegap": good & (F.col("test") == "sizegap") & gap,
        "chimeric": good & (F.col("test") == "chimeric") & partner_hit(F.col("sa_tag"), F.col("partner_chrom"), F.col("partner_pos"), criteria.partner_tolerance),
        "insertion": good & (F.col("test") == "insertion") & (F.contains("seq", F.col("insert_seq")) | F.contains("seq", reverse_complement(F.col("insert_seq")))),
    }
    # Alignments of a fragment are brought together first, so that fragments are counted, not distinct names.
    keys = ["sample", "sample_sv_id", "side", "test"]
    place = _place(pairs)
    seen = pairs.groupBy(*keys, *place, "qname").agg(
        F.count("*").alias("alignments"), F.count_if(~good).alias("low_mapq"), F.count_if(good & (F.col("softclip") >= criteria.min_softclip)).alias("softclips"), F.max(good).alias("_good"),
        *[F.coalesce(F.bool_or(h), F.lit(False)).alias(f"_{n}") for n, h in hits.items()],
    )
    named = F.col("qname").isNotNull()
    any_hit = F.greatest(*[F.col(f"_{n}") for n in hits])
    return seen.groupBy(*keys, *place).agg(
        F.count_if(named & F.col("_good")).alias("coverage"), *[F.sum(c).alias(c) for c in ("alignments", "low_mapq", "softclips")],
        *[F.count_if(named & F.col(f"_{n}")).alias(f"{n}_fragments") for n in hits], F.count_if(named & any_hit).alias("junction_fragments"),
    ).drop(*place)


def event_evidence(junctions: DataFrame, evidence: DataFrame, has_reads: Column, criteria: Criteria = DEFAULT) -> DataFrame:
    """Per event the smaller coverage and the larger fragment counts of its ends, and the tier; a silent end counts 0."""
    keys = ["sample", "sample_sv_id"]
    most = ["sizegap_fragments", "chimeric_fragments", "insertion_fragments", "junction_fragments"]
    per = evidence.groupBy(*keys).agg(F.when(F.count("*") < 2, 0).otherwise(F.min("coverage")).alias("min_coverage"), *[F.max(c).alias(c) for c in most])
    test, reason = select_test(F.col("svtype"), F.col("chrom1"), F.col("chrom2"), F.col("event_size"), F.col("insert_len"), criteria)
    out = junctions.withColumns({"test": test, "test_reason": reason}).join(per, keys, "left").withColumn("has_rna", has_reads)
    out = out.withColumns({c: F.when(F.col("has_rna"), F.coalesce(c, F.lit(0))) for c in ["min_coverage", *most]})
    return out.withColumn("rna_tier", tier(F.col("junction_fragments"), F.col("test") != "none", F.col("has_rna"), criteria))


def junction_usage(pairs: DataFrame, criteria: Criteria = DEFAULT) -> DataFrame:
    """Per event: fragments with the junction's gap, fragments with any gap there, their ratio; null unless sizegap."""
    own = lambda g: (F.abs(g["length"] - F.col("event_size")) <= criteria.gap_size_tolerance) & (F.abs(g["start"] - F.col("first_pos")) <= criteria.gap_position_tolerance)
    over = lambda g: (g["start"] <= F.col("first_pos") + F.col("event_size")) & (g["start"] + g["length"] >= F.col("first_pos"))
    g = F.col("gaps")
    keys = ["sample", "sample_sv_id", "test"]
    per = pairs.groupBy(*keys, *_place(pairs), "qname").agg(F.bool_or(F.exists(g, own)).alias("match"), F.bool_or(F.exists(g, over)).alias("any"))
    if _place(pairs):
        # The ends of an event may be in two places. Fragments without a gap there only tell that the event has reads.
        hit = F.coalesce(F.col("match") | F.col("any"), F.lit(False))
        told = per.groupBy(*keys, *_place(pairs), hit.alias("_hit"), F.when(hit, F.col("qname")).alias("qname")).agg(F.bool_or("match").alias("match"), F.bool_or("any").alias("any"))
        per = told.groupBy(*keys, "_hit", "qname").agg(F.bool_or("match").alias("match"), F.bool_or("any").alias("any"))
    n = per.groupBy("sample", "sample_sv_id", "test").agg(F.count_if(F.col("match")).alias("junction"), F.count_if(F.col("match") | F.col("any")).alias("gapped"))
    ok = F.col("test") == "sizegap"
    return n.select("sample", "sample_sv_id", "test", *[F.when(ok, F.col(c)).alias(c) for c in ("junction", "gapped")], F.when(ok, F.round(F.col("junction") / F.nullif("gapped", F.lit(0)), 4)).alias("usage"))


def gap_profile(pairs: DataFrame, top_sizes: int = 6, top_starts: int = 5) -> DataFrame:
    """(kind, value, n): the most frequent sizes and starts of the gaps at the events; ties go to the smaller value."""
    rows = pairs.select(F.explode("gaps").alias("g"))

    def top(kind: str, field: str, n: int) -> DataFrame:
        counts = rows.groupBy(F.col(f"g.{field}").cast("long").alias("value")).agg(F.count("*").alias("n"))
        return counts.orderBy(F.desc("n"), "value").limit(n).select(F.lit(kind).alias("kind"), "value", "n")

    return top("size", "length", top_sizes).unionByName(top("start", "start", top_starts))


def depth_ratio(intervals: DataFrame, alignments: DataFrame, key: str, flank: int = 1000, width: int = 100_000) -> DataFrame:
    """Mean depth inside each interval and in its flanks, and their ratio, from aligned blocks."""
    def part(name: str, a: Column, b: Column) -> Column:
        return F.struct(F.lit(name).alias("part"), a.alias("p0"), b.alias("p1"))

    start, end = F.col("start"), F.col("end")
    parts = intervals.select(key, "sample", "chrom", F.inline(F.array(part("inside", start, end), part("flank", start - flank, start - 1), part("flank", end + 1, end + flank))))
    # The depth up to a place x: each block that starts at or before x gives x - start + 1, less x - last if it ends before
    # x. So it follows from how many blocks start and end up to x and the sums of their places; no pair is made.
    blocks = alignments.select("sample", "chrom", F.inline(aligned_blocks(F.col("start0"), F.col("cigar")))).filter("length > 0")
    edge = lambda place, sign: F.struct(place.alias("pos"), F.lit(sign).cast("long").alias("_open"), (place * sign).cast("long").alias("_at"))
    edges = blocks.select("sample", "chrom", F.inline(F.array(edge(F.col("start"), 1), edge(F.col("start") + F.col("length"), -1))))
    where = ["sample", "chrom"]
    asks = parts.select(*where, F.explode(F.array(F.col("p0") - 1, F.col("p1"))).alias("pos"))
    upto = sums_upto(asks, edges, where, "pos", ["_open", "_at"], width).select(*where, "pos", ((F.col("pos") + 1) * F.col("_open") - F.col("_at")).alias("depth"))
    side = lambda place, name: upto.select(*where, F.col("pos").alias(place), F.col("depth").alias(name))
    hit = parts.withColumn("_s", F.col("p0") - 1).join(side("_s", "_before"), [*where, "_s"]).join(side("p1", "_upto"), [*where, "p1"])
    bases = hit.groupBy(key, "part").agg(F.sum(F.col("_upto") - F.col("_before")).alias("bases"))
    length = parts.groupBy(key, "part").agg(F.sum(F.col("p1") - F.col("p0") + 1).alias("length"))
    depth = length.join(bases, [key, "part"], "left").withColumn("depth", F.coalesce("bases", F.lit(0)) / F.col("length"))
    out = depth.groupBy(key).agg(F.max(F.when(F.col("part") == "inside", F.col("depth"))).alias("inside"), F.max(F.when(F.col("part") == "flank", F.col("depth"))).alias("flank"))
    return out.withColumn("ratio", F.round(F.col("inside") / F.nullif("flank", F.lit(0.0)), 4))


def depth_verdict(svtype: Column, ratio: Column) -> Column:
    """Deletion or duplication verdict from a depth ratio; undetermined without one."""
    loss = F.when(ratio < 0.25, "homozygous").when(ratio < 0.70, "heterozygous").when(ratio > 0.85, "not genomic").otherwise("ambiguous")
    gain = F.when(ratio > 1.3, "gain").when(ratio < 1.15, "not a gain").otherwise("ambiguous")
    return F.when(ratio.isNull(), "undetermined").when(svtype == "DUP", gain).otherwise(loss)


def background_loci(length: int, n: int, seed: int, chrom: str, width: int = 400) -> Column:
    """n windows of a chromosome to compare a locus with, as an array (chrom, start, end), drawn by hash from a seed."""
    place = lambda i: F.pmod(F.xxhash64(F.lit(chrom), F.lit(seed), i), F.lit(max(1, length - width)))
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(F.lit(chrom).alias("chrom"), place(i).alias("start"), (place(i) + width).alias("end")))


def background_rate(reads: DataFrame, loci: DataFrame, inserted: str, width: int = 1000) -> DataFrame:
    """One row: reads at the loci (chrom, start, end) and how many of 1,000 hold the inserted bases in either direction."""
    hit = F.contains("seq", F.lit(inserted)) | F.contains("seq", reverse_complement(F.lit(inserted)))
    ends = reads.withColumn("end0", reference_end(F.col("start0"), F.col("cigar")))
    met = overlapping(loci, ends, ["chrom"], ("start", "end"), ("start0", "end0"), width)
    return met.agg(F.count("*").alias("background_reads"), F.count_if(hit).alias("background_hits"), F.round(1000.0 * F.count_if(hit) / F.nullif(F.count("*"), F.lit(0)), 3).alias("background_per_1000"))


def breakpoint_or_gap(probes: DataFrame, reads: DataFrame, keys: list[str]) -> DataFrame:
    """Per event (keys): hits of the junction sequence that the breakpoints predict, those of the best sequence that an
    observed gap implies, and which one reads support.

    probes: keys, probe (`breakpoint` or the gap), sequence. Equal hits go to the breakpoint; without any hit neither
    is supported.
    """
    n = probe_support(reads, probes, keys)
    best = F.struct(F.col("hits"), F.col("probe"))
    own, other = F.col("probe") == "breakpoint", F.col("probe") != "breakpoint"
    out = n.groupBy(*keys).agg(F.max(F.when(own, F.col("hits"))).alias("breakpoint_hits"), F.max(F.when(other, best)).alias("_gap"))
    out = out.select(*keys, F.coalesce("breakpoint_hits", F.lit(0)).alias("breakpoint_hits"), F.coalesce("_gap.hits", F.lit(0)).alias("gap_hits"), F.col("_gap.probe").alias("gap"))
    top = F.greatest("breakpoint_hits", "gap_hits")
    return out.withColumn("supported", F.when(top == 0, "neither").when(F.col("breakpoint_hits") == top, "breakpoint").otherwise("gap"))


def insertion_support(reads: DataFrame, inserted: str) -> DataFrame:
    """Reads that hold the inserted bases in either direction: reads, distinct starts, low quality, rate per 1,000."""
    hit = F.contains("seq", F.lit(inserted)) | F.contains("seq", reverse_complement(F.lit(inserted)))
    return reads.agg(
        F.count("*").alias("reads"), F.count_if(hit).alias("supporting"), F.count_distinct(F.when(hit, F.struct("chrom", "start0"))).alias("distinct_starts"),
        F.count_if(hit & (F.col("mapq") < DEFAULT.min_mapq)).alias("low_mapq"), F.count_if(hit & F.col("flag").bitwiseAND(1024).cast("boolean")).alias("duplicates"),
        F.round(1000.0 * F.count_if(hit) / F.nullif(F.count("*"), F.lit(0)), 3).alias("per_1000"),
    )


def probe_support(reads: DataFrame, probes: DataFrame, keys: list[str]) -> DataFrame:
    """Per probe (keys, probe, sequence) the reads of its locus that hold it in either direction, and the best one."""
    hit = F.contains("seq", F.col("sequence")) | F.contains("seq", reverse_complement(F.col("sequence")))
    n = reads.join(probes, keys).groupBy(*keys, "probe").agg(F.count_if(hit).alias("hits"))
    best = n.groupBy(*keys).agg(F.max_by("probe", F.struct("hits", "probe")).alias("supported"))
    return n.join(best, keys)
