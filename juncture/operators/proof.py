"""Proof of a deletion's junction from read sequences: the seam that the breakpoints predict, or one that a gap implies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..criteria import DEFAULT, Criteria
from ..functions.alignments import span, walk
from ..functions.sequence import reverse_complement, translate, windows
from .peptides import head_length
from .ranges import CELL, in_cells, levels_in_use, nested_level, overlapping

#: Windows of events are at most CELL bin widths long where they meet reads in cells; a cell is as long as so many of the
#: longest, so about an eighth of the reads lies in two.
CELL_WINDOWS = 8


def seam(blocks: Column, strand: Column, low: Column, high: Column) -> tuple[Column, Column]:
    """(coding bases kept before the seam, offset of the first one after it) of a transcript that loses the genome
    between low and high, both kept; in reading direction on either strand, by running sums over the coding blocks."""
    before = F.when(strand == "+", head_length(blocks, strand, low)).otherwise(head_length(blocks, strand, high))
    after = F.when(strand == "+", head_length(blocks, strand, high - 1)).otherwise(head_length(blocks, strand, low + 1))
    return before.cast("int"), after.cast("int")


def seam_sequence(cds: Column, before: Column, after: Column, flank: int) -> Column:
    """Up to flank nucleotides on each side of the seam."""
    first = F.greatest(before - flank, F.lit(0))
    return F.concat(F.substring(cds, first + 1, before - first), F.substring(cds, after + 1, F.lit(flank)))


def first_change(native: Column, mutant: Column) -> Column:
    """Place of the first residue that differs, from 0; the shorter length where one begins with the other."""
    shorter = F.least(F.length(native), F.length(mutant))
    places = F.when(shorter > 0, F.sequence(F.lit(1), shorter)).otherwise(F.array().cast("array<int>"))
    differs = F.array_position(F.transform(places, lambda i: F.substring(native, i, F.lit(1)) != F.substring(mutant, i, F.lit(1))), True)
    return F.when(differs > 0, differs - 1).otherwise(shorter).cast("int")


def novel_windows(native: Column, mutant: Column, lengths: Sequence[int]) -> Column:
    """Distinct windows that the native protein lacks."""
    return F.array_distinct(F.transform(F.filter(windows(mutant, lengths), lambda w: ~F.contains(native, w["peptide"])), lambda w: w["peptide"]))


def over_change(peptides: Column, mutant: Column, first: Column) -> Column:
    """Those of the peptides whose first place in the mutant protein spans the changed residue, sorted."""
    at = lambda p: F.instr(mutant, p) - 1
    return F.array_sort(F.filter(peptides, lambda p: (at(p) <= first) & (first < at(p) + F.length(p))))


def prove_junctions(events: DataFrame, transcripts: DataFrame, alignments: DataFrame, keys: Sequence[str], flank: int = 20, margin: int = 400, width: int = 1000, criteria: Criteria = DEFAULT, levels: list[int] | None = None) -> DataFrame:
    """Deletions with the verdict of the reads on their junction, and the peptides that hang on it; one row an event.

    events: keys (unique), sample, chrom, pos1, pos2 (both kept), transcript_id; transcripts: transcript_id, strand,
    cds_blocks, cds; alignments: sample, chrom, start0, mapq, cigar, seq. Probes are the sequence over the seam of the
    breakpoints, and over the seam of every gap of the event's length that reads of enough quality have within `margin`
    of it. A read counts for a probe that it holds in either direction; equal hits go to the breakpoints, none at all to
    neither. levels: those of the nested bins that alignments use, if they are known.

    Events meet gaps of their length first, and the sequences once there are probes. Where no read is longer than width
    and events are short, both happen in cells that hold all of an event, and pairs are counted where they met; else
    sequences are brought to the events by their keys. An event has its transcript joined once, and carries it along.

    Returns keys, coding_removed, in_frame, first_changed, novel, spanning (peptides over the first changed residue),
    reads (in the window), own_gaps and other_gaps (alignments with the event's gap, and with another of its length),
    breakpoint_hits, gap (`start-end` of the best one, skipped bases), gap_hits, supported. Null sequences hold no probe;
    an event without a transcript has null peptides and no probe; without reads it is supported by neither.
    """
    keys = list(keys)
    low, high = F.least("pos1", "pos2").cast("long"), F.greatest("pos1", "pos2").cast("long")
    asks = events.select(*keys, "sample", "chrom", low.alias("low"), high.alias("high"), (high - low - 1).alias("size"), "transcript_id")
    reach = (asks.agg(F.max(F.col("high") - F.col("low"))).first()[0] or 0) + 2 * margin
    if levels is None:
        levels = levels_in_use(alignments.filter("cigar is not null").select(nested_level(F.lit(0), span(F.col("cigar")), width).alias("_level")))
    cells = set(levels) <= {0} and reach <= CELL * width

    def beside(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        """Events with the rows of b over their windows; in cells, an event without any has one row whose start0 is null."""
        if cells:
            wider = b.withColumns({"start0": F.col("start0") - margin, "end0": F.col("end0") + margin})
            return in_cells(a.drop("_cell"), wider, on, ("low", "high"), ("start0", "end0"), max(1, CELL_WINDOWS * reach), reach - 2 * margin, "left")
        a = a.withColumns({"_w0": F.col("low") - margin, "_w1": F.col("high") + margin})
        return overlapping(a, b, on, ("_w0", "_w1"), ("start0", "end0"), width, levels=levels).drop("_w0", "_w1")

    # Gaps of the event's length, by the last base before them; each population counts once as a probe.
    start = F.col("start0").cast("long")
    good = alignments.filter(F.col("mapq") >= criteria.min_mapq).select("sample", "chrom", start.alias("start0"), walk(start, F.col("cigar")).alias("_w"))
    skips = good.select("sample", "chrom", "start0", "_w.end0", F.inline("_w.gaps").alias("at", "length")).withColumn("size", F.col("length").cast("long")).drop("length")
    place = ["_cell"] if cells else []
    event = [*asks.columns, *place]
    n, at, own = F.col("n"), F.col("at"), F.col("at") == F.col("low")
    met = beside(asks, skips, ["sample", "chrom", "size"])
    populations = (met if cells else met.unionByName(asks, True)).groupBy(*event, "at").agg(F.count("start0").alias("n"))
    counted = populations.groupBy(*event).agg(F.sum(F.when(own, n)).alias("own_gaps"), F.sum(F.when(~own, n)).alias("other_gaps"), F.collect_list(F.when(~own, at)).alias("_others"))

    blocks, strand, cds = F.col("cds_blocks"), F.col("strand"), F.col("cds")
    known = transcripts.select("transcript_id", "strand", "cds_blocks", "cds")
    before, after = seam(blocks, strand, F.col("low"), F.col("high"))
    base = counted.join(known, "transcript_id", "left").withColumns({"before": before, "after": after})

    def probe(at: Column) -> Column:
        last = at + F.col("size")
        return F.struct(F.concat_ws("-", (at + 1).cast("string"), last.cast("string")).alias("probe"), seam_sequence(cds, *seam(blocks, strand, at, last + 1), flank).alias("sequence"))

    # The breakpoints' own probe stands first, null if there is none; gaps follow in the order of their names.
    first = seam_sequence(cds, F.col("before"), F.col("after"), flank)
    first = F.array(F.struct(F.lit("breakpoint").alias("probe"), F.when(first != "", first).alias("sequence")))
    base = base.withColumn("_probes", F.concat(first, F.array_sort(F.filter(F.transform("_others", probe), lambda p: p["sequence"] != ""))))
    wanted = base.select(*keys, "sample", "chrom", "low", "high", "_probes", "own_gaps", "other_gaps", "cds", "before", "after")
    lines = alignments.select("sample", "chrom", start.alias("start0"), (start + span(F.col("cigar"))).alias("end0"), "seq")
    if cells:
        met = beside(wanted, lines, ["sample", "chrom"])
    else:
        met = wanted.join(beside(asks, lines, ["sample", "chrom"]).select(*keys, "start0", "seq"), keys, "left")
    event = [*wanted.columns, *place]
    held = lambda s: F.contains("seq", s) | F.contains("seq", reverse_complement(s))
    asked = met.select(*event, "start0", "seq", F.posexplode("_probes").alias("_i", "_p"))
    hits = asked.groupBy(*event, "_i").agg(F.count("start0").alias("reads"), F.count_if(held(F.col("_p.sequence"))).alias("hits"))
    # Of gaps with equal hits the last one: (hits, place) as one number, since the greatest struct would need a sort of all rows.
    gap, tens = F.col("_i") > 0, F.lit(10**10).cast("decimal(11,0)")
    best = F.col("hits").cast("decimal(19,0)") * tens + F.col("_i").cast("decimal(10,0)")
    verdict = hits.groupBy(*event).agg(
        F.max("reads").alias("reads"), F.max(F.when(~gap, F.col("hits"))).alias("breakpoint_hits"), F.max(F.when(gap, F.col("hits"))).alias("gap_hits"), F.max(F.when(gap, best)).alias("_best")
    )
    verdict = verdict.withColumn("gap", F.when(F.col("reads") > 0, F.get("_probes", (F.col("_best") % tens).cast("int"))["probe"]))

    native, mutant = translate(cds), translate(F.concat(F.substring(cds, F.lit(1), F.col("before")), F.substring(cds, F.col("after") + 1, F.length(cds))))
    counts = ["reads", "own_gaps", "other_gaps", "breakpoint_hits", "gap_hits"]
    proteins = verdict.fillna(0, counts).withColumns({"native": native, "mutant": mutant}).withColumn("first_changed", first_change(F.col("native"), F.col("mutant")))
    proteins = proteins.withColumn("_new", novel_windows(F.col("native"), F.col("mutant"), criteria.peptide_lengths))
    removed, top = F.col("after") - F.col("before"), F.greatest("breakpoint_hits", "gap_hits")
    return proteins.select(
        *keys, removed.alias("coding_removed"), (removed % 3 == 0).alias("in_frame"), "first_changed", F.when(cds.isNotNull(), F.size("_new")).alias("novel"),
        F.when(cds.isNotNull(), over_change(F.col("_new"), F.col("mutant"), F.col("first_changed"))).alias("spanning"), *counts, "gap",
        F.when(top == 0, "neither").when(F.col("breakpoint_hits") == top, "breakpoint").otherwise("gap").alias("supported"),
    )
