"""Candidate peptides from junctions on spliced coding sequence, and their checks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from ..criteria import DEFAULT, Criteria
from ..functions.sequence import translate, translated
from .ranges import covering


def best_transcript(ends: DataFrame, transcripts: DataFrame, key: str) -> DataFrame:
    """Per breakend (key, chrom, pos) the overlapping transcript of best rank, longest span, then id."""
    t = transcripts.select("transcript_id", "gene", "chrom", "strand", "start", "end", "exons", "cds_blocks", "cds", "rank").filter("start is not null and end is not null")
    name = ["rank", "transcript_id", "chrom", "start", "end"]
    rest = [c for c in t.columns if c not in name]
    # Transcripts meet breakends by name; what else is known of the best ones is joined after.
    order = F.struct("rank", (F.col("start") - F.col("end")).alias("_short"), "transcript_id", "start", "end")
    best = covering(ends, t, ["chrom"], "pos", "start", "end", {"_best": (F.min(order), F.min)})
    best = best.withColumns({c: F.col(f"_best.{c}") for c in name if c != "chrom"}).drop("_best")
    first = best.groupBy(key).agg(F.min(F.struct("rank", (F.col("start") - F.col("end")).alias("_short"), "transcript_id", *[c for c in best.columns if c not in {key, "rank", "transcript_id"}])).alias("_one"))
    first = first.select(key, *[F.col(f"_one.{c}").alias(c) for c in best.columns if c != key])
    about = t.groupBy(*name).agg(F.min(F.struct(*rest)).alias("_rest"))
    known = first.alias("b").join(about.alias("t"), F.expr(" and ".join(f"b.{c} <=> t.{c}" for c in name)))
    return known.select(*[F.col(f"b.{c}") for c in ends.columns], *[F.col(f"b.{c}") if c in name else F.col(f"t._rest.{c}").alias(c) for c in t.columns if c != "chrom"])


def head_length(blocks: Column, strand: Column, cut: Column) -> Column:
    """Coding nucleotides 5' of a cut, in reading direction, the cut base included."""
    plus = F.aggregate(blocks, F.lit(0).cast("long"), lambda a, b: a + F.greatest(F.lit(0), F.least(b["end"], cut) - b["start"] + 1))
    minus = F.aggregate(blocks, F.lit(0).cast("long"), lambda a, b: a + F.greatest(F.lit(0), b["end"] - F.greatest(b["start"], cut) + 1))
    return F.when(strand == "+", plus).otherwise(minus)


def clip_blocks(blocks: Column, strand: Column, cut: Column, head: bool) -> Column:
    """Blocks 5' (head) or 3' of a cut in genome coordinates, cut base included."""
    left = (strand == "+") == F.lit(head)
    low = F.transform(F.filter(blocks, lambda b: b["start"] <= cut), lambda b: F.struct(b["start"].alias("start"), F.least(b["end"], cut).alias("end")))
    high = F.transform(F.filter(blocks, lambda b: b["end"] >= cut), lambda b: F.struct(F.greatest(b["start"], cut).alias("start"), b["end"].alias("end")))
    return F.when(left, low).otherwise(high)


def rearranged_coding(events: DataFrame) -> DataFrame:
    """events with fused (coding sequence after the event), junction_nt and model.

    Needs strand, cds_blocks, cds of one transcript, pos1 <= pos2, svtype and insert_seq. Inside one transcript: both
    ends in one intron change nothing (same_intron, null); a deletion joins what precedes and follows it around the
    inserted bases; a duplication repeats the stretch between its ends; other classes are not modelled. For fusions of
    two genes use `fused_coding`.
    """
    b, s, n = F.col("cds_blocks"), F.col("strand"), F.length("cds")
    plus = s == "+"
    five, three = F.when(plus, F.col("pos1")).otherwise(F.col("pos2")), F.when(plus, F.col("pos2")).otherwise(F.col("pos1"))
    inside = lambda p: F.exists(b, lambda x: (p >= x["start"]) & (p <= x["end"]))
    upto_five, upto_three = head_length(b, s, five).cast("int"), head_length(b, s, three).cast("int")
    # A breakend's own base stays: before the 5' end it is part of the head, at the 3' end it starts the tail.
    tail = upto_three - F.when(inside(three), 1).otherwise(0)
    same_intron = ~inside(five) & ~inside(three) & (upto_five == upto_three)
    ins = F.coalesce("insert_seq", F.lit(""))
    cds = F.col("cds")
    deletion = F.concat(F.substring(cds, F.lit(1), upto_five), ins, F.substring(cds, tail + 1, n))
    duplication = F.concat(F.substring(cds, F.lit(1), upto_three), ins, F.substring(cds, upto_five - F.when(inside(five), 1).otherwise(0) + 1, n))
    model = F.when(same_intron, "same_intron").when(F.col("svtype") == "DEL", "deletion").when(F.col("svtype") == "DUP", "duplication").otherwise("not_modelled")
    out = events.withColumn("model", model)
    fused = F.when(F.col("model") == "deletion", deletion).when(F.col("model") == "duplication", duplication)
    at = F.when(F.col("model") == "deletion", upto_five).when(F.col("model") == "duplication", upto_three) + F.length(ins)
    return out.withColumns({"fused": fused, "junction_nt": at.cast("int")})


def fused_coding(head_cds: Column, head_nt: Column, inserted: Column, tail_cds: Column, tail_nt: Column) -> Column:
    """Coding sequence of a fusion: head of one gene, inserted bases, and the other gene after its first tail_nt bases."""
    return F.concat(F.substring(head_cds, F.lit(1), head_nt), F.coalesce(inserted, F.lit("")), F.substring(tail_cds, tail_nt + 1, F.length(tail_cds)))


def kept_part(strand: Column, left: Column) -> Column:
    """Which part of its transcript a breakend keeps, 5 or 3, from the side of the genome that it keeps."""
    return F.when((strand == "+") == left, "5").otherwise("3")


def fusion_coding(events: DataFrame) -> DataFrame:
    """events of two genes with fused, junction_nt and model.

    Needs for each side k: strand, cds_blocks, cds, pos, left (the breakend keeps what is left of it) and region. Two
    intronic ends of which one keeps a 5' and the other a 3' part are joined at whole exons (fusion_intronic); two
    parts of one kind make no product (fusion_no_product, null); other regions are not modelled.
    """
    side = lambda k: {c: F.col(f"{c}{k}") for c in ("strand", "cds_blocks", "cds", "pos", "left", "region")}
    one, two = side(1), side(2)
    part1, part2 = (kept_part(s["strand"], s["left"]) for s in (one, two))
    model = F.when((one["region"] == "intron") & (two["region"] == "intron"), F.when(part1 == part2, "fusion_no_product").otherwise("fusion_intronic")).otherwise("not_modelled")
    upto1, upto2 = (head_length(s["cds_blocks"], s["strand"], s["pos"]).cast("int") for s in (one, two))
    first = part1 == "5"
    fused = F.when(first, fused_coding(one["cds"], upto1, F.lit(""), two["cds"], upto2)).otherwise(fused_coding(two["cds"], upto2, F.lit(""), one["cds"], upto1))
    out = events.withColumn("model", F.coalesce(model, F.lit("not_modelled")))
    there = F.col("model") == "fusion_intronic"
    return out.withColumns({"fused": F.when(there, fused), "junction_nt": F.when(there, F.when(first, upto1).otherwise(upto2))})


def _new_windows(events: DataFrame, keys: list[str], native: list[Column], criteria: Criteria) -> DataFrame:
    """keys, neopeptide, spans_junction, pep_length: windows of the protein of `fused` that no native protein has.

    Events, not their windows, are shuffled and sorted by key; a task then goes through them and holds the windows of one
    key, an event's, at a time. A window spans the junction if it does anywhere; null where no event of the key knows it.
    """
    names = [f"_native{k}" for k in range(len(native))]
    rows = events.filter("fused is not null").select(*keys, F.col("junction_nt").cast("int").alias("junction_nt"), "fused", *[c.alias(n) for n, c in zip(names, native, strict=True)])
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)
    made = StructType([*[rows.schema[k] for k in keys], *[StructField(n, t) for n, t in (("neopeptide", StringType()), ("spans_junction", BooleanType()), ("pep_length", IntegerType()))]])
    lengths = criteria.peptide_lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, found, out, kinds = None, {}, [], []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            *of, peptides, spans = zip(*rows, strict=True)
            spans = pa.array([None if s < 0 else s > 0 for s in spans], pa.bool_())
            return pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(of, kinds, strict=True)], pa.array(peptides), spans, pa.array(map(len, peptides), pa.int32())], names=made.names)

        for batch in batches:
            kinds = [batch.schema.field(k).type for k in keys]
            values = zip(zip(*[batch[k].to_pylist() for k in keys], strict=True), *[batch[c].to_pylist() for c in ("junction_nt", "fused", *names)], strict=True)
            for key, junction, fused, *natives in values:
                if key != own:
                    out += [(*own, *w) for w in found.items()] if own else []
                    own, found = key, {}
                    if len(out) > 50_000:
                        yield batch_of(out)
                        out = []
                if None not in natives:
                    _add_windows(found, translated(fused), list(map(translated, natives)), junction, lengths)
        out += [(*own, *w) for w in found.items()] if own else []
        if out:
            yield batch_of(out)

    return rows.mapInArrow(run, made)


def _add_windows(found: dict[str, int], protein: str, natives: list[str], junction: int | None, lengths: Sequence[int]) -> None:
    """Windows that no native protein has, with 1 if they hold the junction somewhere, 0 if not, -1 if it is unknown."""
    shared = max([len(commonprefix([protein, native])) for native in natives])  # its windows are native ones
    for n in lengths:
        for i in range(max(0, shared - n + 1), len(protein) - n + 1):
            peptide = protein[i : i + n]
            if not any([peptide in native for native in natives]):
                span = -1 if junction is None else int(i * 3 < junction < (i + n) * 3)
                found[peptide] = max(span, found.get(peptide, -1))


def fusion_peptides(events: DataFrame, keys: list[str], criteria: Criteria = DEFAULT) -> DataFrame:
    """keys, neopeptide, pep_length, spans_junction: windows of the fusion protein that neither gene's protein has."""
    return _new_windows(events, keys, [F.col("cds1"), F.col("cds2")], criteria)


def frame_effect(head_nt: Column, native: Column, fused: Column) -> Column:
    """Label of the effect: Start-loss under three residues of head; In-frame if the length changes by codons and the
    native stop is met; Stop-loss without any stop; else Stop-gain. All but Start-loss are this package's own rule."""
    protein = translate(fused)
    whole = F.floor(F.length(fused) / 3)
    return (
        F.when(head_nt < 9, "Start-loss").when((F.pmod(F.length(fused) - F.length(native), F.lit(3)) == 0) & (F.length(protein) >= whole - 1), "In-frame")
        .when(F.length(protein) == whole, "Stop-loss").otherwise("Stop-gain")
    )


def candidate_peptides(events: DataFrame, keys: list[str], criteria: Criteria = DEFAULT) -> DataFrame:
    """keys, neopeptide, pep_length, spans_junction: windows of the fused protein that the native protein lacks."""
    return _new_windows(events, keys, [F.col("cds")], criteria)


def variant_ids(rows: DataFrame, junctions: DataFrame) -> DataFrame:
    """rows (chrom1, pos1, chrom2, pos2) with sample_sv_id by the unordered pair of ends, first in file order, else NA."""
    pair = lambda: F.array_sort(F.array(F.struct(F.col("chrom1").alias("c"), F.col("pos1").alias("p")), F.struct(F.col("chrom2").alias("c"), F.col("pos2").alias("p"))))
    ids = junctions.withColumn("_pair", pair()).groupBy("_pair").agg(F.min_by("sample_sv_id", "file_row").alias("sample_sv_id"))
    return rows.withColumn("_pair", pair()).join(ids, "_pair", "left").withColumn("sample_sv_id", F.coalesce("sample_sv_id", F.lit("NA"))).drop("_pair")


#: Back ends of stage 2 by name.
def generator(name: str):
    def spliced(events: DataFrame, keys: list[str]) -> DataFrame:
        """Events of one transcript have cds, those of two genes cds1 and cds2; a table may have either or both."""
        parts = []
        if "cds" in events.columns:
            parts.append(candidate_peptides(rearranged_coding(events.filter("cds is not null")), keys))
        if {"cds1", "cds2"} <= set(events.columns):
            parts.append(fusion_peptides(fusion_coding(events.filter("cds1 is not null and cds2 is not null")), keys))
        if not parts:
            raise ValueError("events have neither cds nor cds1 and cds2")
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    known = {"spliced_cds": spliced, "precomputed": lambda events, keys: events.select(*keys, "neopeptide", "spans_junction", "pep_length")}
    if name not in known:
        raise ValueError(f"unknown generator {name}; known: {', '.join(known)}")
    return known[name]
