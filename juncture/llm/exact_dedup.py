"""Exact deduplication: two-pass Bloom filtering, so that only rows that may repeat are shuffled."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh, materialise, mix64, shared_dir, text_or_empty

#: Bits a row gets in a filter, probes a key makes, bits in a segment, and the most bits of one filter (16 MB, what a
#: task, an executor and the driver hold). More rows have a filter that is cut into sections, which no one holds whole.
BITS_PER_ROW, PROBES, SEGMENT_BITS, MAX_BITS = 16, 4, 1 << 17, 1 << 27
#: Bits of a section, and rows of a chunk, which gets its own answers.
SECTION_BITS, CHUNK_ROWS = 1 << 24, 1 << 19


def _positions(keys: pa.Array, bits: int) -> np.ndarray:
    """Rows x PROBES bit positions from the first 16 bytes of each digest."""
    raw = np.frombuffer(b"".join(k[:16] for k in keys.to_pylist()), dtype="<u8").reshape(-1, 2)
    with np.errstate(over="ignore"):
        at = raw[:, :1] + np.arange(PROBES, dtype=np.uint64) * (raw[:, 1:] | np.uint64(1))
    return (at & np.uint64(bits - 1)).astype(np.int64)


def _get(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bits are set."""
    return ((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)


def _set(table: np.ndarray, at: np.ndarray) -> None:
    """Set the bits at sorted places."""
    if len(at):
        byte = at >> 3
        head = np.flatnonzero(np.concatenate([[True], byte[1:] != byte[:-1]]))
        table[byte[head]] |= np.bitwise_or.reduceat(np.uint8(128) >> (at & 7).astype(np.uint8), head)


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """A power of two, BITS_PER_ROW a row, within [SEGMENT_BITS, max_bits]."""
    return min(max_bits, max(SEGMENT_BITS, 1 << max(rows * BITS_PER_ROW - 1, 1).bit_length()))


def repeated_filter(hashes: DataFrame, key: str, bits: int, least: int = 2) -> bytes:
    """First pass: the bits that at least two keys (or one key twice) have set; with least 1 a plain Bloom filter.

    Each task keeps two bitmaps, "set" and "set again", and sends the segments it touched, compressed; segments are
    merged by OR, where a bit set on both sides becomes "set again". What comes to the driver is bits/8 bytes at most.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, dtype=np.uint8), np.zeros(bits // 8, dtype=np.uint8)
        for b in batches:
            if not b.num_rows:
                continue
            at = np.sort(_positions(b.column(0), bits), axis=None)
            first = np.ones(len(at), dtype=bool)
            first[1:] = at[1:] != at[:-1]
            uniq = at[first]
            _set(twice, at[~first])
            _set(twice, uniq[_get(once, uniq)])
            _set(once, uniq)
        step = SEGMENT_BITS // 8
        for s in range(0, bits // 8, step):
            part = once[s : s + step]
            if part.any():
                pair = (part, twice[s : s + step])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s // step], pa.int64()), *(pa.array([zlib.compress(x.tobytes(), 1)], pa.binary()) for x in pair)], names=["segment", "once", "twice"]
                )

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = twice = np.zeros(SEGMENT_BITS // 8, dtype=np.uint8)
        for b in batches:
            for o, t in zip(b.column("once").to_pylist(), b.column("twice").to_pylist(), strict=True):
                o, t = (np.frombuffer(zlib.decompress(x), dtype=np.uint8) for x in (o, t))
                twice, once = twice | t | (once & o), once | o
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([zlib.compress((twice if least > 1 else once).tobytes(), 1)], pa.binary())], names=["segment", "twice"])

    parts = hashes.select(key).mapInArrow(local, "segment long, once binary, twice binary")
    merged = parts.groupBy("segment").applyInArrow(merge, "segment long, twice binary")
    whole = bytearray(bits // 8)
    for row in merged.toLocalIterator():
        at = row.segment * SEGMENT_BITS // 8
        whole[at : at + SEGMENT_BITS // 8] = zlib.decompress(row.twice)
    return bytes(whole)


def maybe_repeated(hashes: DataFrame, key: str, twice: bytes, flag: str) -> DataFrame:
    """Second pass: flag the rows all of whose bits are set again. Every repeated key is flagged, and few others."""
    bits, shared = len(twice) * 8, hashes.sparkSession.sparkContext.broadcast(twice)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shared.value, dtype=np.uint8)
        for b in batches:
            at = _positions(b.column(b.schema.get_field_index(key)), bits)
            hit = _get(table, at).all(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hit)], names=[*b.schema.names, flag])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hashes.schema)
    return hashes.mapInArrow(run, f"{fields}, `{flag}` boolean")


def _normal_sha256() -> Column:
    return F.sha2(F.regexp_replace(text_or_empty(), r"[\x20\x09-\x0D]+", " ").cast("binary"), 256)


def _addresses(keys: pa.Array, sections: int) -> tuple[np.ndarray, np.ndarray]:
    """Section of each digest and the 32 bits its probes there are made from."""
    raw = np.frombuffer(b"".join(k[:16] for k in keys.to_pylist()), dtype="<u8").reshape(-1, 2)
    return (raw[:, 0] & np.uint64(sections - 1)).astype(np.int64), raw[:, 1].astype(np.uint32)


def _probes(seeds: np.ndarray, bits: int) -> np.ndarray:
    """Rows x PROBES different places in a section."""
    h = mix64(seeds.astype(np.uint64))
    step = (h >> np.uint64(32)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return ((h[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def _by_group(chunk: np.ndarray, section: np.ndarray, seeds: np.ndarray, most: int) -> pa.RecordBatch:
    """A row for each chunk and section with its sorted seeds, each at most `most` times (1 or 2)."""
    order = np.lexsort((seeds, section, chunk))
    chunk, section, seeds = chunk[order], section[order], seeds[order]
    new = np.ones(len(seeds), dtype=bool)
    new[1:] = (chunk[1:] != chunk[:-1]) | (section[1:] != section[:-1])
    keep = new.copy()
    keep[1:] |= seeds[1:] != seeds[:-1]
    if most > 1:
        keep[1:] |= keep[:-1].copy()
    chunk, section, seeds, new = chunk[keep], section[keep], seeds[keep], new[keep]
    cut = np.flatnonzero(new)
    ends = np.append(cut, len(seeds)).astype(np.int32) * 4
    packed = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(seeds.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(chunk[cut]), pa.array(section[cut]), packed], names=["chunk", "section", "seeds"])


def _unpacked(b: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inverse of _by_group."""
    blobs = b.column("seeds").to_pylist()
    width = [len(x) // 4 for x in blobs]
    return np.repeat(np.asarray(b.column("chunk")), width), np.repeat(np.asarray(b.column("section")), width), np.frombuffer(b"".join(blobs), dtype=np.uint32)


def _flag_by_sections(hashes: DataFrame, rows: int, bits: int) -> DataFrame:
    """Both passes with a filter cut into sections of `bits` bits, in a fixed number of jobs.

    Rows are kept in chunks, bucketed by chunk, and never move. A chunk sends each section 4 bytes a row; the task of a
    section sets the bits of all chunks (first pass), tests the same seeds against those set again (second pass) and
    answers with the ones that pass. Answers meet their chunks in the chunks' buckets. A section has BITS_PER_ROW bits
    a row, so its size does not depend on the table's; a key that fills the table costs two seeds a chunk.
    """
    spark, chunk = hashes.sparkSession, fresh(hashes, "_chunk")
    sections = 1 << max(-(-rows * BITS_PER_ROW // bits) - 1, 0).bit_length()
    name = f"juncture_{uuid.uuid4().hex}"
    numbered = hashes.withColumn(chunk, F.shiftright(F.monotonically_increasing_id(), CHUNK_ROWS.bit_length() - 1))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered.write.option("compression", "zstd").option("path", f"{shared_dir(spark)}/juncture/{name}").bucketBy(buckets, chunk).saveAsTable(name)
    chunks = spark.table(name)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        for b in batches:
            if b.num_rows:
                held.append((np.asarray(b.column(0)), *_addresses(b.column(1), sections)))
                size += b.num_rows
            if size >= CHUNK_ROWS:
                yield _by_group(*(np.concatenate(c) for c in zip(*held, strict=True)), 2)
                held, size = [], 0
        if held:
            yield _by_group(*(np.concatenate(c) for c in zip(*held, strict=True)), 2)

    def answer(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, dtype=np.uint8), np.zeros(bits // 8, dtype=np.uint8)
        held = []
        for b in batches:
            held.append(_unpacked(b))
            at = np.sort(_probes(held[-1][2], bits), axis=None)
            first = np.ones(len(at), dtype=bool)
            first[1:] = at[1:] != at[:-1]
            _set(twice, at[~first])
            _set(twice, at[first][_get(once, at[first])])
            _set(once, at[first])
        for of, section, seeds in held:
            hit = _get(twice, _probes(seeds, bits)).all(axis=1)
            if hit.any():
                yield _by_group(of[hit], section[hit], seeds[hit], 1)

    def mark(rows: pa.Table, answers: pa.Table) -> pa.Table:
        section, seeds = _addresses(rows.column("digest"), sections)
        own, (_, where, told) = (section << 32) | seeds, _unpacked(answers)
        return rows.drop_columns([chunk]).append_column("again", pa.array(np.isin(own, (where << 32) | told)))

    group = "chunk long, section long, seeds binary"
    answers = chunks.select(chunk, "digest").mapInArrow(send, group).groupBy("section").applyInArrow(answer, group)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hashes.schema)
    marked = chunks.groupBy(chunk).cogroup(answers.groupBy("chunk")).applyInArrow(mark, f"{fields}, again boolean")
    out = materialise(marked, "flagged")
    discard(chunks)
    spark.sql(f"drop table {name}")
    return out


def flag_repeated(hashes: DataFrame, rows: int, max_bits: int = MAX_BITS) -> DataFrame:
    """hashes (with digest) and `again`: true for every row whose digest repeats and for few others.

    One filter of max_bits at most is sent to all tasks; where the rows need more bits, it is cut into sections.
    """
    if rows * BITS_PER_ROW > max_bits:
        return _flag_by_sections(hashes, rows, min(SECTION_BITS, max_bits))
    hashes = materialise(hashes, "hashes")
    return maybe_repeated(hashes, "digest", repeated_filter(hashes, "digest", filter_bits(rows, max_bits)), "again")


def exact_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are the same after each run of ASCII white space becomes one space; a null text is an
    empty one. The smallest doc_id of a group stays (null ids last); of repeated rows with that id one stays. Only
    rows flagged by the second Bloom pass are grouped; the others are known to be alone and pass straight through.
    Empty table: empty result.
    """
    flagged = flag_repeated(docs.select("doc_id", F.unhex(_normal_sha256()).alias("digest")), docs.count(), max_bits)
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    alone = flagged.filter(~F.col("again")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha
    )
    again = flagged.filter("again").groupBy("digest", "doc_id").agg(F.count("*").alias("n"))
    groups = again.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    rows = again.join(groups, "digest").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)
    return alone.unionByName(rows.select("doc_id", "keep_id", "group_size", kept.alias("kept"), sha))


def without_ids(docs: DataFrame, gone: DataFrame, max_bits: int = MAX_BITS, by: str = "doc_id") -> DataFrame:
    """The rows of docs whose id (`by`) is not in gone (`by`); rows without an id stay. Rows that a Bloom filter of
    the ids rules out stay where they are; only the others, with their texts, are shuffled to an exact anti join. A
    filter of max_bits that holds too many ids rules out fewer rows; the result is the same."""
    digest, maybe, own = (fresh(docs, c) for c in ("_digest", "_maybe", "_gone_id"))

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn(digest, F.unhex(F.md5(F.col(by).cast("string").cast("binary"))))

    ids = materialise(keyed(gone.select(by).filter(F.col(by).isNotNull()).distinct()), "gone")
    seen = repeated_filter(ids, digest, filter_bits(ids.count(), max_bits), least=1)
    flagged = maybe_repeated(keyed(docs.filter(F.col(by).isNotNull())), digest, seen, maybe)
    near = flagged.filter(F.col(maybe)).join(ids.select(F.col(by).alias(own)), F.col(by) == F.col(own), "left_anti").select(docs.columns)
    return flagged.filter(~F.col(maybe)).select(docs.columns).unionByName(near).unionByName(docs.filter(F.col(by).isNull()))


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_duplicates keeps, with their columns.

    Rows are known by doc_id and digest together: ids may repeat, with the same text (one row stays) or another one,
    and may be null. Rows that a Bloom filter of the groups with copies rules out stay where they are.
    """

    digest, maybe, kept, whole = (fresh(docs, c) for c in ("_digest", "_maybe", "_kept", "_whole"))

    def keyed(df: DataFrame, sha: Column) -> DataFrame:
        return df.withColumn(digest, F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), sha).cast("binary"))))

    marks = keyed(exact_duplicates(docs).filter("group_size > 1"), F.col("text_sha256")).groupBy(digest).agg(F.max("kept").alias(kept), F.min("kept").alias(whole))
    marks = materialise(marks.filter(~F.col(whole)).select(digest, kept), "marks")
    seen = repeated_filter(marks, digest, filter_bits(marks.count()), least=1)
    flagged = maybe_repeated(keyed(docs, _normal_sha256()), digest, seen, maybe)
    near = flagged.filter(F.col(maybe)).join(marks, digest, "left")
    once = near.filter(F.col(kept)).dropDuplicates([digest])
    return flagged.filter(~F.col(maybe)).select(docs.columns).unionByName(near.filter(F.col(kept).isNull()).select(docs.columns)).unionByName(once.select(docs.columns))
