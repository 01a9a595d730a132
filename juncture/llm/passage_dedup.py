"""Substring deduplication: MinHash banding of paragraphs, and verbatim passages inside longer paragraphs."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import keyed, map_arrow, materialise, mix64, unique_ids
from .ngram_join import _MARKS, parity_marks, settle_components
from .shingles import _BASE, _INVERSE, _power, buffers, ngram_hashes, word_hashes

#: Words of a shingle; least words of a paragraph or passage that may be removed; similarity num/den.
SHINGLE, LEAST_WORDS, NUM, DEN = 5, 20, 8, 10
#: Wanted chance that a pair at the similarity collides in a band, and the most hashes that may be spent on it.
RECALL, MOST_HASHES = 0.99, 16
#: Words of an anchor; entries of a task's chunk; bits of the bucket number at least; entries of a bucket.
ANCHOR = 8
#: Different runs of an anchor in a chunk above which all are read again without asking at the anchor.
MANY_RUNS = 16
CHUNK_ROWS, LEAST_BUCKET_BITS, BUCKET_ROWS = 1 << 20, 7, 1_000_000


def tune_bands(similarity: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows, so the fewest chance collisions, whose bands reach the recall within the hashes.

    A pair of that similarity collides in a band of r rows with probability similarity ** r.
    """
    best = (1, 1)
    for rows in range(1, most_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if rows == 1 or bands * rows <= most_hashes:
            best = bands, rows
    return best


BANDS, ROWS = tune_bands(NUM / DEN, RECALL, MOST_HASHES)
_BANDS = [f"band{k}" for k in range(BANDS)]
_SALTS = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _changes(*cols: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it in any of the columns."""
    out = np.ones(len(cols[0]), dtype=bool)
    if len(out):
        out[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    return out


def _paragraphs(texts: list[str | None]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per buffer: (text, first word, words, class, n, shingles, cut) of the paragraphs of LEAST_WORDS words or more.

    A paragraph is a line; lines of fewer words in a row, with no blank line between, are one paragraph (wrapped
    text). Its set holds its distinct shingles, those of paragraph k at shingles[cut[k]:cut[k + 1]]; class is the key
    of the set.
    """
    for first, run in buffers(texts):
        words, doc, line = word_hashes(run)
        if not len(words):
            continue
        begin = np.flatnonzero(_changes(line))
        short = np.diff(np.append(begin, len(words))) < LEAST_WORDS
        goes_on = np.zeros(len(begin), dtype=bool)
        goes_on[1:] = short[1:] & short[:-1] & (np.diff(line[begin]) == 1) & (doc[begin[1:]] == doc[begin[:-1]])
        begin = begin[~goes_on]
        size = np.diff(np.append(begin, len(words)))
        home = np.searchsorted(doc, np.arange(len(run) + 1))
        keep = size >= LEAST_WORDS
        begin, size = begin[keep], size[keep]
        if not len(begin):
            continue
        n = size - SHINGLE + 1
        end = np.cumsum(n)
        grams = ngram_hashes(words, SHINGLE)[np.repeat(begin - end + n, n) + np.arange(end[-1])]
        for lo, hi in zip((end - n).tolist(), end.tolist(), strict=True):
            grams[lo:hi].sort()
        which = np.repeat(np.arange(len(n)), n)
        new = _changes(grams, which)
        shingles, counts = grams[new], np.bincount(which[new])
        cut = np.append(0, np.cumsum(counts))
        with np.errstate(over="ignore"):
            total = np.add.reduceat(mix64(shingles), cut[:-1]) + counts.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB)
            classes = mix64(total ^ (total << np.uint64(32))).view(np.int64)
        yield doc[begin] + first, begin - home[doc[begin]], size, classes, counts, shingles, cut


def paragraph_rows(docs: DataFrame) -> DataFrame:
    """doc_id, start, words, class, n, bands, marks of every paragraph of LEAST_WORDS words or more.

    start counts words from 0; bands holds the band keys, marks the parity map of the shingles.
    """

    def one(b: pa.RecordBatch) -> pa.RecordBatch | None:
        keys = b.column("doc_id").to_numpy(zero_copy_only=False)
        parts = []
        for text, start, words, classes, n, shingles, cut in _paragraphs(b.column("text").to_pylist()):
            least = [np.minimum.reduceat(mix64(shingles ^ salt), cut[:-1]) for salt in _SALTS]
            bands = []
            for band in range(BANDS):
                key = np.full(len(n), band + 1, dtype=np.uint64)
                with np.errstate(over="ignore"):
                    for row in range(ROWS):
                        key = mix64(key * np.uint64(0xA0761D6478BD642F) + least[band * ROWS + row])
                bands.append(key.view(np.int64))
            marks = parity_marks(shingles, np.repeat(np.arange(len(n)), n), len(n))
            parts.append(np.stack([keys[text].astype(np.int64), start, words, classes, n, *bands, *marks.T]))
        if not parts:
            return None
        rows = np.concatenate(parts, axis=1)
        names = ["doc_id", "start", "words", "class", "n", *_BANDS, *_MARKS]
        kinds = [np.int64, np.int32, np.int32, np.int64, np.int32] + [np.int64] * (BANDS + len(_MARKS))
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c.astype(k))) for c, k in zip(rows, kinds, strict=True)], names=names)

    return map_arrow(docs, one, "doc_id long, start int, words int, class long, n int, " + ", ".join(f"{c} long" for c in (*_BANDS, *_MARKS)))


def class_sets(docs: DataFrame, owners: DataFrame) -> DataFrame:
    """class, n, tokens of the classes of owners (class, doc_id): read from one document that has the class."""
    wanted = owners.groupBy("doc_id").agg(F.collect_set("class").alias("wanted"))

    def one(b: pa.RecordBatch) -> pa.RecordBatch | None:
        want = [set(w) for w in b.column("wanted").to_pylist()]
        out: dict[int, tuple[int, bytes]] = {}
        for text, _, _, classes, n, shingles, cut in _paragraphs(b.column("text").to_pylist()):
            for k, c in enumerate(classes.tolist()):
                if c in want[text[k]]:
                    out[c] = (int(n[k]), shingles[cut[k] : cut[k + 1]].tobytes())
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), pa.array([v[0] for v in out.values()], pa.int32()), pa.array([v[1] for v in out.values()], pa.binary())], names=["class", "n", "tokens"])

    return map_arrow(docs.join(wanted, "doc_id").select("text", "wanted"), one, "class long, n int, tokens binary")


def paragraph_components(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(node, root) of the classes joined by links: those that collide in a band and have Jaccard similarity >= NUM/DEN.

    Equal sets meet once a task before the shuffle, so a frequent paragraph is one row for each task that has it.
    """
    zero = F.lit(0).cast("int")
    classes = materialise(rows.groupBy("class").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("n", *_BANDS, *_MARKS))), "classes")
    entries = classes.select(F.explode(F.array(*_BANDS)).alias("token"), "class", "n", zero.alias("lone"), zero.alias("at"), *_MARKS)
    return settle_components(entries, lambda wanted: class_sets(docs, classes.select("class", "doc_id").join(wanted, "class")), NUM, DEN)


def _prefixes(words: np.ndarray) -> np.ndarray:
    """Sums of the mixed word hashes times powers of the base, for _stretch."""
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(0)], np.cumsum(mix64(words) * _power(_BASE, len(words))[: len(words)], dtype=np.uint64)])


def _stretch(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words [begin, end) of each pair."""
    with np.errstate(over="ignore"):
        return mix64((prefix[end] - prefix[begin]) * _power(_INVERSE, len(prefix))[begin] + (end - begin).astype(np.uint64))


def anchored_runs(texts: list[str | None]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per buffer: (text, first word, windows, anchor, content) of the runs of windows that share an anchor.

    A window is LEAST_WORDS consecutive words of a text; its anchor is the least hash of ANCHOR words in it, the first
    of equal ones. So equal windows have equal anchors at equal places. content is the hash of all words of the run.
    """
    need = LEAST_WORDS - ANCHOR + 1
    for first, run in buffers(texts):
        words, doc, _ = word_hashes(run)
        n = len(words) - LEAST_WORDS + 1
        if n < 1:
            continue
        prefix = _prefixes(words)
        at = np.arange(len(words) - ANCHOR + 1)
        grams = _stretch(prefix, at, at + ANCHOR)
        bits = np.uint64(max(24, len(words).bit_length()))
        least = (grams >> bits << bits) | at.astype(np.uint64)
        width = 1
        while 2 * width <= need:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < need:
            least = np.minimum(least[: -(need - width)], least[need - width :])
        place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        inside = doc[:n] == doc[LEAST_WORDS - 1 :]
        change = np.ones(n, dtype=bool)
        change[1:] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1]) | (doc[1:n] != doc[: n - 1])
        begin = np.flatnonzero(change)
        count = np.diff(np.append(begin, n))
        begin, count = begin[inside[begin]], count[inside[begin]]
        home = np.searchsorted(doc, np.arange(len(run) + 1))
        yield doc[begin] + first, begin - home[doc[begin]], count, mix64(grams[place[begin]]), _stretch(prefix, begin, begin + count + LEAST_WORDS - 1)


def _send(df: DataFrame, entries: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, ...]]], reduce: Callable[[list[np.ndarray]], tuple[list[np.ndarray], list[np.ndarray]]], kinds: dict[str, type], bits: int) -> DataFrame:
    """Map side: entries (columns of `kinds`, the first one a hash) packed by bucket, the hash's highest bits.

    reduce splits a chunk's entries into those to send and rows of _DIRECT that are settled already; these ride along
    in rows marked direct, dealt over all buckets.
    """
    names = ["bucket", "direct", *"abcde"]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.bool_(), *[pa.binary()] * 5), strict=True)], names=names)

    def flush(held: list[tuple[np.ndarray, ...]], salt: int) -> Iterator[pa.RecordBatch]:
        cols, direct = reduce([np.concatenate(c).astype(k) for c, k in zip(zip(*held, strict=True), kinds.values(), strict=True)])
        bucket = (cols[0] >> np.uint64(64 - bits)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[by], np.arange((1 << bits) + 1))
        cols = [c[by] for c in cols]
        rows = [(k, False, *(c[cut[k] : cut[k + 1]].tobytes() for c in cols), *[b""] * (5 - len(cols))) for k in range(1 << bits) if cut[k + 1] > cut[k]]
        for lo in range(0, len(direct[0]), 8192):
            to = int(mix64(np.array([salt + lo], dtype=np.uint64))[0] & np.uint64((1 << bits) - 1))
            rows.append((to, True, *(c[lo : lo + 8192].astype(k).tobytes() for c, k in zip(direct, _DIRECT.values(), strict=True))))
        for lo in range(0, len(rows), 64):
            yield packed(rows[lo : lo + 64])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        total, salt = 0, TaskContext.get().partitionId() << 32
        for b in batches:
            for cols in entries(b):
                held.append(cols)
                total += len(cols[0])
                if total >= CHUNK_ROWS:
                    yield from flush(held, salt)
                    held, total, salt = [], 0, salt + (1 << 24)
        if total:
            yield from flush(held, salt)

    return df.mapInArrow(send, "bucket int, direct boolean, a binary, b binary, c binary, d binary, e binary")


def _read(batches: Iterator[pa.RecordBatch], kinds: dict[str, type], direct: Callable[[list[np.ndarray]], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch | list[np.ndarray]]:
    """What `direct` makes of the rows marked so, and at last the columns of the other entries, without those whose
    hash occurs once."""
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    for b in batches:
        for row in range(b.num_rows):
            raw = [b.column(c)[row].as_buffer() for c in "abcde"]
            if b.column("direct")[row].as_py():
                yield from direct([np.frombuffer(x, dtype=k) for x, k in zip(raw, _DIRECT.values(), strict=True)])
            else:
                for out, x, k in zip(parts, raw, kinds.values(), strict=False):
                    out.append(np.frombuffer(x, dtype=k))
    cols = [np.concatenate(c) if c else np.zeros(0, k) for c, k in zip(parts, kinds.values(), strict=True)]
    order = np.argsort(cols[0], kind="stable")
    new = _changes(cols[0][order])
    order = order[~(new & np.append(new[1:], True))]
    yield [c[order] for c in cols]


_RUNS = {"anchors": np.uint64, "contents": np.uint64, "docs": np.int64, "starts": np.int32, "counts": np.uint8}
_WINDOWS = {"hashes": np.uint64, "docs": np.int64, "starts": np.int32}
#: A row settled in a chunk; kept_start -1 marks a run to read again.
_DIRECT = {"docs": np.int64, "starts": np.int32, "counts": np.uint8, "kept_docs": np.int64, "kept_starts": np.int32}
_FOUND = "doc_id long, start int, count int, kept_doc_id long, kept_start int"
_NAMES = ["doc_id", "start", "count", "kept_doc_id", "kept_start"]


def _rows(names: list[str], *cols: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(cols[0]), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + 100_000]) for c in cols], names=names)


def _reduce_runs(cols: list[np.ndarray], many_runs: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of equal runs of a chunk the first one is sent for all. Of an anchor with more than many_runs different runs all
    are to be read again, and one run of no windows tells the anchor so; no anchor gets more rows than that."""
    anchor, content, doc, start, count = cols
    order = np.argsort(anchor, kind="stable")
    new = _changes(anchor[order])
    lone = new & np.append(new[1:], True)
    alone, order = order[lone], order[~lone]
    order = order[np.lexsort((start[order], doc[order], content[order], anchor[order]))]
    first = _changes(anchor[order], content[order])
    group = np.cumsum(_changes(anchor[order])) - 1
    many = (np.bincount(group, first)[group] if len(group) else first) > many_runs
    head = order[np.flatnonzero(first)[np.cumsum(first) - 1]] if len(order) else order
    settled, again = order[~first], order[first & many]
    told = again[_changes(anchor[again])]
    at = np.concatenate([alone, order[first & ~many], told])
    sent = [c[at] for c in cols]
    sent[4][len(at) - len(told) :] = 0
    both, kept = np.concatenate([settled, again]), np.concatenate([head[~first], again])
    kept_start = start[kept].copy()
    kept_start[len(settled) :] = -1
    return sent, [doc[both], start[both], count[both], doc[kept], kept_start]


def _reduce_windows(cols: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Of equal windows of a chunk the first one is sent, the others are settled by it."""
    content, doc, start = cols
    order = np.lexsort((start, doc, content))
    new = _changes(content[order])
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]][~new] if len(order) else order
    rest = order[~new]
    return [c[order[new]] for c in cols], [doc[rest], start[rest], np.ones(len(rest)), doc[head], start[head]]


def repeated_windows(texts: DataFrame, bits: int, many_runs: int = MANY_RUNS) -> DataFrame:
    """doc_id, start, count, kept_doc_id, kept_start: windows of LEAST_WORDS words that begin at the words start to
    start + count - 1 and also stand at kept_start onward in kept_doc_id, an earlier place by (doc_id, start).

    Equal windows meet at their anchor. Runs at an anchor all of whose runs are equal are settled as a whole; those of
    the other anchors are read again and decided window by window. The earlier place is the first one that meets the
    window: the first of its chunk, and for that one the first of all chunks.
    """

    def runs(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        keys = b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        for text, start, count, anchor, content in anchored_runs(b.column("text").to_pylist()):
            yield anchor, content, keys[text], start, count

    def decide_runs(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*_NAMES, "open"]

        def direct(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            doc, start, count, kept_doc, kept_start = cols
            yield from _rows(names, doc, start, count.astype(np.int32), kept_doc, kept_start, kept_start < 0)

        for part in _read(batches, _RUNS, direct):
            if isinstance(part, pa.RecordBatch):
                yield part
                continue
            anchor, content, doc, start, count = part
            # Runs of no windows stand last at their anchor.
            order = np.lexsort((start, doc, content, count == 0, anchor))
            anchor, content, doc, start, count = (c[order] for c in (anchor, content, doc, start, count))
            new = _changes(anchor)
            group = np.cumsum(new) - 1
            head = np.flatnonzero(new)[group]
            alike = np.bincount(group, _changes(anchor, content, count == 0))[group] == 1 if len(group) else new
            keep = np.flatnonzero((count > 0) & (~alike | ~new))
            yield from _rows(names, doc[keep], start[keep], count[keep].astype(np.int32), doc[head[keep]], start[head[keep]], ~alike[keep])

    def windows(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
        keys = b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
        starts, counts = b.column("starts").to_pylist(), b.column("counts").to_pylist()
        for first, run in buffers(b.column("text").to_pylist()):
            words, doc, _ = word_hashes(run)
            home = np.searchsorted(doc, np.arange(len(run)))
            sizes = [len(starts[first + k]) for k in range(len(run))]
            text = np.repeat(np.arange(len(run)), sizes)
            begin = np.concatenate([np.array(starts[first + k], dtype=np.int64) for k in range(len(run))])
            count = np.concatenate([np.array(counts[first + k], dtype=np.int64) for k in range(len(run))])
            start = np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum())
            text = np.repeat(text, count)
            at = start + home[text]
            yield _stretch(_prefixes(words), at, at + LEAST_WORDS), keys[first + text], start

    def decide_windows(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def direct(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            doc, start, count, kept_doc, kept_start = cols
            yield from _rows(_NAMES, doc, start, count.astype(np.int32), kept_doc, kept_start)

        for part in _read(batches, _WINDOWS, direct):
            if isinstance(part, pa.RecordBatch):
                yield part
                continue
            content, doc, start = part
            order = np.lexsort((start, doc, content))
            content, doc, start = content[order], doc[order], start[order]
            new = _changes(content)
            head = np.flatnonzero(new)[np.cumsum(new) - 1][~new] if len(new) else order
            yield from _rows(_NAMES, doc[~new], start[~new], np.ones(len(head), np.int32), doc[head], start[head])

    met = materialise(_send(texts, runs, lambda cols: _reduce_runs(cols, many_runs), _RUNS, bits).groupBy("bucket").applyInArrow(decide_runs, _FOUND + ", open boolean"), "runs")
    places = met.filter("open").groupBy("doc_id").agg(F.collect_list(F.struct("start", "count")).alias("at"))
    again = texts.join(places, "doc_id").select("doc_id", "text", F.col("at.start").alias("starts"), F.col("at.count").alias("counts"))
    single = _send(again, windows, _reduce_windows, _WINDOWS, bits).groupBy("bucket").applyInArrow(decide_windows, _FOUND)
    return met.filter("not open").drop("open").unionByName(single)


def repeated_passages(docs: DataFrame, many_runs: int = MANY_RUNS) -> DataFrame:
    """Rows (doc_id, kind, start, words, cluster, kept_doc_id, removed) of what repeats across or within documents.

    kind paragraph: paragraphs of LEAST_WORDS words or more whose sets of 5-word shingles are joined by similarity
    >= 0.8; cluster is their component, its first one (by doc_id, start) stays and the others are removed. A paragraph
    is a line; shorter lines in a row without a blank line between are one. kind passage: a
    stretch of LEAST_WORDS words or more that stands word for word, as a whole, at an earlier place (by doc_id, start),
    whatever lines it is in. Every word of a repeated stretch of that length is in one. Where the earlier place
    changes a new passage begins, so passages of a text may overlap; kept_doc_id is the document of that place, one
    of the earlier ones. start and words count words of the text. A null or empty text has no rows; documents without
    repeats have none. Rows of one doc_id count as documents in the order of their texts, rows without one come last
    and are reported with a null.
    """
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if unique_ids(named):
        return _repeated_passages(named, many_runs)
    rows = keyed(named, "key")
    ids = rows.select("key", F.col("doc_id").alias("own"))
    found = _repeated_passages(rows.select(F.col("key").alias("doc_id"), "text"), many_runs)
    found = found.join(ids, F.col("doc_id") == F.col("key")).drop("doc_id", "key").withColumnRenamed("own", "doc_id")
    found = found.join(ids, F.col("kept_doc_id") == F.col("key")).drop("kept_doc_id", "key").withColumnRenamed("own", "kept_doc_id")
    return found.select("doc_id", "kind", "start", "words", "cluster", "kept_doc_id", "removed")


def _repeated_passages(texts: DataFrame, many_runs: int) -> DataFrame:
    rows = materialise(paragraph_rows(texts), "paragraphs")
    roots = paragraph_components(texts, rows).toDF("class", "root")
    full = rows.select("doc_id", "start", "words", "class").join(roots, "class", "left").withColumn("cluster", F.coalesce("root", "class"))
    full = materialise(full.select("doc_id", "start", "words", "cluster"), "clustered")
    heads = full.groupBy("cluster").agg(F.min(F.struct("doc_id", "start")).alias("head"), F.count("*").alias("n")).filter("n > 1")
    paragraphs = full.join(heads, "cluster").select(
        "doc_id", F.lit("paragraph").alias("kind"), "start", "words", "cluster", F.col("head.doc_id").alias("kept_doc_id"), (F.struct("doc_id", "start") != F.col("head")).alias("removed")
    )
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    found = repeated_windows(texts, max(LEAST_BUCKET_BITS, (size // (40 * BUCKET_ROWS)).bit_length()), many_runs)
    own = W.partitionBy("doc_id").orderBy("start")
    follows = (
        (F.col("start") == F.lag(F.col("start") + F.col("count")).over(own))
        & (F.col("kept_doc_id") == F.lag("kept_doc_id").over(own))
        & (F.col("start") - F.col("kept_start") == F.lag(F.col("start") - F.col("kept_start")).over(own))
    )
    joined = found.withColumn("new", (~F.coalesce(follows, F.lit(False))).cast("int")).withColumn("stretch", F.sum("new").over(own))
    passages = joined.groupBy("doc_id", "stretch").agg(F.min("start").alias("start"), (F.sum("count") + LEAST_WORDS - 1).cast("int").alias("words"), F.first("kept_doc_id").alias("kept_doc_id"))
    passages = passages.select(
        "doc_id", F.lit("passage").alias("kind"), "start", "words", F.xxhash64("kept_doc_id", F.lit("passage")).alias("cluster"), "kept_doc_id", F.lit(True).alias("removed")
    )
    return paragraphs.unionByName(passages)
