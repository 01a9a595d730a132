"""Periodic runs in texts: every maximal stretch of words that repeats with a period, found by minimizers of many scales."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64

#: A run is at least this many words and this many periods long.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Periods up to here are found by comparing the words at each lag; longer ones by minimizers.
SHORT = 8
#: Words that are searched together.
GROUP = 1 << 20
#: Multiplier of the polynomial hash of grams (any odd number).
_BASE = 0x9E3779B97F4A7C15

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).view(np.int8)))
    return edge[::2], edge[1::2]


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Places of the leftmost least value of each window of `width` values, each place once, in order."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    # The least of a window from two overlapping windows of a power of two; place and value travel together.
    best = np.arange(len(values))
    span = 1
    while 2 * span <= width:
        left, right = best[: len(best) - span], best[span:]
        best = np.where(values[right] < values[left], right, left)
        span *= 2
    left, right = best[:n], best[width - span : width - span + n]
    found = np.where(values[right] < values[left], right, left)
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hashes of single items, to be doubled."""
    return mix64(codes.astype(np.uint64) + np.uint64(1))


def _doubled(hashes: np.ndarray, length: int, n: int) -> np.ndarray:
    """Polynomial hashes of grams of 2 * length items, from those of `length`, within the first n items."""
    n -= 2 * length - 1
    with np.errstate(over="ignore"):
        return hashes[:n] * np.uint64(pow(_BASE, length, 1 << 64)) + hashes[length : length + n]


def _seeds(hashes: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of next equal minimizers of one scale: place of the first, and distance, in (gram / 2, gram].

    In a run of a period q in that range and of 4 q words or more, two grams are equal only at a multiple of q, and there
    are windows of gram / 2 + 4 grams that come again q words later: so their minimum does, and no equal one lies
    between the two.
    """
    hashes = mix64(hashes)
    places = _window_minima(hashes, gram // 2 + 4)
    order = np.lexsort((places, hashes[places]))
    at, value = places[order], hashes[places[order]]
    distance = at[1:] - at[:-1]
    near = (value[1:] == value[:-1]) & (distance > gram // 2) & (distance <= gram)
    order = np.argsort(at[:-1][near], kind="stable")
    return at[:-1][near][order], distance[near][order]


def _extended(codes: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The whole stretch around `at` in which words `lag` apart are equal: first word, and end of its last one."""

    def reach(step: int) -> int:
        k, width = 0, 64
        while True:
            if step > 0:
                a = codes[at + k : at + k + width]
                b = codes[at + lag + k : at + lag + k + width]
                a = a[: len(b)]
            else:
                a = codes[max(0, at - k - width) : at - k][::-1]
                b = codes[max(lag, at + lag - k - width) : at + lag - k][::-1][: len(a)]
            differ = np.flatnonzero(a != b)
            if len(differ):
                return k + int(differ[0])
            k += len(a)
            if len(a) < width:
                return k
            width *= 2

    return at - reach(-1), at + lag + reach(1)


def find_runs(codes: np.ndarray, sizes: list[int] | None = None, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> Runs:
    """All runs of a sequence of codes (not negative): starts, lengths, smallest periods, by start, then period.

    A run is a maximal stretch whose items q apart are equal, q its smallest period, of max(least_words,
    least_periods * q) items or more; least_periods is 4 at least. sizes: codes holds sequences of these falling lengths,
    with an item between any two that occurs once; a scale looks at those that are long enough for it.
    """
    if least_periods < 4:
        raise ValueError("runs of fewer than 4 periods are not found")
    n = len(codes)
    lengths = np.array([n] if sizes is None else sizes, np.int64)
    ends = np.cumsum(lengths + 1) - 1
    found: list[Runs] = []
    for lag in range(1, min(SHORT, n - 1) + 1):
        begin, end = _stretches(codes[:-lag] == codes[lag:])
        length = end - begin + lag
        long = length >= max(least_words, least_periods * lag)
        found.append((begin[long], length[long], np.full(int(long.sum()), lag)))
    gram, hashes = 1, _grams(codes)
    while True:
        part = int(np.searchsorted(-lengths, -least_periods * max(gram + 1, SHORT), side="right"))
        if not part or ends[part - 1] < 2 * gram:
            break
        hashes, gram = _doubled(hashes, gram, int(ends[part - 1])), 2 * gram
        if gram <= SHORT:
            continue
        rows: list[tuple[int, int, int]] = []
        reached: dict[int, int] = {}
        for p, q in zip(*(x.tolist() for x in _seeds(hashes, gram)), strict=True):
            if p + q < reached.get(q, 0):
                continue  # within a stretch of this period that has been followed
            begin, end = _extended(codes, p, q)
            reached[q] = end
            if end - begin >= max(least_words, least_periods * q):
                rows.append((begin, end - begin, q))
        if rows:
            found.append(tuple(np.array(x) for x in zip(*rows, strict=True)))  # type: ignore[arg-type]
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    start, length, period = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
    # Of the periods of one stretch the smallest counts; it divides the others.
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.concatenate([[True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])]) if len(start) else np.empty(0, bool)
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def kept_words(n: int, runs: Runs) -> np.ndarray:
    """Which of n words stay when each run is collapsed to its first period: a word goes if any run has it after that."""
    edge = np.zeros(n + 1, np.int64)
    start, length, period = runs
    np.add.at(edge, start + period, 1)
    np.add.at(edge, start + length, -1)
    return np.cumsum(edge[:-1]) == 0


def _searched(texts: list[list[bytes]]) -> list[Runs]:
    """Runs of each list of words; lists are searched together, the longest first, with items between them that occur
    once."""
    known: dict[bytes, int] = {}
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    parts = [np.fromiter((known.setdefault(w, len(known)) for w in texts[k]), np.int64, len(texts[k])) for k in order]
    codes = np.concatenate([np.append(p, len(known) + k) for k, p in enumerate(parts)] or [np.empty(0, np.int64)])
    sizes = [len(p) for p in parts]
    begins = np.cumsum([0, *(n + 1 for n in sizes)])
    start, length, period = find_runs(codes, sizes)
    cut = np.searchsorted(start, begins)
    out: list[Runs] = [(start[:0],) * 3] * len(texts)
    for k, place in enumerate(order):
        a, b = cut[k], cut[k + 1]
        if a < b:
            out[place] = (start[a:b] - begins[k], length[a:b], period[a:b])
    return out


def _groups(batch: pa.RecordBatch, column: str, words_of: Callable[[int | None, bytes], list[bytes]]) -> Iterator[tuple[list, list[list[bytes]]]]:
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch["doc_id"], batch[column], strict=True):
        ids.append(doc_id.as_py())
        texts.append(words_of(ids[-1], text.as_buffer().to_pybytes() if text.is_valid else b""))
        held += len(texts[-1])
        if held >= GROUP:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def periodic_runs(docs: DataFrame, words_of: Callable[[int | None, bytes], list[bytes]] | None = None) -> DataFrame:
    """documents to (doc_id, runs, collapsed): each text's runs as (start, length, period) in words, ordered by start,
    then period, and its words without the repetitions, joined by one space.

    Words are stretches between white space (space, tab to carriage return). A null or blank text has no word and no
    run. Every row is a document: null and repeated doc_ids each keep their row. Other columns are not read. words_of
    replaces the division into words; it gets doc_id and the text's bytes.
    """
    divide = words_of or (lambda _, text: text.split())
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _groups(batch, "text", divide):
                found = _searched(texts)
                collapsed = []
                for words, runs in zip(texts, found, strict=True):
                    if len(runs[0]):
                        words = [words[k] for k in np.flatnonzero(kept_words(len(words), runs)).tolist()]
                    collapsed.append(b" ".join(words).decode())
                rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in zip(*(x.tolist() for x in runs), strict=True)] for runs in found]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, schema.field("runs").type), pa.array(collapsed)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )


def summarise_runs(runs: DataFrame) -> DataFrame:
    """periodic_runs to one row a document: number of runs, the longest one (ties: smallest start, then period), digests
    of all runs and of what stays. Without a run the longest one's columns are null."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    out = runs.withColumn("_best", best)
    length, period = F.col("_best.length"), -F.col("_best.period")
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
