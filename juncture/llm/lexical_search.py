"""Ranked lexical search of all documents for a set of query texts: term at a time with limited accumulators.

Documents are kept in segments: the postings of the queries' terms in some thousand documents. A task goes through its
segments, and through a query's terms from the rarest on. Accumulators are made until what the other terms can still give
is less than the k-th best score so far; from there on only the documents that have one are updated, exactly.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, joined_batches, materialise

#: Results of a query; terms of queries (with repeats between queries) that are searched in one pass; rows of a segment.
TOP, BLOCK_TERMS, SEGMENT_ROWS = 50, 200_000, 1 << 16
#: Groups in which a query's best rows of each task meet first.
SALTS = 32
#: A term is a stretch of digits, letters A to Z and characters beyond ASCII; other bytes of UTF-8 divide terms.
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

SEGMENT = "n_docs long, n_terms long, doc_ids array<long>, lengths array<long>, terms array<int>, dfs array<long>, docs binary, tfs binary"


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8, with repeats."""
    return text.translate(_TERMS).split()


def _segments(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Segments: ids and lengths of the documents that have a term, and postings of the vocabulary's terms, by term and
    place of the document."""

    def segment(ids: list[int | None], lengths: list[int], codes: list[np.ndarray]) -> pa.RecordBatch:
        place = np.repeat(np.arange(len(ids)), [len(c) for c in codes])
        code = np.concatenate([*codes, np.empty(0, np.int64)])
        known = code >= 0
        pairs, tfs = np.unique(code[known] * SEGMENT_ROWS + place[known], return_counts=True)
        terms, dfs = np.unique(pairs // SEGMENT_ROWS, return_counts=True)
        row = {
            "n_docs": len(ids), "n_terms": sum(lengths), "doc_ids": ids, "lengths": lengths, "terms": terms, "dfs": dfs,
            "docs": (pairs % SEGMENT_ROWS).astype("<u2").tobytes(), "tfs": tfs.astype("<u4").tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)

    longs = pa.list_(pa.int64())
    schema = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("doc_ids", longs), ("lengths", longs), ("terms", pa.list_(pa.int32())), ("dfs", longs), ("docs", pa.binary()), ("tfs", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = vocabulary.get
        for batch in joined_batches(batches):
            ids: list[int | None] = []
            lengths: list[int] = []
            codes: list[np.ndarray] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                words = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                if not words:
                    continue
                ids.append(doc_id)
                lengths.append(len(words))
                codes.append(np.fromiter(map(find, words, itertools.repeat(-1)), np.int64, len(words)))
                if len(ids) == SEGMENT_ROWS:
                    yield segment(ids, lengths, codes)
                    ids, lengths, codes = [], [], []
            if ids:
                yield segment(ids, lengths, codes)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SEGMENT)


@dataclass
class Best:
    """The best documents of a query so far, in order: highest score, then lowest id, rows without id last."""

    scores: np.ndarray
    ids: np.ndarray
    missing: np.ndarray

    @classmethod
    def none(cls) -> Best:
        return cls(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))

    def least(self, k: int) -> int:
        """What a document must score to enter."""
        return int(self.scores[k - 1]) if len(self.scores) >= k else 0

    def with_more(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray, k: int) -> Best:
        scores, ids, missing = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.missing, missing)))
        order = np.lexsort((ids, missing, -scores))[:k]
        return Best(scores[order], ids[order], missing[order])


def accumulate(postings: list[tuple[np.ndarray, np.ndarray]], bounds: list[int], n: int, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents that can be among the k best, and their whole scores.

    postings: places and scores of each term's documents, the rarest term first; bounds: the most a term gives to any of
    them; n: number of documents; least: a score that k documents elsewhere have.
    """
    remaining = list(itertools.accumulate(reversed(bounds)))[::-1] + [0]
    scores = np.zeros(n, np.int64)
    open_to = len(postings)
    touched = np.zeros(n, bool)
    made = 0
    for j, (docs, parts) in enumerate(postings):
        enough = least
        if made >= k and remaining[j] < int(scores.max(initial=0)):
            own = scores[touched]
            enough = max(enough, int(np.partition(own, len(own) - k)[len(own) - k]))
        if remaining[j] < enough:
            open_to, least = j, enough
            break
        scores[docs] += parts
        made += int(len(docs) - np.count_nonzero(touched[docs]))
        touched[docs] = True
    alive = np.flatnonzero(touched)
    for j in range(open_to, len(postings)):
        # Those that cannot reach the k-th best any more need no update.
        alive = alive[scores[alive] + remaining[j] >= least]
        docs, parts = postings[j]
        if len(alive) * 8 < len(docs):
            at = np.searchsorted(docs, alive)
            hit = docs[np.minimum(at, len(docs) - 1)] == alive
            scores[alive[hit]] += parts[at[hit]]
        else:
            member = np.zeros(n, bool)
            member[alive] = True
            hit = member[docs]
            scores[docs[hit]] += parts[hit]
    alive = alive[(scores[alive] > 0) & (scores[alive] >= least)]
    return alive, scores[alive]


def _ranked(segments: DataFrame, queries: list[tuple[int, list[int]]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """The k best documents of each task for each query: (query, doc_id, score). queries: number and its terms, the
    rarest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {q: Best.none() for q, _ in queries}
        for batch in batches:
            for r in range(batch.num_rows):
                terms = batch["terms"].slice(r, 1).flatten().to_numpy()
                ids = batch["doc_ids"].slice(r, 1).flatten()
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                lengths = batch["lengths"].slice(r, 1).flatten().to_numpy()
                cuts = np.concatenate([[0], np.cumsum(batch["dfs"].slice(r, 1).flatten().to_numpy())])
                docs = np.frombuffer(batch["docs"][r].as_buffer(), "<u2").astype(np.int64)
                tfs = np.frombuffer(batch["tfs"][r].as_buffer(), "<u4").astype(np.int64)
                m = 50 + 50 * lengths * n_docs // n_terms
                parts = weights[np.repeat(terms, np.diff(cuts))] * (1_000_000_000 * tfs // (1000 * tfs + 20 * m[docs]))
                bounds = np.maximum.reduceat(parts, cuts[:-1]) if len(terms) else parts
                place = np.full(len(weights), -1)
                place[terms] = np.arange(len(terms))
                for q, wanted in queries:
                    there = place[wanted]
                    there = there[there >= 0].tolist()
                    if there:
                        found, scores = accumulate([(docs[cuts[t] : cuts[t + 1]], parts[cuts[t] : cuts[t + 1]]) for t in there], bounds[there].tolist(), len(ids), best[q].least(k), k)
                        if len(found):
                            best[q] = best[q].with_more(scores, ids[found], missing[found], k)
        for q, b in best.items():
            if len(b.scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.scores), q)), pa.array(b.ids, mask=b.missing), pa.array(b.scores)], names=["query", "doc_id", "score"])

    return segments.select("doc_ids", "lengths", "terms", "dfs", "docs", "tfs").mapInArrow(run, "query long, doc_id long, score long")


def _first(found: DataFrame, k: int, *by: str) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, block: list[tuple[int, list[bytes]]], k: int) -> DataFrame:
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in block for t in terms}))}
    segments = materialise(_segments(docs, vocabulary), "segments")
    n_docs, n_terms = (int(x or 0) for x in segments.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    pairs = segments.select(F.explode(F.arrays_zip("terms", "dfs")).alias("x")).select("x.terms", "x.dfs")
    df = np.zeros(len(vocabulary), np.int64)
    for r in pairs.groupBy("terms").agg(F.sum("dfs").alias("n")).toLocalIterator():  # no more rows than the block has terms
        df[r["terms"]] = r["n"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    queries = [(q, sorted((vocabulary[t] for t in terms), key=lambda t: (df[t], t))) for q, terms in block]
    ranked = _ranked(segments, queries, weights, n_docs, max(n_terms, 1), k).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
    out = materialise(_first(_first(ranked, k, "query", "salt"), k, "query").select("query", "rank", "doc_id", "score"), "ranked")
    discard(segments)
    return out


def _blocks(items: Iterable[tuple[object, str | None]]) -> Iterator[tuple[list[object], list[tuple[int, list[bytes]]]]]:
    names: list[object] = []
    block: list[tuple[int, list[bytes]]] = []
    held = 0
    for name, text in items:
        terms = sorted({*terms_of((text or "").encode())})
        if terms:
            block.append((len(names), terms))
            names.append(name)
            held += len(terms)
        if held >= BLOCK_TERMS:
            yield names, block
            names, block, held = [], [], 0
    if block:
        yield names, block


def search(docs: DataFrame, items: DataFrame, k: int = TOP, item_id: str = "item_id") -> DataFrame:
    """The k highest-scoring documents of each item: (item_id, rank from 1, doc_id, score), scores above 0 only.

    Terms are stretches of digits, letters and characters beyond ASCII, A to Z lower-cased; each counts once in an item.
    With N documents that have a term, df of them with the term, L terms in all, n in the document, tf of the term:
    weight w = floor(1000 ln((2 N + 2) / (2 df + 1))), m = 50 + (50 n N) div L, and the score adds
    w * ((10^9 tf) div (1000 tf + 20 m)). Equal scores go by doc_id, rows without one last; repeated rows each count and
    keep a rank of their own. A null or blank text has no term; items without one have no row. Items are searched in
    blocks of about BLOCK_TERMS terms, each in one pass over all documents; their number has no limit.
    """
    spark = docs.sparkSession
    kind = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    rows = ((r[0], r[1]) for r in items.select(F.col(item_id), F.col("text").cast("string")).sort(item_id, "text").toLocalIterator())
    for names, block in _blocks(rows):
        found = _search_block(docs, block, k)
        named = spark.createDataFrame([(q, names[q]) for q, _ in block], f"query long, item_id {kind}")
        out = out.unionByName(found.join(named, "query").select("item_id", "rank", "doc_id", "score"))
    return out
