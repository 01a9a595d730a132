"""Mixing sources to target weights: repeats plus balanced sampling by the cube method."""

from __future__ import annotations

import itertools
import random
import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fresh, keyed, materialise, mix64, unique_ids, words_count

#: Units that one flight handles, about: a source is cut into blocks by a hash of the key. Rounds at most; each leaves
#: two units a block open.
BLOCK_ROWS, MOST_ROUNDS = 4096, 20
EPS = 1e-9


def source_targets(sizes: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """(source, source_size, n_docs, target) from rows of (source, size).

    Sources by code point (null last) take the weights in turn and share the total size by weight; a target stops at
    most * its source's size and the excess is shared again by weight. The level of the filling is the largest of the
    levels met when sources are capped one by one, smallest cap per weight first. The windows run over one row per
    source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    table = F.array(*[F.lit(float(w)) for w in weights])
    rows = per.withColumn("weight", F.get(table, F.pmod(rank, F.lit(len(weights))))).withColumn("cap", F.col("source_size") * float(most))
    before = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy(F.lit(0))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    rows = rows.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return rows.select("source", "source_size", "n_docs", F.least(F.col("cap"), F.col("level") * F.col("weight")).alias("target"))


def cube_flight(size: np.ndarray, pi: np.ndarray, seed: int, land: bool) -> np.ndarray:
    """Move the inclusion probabilities pi to 0 or 1 while sum(pi * size) and sum(pi) stay as they are.

    Three units at a time: their 2 x 3 constraint matrix has a null vector, and a random one of the two ends of the
    segment along it is taken so that each pi keeps its expectation. At most two units stay between 0 and 1; with
    land, these drop the size constraint first and then the count, and a few flips repair the size total.
    """
    rng, p, s = random.Random(seed), pi.tolist(), size.astype(float).tolist()
    active: list[int] = []

    def move(units: list[int], u: list[float]) -> None:
        up = down = float("inf")
        for k, x in zip(units, u, strict=True):
            if x > 0:
                up, down = min(up, (1 - p[k]) / x), min(down, p[k] / x)
            elif x < 0:
                up, down = min(up, p[k] / -x), min(down, (1 - p[k]) / -x)
        step = up if rng.random() * (up + down) < down else -down
        for k, x in zip(units, u, strict=True):
            v = p[k] + step * x
            p[k] = 0.0 if v < EPS else 1.0 if v > 1 - EPS else v

    for k in range(len(p)):
        if not EPS < p[k] < 1 - EPS:
            p[k] = float(round(p[k]))
            continue
        active.append(k)
        while len(active) == 3:
            a, b, c = (s[j] for j in active)
            u = [b - c, c - a, a - b]
            scale = max(map(abs, u))
            move(active, [x / scale for x in u] if scale else [1.0, -1.0, 0.0])
            active = [j for j in active if 0 < p[j] < 1]
    if land:
        while len(active) > 1:
            move(active[:2], [1.0, -1.0])
            active = [j for j in active if 0 < p[j] < 1]
        for j in active:
            p[j] = float(rng.random() < p[j])
        return _land(np.array(p), np.asarray(size, dtype=float), float(np.dot(size, pi)))
    return np.array(p)


def _land(chosen: np.ndarray, size: np.ndarray, total: float, flips: int = 4) -> np.ndarray:
    """Flip the units that bring sum(chosen * size) nearest to total, one at a time, a few at most."""
    off = float(np.dot(chosen, size)) - total
    for _ in range(flips):
        after = np.abs(off + np.where(chosen > 0, -size, size))
        best = int(np.argmin(after)) if len(after) else 0
        if not len(after) or after[best] >= abs(off):
            break
        off += -size[best] if chosen[best] > 0 else size[best]
        chosen[best] = 1 - chosen[best]
    return chosen


def _flight(stratum: str, turn: int, seed: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def flight(key: tuple, table: pa.Table) -> pa.Table:
        name, block, blocks = (k.as_py() for k in key)
        ids, size, pi = (np.asarray(table.column(c).combine_chunks().fill_null(0)) for c in ("key", "size", "pi"))
        order = np.lexsort((pi, ids, mix64(ids.astype(np.int64).view(np.uint64) + np.uint64(seed)), -size))
        at = zlib.crc32(f"{name}|{name is None}|{block}|{turn}|{seed}".encode())
        out = pi.astype(float).copy()
        out[order] = cube_flight(size[order], pi[order], at, blocks == 1)
        return table.select(["key", stratum, "size"]).append_column("pi", pa.array(out))

    return flight


def cube_sample(units: DataFrame, stratum: str, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Balanced 0/1 choice of units (key long, stratum, size long, pi double): the same rows with pi 0 or 1.

    Every stratum is balanced on its sum of pi * size and its sum of pi. Rounds of flights over hash blocks leave two
    open units a block at most; the next round has only these, until a stratum is one block, which lands. The result
    depends on the rows and the seed, not on their partitions. Rows of a block go largest
    first (ties by a hash of the key), so that what stays open, and what landing can miss, is small.
    """
    schema = f"key long, `{stratum}` string, size long, pi double"
    done: list[DataFrame] = []
    for turn in itertools.count():
        if turn == MOST_ROUNDS:
            raise RuntimeError(f"units are open after {turn} rounds")
        counts = units.groupBy(F.col(stratum).alias("_stratum")).agg(F.count("*").alias("_n"))
        placed = (
            units.join(counts, F.col(stratum).eqNullSafe(F.col("_stratum")))
            .select("key", stratum, "size", "pi", F.ceil(F.col("_n") / block_rows).alias("_blocks"))
            .withColumn("_block", F.pmod(F.xxhash64("key", F.lit(turn)), F.col("_blocks")))
        )

        flown = materialise(placed.groupBy(stratum, "_block", "_blocks").applyInArrow(_flight(stratum, turn, seed), schema), "flight")
        whole = F.col("pi").isin(0.0, 1.0)
        done.append(flown.filter(whole))
        units = flown.filter(~whole)
        if units.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def mix_sources(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken: how many words of each document the mix takes, repeats counted.

    A source's ratio target / size gives every document its whole part as repeats; the fraction is one more copy for
    documents chosen by the cube method. So no document exceeds `most` times its size (for a whole number `most`), and
    each source's words differ from its target by about the size of a document or two. Null texts have size 0 and take
    nothing; a null source is a source of its own; repeated rows count as rows. Empty table: empty result.
    """
    sizes = materialise(docs.select("doc_id", F.col("source").cast("string").alias("source"), words_count().alias("size")), "sizes")
    targets = materialise(source_targets(sizes, weights, most), "targets").withColumnRenamed("source", "_source")
    rows = sizes.join(targets, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    )
    whole = F.floor(F.col("ratio") + EPS)
    rows = rows.withColumn("base", whole).withColumn("pi", F.greatest(F.col("ratio") - whole, F.lit(0.0)))
    units = rows.select(F.col("doc_id").alias("key"), "source", "size", "pi")
    chosen = cube_sample(units, "source", seed)
    facts = targets.withColumn("base", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + EPS)).otherwise(0))
    return chosen.join(facts, F.col("source").eqNullSafe(F.col("_source"))).select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("size") * (F.col("base") + F.col("pi").cast("long"))).alias("taken"),
        (F.col("base") + F.col("pi").cast("long")).alias("copies"),
    )


def mix_documents(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3, seed: int = 0) -> DataFrame:
    """`mix_sources` for rows whose doc_id may be missing or shared: each row is drawn by a key of its own, so rows of one
    id, however many, are spread over blocks like any others. Returns a row for each row, with its doc_id."""
    if unique_ids(docs):
        return mix_sources(docs, weights, most, seed)
    key = fresh(docs, "_key")
    named = keyed(docs, key)
    taken = mix_sources(named.select(F.col(key).alias("doc_id"), "source", "text"), weights, most, seed).withColumnRenamed("doc_id", key)
    return named.select(key, "doc_id").join(taken, key).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixed_rows(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3, seed: int = 0) -> DataFrame:
    """The rows of docs that the mix takes, each as often as it takes them, with their columns.

    Rows of one doc_id and rows without one are rows of their own.
    """
    key, own, copies, turn = (fresh(docs, c) for c in ("_key", "_own", "_copies", "_turn"))
    named = keyed(docs, key)
    taken = mix_sources(named.select(F.col(key).alias("doc_id"), "source", "text"), weights, most, seed).filter("copies > 0")
    rows = named.join(taken.select(F.col("doc_id").alias(own), F.col("copies").alias(copies)), F.col(key) == F.col(own))
    return rows.withColumn(turn, F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(docs.columns)
