"""Sharding by rendezvous (highest random weight) hashing of stable record keys. Native expressions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows that one slot-numbering task may hold.
SLOT_ROWS = 100_000


def _hash(key: Column, shard: Column) -> Column:
    return F.md5(F.concat_ws(":", key, shard.cast("string")).cast("binary"))


def _score(key: Column, shard: Column, weight: Column | None) -> Column:
    """Comparable score, larger wins. Equal weights compare the digest itself; else w / -ln(u)."""
    if weight is None:
        return _hash(key, shard)
    u = (F.conv(F.substring(_hash(key, shard), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -weight / F.log(u)


def rendezvous(df: DataFrame, key: str, weights: Sequence[float], grown_weight: float | None = None) -> DataFrame:
    """Give every row the shard whose score for the row's key is highest.

    weights: one positive weight per shard; a shard's share is its weight's share. The shard depends on the key and
    the weights alone, so rows with one key go together and row order does not matter. With grown_weight, the column
    grown_shard holds the shard after one more shard of that weight joins: it is either the old one or the new one.

    Nulls: a null key counts as an empty one. Empty table: empty result. Columns named shard or grown_shard are
    replaced; other columns pass through.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive, one per shard at least")
    n = len(weights)
    equal = len({*weights, *([grown_weight] if grown_weight is not None else [])}) == 1
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    table = F.array(*[F.lit(float(w)) for w in weights])
    best = F.array_max(
        F.transform(
            F.sequence(F.lit(0), F.lit(n - 1)),
            lambda s: F.struct(_score(name, s, None if equal else F.get(table, s)).alias("score"), (-s).alias("order")),
        )
    )
    out = df.withColumn("_best", best).withColumn("shard", (-F.col("_best.order")).cast("int"))
    if grown_weight is not None:
        new = _score(name, F.lit(n), None if equal else F.lit(float(grown_weight)))
        out = out.withColumn("grown_shard", F.when(new > F.col("_best.score"), F.lit(n)).otherwise(F.col("shard")))
    return out.drop("_best")


def number_slots(df: DataFrame, key: str, rows: int, shards: int, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """Number the rows of every shard from 0 without gaps.

    Shards are cut into hash buckets of about slot_rows rows; each bucket is numbered alone and moved by the sizes of
    the buckets before it, so no task holds a shard. Within a bucket rows go by key (null first), then by all values.
    Rows of one key, or without one, are spread over the buckets by their other values.
    """
    buckets = max(1, math.ceil(rows / (max(shards, 1) * slot_rows)))
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    others = [F.col(f"`{c}`") for c, kind in df.dtypes if c != key and "map<" not in kind and "variant" not in kind]
    part = df.withColumn("_bucket", F.pmod(F.xxhash64(name, *others), F.lit(buckets)).cast("int"))
    own = F.row_number().over(W.partitionBy("shard", "_bucket").orderBy(key, *others))
    if buckets == 1:
        return part.withColumn("slot", (own - 1).cast("long")).drop("_bucket")
    before = W.partitionBy("shard").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = part.groupBy("shard", "_bucket").count().select(
        "shard", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    return (
        part.join(starts, ["shard", "_bucket"])
        .withColumn("slot", (own - 1 + F.col("_start")).cast("long"))
        .drop("_bucket", "_start")
    )


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """documents to (doc_id, size, text_crc32, law, shard, slot, grown_shard) under the law `key`.

    Size is the text's UTF-8 bytes (null: none) plus 16; a null text has the checksum of no bytes.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    placed = rendezvous(rows, "doc_id", [1.0] * shards, grown_weight=1.0)
    slotted = number_slots(placed, "doc_id", docs.count(), shards)
    return slotted.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
