"""Language identification with interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise, mix64

#: Order of the models; rows and characters a language gives to training and to calibration at most (bounded samples
#: by key hash); rows of a table that may be broadcast.
ORDER, TRAIN_ROWS, CALIBRATION_ROWS, CHARACTERS, BROADCAST_ROWS = 4, 600, 150, 20_000_000, 1_000_000
#: Characters scored at once, slots of the lookup cache, sharpness of the score, and slack of a language's rejection
#: limit in nats above the QUANTILE of its calibration rows' cross-entropies; SHORT / sqrt(characters) comes on top.
PIECE, SLOTS, SHARPNESS, SLACK = 1 << 20, 1 << 19, 5.0, 0.5
QUANTILE, SHORT = 0.9, 5.0
_STEP = np.uint64(0x9E3779B97F4A7C15)
_OTHER = re.compile(r"[\W\d_]+")


def normalise(text: str) -> str:
    """Lower case, every run of non-letters one space, a space at both ends; empty if there is no letter."""
    out = _OTHER.sub(" ", text.lower()).strip()
    return f" {out} " if any(map(str.isalpha, out)) else ""


def gram_hashes(text: str) -> list[np.ndarray]:
    """Hashes of the 1- to ORDER-grams that end at each character, spaces standing before the text."""
    codes = np.frombuffer((" " * (ORDER - 1) + text).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    with np.errstate(over="ignore"):
        one = mix64(codes + np.uint64(1))
        grams = [one]
        for _ in range(ORDER - 1):
            longer = one.copy()
            longer[1:] += grams[-1][:-1] * _STEP
            grams.append(longer)
    return [g[ORDER - 1 :] for g in grams]


@dataclass
class CharacterModel:
    """One language: by order, sorted hashes of grams with discounted probabilities, of contexts with back-off mass."""

    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    floor: float

    @staticmethod
    def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
        return np.where(table[0][at] == keys, table[1][at], missing) if len(table[0]) else np.full(len(keys), missing)

    def log_probability(self, grams: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        """Natural log of P(character | context); contexts[k] is the hash of the k characters before (k >= 1)."""
        p = np.full(len(grams[0]), self.floor)
        for k in range(ORDER):
            missing = self.contexts[0][1][0] if k == 0 else 1.0
            mass = np.full(len(p), missing) if k == 0 else self._find(self.contexts[k], contexts[k], 1.0)
            p = self._find(self.grams[k], grams[k], 0.0) + mass * p
        return np.log(p)


def fit(counts: dict[int, np.ndarray], vocabulary: int) -> CharacterModel:
    """counts: by order n from 1 to ORDER, a structured array (gram, context, suffix, n) of the n-grams seen.

    The highest order uses counts, lower ones the number of distinct characters before a gram; the discount of an
    order is n1 / (n1 + 2 n2). What is discounted goes to the next lower order, and at the end to a uniform choice.
    """
    grams, contexts, tables = [], [], {ORDER: counts[ORDER]}
    for n in range(ORDER - 1, 0, -1):
        kinds, followers = np.unique(counts[n + 1]["suffix"], return_counts=True)
        rows = counts[n]
        at = np.searchsorted(kinds, rows["gram"])
        at = np.minimum(at, max(len(kinds) - 1, 0))
        n_cont = np.where(kinds[at] == rows["gram"], followers[at], 1) if len(kinds) else np.ones(len(rows))
        new = rows.copy()
        new["n"] = n_cont
        tables[n] = new
    for n in range(1, ORDER + 1):
        rows = tables[n]
        c = rows["n"].astype(float)
        n1, n2 = float((c == 1).sum()), float((c == 2).sum())
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        ctx, inverse = np.unique(rows["context"], return_inverse=True)
        total, kinds = np.bincount(inverse, c, len(ctx)), np.bincount(inverse, minlength=len(ctx))
        order = np.argsort(rows["gram"])
        grams.append((rows["gram"][order], (np.maximum(c - d, 0) / total[inverse])[order]))
        contexts.append((ctx, np.minimum(d, c.min() if len(c) else d) * kinds / total))
    return CharacterModel(grams, contexts, 1.0 / (vocabulary + 1))


@dataclass
class LanguageModels:
    """The models by language, and the calibrated limits of the cross-entropy of long texts, by language."""

    names: list[str]
    models: list[CharacterModel]
    limits: dict[str, float] = field(default_factory=dict)
    _keys: np.ndarray | None = field(default=None, repr=False)
    _logs: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_keys": None, "_logs": None}

    def cross_entropies(self, text: str) -> np.ndarray:
        """Nats a character by language over a normalised text, however long."""
        total = np.zeros(len(self.names))
        for start in range(0, len(text), PIECE):
            lead = min(start, ORDER - 1)
            total += self._sums(text[start - lead : start + PIECE], lead)
        return np.round(-total / len(text), 9)

    def _sums(self, text: str, lead: int) -> np.ndarray:
        whole = gram_hashes(" " + text)
        grams, contexts = [w[lead + 1 :] for w in whole], [None, *[w[lead:-1] for w in whole[:-1]]]
        if self._keys is None:
            self._keys, self._logs = np.zeros(SLOTS, np.uint64), np.zeros((SLOTS, len(self.names)), np.float32)
        top = grams[-1]
        slot = (top & np.uint64(SLOTS - 1)).astype(np.int64)
        miss = np.flatnonzero(self._keys[slot] != top)
        out = self._logs[slot].sum(axis=0, dtype=np.float64)
        if len(miss):
            out -= self._logs[slot[miss]].sum(axis=0, dtype=np.float64)
            keys, first, n = np.unique(top[miss], return_index=True, return_counts=True)
            at = miss[first]
            parts = [g[at] for g in grams], [None if c is None else c[at] for c in contexts]
            logs = np.stack([m.log_probability(*parts) for m in self.models], axis=1).astype(np.float32)
            out += (logs.astype(np.float64) * n[:, None]).sum(axis=0)
            self._keys[slot[at]], self._logs[slot[at]] = keys, logs
        return out

    def predict(self, text: str | None) -> tuple[str, float, float | None, bool]:
        """(language or und, score, cross-entropy, accepted)."""
        body = normalise(text or "")
        if not body or not self.names:
            return "und", 0.0, None, False
        ce = self.cross_entropies(body)
        best = int(np.argmin(ce))
        return self.names[best], float(1 / np.exp(-SHARPNESS * (ce - ce[best])).sum()), float(ce[best]), bool(ce[best] <= self.limits.get(self.names[best], float("inf")) + SHORT / len(body) ** 0.5)


def _small(df: DataFrame, rows: int) -> DataFrame:
    """df with a broadcast hint if it is known to have few rows."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _sample(labelled: DataFrame, rows: int, salt: str, characters: int = CHARACTERS) -> DataFrame:
    """(lang, text) of at most `rows` rows and `characters` characters of each language, those of the least key hash.

    The text that passes the limit of characters is cut, so that a long one shortens the sample and no language is left
    without any. Rows that share an id count one by one.
    """
    share = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(salt), F.col("doc_id").cast("string")).cast("binary")), 1, 12), 16, 10).cast("double") / float(1 << 48)
    keyed = labelled.select("doc_id", "lang", F.substring("text", 1, characters).alias("text"), share.alias("_share"))
    counts = materialise(labelled.groupBy("lang").agg(F.count("*").alias("_n")), "languages")
    near = keyed.join(_small(counts, counts.count()), "lang").filter(F.col("_share") * F.col("_n") <= 2.0 * rows + 50)
    order = W.partitionBy("lang").orderBy("_share", "doc_id", F.length("text"), "text")
    chosen = near.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= rows).select("lang", "text", "_rank")
    before = F.coalesce(F.sum(F.length("text").cast("long")).over(W.partitionBy("lang").orderBy("_rank").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return chosen.withColumn("_left", F.lit(characters) - before).filter("_left > 0").select("lang", F.substring(F.col("text"), F.lit(1), F.col("_left").cast("int")).alias("text"))


def _count_grams(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                body = normalise(text)
                if not body:
                    continue
                grams = gram_hashes(body)
                for n in range(1, ORDER + 1):
                    keys, first, c = np.unique(grams[n - 1], return_index=True, return_counts=True)
                    # What stands before the first character is a space, as in gram_hashes.
                    whole = gram_hashes(" " + body)
                    context = whole[n - 2][first] if n > 1 else np.zeros(len(keys), np.uint64)
                    suffix = grams[n - 2][first] if n > 1 else np.zeros(len(keys), np.uint64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys)), pa.array([n] * len(keys), pa.int32()), *(pa.array(x.view(np.int64)) for x in (keys, context, suffix)), pa.array(c.astype(np.int64))],
                        names=["lang", "n", "gram", "context", "suffix", "c"],
                    )

    rows = texts.mapInArrow(run, "lang string, n int, gram long, context long, suffix long, c long")
    return rows.groupBy("lang", "n", "gram", "context", "suffix").agg(F.sum("c").alias("c"))


def _limits(held: DataFrame, models: LanguageModels) -> dict[str, float]:
    """QUANTILE of the cross-entropies plus SLACK, by language, over the rows predicted as labelled."""
    shared = held.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            got = [own.predict(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array([g[0] for g in got], pa.string()), pa.array([g[2] for g in got], pa.float64())], names=["lang", "lang_pred", "ce"])

    rows = held.select("lang", F.col("text").cast("string").alias("text")).mapInArrow(run, "lang string, lang_pred string, ce double").filter("lang = lang_pred")
    found = {k: float(np.quantile(ce, QUANTILE, method="lower")) + SLACK for k, ce in rows.toPandas().groupby("lang")["ce"]}
    return {name: found.get(name, max(found.values())) for name in models.names} if found else {}


def train(labelled: DataFrame, calibration: Column, train_rows: int = TRAIN_ROWS, calibration_rows: int = CALIBRATION_ROWS) -> LanguageModels:
    """Fit models on a bounded sample of labelled rows (doc_id, text, lang); `calibration` marks rows for the limit.

    At most train_rows rows of each language are counted and calibration_rows rows set its limit of the cross-entropy:
    the QUANTILE of those that are predicted as labelled, rounded down to a row, plus SLACK, so that odd rows do not
    lift it. A text is rejected above its language's limit plus SHORT / sqrt(characters). A language without such rows
    has the highest limit of the others. Rows with a null text or language teach nothing.
    """
    usable = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    grams = _count_grams(_sample(usable.filter(~calibration), train_rows, "train")).toPandas()
    names = sorted(grams["lang"].unique())
    seen = max(1, grams.loc[grams["n"] == 1, "gram"].nunique())
    models = []
    for name in names:
        own = grams[grams["lang"] == name]
        tables = {}
        for n in range(1, ORDER + 1):
            part = own[own["n"] == n]
            rows = np.zeros(len(part), dtype=[("gram", np.uint64), ("context", np.uint64), ("suffix", np.uint64), ("n", np.int64)])
            for c in ("gram", "context", "suffix"):
                rows[c] = part[c].to_numpy().view(np.uint64)
            rows["n"] = part["c"].to_numpy()
            tables[n] = np.sort(rows, order="gram")
        models.append(fit(tables, seen))
    out = LanguageModels(names, models)
    out.limits = _limits(_sample(usable.filter(calibration), calibration_rows, "calibrate"), out)
    return out


def identify(docs: DataFrame, models: LanguageModels) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, accepted from doc_id and text alone.

    `und` (score 0, not accepted) where the text is null or has no letter; else the language of the lowest
    cross-entropy a character. accepted is false above the calibrated limit. Repeated rows repeat; ties go to the
    first language by name; without any model everything is `und`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            got = [own.predict(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array([g[k] for g in got], t) for k, t in enumerate((pa.string(), pa.float64(), pa.float64(), pa.bool_())))],
                names=["doc_id", "lang_pred", "score", "cross_entropy", "accepted"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double, cross_entropy double, accepted boolean")


def fold(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 5; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def identify_documents(docs: DataFrame) -> DataFrame:
    """Learn from the rows whose fold is not 0 (fold 1 calibrates), predict all rows from their texts."""
    models = train(docs.filter(fold() != 0), fold() == 1)
    return identify(docs, models).withColumn("held_out", fold() == 0)


def keep_accepted(docs: DataFrame) -> DataFrame:
    """The rows of docs whose language the models accept, with their columns; nothing is shuffled but the training sample."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs.filter(fold() != 0), fold() == 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            keep = [own.predict(t)[3] for t in b.column("text").to_pylist()]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
