"""N-gram Jaccard self-join: rare-first prefixes, length, positional and suffix filters, one verification a pair."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, keyed, map_arrow, materialise, mix64
from .components import connected_components, grow_components
from .exact_dedup import without_ids
from .shingles import shingle_sets

#: Shingles that a map task sends at once, documents a chunk may hold, and bits of a token below its bucket.
CHUNK_TOKENS, CHUNK_DOCS, LOW_BITS = 1 << 20, 60_000, 40
#: Bits of the bucket number; a bucket has about its share of all shingles. More for larger inputs (see bucket_bits).
LEAST_BUCKET_BITS, BUCKET_TOKENS = 9, 1_000_000
#: Classes with one token that one task compares with each other.
TILE = 8192
#: Bits of the parity map of a set in the suffix filter, as longs.
MARK_LONGS = 4
_MANY = np.uint16(0xFFFF)


def least_overlap(nx: np.ndarray | int, ny: np.ndarray | int, num: int, den: int) -> np.ndarray | int:
    """Smallest intersection with den * intersection >= num * union."""
    return -(-num * (nx + ny) // (num + den))


def prefix_length(n: int, num: int, den: int) -> int:
    """Tokens, rarest first, of which a partner of any allowed size must share one."""
    return n + (-num * n // den) + 1


def class_of(tokens: np.ndarray) -> int:
    """Key of a whole set, signed 64 bits; equal sets have equal keys."""
    with np.errstate(over="ignore"):
        total = np.add.reduce(mix64(tokens), dtype=np.uint64) + np.uint64(len(tokens)) * np.uint64(0xE7037ED1A0B428DB)
    return int(mix64(np.array([total ^ (total << np.uint64(32))], dtype=np.uint64)).view(np.int64)[0])


def members(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, n_shingles and class (null for an empty set) of each row."""

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s for _, s in shingle_sets(b.column("text").to_pylist(), n)]
        return pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) if len(s) else None for s in sets], pa.int64())],
            names=["doc_id", "n_shingles", "class"],
        )

    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), one, "doc_id long, n_shingles long, class long")


_PARCEL = "bucket int, chunk long, kind int, a binary, b binary, c binary, d binary, e binary"


def _parcels(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 5)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "chunk", "kind", *"abcde"])


def _five(tokens: np.ndarray) -> bytes:
    """Low five bytes of each token."""
    return tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _from_five(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel().astype(np.uint64)


def _send(docs: DataFrame, n: int, bits: int) -> DataFrame:
    """Map side of the frequency count.

    A task gathers the sets of its documents (each class once) into chunks. A token goes once to its bucket: with the
    number of its document if only one document of the chunk has it, else with its count. What documents share a token
    within the chunk stays in the chunk's own parcel (kind 1), which goes straight to where the chunk is put together.
    """

    def flush(chunk: int, classes: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(s) for s in sets], dtype=np.int32)
        tokens = np.concatenate(sets)
        sets.clear()
        order = np.argsort(tokens, kind="stable")
        tokens = tokens[order]
        owner = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)[order]
        del order
        first = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        count = np.diff(np.append(first, len(tokens))).astype(np.int32)
        uniq, single = tokens[first], count == 1
        of = np.where(single, owner[first], _MANY)
        shared = np.repeat(~single, count)
        yield _parcels([(int(mix64(np.array([chunk], np.uint64))[0] & np.uint64((1 << bits) - 1)), chunk, 1, np.array(classes, dtype=np.int64).tobytes(), sizes.tobytes(), uniq[~single].tobytes(), count[~single].tobytes(), owner[shared].tobytes())])
        del tokens, owner, shared, first
        # Tokens are in order, so those of a bucket lie together.
        cut = np.searchsorted(uniq, np.arange(1 << bits, dtype=np.uint64) << np.uint64(LOW_BITS)).tolist() + [len(uniq)]
        rows = []
        for b, (lo, hi) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            if hi > lo:
                # By document, so that their numbers compress.
                by = lo + np.argsort(of[lo:hi], kind="stable")
                many = count[by][of[by] == _MANY]
                rows.append((b, chunk, 0, _five(uniq[by]), of[by].tobytes(), many.astype(np.uint32).tobytes(), b"", b""))
            if len(rows) == 256:
                yield _parcels(rows)
                rows = []
        if rows:
            yield _parcels(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn, total = TaskContext.get().partitionId(), 0, 0
        classes: list[int] = []
        sets: list[np.ndarray] = []
        seen: set[int] = set()
        shift = np.uint64(64 - LOW_BITS - bits)
        for b in batches:
            for _, s in shingle_sets(b.column("text").to_pylist(), n):
                if not len(s) or (c := class_of(s)) in seen:
                    continue
                seen.add(c)
                classes.append(c)
                sets.append(s >> shift)
                total += len(s)
                if total >= CHUNK_TOKENS or len(sets) >= CHUNK_DOCS:
                    yield from flush((part << 24) + turn, classes, sets)
                    classes, sets, total, turn = [], [], 0, turn + 1
        if sets:
            yield from flush((part << 24) + turn, classes, sets)

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, _PARCEL)


def _count(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bucket's tokens: those of two or more documents go back to their chunks with a frequency on a log scale."""
    high = np.uint64(key[0].as_py()) << np.uint64(LOW_BITS)
    sent = []
    for b in batches:
        own = pc.equal(b.column("kind"), 1)
        if pc.any(own).as_py():
            yield b.filter(own)
        chunks, a, of, many = (b.column(c) for c in ("chunk", "a", "b", "c"))
        for k in np.flatnonzero(~np.asarray(own)).tolist():
            sent.append((chunks[k].as_py(), _from_five(a[k].as_buffer()), np.frombuffer(of[k].as_buffer(), dtype=np.uint16), np.frombuffer(many[k].as_buffer(), dtype=np.uint32)))
    if not sent:
        return
    weights = []
    for _, tokens, of, many in sent:
        w = np.ones(len(tokens), dtype=np.int64)
        w[of == _MANY] = many
        weights.append(w)
    _, inverse = np.unique(np.concatenate([s[1] for s in sent]), return_inverse=True)
    frequency = np.bincount(inverse, np.concatenate(weights))[inverse]
    rank = np.minimum(np.round(8 * np.log2(np.maximum(frequency, 1))), 255).astype(np.uint8)
    at, rows = 0, []
    for chunk, tokens, of, _ in sent:
        keep = frequency[at : at + len(tokens)] >= 2
        if keep.any():
            rows.append((key[0].as_py(), chunk, 0, (tokens[keep] | high).tobytes(), of[keep].tobytes(), rank[at : at + len(tokens)][keep].tobytes(), b"", b""))
        at += len(tokens)
    for k in range(0, len(rows), 1024):
        yield _parcels(rows[k : k + 1024])


def parity_marks(tokens: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """For each owner MARK_LONGS longs: bit h is the parity of the number of its tokens of hash h.

    Bits that differ between two sets need a token that only one of them has, so their number bounds the size of the
    symmetric difference from below.
    """
    width = 64 * MARK_LONGS
    bit = (mix64(tokens + np.uint64(7)) & np.uint64(width - 1)).astype(np.int64)
    odd = (np.bincount(owner.astype(np.int64) * width + bit, minlength=owners * width) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(owners, width), axis=1).view(np.int64)


def _assemble(num: int, den: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """A chunk's classes: repeated tokens and the prefix part that others may share, for classes that have one."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        kind = np.asarray(table.column("kind"))
        at = {c: table.column(c) for c in "abcde"}
        head = int(np.flatnonzero(kind == 1)[0])
        classes, sizes, inner, width, inside = (np.frombuffer(at[c][head].as_buffer(), dtype=d) for c, d in zip("abcde", (np.int64, np.int32, np.uint64, np.int32, np.uint16), strict=True))
        tokens, owners, ranks = [], [], []
        begin = np.cumsum(width) - width
        for r in np.flatnonzero(kind == 0).tolist():
            t, of, rank = (np.frombuffer(at[c][r].as_buffer(), dtype=d) for c, d in (("a", np.uint64), ("b", np.uint16), ("c", np.uint8)))
            one = of != _MANY
            tokens.append(t[one])
            owners.append(of[one])
            ranks.append(rank[one])
            place = np.searchsorted(inner, t[~one])
            if len(place):
                w = width[place]
                where = np.repeat(begin[place] - (np.cumsum(w) - w), w) + np.arange(w.sum())
                tokens.append(np.repeat(t[~one], w))
                owners.append(inside[where])
                ranks.append(np.repeat(rank[~one], w))
        out: dict[str, list] = {c: [] for c in ("class", "n", "lone", "tokens", "prefix", "mark")}
        if tokens:
            tok, own, rank = np.concatenate(tokens), np.concatenate(owners), np.concatenate(ranks)
            order = np.lexsort((tok, rank, own))
            tok, own = tok[order], own[order]
            cut = np.searchsorted(own, np.arange(len(classes) + 1))
            marks = parity_marks(tok, own, len(classes))
            for k in range(len(classes)):
                mine, n = tok[cut[k] : cut[k + 1]], int(sizes[k])
                lone = n - len(mine)
                usable = prefix_length(n, num, den) - lone
                if usable > 0 and len(mine):
                    for c, v in zip(out, (int(classes[k]), n, lone, np.sort(mine).tobytes(), mine[:usable].tobytes(), marks[k].tobytes()), strict=True):
                        out[c].append(v)
        return pa.table([pa.array(v, t) for v, t in zip(out.values(), (pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3), strict=True)], names=list(out))

    return run


_MARKS = [f"mark{k}" for k in range(MARK_LONGS)]


def _entries(sets: DataFrame) -> DataFrame:
    """One row for each prefix token of a class: token, class, n, lone, at (its rank among the repeated tokens), mark."""

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        prefix = [np.frombuffer(p, dtype=np.int64) for p in b.column("prefix").to_pylist()]
        width = [len(p) for p in prefix]
        rep = [np.repeat(np.asarray(b.column(c)), width) for c in ("class", "n", "lone")]
        at = np.concatenate([np.arange(w, dtype=np.int32) for w in width])
        marks = np.repeat(np.frombuffer(b"".join(b.column("mark").to_pylist()), dtype=np.int64).reshape(-1, MARK_LONGS), width, axis=0).T
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(prefix), *rep, at, *marks)], names=["token", "class", "n", "lone", "at", *_MARKS])

    return map_arrow(sets.select("class", "n", "lone", "prefix", "mark"), one, "token long, class long, n int, lone int, at int, " + ", ".join(f"{m} long" for m in _MARKS))


def _passes(a: np.ndarray, b: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(kept, least difference) by the length, positional and suffix filters over columns (n, lone, at, mark) of two
    sides that share a token.

    Positional: before the token at most the smaller rank, from it on at most the smaller rest is shared. Suffix: the
    lone tokens and the differing bits of the marks bound the symmetric difference of the rest.
    """
    na, nb = a[0], b[0]
    need = least_overlap(na, nb, num, den)
    most = np.minimum(a[2], b[2]) + np.minimum(na - a[1] - a[2], nb - b[1] - b[2])
    apart = a[1] + b[1] + np.bitwise_count((a[3:] ^ b[3:]).view(np.uint64)).sum(axis=0, dtype=np.int64)
    return (den * np.minimum(na, nb) >= num * np.maximum(na, nb)) & (most >= need) & (na + nb - apart >= 2 * need), apart


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Runs of two or more classes with one token from rows sorted by token, as columns (class, label, n, lone, at,
    mark, side); a run may go on over batches, and a class that repeats in it counts once."""

    def whole(held: list[np.ndarray]) -> np.ndarray:
        run = np.concatenate(held, axis=1)
        return run[:, np.concatenate([[True], run[0, 1:] != run[0, :-1]])]

    held: list[np.ndarray] = []
    token = None
    for b in batches:
        cols = [np.asarray(b.column(c)).astype(np.int64) for c in ("token", "class", "label", "n", "lone", "at", *_MARKS, "side")]
        cut = np.flatnonzero(np.concatenate([[True], cols[0][1:] != cols[0][:-1]]))
        end = np.append(cut[1:], len(cols[0]))
        some = end - cut > 1
        some[[0, -1]] = True
        block = np.stack(cols[1:])
        for lo, hi in zip(cut[some].tolist(), end[some].tolist(), strict=True):
            if cols[0][lo] != token:
                if held and (r := whole(held)).shape[1] > 1:
                    yield r
                held, token = [], cols[0][lo]
            held.append(block[:, lo:hi])
    if held and (r := whole(held)).shape[1] > 1:
        yield r


def _pairs_of_runs(num: int, den: int, mode: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Candidate pairs of the runs.

    near: each class with the one before it and with the run's first, in order of size, 2m pairs for m classes.
    best: of the classes of another label the one whose marks differ least, m pairs. all: every pair of different
    labels that the filters let through. Of a run with sides only classes of different sides are paired.
    """

    def pairs(run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key, label, meta, side = run[0], run[1], run[2:-1], run[-1]
        m = len(key)
        if mode == "near":
            i = np.concatenate([np.zeros(m - 1, np.int64), np.arange(1, m - 1)])
            j = np.concatenate([np.arange(1, m), np.arange(2, m)])
            ok, _ = _passes(meta[:, i], meta[:, j], num, den)
            return key[i[ok]], key[j[ok]]
        left, right = [key[:0]], [key[:0]]
        if (label == label[0]).all():
            return key[:0], key[:0]
        for i in range(m - 1):
            hi = np.searchsorted(meta[0], den * meta[0, i] // num, side="right")
            j = np.arange(i + 1, hi)
            j = j[(label[j] != label[i]) & ((side[j] != side[i]) | (side[i] == 0))]
            if not len(j):
                continue
            ok, apart = _passes(np.repeat(meta[:, i : i + 1], len(j), 1), meta[:, j], num, den)
            j, apart = j[ok], apart[ok]
            if mode == "best" and len(j):
                j = j[[apart.argmin()]]
            left.append(np.repeat(key[i], len(j)))
            right.append(key[j])
        return np.concatenate(left), np.concatenate(right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0

        def flush() -> pa.RecordBatch:
            both = np.unique(np.concatenate(out, axis=1), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in both], names=["a", "b"])

        for r in _runs(batches):
            a, b = pairs(r)
            if len(a):
                out.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
                size += len(a)
                if size > 1 << 16:
                    yield flush()
                    out, size = [], 0
        if out:
            yield flush()

    return run


_ENTRY = "token long, class long, label long, n int, lone int, at int, " + ", ".join(f"{m} long" for m in _MARKS) + ", side int"


def _open_runs(num: int, den: int, tile: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of the runs that still hold two labels or more; each run gets a token of its own again.

    A run of more than `tile` classes (0: never) becomes a run for each block of tile classes and one for each two
    blocks whose sizes allow a link, with a side for each block, so that its pairs are spread over tasks.
    """

    def tiles(r: np.ndarray) -> Iterator[np.ndarray]:
        if not tile or r.shape[1] <= tile or r[-1].any():
            yield r
            return
        blocks = [r[:, lo : lo + tile] for lo in range(0, r.shape[1], tile)]
        for i, a in enumerate(blocks):
            yield a
            for b in blocks[i + 1 :]:
                if den * a[2, -1] >= num * b[2, 0]:
                    both = np.concatenate([a, b], axis=1)
                    both[-1] = np.repeat([1, 2], [a.shape[1], b.shape[1]])
                    yield both

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, names = TaskContext.get().partitionId(), 0, ["token", "class", "label", "n", "lone", "at", *_MARKS, "side"]
        for r in (t for whole in _runs(batches) for t in tiles(whole)):
            if (r[1] != r[1, 0]).any():
                cols = [np.full(r.shape[1], (part << 40) + k), *r[:2], *(c.astype(np.int32) for c in r[2:5]), *r[5:-1], r[-1].astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=names)
                k += 1

    return run


def settle_components(entries: DataFrame, sets_of: Callable[[DataFrame], DataFrame], num: int, den: int, rounds: int = 2, tile: int = TILE) -> DataFrame:
    """(node, root) of the components of all verified links among classes that share a token; classes without do not appear.

    entries: token, class, n, lone, at, marks; sets_of gives (class, n, tokens) for a table of classes, those that
    share a token with another one. First every class is paired with its neighbours in its runs; the components of
    what holds are labels. Then only runs with several labels are left: for a few rounds each class there is paired
    with the most similar one of another label, and at last all pairs of different label that the filters let through
    are verified. New links only join the labels at hand. A group of thousands of near copies so costs few pairs, and
    no link between components is lost.
    """

    def ordered(df: DataFrame) -> DataFrame:
        return df.repartition("token").sortWithinPartitions("token", "n", "class")

    def opened(labelled: DataFrame, tile: int) -> DataFrame:
        return materialise(ordered(labelled.select(*(f.split()[0] for f in _ENTRY.split(", ")))).mapInArrow(_open_runs(num, den, tile), _ENTRY), "open")

    def candidates(mode: str, tested: DataFrame | None) -> DataFrame:
        found = ordered(still).mapInArrow(_pairs_of_runs(num, den, mode), "a long, b long").distinct()
        return materialise(found if tested is None else found.join(tested, ["a", "b"], "left_anti"), "pairs")

    def relabelled() -> DataFrame:
        named = still.drop("label").join(roots.toDF("class", "_label"), "class", "left")
        return opened(named.withColumn("label", F.coalesce("_label", "class")), tile)

    def verified(pairs: DataFrame) -> DataFrame:
        return materialise(_verify(pairs, sets, num, den), "links")

    still = opened(entries.withColumns({"label": F.col("class"), "side": F.lit(0)}), 0)
    sets = materialise(sets_of(still.select("class").distinct()), "sets")
    tested = candidates("near", None)
    roots = connected_components(verified(tested))
    still = relabelled()
    for _ in range(rounds):
        pairs = candidates("best", tested)
        tested = tested.unionByName(pairs)
        new = verified(pairs)
        if new.isEmpty():
            break
        roots = grow_components(roots, new)
        still = relabelled()
    return grow_components(roots, verified(candidates("all", tested)))


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose Jaccard similarity is num/den or more: the suffix filter, then one intersection."""
    of = sets.select("class", "n", "tokens")
    both = pairs.join(of.toDF("a", "na", "ta"), "a").join(of.toDF("b", "nb", "tb"), "b")

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for na, nb, ta, tb in zip(*(b.column(c).to_pylist() for c in ("na", "nb", "ta", "tb")), strict=True):
            need = least_overlap(na, nb, num, den)
            x, y = np.frombuffer(ta, dtype=np.uint64), np.frombuffer(tb, dtype=np.uint64)
            marks = x[[len(x) // 4, len(x) // 2, 3 * len(x) // 4]]
            apart = np.abs(np.diff(np.searchsorted(x, marks), prepend=0, append=len(x)) - np.diff(np.searchsorted(y, marks), prepend=0, append=len(y))).sum()
            keep.append(bool((len(x) + len(y) - apart) // 2 >= need and len(np.intersect1d(x, y, assume_unique=True)) >= need))
        where = np.flatnonzero(keep)
        return pa.RecordBatch.from_arrays([b.column(c).take(pa.array(where)) for c in ("a", "b")], names=["a", "b"])

    return map_arrow(both.select("a", "b", "na", "nb", "ta", "tb"), one, "a long, b long")


def bucket_bits(tokens: int) -> int:
    return max(LEAST_BUCKET_BITS, (max(tokens, 1) // BUCKET_TOKENS).bit_length())


def jaccard_roots(docs: DataFrame, rows: DataFrame, n: int, num: int, den: int, tile: int = TILE) -> DataFrame:
    """(node, root) of the classes that links of similarity >= num/den join."""
    total = rows.agg(F.sum("n_shingles")).first()[0] or 0
    sent = _send(docs, n, bucket_bits(total))
    counted = sent.groupBy("bucket").applyInArrow(_count, _PARCEL)
    found = counted.groupBy("chunk").applyInArrow(_assemble(num, den), "class long, n int, lone int, tokens binary, prefix binary, mark binary")
    sets = materialise(found.dropDuplicates(["class"]), "sets")
    return settle_components(_entries(sets), lambda classes: sets.select("class", "n", "tokens").join(classes, "class", "left_semi"), num, den, tile=tile)


def jaccard_components(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, class, component_id of each row: documents joined by links of Jaccard >= num/den.

    Words are runs other than ASCII white space, A-Z lower-cased; a set holds the distinct n-word shingles, or the
    whole sequence if it is shorter. A text without words or a null one has an empty set and is linked with nothing.
    Equal sets are one class and never expanded into pairs. component_id is the least doc_id of the component.
    Every allowed pair shares a token of its two rare-first prefixes; a token only one document has cannot be shared,
    so a document whose prefix is all such tokens is dropped at once.
    """
    rows = materialise(members(docs, n), "classes")
    roots = jaccard_roots(docs, rows, n, num, den, tile)
    full = rows.filter("class is not null").join(roots.toDF("class", "root"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    full = materialise(full, "rooted")
    least = full.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    out = full.join(least, "root").select("doc_id", "n_shingles", "class", "component_id")
    return out.unionByName(rows.filter("class is null").select("doc_id", "n_shingles", "class", F.col("doc_id").alias("component_id")))


def keep_one_of_each(docs: DataFrame, n: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """The rows of docs without those whose component has an earlier row, with their columns.

    Rows are known by a key of their own: where ids are there and unique it is the id, else rows go by doc_id (nulls
    last), then text; rows that share an id are compared by their texts like any others. A text without words stays.
    """
    key = fresh(docs, "_key")
    named = keyed(docs, key)
    found = jaccard_components(named.select(F.col(key).alias("doc_id"), "text"), n, num, den)
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias(key))
    return without_ids(named, gone, by=key).select(docs.columns)
