"""Token ids in files: a static range asymmetric numeral system with one shared table of frequencies.

Texts become ids, the ids of the whole corpus are counted, and every document is coded in blocks that need nothing but
the table: LANES interleaved states share a stream of 32-bit words, the states are kept every CHECK steps so that a
reader can begin there, and each block has a checksum of its ids. The files hold the documents in ascending doc_id.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import discard, joined_batches, materialise, shared_dir

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Bits of the table's total, states of a block, ids of a block, steps between checkpoints.
SCALE, LANES, BLOCK, CHECK = 20, 4, 8192, 512
#: States stay in [LOW, LOW << 32).
LOW = 1 << 31
#: A slot's symbol, frequency and place among the symbol's slots are packed into 64 bits.
_AT_SYMBOL, _AT_FREQ, _FIELD = np.uint64(42), np.uint64(21), np.uint64((1 << 21) - 1)
#: Ids that are coded at once, and bytes of a frame of a file.
GROUP, FRAME = 1 << 21, 8 << 20
#: Pieces and ids that a worker keeps beside their spelling.
PIECES, PIECE_IDS = 800_000, 8_000_000
_HEAD = np.dtype([("crc", "<u4"), ("words", "<u4")])
_POINT = np.dtype([("states", "<u8", LANES), ("at", "<u4")])
#: A cut before a space that stands before something else than space never divides a piece of a byte-level vocabulary.
_CUT = re.compile(r"(?<=.)(?= \S)", re.S)
#: Letters and digits by any version of Unicode, and marks that end a piece of them (an apostrophe may not).
_LETTERS = frozenset(map(chr, [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x180)]))
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_vocabulary() -> str:
    """Where the public byte-level vocabulary of 50,257 ids is."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _expanded(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all stretches one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def _counted(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2 and so on in each stretch."""
    return _expanded(np.zeros(len(lengths), np.int64), lengths)


class Encoder:
    """The tokenizers library over texts of a batch; a piece that comes again in this process is not encoded again.

    Texts are cut where no piece of a byte-level vocabulary can reach across. Other vocabularies get whole texts.
    """

    _known: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        kind = repr(self.tokenizer.pre_tokenizer)
        self.cuts = kind.startswith("ByteLevel(") and "add_prefix_space=False" in kind and "use_regex=True" in kind and self.tokenizer.normalizer is None
        space = "\u0120"  # how byte-level vocabularies spell it
        vocabulary = self.tokenizer.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for t, i in vocabulary.items() if t.startswith(space)]] = True
        # Words of ASCII letters are one piece each, so that the library's model can have them without its patterns.
        self.letters, self.space = Tokenizer(self.tokenizer.model), space
        self.letters.pre_tokenizer = CharDelimiterSplit("\n")
        self.clear()

    @classmethod
    def of(cls, path: str) -> Encoder:
        if path not in cls._known:
            cls._known[path] = cls(path)
        return cls._known[path]

    @classmethod
    def forget(cls) -> None:
        """Leave a worker's memory to the steps that only see ids."""
        if cls._known:
            cls._known.clear()
            pa.default_memory_pool().release_unused()

    def clear(self) -> None:
        self.spaced: dict[str, int] = {}
        self.plain: dict[str, int] = {}
        self.flat, self.starts, self.lengths = np.empty(1 << 16, np.uint32), np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)
        self.pieces = self.filled = 0

    def _add(self, known: dict[str, int], new: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, k = self.pieces, self.pieces + len(new)
        self.flat = _room(self.flat, self.filled + len(ids))
        self.starts, self.lengths = _room(self.starts, k), _room(self.lengths, k)
        self.flat[self.filled : self.filled + len(ids)] = ids
        self.starts[n:k] = self.filled + np.cumsum(sizes) - sizes
        self.lengths[n:k] = sizes
        known.update(zip(new, range(n, k), strict=True))
        self.pieces, self.filled = k, self.filled + len(ids)

    def _encoded(self, texts: list[str], tokenizer: Tokenizer | None = None) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _plain(self, pieces: list[str]) -> np.ndarray:
        """Codes of texts as they stand."""
        codes, new = _look_up(self.plain, pieces)
        if len(new):
            self._add(self.plain, texts := list(dict.fromkeys(pieces[k] for k in new)), *self._encoded(texts))
            codes[new] = [self.plain[pieces[k]] for k in new]
        return codes

    def _spaced(self, pieces: list[str]) -> np.ndarray:
        """Codes of distinct texts without a space in them, each behind a space. Many are encoded at once: the ids that
        begin with a space tell where each begins."""
        codes, new = _look_up(self.spaced, pieces)
        letters = np.fromiter((pieces[k].isascii() and pieces[k].isalpha() for k in new.tolist()), bool, len(new))
        for tokenizer, space, places in ((self.letters, "\n" + self.space, new[letters]), (self.tokenizer, " ", new[~letters])):
            for k in range(0, len(places), 50_000):
                at = places[k : k + 50_000]
                part = [pieces[j] for j in at.tolist()]
                ids, _ = self._encoded([space + space.join(part[j : j + 200]) for j in range(0, len(part), 200)], tokenizer)
                begins = np.flatnonzero(self.begins[ids])
                codes[at] = np.arange(self.pieces, self.pieces + len(part))
                self._add(self.spaced, part, ids, np.diff(np.append(begins, len(ids))))
        return codes

    def encode(self, texts: pa.Array, end_id: int) -> pa.Array:
        """Each text's ids and then end_id, as 32-bit little-endian numbers; null is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.cuts or not len(texts):
            ids, sizes = self._encoded(texts.to_pylist())
            ends = np.cumsum(sizes)
            return _binary(np.insert(ids, ends, end_id), np.concatenate([[0], ends + np.arange(1, len(ends) + 1)]))
        if self.pieces > PIECES or self.filled > PIECE_IDS:
            self.clear()
        split = pc.split_pattern(texts, " ")
        ends, words = split.offsets.to_numpy(), split.values.dictionary_encode()
        codes, firsts = words.indices.to_numpy().astype(np.int64), ends[:-1]
        words = words.dictionary
        odd_word = _characters(pc.utf8_slice_codeunits(words, 0, 1), lambda c: not c or c.isspace())
        cores = pc.utf8_rtrim(words, characters=_MARKS)
        marks = (pc.binary_length(words).to_numpy() - pc.binary_length(cores).to_numpy()).astype(np.int64)
        marks[~_characters(pc.utf8_slice_codeunits(cores, -1), lambda c: c in _LETTERS)] = 0
        cores = pc.if_else(pa.array(odd_word), "x", pc.if_else(pa.array(marks > 0), cores, words)).dictionary_encode()
        one = self._spaced(_strings(cores.dictionary))[cores.indices.to_numpy()]
        two = np.full(len(words), -1, np.int64)
        marked = np.flatnonzero(marks)
        tails = _tails(words, marked, marks[marked]).dictionary_encode()
        two[marked] = self._plain(_strings(tails.dictionary))[tails.indices.to_numpy()]
        # Behind the distinct words come the first one of each text, and the stretches of texts with other gaps.
        first = self._plain(_strings(words.take(pa.array(codes[firsts]))))
        odd = odd_word[codes]
        codes[firsts] = len(words) + np.arange(len(firsts))
        odd[firsts] = False
        one, two, per_text = np.concatenate([one, first]), np.concatenate([two, np.full(len(first), -1)]), np.diff(ends).astype(np.int64)
        if odd.any():
            lists = np.split(codes, firsts[1:])
            for k in np.flatnonzero(np.add.reduceat(odd, firsts)):
                cut = self._plain(_CUT.split(texts[int(k)].as_py()))
                lists[k] = len(one) + np.arange(len(cut))
                one, two = np.concatenate([one, cut]), np.concatenate([two, np.full(len(cut), -1)])
            codes, per_text = np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))
        # Ids of each distinct stretch, behind them the end; then those of all stretches of the texts, in one pass of Arrow.
        pair = np.stack([one, two], 1)
        has = pair >= 0
        pieces = pair[has]
        sizes = self.lengths[pieces]
        own = self.flat[_expanded(self.starts[pieces], sizes)]
        upto = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(has.sum(1))])]
        stretches = _binary(np.append(own, np.uint32(end_id)), np.append(upto, upto[-1] + 1), pa.large_binary())
        ids, cuts = _ids(stretches.take(pa.array(np.insert(codes, np.cumsum(per_text), len(one)))))
        return _binary(ids, cuts[np.concatenate([[0], np.cumsum(per_text + 1)])])


def _look_up(known: dict[str, int], pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of pieces, and the places of those that have none."""
    codes = np.fromiter(map(known.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
    return codes, np.flatnonzero(codes < 0)


def _strings(column: pa.Array) -> list[str]:
    """A column without nulls as a list; made at once, not value by value."""
    return column.to_numpy(zero_copy_only=False).tolist()


def _tails(words: pa.Array, at: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The last bytes, in these numbers, of the words at these places."""
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset + at + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[_expanded(ends - sizes, sizes)]
    cuts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(cuts), pa.py_buffer(data)])


def _characters(column: pa.Array, test: Callable[[str], bool]) -> np.ndarray:
    """A test of few distinct strings for each row."""
    few = column.dictionary_encode()
    return np.fromiter(map(test, few.dictionary.to_pylist()), bool, len(few.dictionary))[few.indices.to_numpy()]


def _room(x: np.ndarray, n: int) -> np.ndarray:
    if n <= len(x):
        return x
    more = np.empty(max(n, 2 * len(x)), x.dtype)
    more[: len(x)] = x
    return more


def tokenise(docs: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """documents to (doc_id, ids): 32-bit little-endian ids of the whole text, then end_id. A null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores; threads would each keep memory
        encoder = Encoder.of(vocabulary)
        for batch in joined_batches(batches, 6 << 20):
            for doc_ids, texts in _slices(batch, "text", 12 << 20):
                yield pa.RecordBatch.from_arrays([doc_ids, encoder.encode(texts, end_id)], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary")


def _slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[tuple[pa.Array, pa.Array]]:
    """doc_id and a column in slices of about `most` bytes, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for k, size in enumerate(sizes):
        if k > begin and total + size > most:
            yield batch["doc_id"].slice(begin, k - begin), batch[column].slice(begin, k - begin)
            begin, total = k, 0
        total += int(size)
    if begin < len(sizes):
        yield batch["doc_id"].slice(begin), batch[column].slice(begin)


def _binary(ids: np.ndarray, cuts: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """Rows of ids as a binary column, from where they begin and end."""
    data, cuts = np.ascontiguousarray(ids, "<u4"), np.ascontiguousarray(4 * cuts, np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]).cast(kind or pa.binary())


def count_ids(tokens: DataFrame) -> DataFrame:
    """(id, count) over all documents; a task sends one row for each id it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Encoder.forget()
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for _, ids in _slices(batch.append_column("doc_id", pa.nulls(batch.num_rows)), "ids"):
                more = np.bincount(_ids(ids)[0])
                counts = _zeros(counts, len(more))
                counts[: len(more)] += more
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], names=["id", "count"])

    return tokens.select("ids").mapInArrow(run, "id long, count long").groupBy("id").agg(F.sum("count").alias("count"))


def _zeros(x: np.ndarray, n: int) -> np.ndarray:
    return x if n <= len(x) else np.concatenate([x, np.zeros(n - len(x), x.dtype)])


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a binary column one after the other, and where each row's begin and end."""
    column = column.cast(pa.large_binary())
    cuts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
    return data.view("<u4"), (cuts - cuts[0]) // 4


class Frequencies:
    """Frequencies of ids that add up to 2^SCALE, each 1 at least; rounding goes to the most frequent ones."""

    def __init__(self, counts: dict[int, int]):
        ids = np.array(sorted(counts), np.int64)
        seen = np.array([counts[i] for i in ids.tolist()], np.float64)
        total = 1 << SCALE
        if not len(ids) or len(ids) > total // 2:
            raise ValueError("between 1 and 2^19 different ids")
        own = np.maximum(1, np.floor(seen / seen.sum() * total)).astype(np.int64)
        over, order = int(own.sum()) - total, np.lexsort((ids, -seen))
        if over < 0:
            own[order[0]] -= over
        for k in order.tolist() if over > 0 else ():
            cut = min(over, int(own[k]) - 1)
            own[k] -= cut
            over -= cut
            if not over:
                break
        size = int(ids[-1]) + 1
        self.freq, self.below = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.freq[ids], self.below[ids] = own, np.cumsum(own) - own
        fields = np.repeat((ids.astype(np.uint64) << _AT_SYMBOL) | (own.astype(np.uint64) << _AT_FREQ), own)
        self.slots = fields | (np.arange(total) - np.repeat(np.cumsum(own) - own, own)).astype(np.uint64)
        self.coding = (self.freq << np.uint64(SCALE)) | self.below
        self.pad = int(ids[order[0]])
        self.mark = zlib.crc32(self.freq.astype("<u4").tobytes())


def _layout(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a table of (step, stretch) for stretches in falling length: how many take part in a step, where a step's
    rows begin, and step and stretch of each row."""
    active = np.cumsum(np.bincount(steps, minlength=int(steps[0]) + 1)[::-1])[::-1][1:]
    begins = np.concatenate([[0], np.cumsum(active)])
    step = np.repeat(np.arange(len(active)), active)
    return active, begins, step, np.arange(begins[-1]) - begins[step]


def _by_stretch(begins: np.ndarray, rank: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Rows of the table stretch by stretch; rank: a stretch's place in falling length."""
    ends = np.cumsum(steps)
    return begins[np.arange(ends[-1]) - np.repeat(ends - steps, steps)] + np.repeat(rank, steps)


def _rows(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of four 32-bit numbers, each taken as one value."""
    return table.view(np.complex128).reshape(-1).take(at).view(np.uint32).reshape(-1, LANES)


def encode_documents(ids: np.ndarray, cuts: np.ndarray, table: Frequencies) -> list[bytes]:
    """Each document's ids coded in blocks: its number of ids, the heads of its blocks, their checkpoints, their words."""
    sizes = np.diff(cuts)
    of_doc = -(-sizes // BLOCK)
    doc = np.repeat(np.arange(len(sizes)), of_doc)
    begin = cuts[doc] + BLOCK * (np.arange(len(doc)) - np.repeat(np.cumsum(of_doc) - of_doc, of_doc))
    n = np.minimum(BLOCK, cuts[doc + 1] - begin)
    if not len(n):
        return [np.uint64(0).tobytes() for _ in sizes]
    order = np.argsort(-n, kind="stable")
    steps = -(-n[order] // LANES)
    active, begins, step, block = _layout(steps)
    at = (begin[order][block] + LANES * step) + np.arange(LANES)[:, None]
    symbols = ids.take(at, mode="clip")
    last = begins[steps - 1] + np.arange(len(n))  # the step in which a block may have no more ids for some lanes
    symbols[:, last] = np.where(at[:, last] < (begin + n)[order], symbols[:, last], table.pad)
    points = -(-steps // CHECK)
    point_at = np.concatenate([[0], np.cumsum(points)])
    states = np.empty((point_at[-1], LANES), np.uint64)
    words, sent = np.empty((begins[-1], LANES), np.uint32), np.empty((begins[-1], LANES), bool)
    x = np.full((LANES, len(n)), LOW, np.uint64)
    total, scale, half, room = np.uint64(1 << SCALE), np.uint64(SCALE), np.uint64(5), np.uint64(31 - SCALE + 32)
    for t in range(len(active) - 1, -1, -1):
        rows = slice(int(begins[t]), int(begins[t + 1]))
        y, own = x[:, : int(active[t])], table.coding.take(symbols[:, rows])
        f = own >> scale
        full = (y >> room) >= f
        words[rows], sent[rows] = y.T, full.T
        y >>= full.astype(np.uint64) << half
        y += (y // f) * (total - f)
        y += own & (total - np.uint64(1))
        if t % CHECK == 0:
            states[point_at[: y.shape[1]] + t // CHECK] = y.T
    by_block = _by_stretch(begins, np.arange(len(n)), steps)
    sent = sent.view(np.uint32).reshape(-1).take(by_block).view(bool).reshape(-1, LANES)
    stream = _rows(words, by_block)[sent]
    emitted = np.concatenate([[0], np.cumsum(np.count_nonzero(sent, axis=1))])
    row_at = np.concatenate([[0], np.cumsum(steps)])
    word_at = emitted[row_at]
    ends = np.repeat(row_at[:-1], points) + CHECK * (np.arange(point_at[-1]) - np.repeat(point_at[:-1], points))
    place = np.empty(point_at[-1], _POINT)
    place["states"], place["at"] = states, emitted[ends] - np.repeat(word_at[:-1], points)
    where = np.empty(len(n), np.int64)
    where[order] = np.arange(len(n))
    raw = memoryview(np.ascontiguousarray(ids, "<u4").view(np.uint8))
    head = np.empty(len(n), _HEAD)
    head["words"] = (word_at[1:] - word_at[:-1])[where]
    head["crc"] = [zlib.crc32(raw[a:b]) for a, b in zip((4 * begin).tolist(), (4 * (begin + n)).tolist(), strict=True)]
    place = place[_expanded(point_at[where], points[where])]
    stream = stream[_expanded(word_at[where], head["words"].astype(np.int64))].astype("<u4")
    # Where a document's heads, checkpoints and words end.
    until = np.cumsum(of_doc)
    lead, until_point = np.uint64(sizes).tobytes(), np.concatenate([[0], np.cumsum(points[where])])[np.concatenate([[0], until])]
    until_word = np.concatenate([[0], np.cumsum(head["words"], dtype=np.int64)])[np.concatenate([[0], until])]
    columns = [(lead, 8 * np.arange(len(sizes) + 1)), (head.tobytes(), _HEAD.itemsize * np.concatenate([[0], until])), (place.tobytes(), _POINT.itemsize * until_point), (stream.tobytes(), 4 * until_word)]
    parts = [[data[a:b] for a, b in itertools.pairwise(ends.tolist())] for data, ends in columns]
    return [b"".join(p) for p in zip(*parts, strict=True)]


def decode_documents(coded: list[bytes | memoryview], table: Frequencies, begin: int = 0, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Ids of documents one after the other and where each begins and ends; all checkpoints are read side by side.

    begin, end: only ids of these places of each document, from the checkpoints that lie around them; blocks that are
    read whole are held against their checksums, and a difference raises an error.
    """
    # All documents behind one another as 32-bit words: number of ids, heads, checkpoints and stream of each.
    data = np.frombuffer(b"".join(coded), "<u4")
    lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
    at = np.cumsum(lengths) - lengths
    sizes = data[at] + (data[at + 1].astype(np.int64) << 32)
    blocks = -(-sizes // BLOCK)
    doc = np.repeat(np.arange(len(coded)), blocks)
    nth = _counted(blocks)
    n = np.minimum(BLOCK, sizes[doc] - BLOCK * nth)
    points = -(-(-(-n // LANES)) // CHECK)
    head = data[_expanded(at + 2, 2 * blocks)].view(_HEAD)
    first = np.concatenate([[0], np.cumsum(points)])[np.concatenate([[0], np.cumsum(blocks)])]
    places = at + 2 + 2 * blocks
    place = data[_expanded(places, _POINT.itemsize // 4 * np.diff(first))].view(_POINT)
    used = head["words"].astype(np.int64)
    inside = np.concatenate([[0], np.cumsum(used)])
    word_at = (places + _POINT.itemsize // 4 * np.diff(first))[doc] + inside[:-1] - inside[np.cumsum(blocks) - blocks][doc]
    low = np.minimum(begin, sizes)
    high = np.maximum(low, sizes if end is None else np.minimum(end, sizes))
    of = np.repeat(np.arange(len(n)), points)
    local = LANES * CHECK * _counted(points)
    origin, length = (BLOCK * nth)[of] + local, np.minimum(LANES * CHECK, n[of] - local)
    near = np.flatnonzero((origin < high[doc[of]]) & (origin + length > low[doc[of]]))
    cuts = np.concatenate([[0], np.cumsum(high - low)])
    if not len(near):
        return np.empty(0, np.uint32), cuts
    count, origin, around = length[near], origin[near], doc[of[near]]
    skipped = np.maximum(low[around] - origin, 0)
    taken = np.minimum(high[around] - origin, count) - skipped
    stream, pointers = np.append(data, np.uint32(0)), word_at[of[near]] + place["at"][near]
    order = np.argsort(-count, kind="stable")
    active, begins, step, stretch = _layout(-(-count[order] // LANES))
    x, pointer = np.ascontiguousarray(place["states"][near][order].T, np.uint64), pointers[order]
    found = np.empty((begins[-1], LANES), np.uint32)
    mask, scale, half, low_state = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32), np.uint64(LOW)
    for t, a in enumerate(active.tolist()):
        y = x[:, :a]
        entry = table.slots.take((y & mask).view(np.int64))
        found[begins[t] : begins[t + 1]] = (entry >> _AT_SYMBOL).T
        y = ((entry >> _AT_FREQ) & _FIELD) * (y >> scale) + (entry & _FIELD)
        short = y < low_state
        for lane in range(LANES):
            hit = np.flatnonzero(short[lane])
            y[lane, hit] = (y[lane, hit] << half) | stream.take(pointer[hit])
            pointer[hit] += 1
        x[:, :a] = y
    rank = np.empty(len(count), np.int64)
    rank[order] = np.arange(len(count))
    flat = _rows(found, _by_stretch(begins, rank, -(-count // LANES))).reshape(-1)
    padded = LANES * -(-count // LANES)
    ids = flat if (taken == padded).all() else flat[_expanded(np.cumsum(padded) - padded + skipped, taken)]
    raw = memoryview(np.ascontiguousarray(ids, "<u4").view(np.uint8))
    whole = np.flatnonzero((low[doc] <= BLOCK * nth) & (BLOCK * nth + n <= high[doc]))
    origin = 4 * (cuts[doc] + BLOCK * nth - low[doc])[whole]
    for a, b, crc in zip(origin.tolist(), (origin + 4 * n[whole]).tolist(), head["crc"][whole].tolist(), strict=True):
        if zlib.crc32(raw[a:b]) != crc:
            raise ValueError("a block's checksum differs")
    return ids, cuts


#: Stands for a null doc_id in the order of the files, behind all others.
_LAST = (1 << 63) - 1


def _bounds(tokens: DataFrame, parts: int) -> np.ndarray:
    """doc_ids that cut the documents into about even parts; an id that many rows share can be there several times."""
    shares = [k / parts for k in range(1, parts)]
    found = tokens.select(F.coalesce("doc_id", F.lit(_LAST)).alias("k")).agg(F.percentile_approx("k", shares, max(10_000, 20 * parts))).first() if shares else None
    return np.array(found[0] or [], np.int64) if found else np.empty(0, np.int64)


def _coded(tokens: DataFrame, table: Frequencies, bounds: np.ndarray) -> DataFrame:
    """(part, doc_id, n, coded): parts follow doc_id; rows of an id that cuts lie on are dealt to the parts around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Encoder.forget()
        for batch in batches:
            for doc_ids, column in _slices(batch, "ids", 4 * GROUP):
                ids, cuts = _ids(column)
                coded = encode_documents(ids, cuts, table)
                key = doc_ids.fill_null(_LAST).to_numpy()
                low, high = np.searchsorted(bounds, key, "left"), np.searchsorted(bounds, key, "right")
                part = low.copy()
                for k in np.flatnonzero(high > low + 1).tolist():
                    part[k] += 1 + zlib.crc32(coded[k]) % int(high[k] - low[k] - 1)
                yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), doc_ids, pa.array(np.diff(cuts)), pa.array(coded, pa.binary())], names=["part", "doc_id", "n", "coded"])

    return tokens.mapInArrow(run, "part int, doc_id long, n long, coded binary")


FRAMES = "part int, at long, n long, doc_ids array<long>, sizes array<long>, bytes array<long>, payload binary"


def _framed(coded: DataFrame) -> DataFrame:
    """Documents of sorted parts in frames of about FRAME bytes, with the number of the part's ids before each frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, held = -1, 0, 0
        rows: list[tuple] = []

        def frame() -> pa.RecordBatch:
            ids, sizes, coded = zip(*rows, strict=True)
            row = {"part": part, "at": at, "n": sum(sizes), "doc_ids": list(ids), "sizes": list(sizes), "bytes": list(map(len, coded)), "payload": b"".join(coded)}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        whole = pa.list_(pa.int64())
        schema = pa.schema([("part", pa.int32()), ("at", pa.int64()), ("n", pa.int64()), ("doc_ids", whole), ("sizes", whole), ("bytes", whole), ("payload", pa.binary())])
        for batch in batches:
            for own, *row in zip(*(batch[c].to_pylist() for c in ("part", "doc_id", "n", "coded")), strict=True):
                if own != part:
                    if rows:
                        yield frame()
                    part, at, held, rows = own, 0, 0, []
                rows.append(tuple(row))
                held += len(row[2])
                if held >= FRAME:
                    yield frame()
                    at, held, rows = at + sum(r[1] for r in rows), 0, []
        if rows:
            yield frame()

    return coded.mapInArrow(run, FRAMES)


def write_token_files(docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = 0, partitions: int | None = None) -> None:
    """Write the ids of all documents below path: `frames` with the coded documents in ascending doc_id, and `table`
    with the frequencies (id, count) that all blocks share.

    Every row of docs is a document: null text is empty, repeated doc_ids each stay (ordered by their coded bytes), null
    ids come last; other columns are not read. An empty table writes empty files. Ids are encoded once and kept in a
    table until the files are there.
    """
    tokens = materialise(tokenise(docs, vocabulary or byte_vocabulary(), end_id), "tokens")
    spark = docs.sparkSession
    count_ids(tokens).coalesce(1).write.parquet(f"{path}/table")
    frames = f"{path}/frames"
    if tokens.isEmpty():
        spark.createDataFrame([], FRAMES).write.parquet(frames)
        return
    n = partitions or max(1, tokens.rdd.getNumPartitions())
    coded = _coded(tokens, read_table(spark, path), _bounds(tokens, n)).repartition(n, "part")
    order = ["part", F.col("doc_id").asc_nulls_last(), "n", "coded"]
    _framed(coded.sortWithinPartitions(*order)).write.option("compression", "none").parquet(frames)
    discard(tokens)


def read_table(spark: SparkSession, path: str) -> Frequencies:
    """The shared frequencies; as many rows as the vocabulary has ids at most."""
    return Frequencies({r["id"]: r["count"] for r in spark.read.parquet(f"{path}/table").collect()} or {0: 1})


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """Frames with `start`, the number of ids in all files before each. There is a row a part, so frames are not shuffled."""
    frames = spark.read.schema(FRAMES).parquet(f"{path}/frames")
    parts = frames.groupBy("part").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = parts.select("part", F.coalesce(before, F.lit(0)).alias("_before"))
    return frames.join(F.broadcast(starts), "part").withColumn("start", F.col("at") + F.col("_before")).drop("_before")


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[list, list, list, int]]:
    """doc_ids, sizes and coded bytes of a frame in groups of about GROUP ids, with the group's start."""
    for k in range(batch.num_rows):
        start, payload = batch["start"][k].as_py(), memoryview(batch["payload"][k].as_buffer())
        ids, sizes, lengths = (batch[c][k].as_py() for c in ("doc_ids", "sizes", "bytes"))
        at = begin = held = 0
        views: list[memoryview] = []
        for j, (size, length) in enumerate(zip(sizes, lengths, strict=True)):
            if views and held + size > GROUP:
                yield ids[begin:j], sizes[begin:j], views, start
                start, begin, held, views = start + held, j, 0, []
            views.append(payload[at : at + length])
            at, held = at + length, held + size
        if views:
            yield ids[begin:], sizes[begin:], views, start


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The files back as (doc_id, start, ids): ids as 32-bit little-endian numbers, start the ids before the document."""
    table = read_table(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, _, views, start in _documents(batch):
                ids, cuts = decode_documents(views, table)
                data = _binary(ids, cuts)
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(start + cuts[:-1]), data], names=["doc_id", "start", "ids"])

    return _placed(spark, path).select("start", "doc_ids", "sizes", "bytes", "payload").mapInArrow(run, "doc_id long, start long, ids binary")


def read_range(spark: SparkSession, path: str, begin: int, end: int) -> DataFrame:
    """Ids begin to end (exclusive) of the whole corpus as (start, ids) rows of documents, from the checkpoints around
    them; frames that lie elsewhere are skipped by their headers."""
    table = read_table(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sizes, views, start in _documents(batch):
                for size, view in zip(sizes, views, strict=True):
                    low, high = max(begin - start, 0), min(end - start, size)
                    if low < high:
                        ids, _ = decode_documents([view], table, low, high)
                        yield pa.RecordBatch.from_arrays([pa.array([start + low]), pa.array([ids.astype("<u4").tobytes()])], names=["start", "ids"])
                    start += size

    near = _placed(spark, path).filter((F.col("start") < end) & (F.col("start") + F.col("n") > begin))
    return near.select("start", "doc_ids", "sizes", "bytes", "payload").mapInArrow(run, "start long, ids binary")


def summarise_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from its decoded ids."""
    table = read_table(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Encoder.forget()
        for batch in batches:
            for doc_ids, _, views, start in _documents(batch):
                ids, cuts = decode_documents(views, table)
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(start + cuts[:-1]), pa.array(np.diff(cuts)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return _placed(spark, path).select("start", "doc_ids", "sizes", "bytes", "payload").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame) -> DataFrame:
    """Write the ids of documents to files in the shared folder, and summarise what is read back."""
    import uuid

    path = f"{shared_dir(docs.sparkSession)}/juncture/token_files-{uuid.uuid4().hex}"
    write_token_files(docs, path)
    return summarise_files(docs.sparkSession, path)
