"""SentencePiece encoding and decoding: Gumbel top-k sampling of segmentations without replacement."""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, uniform
from .shingles import _BASE, _INVERSE, _power

#: Where the public tokenizers' files are; a parameter of every function that needs one.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Segmentations a text gets, characters in a lattice slice, characters of a stretch between rescalings of its sums.
SAMPLES, SLICE, RESCALE = 2, 1 << 19, 32
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


@dataclass
class Vocabulary:
    """Pieces by id with their weights, and a hash table of all prefixes of pieces for the lattice."""

    pieces: list[str]
    weights: np.ndarray
    bytes_at: int
    _table: tuple | None = field(default=None, repr=False)
    _spelled: list[str] | None = field(default=None, repr=False)
    _flat: tuple | None = field(default=None, repr=False)

    @classmethod
    def load(cls, path: str = MODEL, temperature: float = 1.0) -> Vocabulary:
        """A model without piece probabilities gets a Zipf law: weight 1 / (10 + place among the ordinary pieces)."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        first = max(i for i, p in enumerate(pieces) if _BYTE_PIECE.fullmatch(p)) + 1
        place = np.arange(len(pieces)) - first
        weights = np.where(place >= 0, (1.0 / (10.0 + np.maximum(place, 0))) ** (1.0 / temperature), 0.0)
        return cls(pieces, weights, first - 256)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_table": None, "_spelled": None, "_flat": None}

    def spelled(self) -> list[str]:
        """Text of each piece: spaces for marks, and ASCII bytes as their character."""
        if self._spelled is None:
            self._spelled = [p.replace(SPACE, " ") for p in self.pieces]
            self._spelled[self.bytes_at : self.bytes_at + 128] = map(chr, range(128))
        return self._spelled

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(codes, start, length): the spelled pieces one after another."""
        if self._flat is None:
            spelled = self.spelled()
            length = np.array([len(p) for p in spelled], dtype=np.int64)
            self._flat = _codes("".join(spelled)), np.cumsum(length) - length, length
        return self._flat

    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """(keys, ids, single, heads, longest): open-addressed hashes of prefixes of two or more characters with the
        id of the piece or -1; by character its piece or -1 and whether longer pieces begin with it; the longest piece.
        """
        if self._table is None:
            ids: dict[str, int] = {}
            single, heads = np.full(0x110000, -1, np.int32), np.zeros(0x110000, dtype=bool)
            for i in range(self.bytes_at + 256, len(self.pieces)):
                p = self.pieces[i]
                if len(p) == 1:
                    single[ord(p)] = i
                    continue
                heads[ord(p[0])] = True
                for k in range(2, len(p)):
                    ids.setdefault(p[:k], -1)
                ids[p] = i
            size = 1 << (4 * len(ids) + 4).bit_length()
            keys, values = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
            codes, width = _codes("".join(ids)), np.array([len(p) for p in ids], dtype=np.int64)
            begin = np.cumsum(width) - width
            for key, value in zip(_stretch_hash(codes, begin, width).tolist(), ids.values(), strict=True):
                at = key & (size - 1)
                while keys[at]:
                    at = (at + 1) & (size - 1)
                keys[at], values[at] = key, value
            self._table = keys, values, single, heads, max([1, *map(len, ids)])
        return self._table

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is a prefix of a piece, id of the piece or -1) of each hash."""
        keys, values, *_ = self.table()
        at = (hashes & np.uint64(len(keys) - 1)).astype(np.int64)
        found, out = np.zeros(len(at), bool), np.full(len(at), -1, np.int32)
        todo = np.arange(len(at))
        while len(todo):
            k = keys[at[todo]]
            hit = k == hashes[todo]
            found[todo[hit]], out[todo[hit]] = True, values[at[todo[hit]]]
            todo = todo[~hit & (k != 0)]
            at[todo] = (at[todo] + 1) & (len(keys) - 1)
        return found, out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _prefix(codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate([[np.uint64(0)], np.cumsum(mix64(codes.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(codes) + 1)[: len(codes)], dtype=np.uint64)])


def _stretch_hash(codes: np.ndarray, begin: np.ndarray, width: np.ndarray | int, prefix: np.ndarray | None = None) -> np.ndarray:
    """Hash of codes[begin : begin + width]."""
    s = _prefix(codes) if prefix is None else prefix
    with np.errstate(over="ignore"):
        return mix64((s[begin + width] - s[begin]) * _power(_INVERSE, len(codes) + 1)[begin] + np.asarray(width).astype(np.uint64)) | np.uint64(1)


def normalise(text: str | None) -> str:
    """Spaces become the space mark, one stands before the text; an empty or null text stays empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def decode(vocabulary: Vocabulary, ids: np.ndarray | list[int]) -> str:
    """The text of piece ids: bytes joined, space marks to spaces, the first one dropped."""
    ids = np.asarray(ids, dtype=np.int64)
    low, high = vocabulary.bytes_at, vocabulary.bytes_at + 256
    spelled = vocabulary.spelled()
    raw = (ids >= low + 128) & (ids < high)
    if not raw.any():
        text = "".join(map(spelled.__getitem__, ids.tolist()))
    else:
        raw = (ids >= low) & (ids < high)
        out, at = [], 0
        for end in [*(np.flatnonzero(raw[1:] != raw[:-1]) + 1).tolist(), len(ids)]:
            part = ids[at:end]
            out.append(bytes((part - low).astype(np.uint8)).decode("utf-8", "replace") if raw[at] else "".join(map(spelled.__getitem__, part.tolist())))
            at = end
        text = "".join(out)
    return text[1:] if text[:1] == " " else text


def round_trips(vocabulary: Vocabulary, texts: list[str | None], owner: list[int], ids: np.ndarray, ends: np.ndarray) -> list[bool]:
    """Whether decoding ids[ends[k]:ends[k + 1]] gives the text owner[k] again; all are spelled out at once, but for
    those with bytes beyond ASCII."""
    flat, start, length = vocabulary.flat()
    size = length[ids]
    begin = np.append(0, np.cumsum(size))
    spelled = flat[np.repeat(start[ids] - begin[:-1], size) + np.arange(begin[-1])]
    raw = np.append(0, np.cumsum((ids >= vocabulary.bytes_at + 128) & (ids < vocabulary.bytes_at + 256)))
    want = [_codes(" " + t) if t else np.zeros(0, "<u4") for t in texts]
    out = []
    for k, d in enumerate(owner):
        lo, hi = int(ends[k]), int(ends[k + 1])
        if raw[hi] > raw[lo]:
            out.append(decode(vocabulary, ids[lo:hi]) == (texts[d] or ""))
        else:
            out.append(bool(np.array_equal(spelled[begin[lo] : begin[hi]], want[d])))
    return out


class Lattice:
    """The segmentations of several normalised texts; equal stretches between boundaries share one lattice.

    A boundary is before a run of space marks and around a character that no piece has (its bytes are its only
    segmentation). A state is a distinct stretch with a number of characters left; its options are the pieces that
    start there, each with the probability that a segmentation drawn by weight goes on with it. Stretches are ranked
    by length, longest first, and states numbered by characters left and then by rank, so the sums from the ends run
    over slices.
    """

    def __init__(self, vocabulary: Vocabulary, texts: list[str]) -> None:
        self.vocabulary = vocabulary
        *_, single, _, _ = vocabulary.table()
        codes = self.codes = _codes("".join(texts))
        size = np.array([len(t) for t in texts], dtype=np.int64)
        start = np.cumsum(size) - size
        mark = np.zeros(len(codes) + 1, dtype=bool)
        mark[start] = True
        mark[len(codes)] = True
        if len(codes):
            space, strange = codes == ord(SPACE), single[codes] < 0
            mark[1:-1] |= (space[1:] & ~space[:-1]) | strange[1:] | strange[:-1]
        begin = np.flatnonzero(mark[:-1])
        width = np.diff(np.append(begin, len(codes)))
        self.doc_of = np.searchsorted(start, begin, side="right") - 1 if len(begin) else begin
        # Texts of no characters share their start with the next text, so the last one starting there owns it.
        self.first_token = np.searchsorted(begin, start)
        _, first, kind = np.unique(_stretch_hash(codes, begin, width), return_index=True, return_inverse=True)
        order = np.argsort(-width[first], kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.kind, self.width = rank[kind], width[first][order]
        self._options(begin[first][order])

    def _options(self, begin: np.ndarray) -> None:
        """Edges of the states in order of state and length: piece id, length, probability, and sums for drawing."""
        keys, values, single, heads, longest = self.vocabulary.table()
        most = int(self.width.max(initial=0))
        # Stretches with k or more characters are the first alive[k - 1]; states with k left start at level[k - 1].
        alive = len(self.width) - np.searchsorted(self.width[::-1], np.arange(1, most + 1))
        self.level = level = np.append(0, np.cumsum(alive))
        total = int(level[-1])
        left = np.repeat(np.arange(1, most + 1, dtype=np.int32), alive)
        rank = np.arange(total) - level[left - 1]
        where = (begin + self.width)[rank] - left
        chars, prefix = self.codes[where], _prefix(self.codes)
        number = np.ones(total, dtype=np.int64)
        piece = single[chars]
        weight = np.where(piece < 0, 1.0, self.vocabulary.weights[np.maximum(piece, 0)])
        # A character without a piece stands for its bytes, id -2 - code.
        piece = np.where(piece < 0, -2 - chars.astype(np.int32), piece)
        parts = [(np.arange(total), np.ones(total, np.int32), np.zeros(total, np.int64), piece, weight)]
        at = np.flatnonzero(heads[chars])
        for n in range(2, longest + 1):
            at = at[left[at] >= n]
            if not len(at):
                break
            found, ids = self.vocabulary.find(_stretch_hash(self.codes, where[at], n, prefix))
            hit = ids >= 0
            state, own = at[hit], ids[hit]
            parts.append((state, np.full(len(state), n, np.int32), number[state], own, self.vocabulary.weights[own]))
            number[state] += 1
            at = at[found]
        self.begin = np.append(0, np.cumsum(number))
        state, size, turn, piece, weight = (np.concatenate(c) for c in zip(*parts, strict=True))
        place = self.begin[state] + turn
        self.state, self.size, self.ids, self.chance = (np.empty(len(place), c.dtype) for c in (state, size, piece, weight))
        self.state[place], self.size[place], self.ids[place], self.chance[place] = state, size, piece, weight
        self._sums(left, rank, longest, number)

    def _sums(self, left: np.ndarray, rank: np.ndarray, longest: int, number: np.ndarray) -> None:
        """Turn weights into probabilities, from the ends of the stretches to their starts.

        The sum of a state is that of weight times the sum of the state behind, over its options. Only ratios within
        the reach of a piece matter, so every RESCALE characters the last sums of a stretch are divided by the newest.
        """
        level, total, chance = self.level, len(left), self.chance
        after = left[self.state] - self.size
        behind = np.where(after > 0, level[np.maximum(after, 1) - 1] + rank[self.state], total)
        beyond = np.ones(total + 1)
        for k in range(len(level) - 1):
            lo, hi = level[k], level[k + 1]
            if k and k % max(RESCALE, longest) == 0:
                scale = 1.0 / beyond[level[k - 1] : level[k - 1] + hi - lo]
                for j in range(k - longest, k):
                    beyond[level[j] : level[j] + hi - lo] *= scale
            e = slice(self.begin[lo], self.begin[hi])
            value = chance[e] * beyond[behind[e]]
            mass = np.add.reduceat(value, self.begin[lo:hi] - self.begin[lo])
            beyond[lo:hi] = mass
            chance[e] = value / np.repeat(mass, number[lo:hi])
        # Probability of an option or a longer one; an option is drawn from the longest down.
        running = np.cumsum(chance)
        last = running[self.begin[1:] - 1]
        self.down = np.repeat(last, number) - running + chance
        self.down[self.begin[:-1]] = 2.0

    def walk(self, tokens: np.ndarray, at: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draw on from place `at` of each token to its end: (token, edge), in text order."""
        found, sizes = [], []
        index, kind = np.arange(len(tokens)), self.kind[tokens]
        left = self.width[kind] - at
        keep = left > 0
        if not keep.all():
            index, left, kind = index[keep], left[keep], kind[keep]
        count = np.zeros(len(tokens), dtype=np.int64)
        while len(index):
            edge = self.begin[self.level[left - 1] + kind + 1] - 1
            with np.errstate(over="ignore"):
                u = uniform(mix64(seeds[index] + left.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)))
            todo = np.flatnonzero(self.down[edge] <= u)
            while len(todo):
                edge[todo] -= 1
                todo = todo[self.down[edge[todo]] <= u[todo]]
            found.append(edge)
            sizes.append(index)
            count[index] += 1
            left = left - self.size[edge]
            keep = np.flatnonzero(left)
            index, left, kind = index[keep], left[keep], kind[keep]
        out = np.empty(int(count.sum()), dtype=np.int64)
        begin = np.cumsum(count) - count
        for step, (index, edge) in enumerate(zip(sizes, found, strict=True)):
            out[begin[index] + step] = edge
        return np.repeat(tokens, count), out

    def other(self, edge: int, taken: set[int], u: float) -> tuple[int, float]:
        """(edge, log probability) of a draw at the state of an edge without the edges taken."""
        state = int(self.state[edge])
        first, last = int(self.begin[state]), int(self.begin[state + 1])
        p = self.chance[first:last].copy()
        p[[t - first for t in taken]] = 0.0
        left = np.cumsum(p)
        k = int((left <= u * left[-1]).sum())
        return first + k, float(np.log(p[k]))

    def done(self, edge: int, token: int) -> int:
        """Characters of the token that stand up to the end of the edge."""
        state, kind = int(self.state[edge]), int(self.kind[token])
        left = int(np.searchsorted(self.level, state, side="right"))
        return int(self.width[kind]) - left + int(self.size[edge])

    def piece_ids(self, edges: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces with bytes spelled out, and where the given cuts of the edges then are."""
        ids = self.ids[edges].astype(np.int32)
        strange = np.flatnonzero(ids <= -2)
        if not len(strange):
            return ids, cuts
        uniq, which = np.unique(-2 - ids[strange], return_inverse=True)
        spelled = [np.frombuffer(chr(c).encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.int32) + self.vocabulary.bytes_at for c in uniq.tolist()]
        size = np.ones(len(ids), dtype=np.int64)
        size[strange] = np.array([len(s) for s in spelled])[which]
        out = np.repeat(ids, size)
        end = np.concatenate([[0], np.cumsum(size)])
        for k in range(4):
            longer = size[strange] > k
            out[end[strange[longer]] + k] = np.array([s[k] if len(s) > k else 0 for s in spelled], dtype=np.int32)[which[longer]]
        return out, end[cuts]


def _gumbel_below(place: np.ndarray, bound: np.ndarray | float, u: np.ndarray) -> np.ndarray:
    """Gumbel variables of the given locations, each conditioned to be at most bound."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        return np.where(np.isneginf(place), -np.inf, place - np.logaddexp(place - bound, np.log(-np.log(u))))


def _log_rest(chance: np.ndarray) -> np.ndarray:
    """log(1 - chance); minus infinity for a choice that is (up to rounding) certain."""
    with np.errstate(divide="ignore"):
        return np.where(chance < 1 - 1e-12, np.log1p(-np.minimum(chance, 1 - 1e-13)), -np.inf)


@dataclass
class _Sample:
    """A segmentation: its edges, the token of each, its perturbed score and those of the subtrees that leave it."""

    edges: np.ndarray
    tokens: np.ndarray
    logs: np.ndarray
    value: float
    bounds: np.ndarray | None = None


def sample_texts(vocabulary: Vocabulary, texts: list[str | None], keys: list[int | None], k: int = SAMPLES) -> tuple[list[list[tuple[float, float, float]]], np.ndarray, np.ndarray]:
    """Per text up to k distinct segmentations, best perturbed score first.

    Returns (per text: (log probability, score, log inclusion) of each), the ids of all of them, and their ends.

    A search over the tree of partial segmentations: a node's score is the largest perturbed log probability below
    it, so the next node to open is the one of highest score, and opening it draws one segmentation and leaves the
    subtrees that branch off its path, each with a Gumbel value bounded by the node's. The score of the (k+1)th node
    is the threshold of the inclusion score log(1 - exp(-exp(log probability - threshold))). Everything drawn depends
    on the text, its key and k alone. Fewer than k segmentations exist for short texts; the threshold is then minus
    infinity and the inclusion score 0.
    """
    lattice = Lattice(vocabulary, [normalise(t) for t in texts])
    n_docs, n_tokens = len(texts), len(lattice.kind)
    seeds = mix64(np.array([key if key is not None else -1 for key in keys], dtype=np.int64).view(np.uint64) + np.uint64(0x1234567))
    first = np.append(lattice.first_token, n_tokens)
    local = np.arange(n_tokens) - first[lattice.doc_of] if n_tokens else np.zeros(0, np.int64)

    def token_seeds(tokens: np.ndarray, turn: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64(seeds[lattice.doc_of[tokens]] + mix64(local[tokens].astype(np.uint64) * np.uint64(64) + np.uint64(turn)))

    everything = np.arange(n_tokens)
    token, edge = lattice.walk(everything, np.zeros(n_tokens, np.int64), token_seeds(everything, 0))
    cut = np.searchsorted(token, first)
    noise = [random.Random(int(s)) for s in seeds.tolist()]
    values = np.array([-math.log(-math.log(r.random() or 0.5)) for r in noise])
    logs, bounds = _branches(lattice, edge, cut, np.zeros(n_docs, np.int64), values, mix64(seeds + np.uint64(1)))
    found: list[list[_Sample]] = []
    for d in range(n_docs):
        s = slice(cut[d], cut[d + 1])
        found.append([_Sample(edge[s], token[s], logs[s], float(values[d]), bounds[s])])
    taken: list[dict[tuple[int, int], set[int]]] = [{} for _ in range(n_docs)]
    threshold = [float("-inf")] * n_docs
    for turn in range(1, k + 1):
        opened = []
        for d in range(n_docs):
            if len(found[d]) < turn:
                continue
            j = max(range(turn), key=lambda j: found[d][j].bounds.max(initial=-np.inf))
            bounds = found[d][j].bounds
            i = int(bounds.argmax()) if len(bounds) else 0
            if not len(bounds) or np.isneginf(bounds[i]):
                continue
            if turn == k:
                threshold[d] = float(bounds[i])
            else:
                opened.append((d, j, i))
        if turn == k or not opened:
            break
        walks, forced = [], []
        for d, j, i in opened:
            path = found[d][j]
            used = taken[d].setdefault((j, i), {int(path.edges[i])})
            choice, log = lattice.other(int(path.edges[i]), used, noise[d].random())
            used.add(choice)
            t = int(path.tokens[i])
            forced.append((choice, log))
            walks.append((t, int(first[d + 1]), lattice.done(choice, t)))
        width = np.array([end - t for t, end, _ in walks])
        heads = np.cumsum(width) - width
        tokens = np.repeat(np.array([t for t, _, _ in walks]) - heads, width) + np.arange(width.sum())
        at = np.zeros(len(tokens), dtype=np.int64)
        at[heads] = [a for _, _, a in walks]
        token, edge = lattice.walk(tokens, at, token_seeds(tokens, turn))
        parts, owners, values = [], [], np.empty(len(opened))
        for n, ((d, j, i), (t, end, _), (choice, _)) in enumerate(zip(opened, walks, forced, strict=True)):
            s = slice(*np.searchsorted(token, (t, end)))
            path = found[d][j]
            parts.append(np.concatenate([path.edges[:i], [choice], edge[s]]))
            owners.append(np.concatenate([path.tokens[: i + 1], token[s]]))
            values[n] = path.bounds[i]
        cuts = np.cumsum([0, *map(len, parts)])
        own = np.array([d for d, _, _ in opened])
        logs, bounds = _branches(lattice, np.concatenate(parts), cuts, np.array([i + 1 for _, _, i in opened]), values, mix64(seeds[own] + np.uint64(turn + 1)))
        for n, (d, j, i) in enumerate(opened):
            s, path = slice(cuts[n], cuts[n + 1]), found[d][j]
            found[d].append(_Sample(parts[n], owners[n], logs[s], float(values[n]), bounds[s]))
            left = 1.0 - float(lattice.chance[list(taken[d][(j, i)])].sum())
            place = path.logs[:i].sum() + (math.log(left) if left > 1e-12 else -np.inf)
            path.bounds[i] = _gumbel_below(np.array([place]), values[n], np.array([noise[d].random() or 0.5]))[0]
    out = []
    for d in range(n_docs):
        rows = []
        for s in found[d]:
            log = float(s.logs.sum())
            above = log - threshold[d]
            inclusion = 0.0 if above > 30 else above if above < -30 else math.log(-math.expm1(-math.exp(above)))
            rows.append((log, s.value, inclusion))
        out.append(rows)
    paths = [s.edges for samples in found for s in samples]
    ids, ends = lattice.piece_ids(np.concatenate(paths) if paths else np.zeros(0, np.int64), np.cumsum([0, *map(len, paths)]))
    return out, ids, ends


def _branches(lattice: Lattice, edges: np.ndarray, cut: np.ndarray, begin: np.ndarray, values: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log probabilities, perturbed maxima of the subtrees that leave each path at each step from its `begin` on).

    Paths lie one after another, path k at cut[k]:cut[k + 1]. Steps whose subtree has e**-45 of the mass of the
    path's best one are left out: they lie below the precision of the sums.
    """
    chance = lattice.chance[edges]
    logs = np.log(np.maximum(chance, 1e-300))
    bounds = np.full(len(edges), -np.inf)
    width = np.diff(cut)
    if not len(edges):
        return logs, bounds
    before = np.cumsum(logs) - logs
    path = np.repeat(np.arange(len(width)), width)
    step = np.arange(len(edges)) - cut[:-1][path]
    full = width > 0
    base = np.zeros(len(width))
    base[full] = before[cut[:-1][full]]
    place = before - base[path] + _log_rest(chance)
    place[step < begin[path]] = -np.inf
    best = np.full(len(width), -np.inf)
    best[full] = np.maximum.reduceat(place, cut[:-1][full])
    near = np.flatnonzero((place >= best[path] - 45) & ~np.isneginf(place))
    with np.errstate(over="ignore"):
        u = uniform(mix64(seeds[path[near]] + step[near].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)))
    bounds[near] = _gumbel_below(place[near], values[path[near]], u)
    return logs, bounds


def sample_segmentations(docs: DataFrame, k: int = SAMPLES, path: str = MODEL, temperature: float = 1.0) -> DataFrame:
    """Rows (doc_id, sample, n_pieces, log_prob, perturbed, log_inclusion, round_trip, ids), up to k per row of docs.

    The vocabulary (a fixed file) is read once on the driver and broadcast. round_trip tells whether decoding the ids
    gives the text again; a text with the space mark itself decodes to a space there. A null or empty text has one
    empty segmentation. Repeated rows give repeated results, since the seed is the row key.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path, temperature))
    names = ["doc_id", "sample", "n_pieces", "log_prob", "perturbed", "log_inclusion", "round_trip", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.bool_(), pa.list_(pa.int32())]

    def emit(v: Vocabulary, keys: list[int], texts: list[str | None]) -> pa.RecordBatch:
        scores, ids, ends = sample_texts(v, texts, keys, k)
        owner = [d for d, got in enumerate(scores) for _ in got]
        good = round_trips(v, texts, owner, ids, ends)
        rows = []
        for key, got in zip(keys, scores, strict=True):
            for n, (log, score, inclusion) in enumerate(got):
                lo, hi = ends[len(rows)], ends[len(rows) + 1]
                rows.append((key, n, hi - lo, log, score, inclusion, good[len(rows)]))
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
        return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=False)), lists], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for b in batches:
            keys, texts, size = [], [], 0
            for key, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                keys.append(key)
                texts.append(text)
                size += len(text or "")
                if size >= SLICE:
                    yield emit(v, keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield emit(v, keys, texts)

    schema = "doc_id long, sample int, n_pieces int, log_prob double, perturbed double, log_inclusion double, round_trip boolean, ids array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
