"""Hashes of words and word n-grams of whole texts, over numpy buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from .common import mix64

#: Bytes hashed at once; one longer text is a buffer of its own.
BUFFER = 1 << 19
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.ones(1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            while len(out) < n:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
        if n > 4 * BUFFER:
            return out
        _powers[base] = have = out
    return have


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, document, line) of each word of the texts, A-Z lower-cased; lines count over all texts."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    starts = np.cumsum([1, *(len(p) + 1 for p in parts)])[:-1] if parts else np.zeros(0, np.int64)
    data = np.frombuffer(b"\n" + b"\n".join(parts).translate(_LOWER) + b"\n", dtype=np.uint8)
    inside = _IS_WORD[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    begin, end = edge[::2], edge[1::2]
    with np.errstate(over="ignore"):
        total = np.cumsum(_BYTE[data] * _power(_BASE, len(data))[: len(data)], dtype=np.uint64)
        raw = (total[end - 1] - total[begin - 1]) * _power(_INVERSE, len(data))[begin]
        hashes = mix64(raw + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    doc = np.searchsorted(starts, begin, side="right") - 1
    return hashes, doc, np.cumsum(data == 0x0A)[begin]


def buffers(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about BUFFER characters: (index of the first, texts)."""
    run: list[str] = []
    size, first = 0, 0
    for k, t in enumerate(texts):
        run.append(t or "")
        size += len(run[-1])
        if size >= BUFFER:
            yield first, run
            run, size, first = [], 0, k + 1
    if run:
        yield first, run


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words."""
    if len(words) < n:
        return words[:0]
    with np.errstate(over="ignore"):
        out = words[: len(words) - n + 1].copy()
        for k in range(1, n):
            out = mix64(out * np.uint64(0xA0761D6478BD642F) + words[k : len(words) - n + 1 + k])
    return out


def shingle_sets(texts: list[str | None], n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(index, sorted distinct hashes of n-word shingles) of each text.

    A text of fewer than n words has its whole sequence as one shingle; one without words (or null) has none.
    """
    for first, run in buffers(texts):
        words, doc, _ = word_hashes(run)
        grams = ngram_hashes(words, n)
        cut = np.searchsorted(doc, np.arange(len(run) + 1))
        for k in range(len(run)):
            lo, hi = cut[k], cut[k + 1]
            if hi - lo >= n:
                yield first + k, np.unique(grams[lo : hi - n + 1])
            elif hi > lo:
                yield first + k, mix64(ngram_hashes(words[lo:hi], int(hi - lo)) + np.uint64(hi - lo))
            else:
                yield first + k, words[:0]
