"""Words and word shingles of whole texts as 64-bit hashes, computed on Arrow buffers.

A word is a run of bytes other than space and \\x09-\\x0D; A-Z are lower-cased. Everything
works on one batch of texts at a time, cut into chunks of bounded size, so memory does not
grow with the table; one very long text forms a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = np.ones(1, dtype=np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        steps = np.full(max(n, 1024), _BASE, dtype=np.uint64)
        steps[0] = 1
        powers = np.multiply.accumulate(steps)
        if n > 1 << 16:
            return powers
        _POWERS = powers
    return _POWERS


class Words:
    """The words of some consecutive texts: hash, byte range and text of every word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        texts = len(offsets) - 1
        space = _SPACE[data]
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[offsets] = True
        solid = ~space
        before = np.empty(len(data), dtype=bool)
        before[:1] = False
        before[1:] = solid[:-1]
        starts = np.flatnonzero(solid & (~before | begins[:-1]))
        after = np.empty(len(data), dtype=bool)
        after[-1:] = False
        after[:-1] = solid[1:]
        self.starts, self.ends = starts, np.flatnonzero(solid & (~after | begins[1:])) + 1
        # words are counted per text by where its bytes begin and end
        self.first = np.searchsorted(starts, offsets)
        self.counts = np.diff(self.first)
        self.texts = texts
        self._solid = solid

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word, a polynomial in its lower-cased bytes."""
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        lengths = self.ends - self.starts
        at = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
        letters = _LOWER[self.data[self._solid]].astype(np.uint64) + np.uint64(1)
        summed = np.add.reduceat(letters * _powers(int(lengths.max()) + 1)[place], at)
        return mixed(summed + lengths.astype(np.uint64) * _STEP)

    def shingles(self, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the runs of k words and the number of runs per text, in text order.

        With ``short``, a text of fewer words (but not none) counts as one run.
        """
        h = self.hashes()
        runs = np.maximum(self.counts - k + 1, 0)
        if len(h) >= k:
            s = h[: len(h) - k + 1].copy()
            for j in range(1, k):
                s = s * _BASE + h[j: len(h) - k + 1 + j]
        else:
            s = np.zeros(0, dtype=np.uint64)
        place = np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs) + np.repeat(self.first[:-1], runs)
        hashes = mixed(s[place])
        if not short:
            return hashes, runs
        few = np.flatnonzero((self.counts > 0) & (self.counts < k))
        whole = np.zeros(len(few), dtype=np.uint64)
        for i, t in enumerate(few):
            for w in h[self.first[t]: self.first[t + 1]]:
                whole[i: i + 1] = whole[i: i + 1] * _BASE + w
        whole = mixed(whole + self.counts[few].astype(np.uint64) * _STEP)
        at = (np.cumsum(runs) - runs)[few]
        runs = runs.copy()
        runs[few] = 1
        return np.insert(hashes, at, whole), runs


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, Words]]:
    """(index of the first text, its words) for stretches of a column of texts; null is empty."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    _, places, body = texts.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(body, dtype=np.uint8) if body else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, side="right")) - 1)
        part = offsets[i: j + 1]
        yield i, Words(data[part[0]: part[-1]], part - part[0])
        i = j


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as a signed long, which is what Spark stores."""
    return h.view(np.int64)
