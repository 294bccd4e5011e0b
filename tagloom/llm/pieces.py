"""A fixed public vocabulary of text pieces, and dynamic programs over all words of a batch at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands before the first letter of a word, as in the vocabulary's own pieces
LONG = 40  # words of more characters are scored one by one
_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=4)
def read_pieces(path: str = VOCABULARY) -> tuple[str, ...]:
    """The vocabulary's ordinary pieces, most frequent first. Read by the driver only."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return tuple(model.id_to_piece(i) for i in range(model.get_piece_size()) if not any(f(i) for f in special))


def codes_of(words: Sequence[str], width: int) -> np.ndarray:
    """Code points plus one, padded with zeros."""
    padded = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)
    return padded.astype(np.uint64) + (padded > 0)


class Pieces:
    """Looks up pieces by the hash of their code points; unknown pieces are number -1."""

    def __init__(self, pieces: Sequence[str]):
        self.number = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        codes = codes_of(list(pieces) or [""], self.longest)
        h = np.zeros(len(codes), dtype=np.uint64)
        for j in range(self.longest):
            h = np.where(codes[:, j] > 0, h * _BASE + codes[:, j], h)
        self.order = np.argsort(h, kind="stable")
        self.sorted = h[self.order]

    def of(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.sorted, hashes), len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1)


def steps(pieces: Pieces, words: Sequence[str], visit: Callable[[int, int, np.ndarray, np.ndarray], None],
          wanted: np.ndarray | None = None) -> None:
    """Calls visit(end, length, rows, piece numbers) for every piece of every word, ends ascending.

    Words hold at most LONG characters, mark included. A single unknown character is visited
    as number -1; longer unknown stretches are no pieces. With ``wanted[word, end]`` only those
    ends are visited.
    """
    width = max(map(len, words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    codes = codes_of(words, width)
    hashes: dict[int, np.ndarray] = {}  # by length: hash of the stretch that ends here
    for end in range(1, width + 1):
        rows = np.flatnonzero(lengths >= end if wanted is None else (lengths >= end) & wanted[:, end])
        for length in range(min(end, pieces.longest), 0, -1):
            shorter = hashes.get(length - 1)  # of the stretch that ended one character before
            hashes[length] = codes[:, end - 1].copy() if length == 1 else shorter * _BASE + codes[:, end - 1]
            found = pieces.of(hashes[length][rows])
            if length == 1:
                visit(end, 1, rows, found)
            elif (known := found >= 0).any():
                visit(end, length, rows[known], found[known])
