"""Token counts of texts under a unigram model, by a trie over their distinct pre-tokens.

The pre-tokens of many texts (runs between white space, with the mark that stands before a
word) are put into one trie. A node is a prefix: its best score over all segmentations into
pieces of the vocabulary is computed once, from its ancestors, for all words that share it, and
the number of tokens of the best segmentation is stored at the terminals. A text's count is the
sum over its pre-tokens.

Piece scores are the log-shares that Zipf's law gives to the vocabulary's own order. A character
that the vocabulary lacks counts as its UTF-8 bytes. Equal scores prefer fewer tokens.

Defined cases: a null text has null counts, an empty one 0; every text is read whole, whatever
its length; repeated rows count alike; other columns stay out of the way.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagloom.llm.pieces import LONG, MARK, Pieces, VOCABULARY, codes_of, read_pieces, steps

BYTE_SCORE = -20.0  # of one byte of an unknown character
CACHED_WORDS = 400_000
TEXTS_AT_ONCE = 128
BLOCK_WORDS = 20_000


def piece_scores(pieces: Sequence[str]) -> np.ndarray:
    shares = 1.0 / np.arange(2, len(pieces) + 2)
    return np.log(shares / shares.sum()) if len(pieces) else np.zeros(0)


def utf8_bytes(points: np.ndarray) -> np.ndarray:
    return 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)


class Trie:
    """Prefixes of sorted words as flat arrays: node[i, d] is the first word that shares the
    first d characters of word i, and stands for that prefix."""

    def __init__(self, words: Sequence[str]):
        self.words = sorted(words)
        width = max(map(len, self.words))
        self.codes = codes_of(self.words, width)
        differs = np.ones((len(self.words), width + 1), dtype=bool)
        differs[1:, 0] = False
        if len(self.words) > 1:
            differs[1:, 1:] = np.logical_or.accumulate(self.codes[1:] != self.codes[:-1], axis=1)
        self.new = differs
        self.node = np.maximum.accumulate(np.where(differs, np.arange(len(self.words))[:, None], 0), axis=0)


def trie_counts(pieces: Pieces, scores: np.ndarray, words: Sequence[str]) -> dict[str, int]:
    """Tokens of every word of at most LONG characters, mark included."""
    trie = Trie(words)
    shape = trie.node.shape
    best = np.full(shape, -np.inf)
    count = np.zeros(shape, dtype=np.int32)
    best[:, 0] = 0

    def visit(end, length, rows, numbers):
        before = trie.node[rows, end - length]
        bytes_ = utf8_bytes(trie.codes[rows, end - 1] - 1)
        known = numbers >= 0
        score = best[before, end - length] + np.where(known, scores[numbers], BYTE_SCORE * bytes_)
        tokens = count[before, end - length] + np.where(known, 1, bytes_)
        better = (score > best[rows, end]) | ((score == best[rows, end]) & (tokens < count[rows, end]))
        best[rows[better], end] = score[better]
        count[rows[better], end] = tokens[better]

    steps(pieces, trie.words, visit, trie.new)
    ends = np.fromiter(map(len, trie.words), dtype=np.int64, count=len(trie.words))
    terminal = trie.node[np.arange(len(ends)), ends]
    return dict(zip(trie.words, count[terminal, ends].tolist()))


def word_count(pieces: Pieces, scores: np.ndarray, word: str) -> int:
    """Tokens of one word of any length."""
    best, count = [0.0], [0]
    for end in range(1, len(word) + 1):
        here, tokens = -np.inf, 0
        for length in range(1, min(end, pieces.longest) + 1):
            number = pieces.number.get(word[end - length: end], -1)
            if number < 0 and length > 1:
                continue
            size = 1 if number >= 0 else len(word[end - 1].encode("utf-8", "surrogatepass"))
            score = best[end - length] + (scores[number] if number >= 0 else BYTE_SCORE * size)
            if score > here or (score == here and count[end - length] + size < tokens):
                here, tokens = score, count[end - length] + size
        best.append(here)
        count.append(tokens)
    return count[-1]


def _count(batches: Iterator[pa.RecordBatch], vocabulary: tuple[str, ...], text: str) -> Iterator[pa.RecordBatch]:
    pieces, scores = Pieces(vocabulary), piece_scores(vocabulary)
    known: dict[str, int] = {}
    for batch in batches:
        for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
            rows = batch.slice(i, TEXTS_AT_ONCE)
            words = [None if t is None else t.split() for t in rows.column(text).to_pylist()]
            if len(known) > CACHED_WORDS:
                known.clear()
            fresh = [w for w in set().union(*(w for w in words if w)) if w not in known]
            short = sorted((MARK + w for w in fresh if len(w) < LONG), key=len)
            for b in range(0, len(short), BLOCK_WORDS):
                known.update((w[1:], n) for w, n in trie_counts(pieces, scores, short[b: b + BLOCK_WORDS]).items())
            known.update((w, word_count(pieces, scores, MARK + w)) for w in fresh if len(w) >= LONG)
            tokens = [None if w is None else sum(map(known.__getitem__, w)) for w in words]
            rows = rows.drop_columns([text])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([None if w is None else len(w) for w in words], pa.int64()), pa.array(tokens, pa.int64())],
                                             [*rows.schema.names, "n_pretokens", "n_tokens"])


def count_tokens(documents: DataFrame, keep: Sequence[str] = ("doc_id",), vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` with ``n_pretokens`` and ``n_tokens`` of ``text``."""
    shared = documents.sparkSession.sparkContext.broadcast(read_pieces(vocabulary))
    rows = documents.select(*keep, F.col("text").alias("__text"))
    schema = documents.select(*keep, F.lit(None).cast("long").alias("n_pretokens"), F.lit(None).cast("long").alias("n_tokens")).schema
    return rows.mapInArrow(lambda batches: _count(batches, shared.value, "__text"), schema)
