"""Language identification by segmentation-marginalised unigrams.

Every language is a unigram model over one fixed public vocabulary of pieces. The probability
of a word is the sum over all its segmentations into pieces, computed by the forward
algorithm; a text's log-likelihood is the sum over its words, and the score is the posterior
of the best language under equal priors.

Piece probabilities are learned by expectation maximisation over all segmentations, on a
sample of about ``rows_per_language`` labelled texts of each language (chosen by a hash of
the text, so it is the same on every run). That number is the only bound; every text is read
and scored whole.

Defined cases: a text that is null or has no letter gets ``und`` and score 0; ties go to the
language that sorts first; repeated rows score alike; without any labelled text every text
with a letter gets ``und`` too; other columns of the table are kept out of the result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm.pieces import LONG, MARK, Pieces, VOCABULARY, read_pieces, steps
from tagloom.operators.staging import stage

ROWS_PER_LANGUAGE = 2000
ROUNDS = 3
MAX_LANGUAGES = 1000
UNKNOWN = 1e-7  # share of a character that the vocabulary or the language does not have
SMOOTHING = 0.01  # occurrences added to every piece
CACHED_WORDS = 200_000
TEXTS_AT_ONCE = 128  # words of so many texts are scored together
BLOCK_CELLS = 80_000  # words times languages that are computed at a time
UNDETERMINED = "und"
_OWN_TEXT = "__text"  # the text's name where it is read but not kept
_LETTERS = re.compile(r"[^\W\d_]+")


def letter_runs(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def _has_letter(word: str) -> bool:
    return any(map(str.isalpha, word))


@dataclass(frozen=True)
class LanguageModel:
    """Piece shares per language: one row per piece, one column per language, and a last row
    for unknown characters. Its size is bounded by vocabulary times languages."""

    languages: tuple[str, ...]
    pieces: tuple[str, ...]
    shares: np.ndarray


def _forward(pieces: Pieces, shares: np.ndarray, words: Sequence[str]) -> np.ndarray:
    """alpha[word, characters read, language]: probability of the part that was read."""
    width = max(map(len, words))
    alpha = np.zeros((len(words), width + 1, shares.shape[1]))
    alpha[:, 0] = 1

    def visit(end, length, rows, numbers):
        alpha[rows, end] += alpha[rows, end - length] * shares[numbers]

    steps(pieces, words, visit)
    return alpha


def _blocks(items: list[int], shares: np.ndarray) -> Iterator[list[int]]:
    size = max(1, BLOCK_CELLS // max(1, shares.shape[1]))
    for b in range(0, len(items), size):
        yield items[b: b + size]


def _long_word(pieces: Pieces, shares: np.ndarray, word: str) -> np.ndarray:
    """Log-probabilities of one word of any length, rescaled at every character."""
    recent = [np.ones(shares.shape[1])]
    total = np.zeros(shares.shape[1])
    for end in range(1, len(word) + 1):
        here = np.zeros(shares.shape[1])
        for length in range(1, min(len(recent), pieces.longest) + 1):
            number = pieces.number.get(word[end - length: end], -1)
            if number >= 0 or length == 1:
                here = here + recent[-length] * shares[number]
        total += np.log(here)
        recent = [r / here for r in recent[-pieces.longest:]] + [np.ones_like(here)]
    return total


def word_scores(pieces: Pieces, shares: np.ndarray, words: Sequence[str]) -> np.ndarray:
    """Log-probability of every word in every language, all segmentations summed."""
    marked = [MARK + w for w in words]
    scores = np.empty((len(words), shares.shape[1]))
    short = [i for i, w in enumerate(marked) if len(w) <= LONG]
    short.sort(key=lambda i: len(marked[i]))
    for block in _blocks(short, shares):
        alpha = _forward(pieces, shares, [marked[i] for i in block])
        ends = np.fromiter((len(marked[i]) for i in block), dtype=np.int64, count=len(block))
        scores[block] = np.log(alpha[np.arange(len(block)), ends])
    for i, w in enumerate(marked):
        if len(w) > LONG:
            scores[i] = _long_word(pieces, shares, w)
    return scores


def expected_pieces(pieces: Pieces, shares: np.ndarray, words: Sequence[str], weights: np.ndarray) -> np.ndarray:
    """Expected occurrences of every piece over all segmentations of the words; weights[word,
    language] says how often a language has the word."""
    counts = np.zeros_like(shares)
    for i in (i for i, w in enumerate(words) if len(w) >= LONG):
        for language in np.flatnonzero(weights[i]):
            _expected_long(pieces, shares[:, language], MARK + words[i], weights[i, language], counts[:, language])
    order = sorted((i for i, w in enumerate(words) if len(w) < LONG), key=lambda i: len(words[i]))
    for block in _blocks(order, shares):
        marked = [MARK + words[i] for i in block]
        alpha = _forward(pieces, shares, marked)
        ends = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
        beta = np.zeros_like(alpha)
        beta[np.arange(len(block)), ends] = weights[block] / alpha[np.arange(len(block)), ends]
        seen: list[tuple] = []
        steps(pieces, marked, lambda *piece: seen.append(piece))
        for end, length, rows, numbers in reversed(seen):
            passed = shares[numbers] * beta[rows, end]
            np.add.at(counts, numbers, alpha[rows, end - length] * passed)
            beta[rows, end - length] += passed
    return counts


def _endings(pieces: Pieces, word: str, end: int) -> Iterator[tuple[int, int]]:
    """(length, number) of the pieces of ``word`` that end there; one unknown character is number -1."""
    for length in range(1, min(end, pieces.longest) + 1):
        number = pieces.number.get(word[end - length: end], -1)
        if number >= 0 or length == 1:
            yield length, number


def _expected_long(pieces: Pieces, shares: np.ndarray, word: str, weight: float, counts: np.ndarray) -> None:
    """``expected_pieces`` of one word of any length in one language, added to ``counts``. The forward sums are
    rescaled at every character to 1, ``grown[end]`` being the factor; going back, ``boundary[end]`` is the
    probability that a segmentation has a boundary there. Two numbers per character are kept."""
    grown = np.ones(len(word) + 1)
    for end in range(1, len(word) + 1):
        here = 0.0
        for length, number in _endings(pieces, word, end):
            here += shares[number] / np.prod(grown[end - length + 1: end])
        grown[end] = here
    boundary = np.zeros(len(word) + 1)
    boundary[-1] = weight
    for end in range(len(word), 0, -1):
        for length, number in _endings(pieces, word, end):
            times = shares[number] * boundary[end] / np.prod(grown[end - length + 1: end + 1])
            counts[number] += times
            boundary[end - length] += times


def _to_shares(counts: np.ndarray) -> np.ndarray:
    counts = counts + SMOOTHING
    shares = counts / counts.sum(axis=0)
    shares[-1] = UNKNOWN
    return shares


def train(documents: DataFrame, labelled: Column | None = None, vocabulary: str = VOCABULARY,
          rows_per_language: int = ROWS_PER_LANGUAGE, rounds: int = ROUNDS) -> LanguageModel:
    """Learns from ``text`` and ``lang`` of the rows for which ``labelled`` holds.

    Only sums per piece and language reach the driver: vocabulary times languages numbers.
    """
    spark = documents.sparkSession
    known = documents.where("lang IS NOT NULL AND text IS NOT NULL")
    known = known if labelled is None else known.where(labelled)
    rows = known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: lang does not hold language names")
    languages = tuple(r.lang for r in rows)
    vocabulary_pieces = read_pieces(vocabulary)
    if not languages:
        return LanguageModel((), vocabulary_pieces, np.zeros((len(vocabulary_pieces) + 1, 0)))
    # at most MAX_LANGUAGES rows, as checked above
    shares_kept = spark.createDataFrame([(r.lang, min(1.0, rows_per_language / r.rows)) for r in rows], "lang string, kept double")
    draw = F.xxhash64("text").bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
    sample = stage(known.select("lang", "text").join(F.broadcast(shares_kept), "lang").where(draw < F.col("kept")).select("lang", "text"), "language-sample")

    # first shares: the vocabulary's own order, by Zipf's law; the same for all languages
    zipf = 1.0 / np.arange(2, len(vocabulary_pieces) + 3)
    shares = _to_shares(np.repeat(1e6 * zipf[:, None], len(languages), axis=1))
    for _ in range(rounds):
        model = spark.sparkContext.broadcast((languages, vocabulary_pieces, shares))
        sums = sample.mapInArrow(lambda batches: _expect(batches, LanguageModel(*model.value)), "language int, piece int, times double")
        counts = np.zeros_like(shares)
        for r in sums.groupBy("language", "piece").agg(F.sum("times").alias("times")).toLocalIterator():
            counts[r.piece, r.language] = r.times
        shares = _to_shares(counts)
        model.unpersist()
    return LanguageModel(languages, vocabulary_pieces, shares)


def _expect(batches: Iterator[pa.RecordBatch], model: LanguageModel) -> Iterator[pa.RecordBatch]:
    pieces = Pieces(model.pieces)
    place = {lang: i for i, lang in enumerate(model.languages)}
    counts = np.zeros_like(model.shares)
    for batch in batches:
        words: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words.setdefault(lang, Counter()).update(letter_runs(text))
        distinct = {w: i for i, w in enumerate({w for c in words.values() for w in c})}
        weights = np.zeros((len(distinct), len(place)))
        for lang, c in words.items():
            for w, n in c.items():
                weights[distinct[w], place[lang]] = n
        if distinct:
            counts += expected_pieces(pieces, model.shares, list(distinct), weights)
    piece, language = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(language, pa.int32()), pa.array(piece, pa.int32()), pa.array(counts[piece, language])],
                                     ["language", "piece", "times"])


class _Scorer:
    """Scores of the words that were met, kept up to a bound."""

    def __init__(self, model: LanguageModel):
        self.model, self.pieces = model, Pieces(model.pieces)
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)))

    def learn(self, words: set[str]) -> None:
        if len(self.at) > CACHED_WORDS:
            self.clear()
        new = [w for w in words if w not in self.at]
        if new:
            scores = word_scores(self.pieces, self.model.shares, new)
            scores[[not _has_letter(w) for w in new]] = 0  # numerals of other scripts
            self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
            self.scores = np.concatenate([self.scores, scores])

    def best(self, words: list[str]) -> tuple[str, float]:
        if not self.model.languages or not any(map(_has_letter, words)):
            return UNDETERMINED, 0.0
        total = self.scores[np.fromiter(map(self.at.__getitem__, words), dtype=np.int64, count=len(words))].sum(axis=0)
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())


def _score(batches: Iterator[pa.RecordBatch], model: LanguageModel, text: str) -> Iterator[pa.RecordBatch]:
    scorer = _Scorer(model)
    for batch in batches:
        for i in range(0, batch.num_rows, TEXTS_AT_ONCE):
            rows = batch.slice(i, TEXTS_AT_ONCE)
            words = [letter_runs(t) if t else [] for t in rows.column(text).to_pylist()]
            if model.languages:
                scorer.learn(set().union(*words))
            found = [scorer.best(w) for w in words]
            rows = rows.drop_columns([text]) if text == _OWN_TEXT else rows
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                             [*rows.schema.names, "lang_pred", "score"])


def predict(documents: DataFrame, model: LanguageModel, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score``; only ``text`` is looked at."""
    shared = documents.sparkSession.sparkContext.broadcast((model.languages, model.pieces, model.shares))  # plain values: broadcasts carry no code
    # a text that is kept travels once
    text = "text" if "text" in keep else _OWN_TEXT
    rows = documents.select(*keep) if text in keep else documents.select(*keep, F.col("text").alias(text))
    schema = documents.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(lambda batches: _score(batches, LanguageModel(*shared.value), text), schema)
