"""Phrase collocations per language: best-first branch-and-bound growth of phrases word by word.

A phrase of 2 to 4 words scores floor(2,000,000 * a / (l + r)) at its worst cut, where a, l and r count the phrase, the
part before the cut and the part behind it. The table of the ``top`` best phrases of a language needs no count of
most longer phrases: a is at most the count of any part, and l + r is at least l + a. So the counts of the parts
known so far bound the score of everything that grows from them, and none of it is counted while the bound is under a
language's cutoff.

* Frontier: words, then all pairs of frequent words are counted exactly. The score of the pair that
  is ``2 * top``-th in its language is the first cutoff.
* Growth: of three words, then four, those are counted whose bound reaches the cutoff, that may be
  the beginning or the end of a longer phrase whose bound does, or that extend a phrase whose score
  does (those decide whether it survives). All phrases that reach the cutoff are then known
  with exact counts, and so is whatever can drop them.
* Settled: a language with ``top`` surviving phrases at or above its cutoff is done, ties included,
  since all others score less. The others go on with the score of a pair further down, at last
  with 0, which counts everything frequent.

A pass reads the texts once. Tasks count in stretches of bounded size, over numbers that stand for
words exactly, and pass (phrase, count) on to a map-side combined sum. The bounds
travel to the tasks in tables of 2^20 places whatever the corpus: a phrase's place holds
the largest and the smallest count of all phrases that fall on it. Sharing a place loosens bounds; it never drops
a phrase. Scores are exact decimals. Per language only a cutoff is collected.

Defined cases: a null text is empty; a null language is ``und``; texts without words and languages
without frequent phrases have no rows; repeated rows count again; an empty table gives an empty result;
a text longer than a stretch is read in several, cut where a piece ends. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from tagloom.llm.words import Words, mixed, signed
from tagloom.operators.staging import scratch, stage

LEAST = 30  # occurrences of a candidate
LONGEST = 4  # words of a candidate
TOP = 2000
WIDER = 4  # how much further down the pairs the next cutoff is taken
UNIT = 2_000_000
UNKNOWN = "und"
STRETCH_BYTES = 1 << 20
BATCH_ROWS = 20_000  # that a task hands on at a time
PLACES = 1 << 20  # of a table of bounds

_KIND = np.zeros(256, dtype=np.uint8)  # 1 parts words, 2 parts pieces
_KIND[[9, 32]] = 1
_KIND[[*map(ord, ".,;:!?"), *range(10, 14)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_COUNTS = "lang string, phrase string, place long, rows long"


# ---- words of texts ---------------------------------------------------------------

def _stretches(texts: pa.Array, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, text offsets, index of the first text); texts beyond the size are cut where a piece ends."""
    texts = texts.cast(pa.large_string())
    texts = texts.fill_null("") if texts.null_count else texts
    _, places, body = texts.buffers()
    if not len(texts) or body is None:
        return
    offsets = np.frombuffer(places, dtype=np.int64)[texts.offset: texts.offset + len(texts) + 1]
    data = np.frombuffer(body, dtype=np.uint8)
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = end
        if at + size < end:
            whole = int(offsets[np.searchsorted(offsets, at + size, side="right") - 1])
            stop = whole if whole > at else _piece_end(data, at + size, int(offsets[np.searchsorted(offsets, at, side="right")]), size)
        first = int(np.searchsorted(offsets, at, side="right")) - 1
        inside = offsets[first + 1: int(np.searchsorted(offsets, stop, side="left"))]
        yield data[at:stop], np.concatenate([[at], inside, [stop]]) - at, first
        at = stop


def _piece_end(data: np.ndarray, at: int, end: int, size: int) -> int:
    while at < end:
        found = np.flatnonzero(_KIND[data[at: min(end, at + size)]] == 2)
        if len(found):
            return at + int(found[0])
        at += size
    return end


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each key, first place and count of each number."""
    coded = pa.array(keys).dictionary_encode()
    number = coded.indices.to_numpy()
    first = np.empty(len(coded.dictionary), dtype=np.int64)
    first[number[::-1]] = np.arange(len(keys))[::-1]
    return number, first, np.bincount(number, minlength=len(first))


class Occurrences:
    """The words of a stretch: language, exact number, hash and piece of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray, language_hash: np.ndarray):
        kind = _KIND[data]
        solid = kind == 0
        begins = np.zeros(len(data) + 1, dtype=bool)
        begins[offsets] = True
        start = solid & ~np.r_[False, solid[:-1]] | solid & begins[:-1]
        stop = solid & ~np.r_[solid[1:], False] | solid & begins[1:]
        starts, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
        lengths = np.concatenate([[0], np.cumsum(ends - starts)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(_LOWER[data[solid]])])
        coded = words.dictionary_encode()
        self.words = coded.dictionary
        text = np.searchsorted(offsets, starts, side="right") - 1
        self.piece = np.cumsum(kind == 2)[starts] + text
        self.language = languages[text]
        self.word = coded.indices.to_numpy().astype(np.int64)
        _, places, body = self.words.buffers()
        hashes = Words(np.frombuffer(body, dtype=np.uint8), np.frombuffer(places, dtype=np.int64)[: len(self.words) + 1]).hashes() if len(self.words) else np.zeros(0, dtype=np.uint64)
        self.hash = [mixed(hashes[self.word] ^ language_hash[self.language])]  # one array per number of words

    def __len__(self) -> int:
        return len(self.word)

    def hashes(self, n: int) -> np.ndarray:
        """Hash of the n words from each place on."""
        while len(self.hash) < n:
            h, k = self.hash[-1], len(self.hash)
            self.hash.append(mixed(h[:-1] * _BASE + self.hash[0][k:]))
        return self.hash[n - 1]

    def runs(self, n: int) -> np.ndarray:
        """Places from which n words lie within one piece."""
        if len(self) < n:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.piece[: len(self) - n + 1] == self.piece[n - 1:])

    def counted(self, at: np.ndarray, n: int, names: pa.Array, table: int) -> pa.RecordBatch:
        """The different phrases of n words from the places ``at`` on, with their counts."""
        number, most = self.language[at].astype(np.int64), len(self.words)
        for k in range(n):
            number, first, rows = _distinct(number * most + self.word[at + k])
        places = at[first]
        parts = [self.words.take(pa.array(self.word[places + k])).cast(pa.large_string()) for k in range(n)]
        phrase = parts[0] if n == 1 else pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
        place = signed(self.hashes(n)[places]) & (table - 1)
        return pa.RecordBatch.from_arrays([names.take(pa.array(self.language[places])), phrase.cast(pa.string()), pa.array(place), pa.array(rows.astype(np.int64))], ["lang", "phrase", "place", "rows"])


# ---- bounds -----------------------------------------------------------------------

@dataclass(frozen=True)
class Bounds:
    """Per place: the largest and the smallest count of the frequent phrases there (0: none), rounded
    outwards to 32 bits, and whether the score of one reaches its cutoff."""

    most: np.ndarray
    least: np.ndarray
    live: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame, table: int, live: str = "false") -> Bounds:
        """``counts`` (place, rows); at most ``table`` rows are collected."""
        rows = counts.groupBy("place").agg(F.max("rows").alias("most"), F.min("rows").alias("least"), F.max(F.expr(f"coalesce({live}, false)")).alias("live")).toArrow()
        places = np.asarray(rows["place"])
        most, least, alive = np.zeros(table, dtype=np.float32), np.zeros(table, dtype=np.float32), np.zeros(table, dtype=bool)
        most[places] = np.nextafter(np.asarray(rows["most"]).astype(np.float32), np.float32(np.inf))
        least[places] = np.nextafter(np.asarray(rows["least"]).astype(np.float32), np.float32(0))
        alive[places] = np.asarray(rows["live"])
        return cls(most, least, alive)

    def at(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        place = (hashes & np.uint64(len(self.most) - 1)).astype(np.int64)
        return self.most[place].astype(np.float64), self.least[place].astype(np.float64), self.live[place]


def _reaches(a: np.ndarray, whole: np.ndarray, cutoff: np.ndarray) -> np.ndarray:
    """Whether a phrase counted at most a times can reach the cutoff at a cut whose parts are counted
    at least ``whole`` times together. The factor outweighs the rounding of floats."""
    return UNIT * (1 + 1e-9) * a >= cutoff * whole


def _worth(words: Occurrences, at: np.ndarray, n: int, bounds: list[Bounds], cutoff: np.ndarray) -> np.ndarray:
    """Those places from which a run of n words must be counted."""
    def look(size: int, first: int):
        return bounds[size - 1].at(words.hashes(size)[at + first])
    begin, begin_least, begin_live = look(n - 1, 0)
    end, end_least, end_live = look(n - 1, 1)
    both = (begin > 0) & (end > 0)
    a = np.minimum(begin, end)
    if n == 2:
        return at[both]
    own = both.copy()
    for k in range(1, n):  # the score of the phrase itself
        own &= _reaches(a, look(k, 0)[1] + look(n - k, k)[1], cutoff)
    wanted = own | (begin_live & (begin > 0)) | (end_live & (end > 0))
    if n < LONGEST:
        # as the beginning or the end of a longer phrase: its other part counts at least what it counts
        grows, closes = both.copy(), both.copy()
        for k in range(1, n):
            grows &= _reaches(a, look(k, 0)[1] + a, cutoff)
            closes &= _reaches(a, look(k, n - k)[1] + a, cutoff)
        wanted |= grows | closes
    return at[wanted]


def _count(batches: Iterator[pa.RecordBatch], n: int, bounds: list[Bounds], cutoffs: dict[str, int], table: int, stretch: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        coded = batch.column("lang").dictionary_encode()
        names, languages = coded.dictionary, coded.indices.to_numpy()
        hashes = mixed(np.array([crc32(name.encode()) for name in names.to_pylist()], dtype=np.uint64))
        cutoff = np.array([cutoffs.get(name, 0) for name in names.to_pylist()], dtype=np.float64)
        for data, offsets, first in _stretches(batch.column("text"), stretch):
            words = Occurrences(data, offsets, languages[first: first + len(offsets) - 1], hashes)
            at = words.runs(n)
            if n > 1 and len(at):
                at = _worth(words, at, n, bounds, cutoff[words.language[at]])
            if len(at):
                found = words.counted(at, n, names, table)
                for row in range(0, len(found), BATCH_ROWS):
                    yield found.slice(row, BATCH_ROWS)


# ---- growth -----------------------------------------------------------------------

class _Corpus:
    def __init__(self, texts: DataFrame, least: int, table: int, stretch: int):
        self.texts, self.least, self.table, self.stretch, self.spark = texts, least, table, stretch, texts.sparkSession

    def counts(self, n: int, bounds: list[Bounds], cutoffs: dict[str, int], texts: DataFrame | None = None) -> DataFrame:
        """(lang, phrase, place, rows) of the runs of n words that are worth it."""
        known, table, stretch = self.spark.sparkContext.broadcast(bounds), self.table, self.stretch
        found = (self.texts if texts is None else texts).mapInArrow(lambda batches: _count(batches, n, known.value, cutoffs, table, stretch), _COUNTS)
        return found.groupBy("lang", "phrase").agg(F.max("place").alias("place"), F.sum("rows").alias("rows"))

    def frequent(self, *args, **more) -> DataFrame:
        return stage(self.counts(*args, **more).where(F.col("rows") >= self.least), "phrases")


def _scored(counts: DataFrame, n: int, shorter: DataFrame) -> DataFrame:
    """Phrases of n words with the count a and, of the worst cut, score, l and r; null where a part was
    not worth counting, whose score then is below the cutoff."""
    parts = [F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), F.substring_index("phrase", " ", k if side == 0 else k - n).alias("part"))
             for k in range(1, n) for side in (0, 1)]
    cut = counts.select("lang", F.col("phrase").alias("whole"), "place", F.col("rows").alias("a"), F.explode(F.array(*parts)).alias("c")).select("lang", "whole", "place", "a", "c.*")
    known = cut.join(shorter.select(F.col("lang"), F.col("phrase").alias("part"), "rows"), ["lang", "part"], "left")
    sides = [F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("rows"))).alias(f"{'lr'[side]}{k}") for k in range(1, n) for side in (0, 1)]
    wide = known.groupBy("lang", "whole", "place", "a").agg(*sides)
    cuts = [f"struct(({UNIT}BD * CAST(a AS DECIMAL(20,0))) div (CAST(l{k} AS DECIMAL(20,0)) + CAST(r{k} AS DECIMAL(20,0))) AS score, {k} AS k, l{k} AS l, r{k} AS r)" for k in range(1, n)]
    whole = " AND ".join(f"l{k} + r{k} IS NOT NULL" for k in range(1, n))
    worst = F.expr(f"CASE WHEN {whole} THEN array_min(array({', '.join(cuts)})) END")
    return wide.withColumn("worst", worst).select("lang", F.col("whole").alias("phrase"), "place", F.col("a").alias("rows"), "worst.score", "worst.l", "worst.r")


def _survivors(scored: DataFrame, n: int, longer: DataFrame) -> DataFrame:
    """Phrases without an extension by one word that is counted 80 % as often: a longer phrase that
    holds them is counted at most as often as such an extension."""
    ends = longer.select("lang", F.explode(F.array(F.substring_index("phrase", " ", n), F.substring_index("phrase", " ", -n))).alias("phrase"), "rows")
    most = stage(ends.groupBy("lang", "phrase").agg(F.max("rows").alias("longest")), "extensions")
    hides = F.expr("100BD * CAST(longest AS DECIMAL(20,0)) >= 80BD * CAST(rows AS DECIMAL(20,0))")
    return scored.join(most, ["lang", "phrase"], "left").where(~F.coalesce(hides, F.lit(False))).drop("longest")


def _pair_scores(pairs: DataFrame, rank: int) -> dict[str, int]:
    """The score of the pair with that rank in each language that has so many."""
    ranked = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))).where(F.col("rank") <= rank)
    return {r.lang: r.score for r in ranked.where(F.col("rank") == rank).select("lang", "score").collect()}  # a row per language


def _at_cutoff(scored: DataFrame, cutoffs: dict[str, int]) -> DataFrame:
    """The column ``live``: whether the score reaches the language's cutoff."""
    known = [item for lang, cutoff in cutoffs.items() for item in (F.lit(lang), F.lit(cutoff))]
    cutoff = F.coalesce(F.element_at(F.create_map(*known), F.col("lang")), F.lit(0)) if known else F.lit(0)
    return scored.withColumn("live", F.coalesce(F.col("score") >= cutoff, F.lit(False)))


def collocations(documents: DataFrame, top: int = TOP, least: int = LEAST, table: int = PLACES, stretch: int = STRETCH_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language of
    ``documents`` (text, lang) by score, a and phrase; n counts the language's words. ``table`` places
    (a power of two) hold the bounds; ``stretch`` bytes of text are counted at a time."""
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
    corpus = _Corpus(texts, least, table, stretch)
    with scratch(corpus.spark):
        words = stage(corpus.counts(1, [], {}), "words")
        totals = stage(words.groupBy("lang").agg(F.sum("rows").alias("n")), "totals")
        frequent = words.where(F.col("rows") >= least)
        one = Bounds.of(frequent, table)
        two_counts = corpus.frequent(2, [one], {})
        pairs = stage(_scored(two_counts, 2, frequent), "pairs")
        open_ = {r.lang for r in pairs.select("lang").distinct().collect()}  # a row per language
        rank, settled = 2 * top, []
        while open_:
            further = _pair_scores(pairs, rank)
            cutoffs = {lang: further.get(lang, 0) for lang in open_}
            found = stage(_round(corpus, open_, cutoffs, one, frequent, pairs), "candidates")
            enough = {r.lang for r in found.groupBy("lang").count().where(F.col("count") >= top).select("lang").collect()}
            done = {lang for lang in open_ if cutoffs[lang] == 0 or lang in enough}
            if done:
                settled.append(found.where(F.col("lang").isin(*done)))
            open_ -= done
            rank *= WIDER
        schema = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"
        if not settled:
            return corpus.spark.createDataFrame([], schema)
        every = settled[0]
        for more in settled[1:]:
            every = every.unionByName(more)
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("rows"), "phrase")
        ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        named = ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("rows").alias("a"), "l", "r", "n", F.col("score").cast("long").alias("score"))
        return stage(named, "collocations", kept=True)


def _round(corpus: _Corpus, languages: set[str], cutoffs: dict[str, int], one: Bounds, words: DataFrame, pairs: DataFrame) -> DataFrame:
    """All phrases of some languages that survive and reach the cutoff."""
    own = F.col("lang").isin(*languages)
    texts = corpus.texts.where(own)
    two = _at_cutoff(pairs.where(own), cutoffs)
    bounds = [one, Bounds.of(two, corpus.table, "live")]
    three_counts = corpus.frequent(3, bounds, cutoffs, texts)
    shorter = words.select("lang", "phrase", "rows").unionByName(pairs.select("lang", "phrase", "rows"))
    three = stage(_at_cutoff(_scored(three_counts, 3, shorter), cutoffs), "threes")
    four_counts = corpus.frequent(4, [*bounds, Bounds.of(three, corpus.table, "live")], cutoffs, texts)
    four = _at_cutoff(_scored(four_counts, 4, shorter.unionByName(three.select("lang", "phrase", "rows"))), cutoffs)
    parts = [_survivors(two.where("live"), 2, three_counts), _survivors(three.where("live"), 3, four_counts), four.where("live")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("lang", "phrase", "rows", "l", "r", "score")
