"""Near-duplicate passages by compact windows.

Every run of ``SHINGLE`` words of a text is a token. Under each of several hash functions, the
tokens of a text form a Cartesian tree by hash: a node covers the stretch in which it is the
least, so all subsequences in that stretch that hold the node share its min-hash. Only nodes
whose stretch is as long as a passage matter. These compact windows (hash, text, stretch) meet
windows of other texts with the same min-hash; where enough hash functions agree on intersecting
stretches, the two passages are verified word by word.

Each hash is compared with its first holder, the keeper (smallest id), so a passage that a third
of all texts share costs its occurrences and not their square. A passage begins and ends with an
equal word and is a maximal stretch of equal runs of words with small gaps, of at least ``WORDS``
words and 5-word similarity of at least ``SIMILARITY``; the later text's copy is the duplicate.
Stretches of at least ``SHINGLE`` equal words are chained from a seed in both directions, and each
chain is searched for its maximal parts that are passages.

What the first holders leave open (a key with more holders, in no passage found) is compared by
equal runs of ``WORDS`` and of half as many words, each with its own first holder. So an equal
passage is found whoever else holds parts of it.

Limits of the method: a passage that only resembles its duplicates is found when enough of its
min-hashes agree (over 0.97 of cases at the least similarity) with their first holder or, where
there are more holders, when one of its equal runs of half of ``WORDS`` has no earlier holder. Runs
inside a passage that occur twice count once for its similarity; where that leaves too little, the
passage is trimmed from its weaker end and a longer part may be missed.

Defined cases: null and short texts have no passages; repeats inside one text are left alone;
rows with a null id take no part; equal rows are one text; rows that share an id but not the
text are texts of their own, ordered by a hash; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tagloom.llm.words import Words, mixed, signed, text_chunks
from tagloom.operators.staging import discard, stage

SHINGLE = 5
WORDS = 50
SIMILARITY = 0.8
HASHES = 4
AGREEING = 2
KEPT_WORDS = 1 << 21  # words of texts whose hashes a task keeps
RUN_ROWS = 200_000  # long runs that a task hands on at a time, about
CROWDED = 600  # a key with one in so many rows of a batch is dealt with apart
KEY_ROWS = 1 << 16  # rows of one key that a task keeps
_FEW = 48  # equal runs that are compared one by one
_GROW = np.uint64(0x9E3779B97F4A7C15)
_SHRINK = np.uint64(pow(int(_GROW), -1, 1 << 64))
GAP = 12  # words that a passage may differ by in one place
ROWS = "doc_id long, part long, first_word int, last_word int, keeper_id long, keeper_part long, keeper_first int, keeper_last int, similarity double"


def _sliding(values: np.ndarray, width: int, least) -> np.ndarray:
    """Least (or greatest) of every stretch of ``width`` values, by doubling."""
    have, out = 1, values
    while have * 2 <= width:
        out = least(out[:-have], out[have:])
        have *= 2
    return out if have == width else least(out[: len(values) - width + 1], out[width - have:][: len(values) - width + 1])


def _smaller_before(h: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each, within its text; else -1. Every step jumps
    over what is known to be larger, as a Cartesian tree is built."""
    at = np.arange(len(h)) - 1
    while True:
        ok = at >= 0
        ok[ok] = text[at[ok]] == text[ok]
        at[~ok] = -1
        step = ok.copy()
        step[ok] = h[at[ok]] >= h[ok]
        if not step.any():
            return at
        at[step] = at[at[step]]


def compact_windows(words: Words, least_runs: int, hashes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per hash function: (key, text, place, first, last) of the windows that hold at least
    ``least_runs`` tokens; places count tokens from the text's start."""
    tokens, runs = words.shingles(SHINGLE, short=False)
    if len(tokens) < least_runs:
        return
    text = np.repeat(np.arange(len(runs)), runs)
    begin = np.repeat(np.cumsum(runs) - runs, runs)
    whole = text[: len(tokens) - least_runs + 1] == text[least_runs - 1:]
    for f in range(hashes):
        h = mixed(tokens ^ np.uint64(0x9E3779B97F4A7C15 * (f + 1) % (1 << 64))) | np.uint64(1)
        low = np.where(whole, _sliding(h, least_runs, np.minimum), np.uint64(0))
        # a token is the least of some stretch when the greatest of its stretches' minima is its own
        padded = np.concatenate([np.zeros(least_runs - 1, dtype=np.uint64), low, np.zeros(least_runs - 1, dtype=np.uint64)])
        node = np.flatnonzero(_sliding(padded, least_runs, np.maximum)[: len(h)] == h)
        before = _smaller_before(h[node], text[node])
        after = len(node) - 1 - _smaller_before(h[node][::-1], text[node][::-1])[::-1]
        last = begin[node] + runs[text[node]] - 1
        first = np.where(before >= 0, node[before] + 1, begin[node])
        final = np.where(after < len(node), node[np.minimum(after, len(node) - 1)] - 1, last)
        yield mixed(h[node] + np.uint64(f)), text[node], node - begin[node], first - begin[node], final - begin[node]


def _windows(batches: Iterator[pa.RecordBatch], hashes: int, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, parts = np.asarray(batch.column(0)), np.asarray(batch.column(1))
        for at, words in text_chunks(batch.column(2)):
            for f, (key, text, place, first, last) in enumerate(compact_windows(words, least, hashes)):
                columns = [pa.array(signed(key)), pa.array(ids[at + text]), pa.array(parts[at + text]), *(pa.array(c.astype(np.int32)) for c in (place, place - first, last - place)), pa.array(np.full(len(key), f, dtype=np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "part", "place", "before", "after", "f"])


def _walk(x: np.ndarray, y: np.ndarray, xs: list, ys: list, p: int, q: int) -> Iterator[tuple[int, int, int]]:
    """(start, other start, length) of equal stretches of runs from (p, q) on, each the nearest
    that begins within ``GAP`` words of the one before in both texts. ``xs`` and ``ys`` are the runs as
    lists: most stretches are too short for arrays."""
    reach = GAP + SHINGLE
    while True:
        most, n, width = min(len(xs) - p, len(ys) - q), 0, 64
        few = min(most, _FEW)
        while n < few and xs[p + n] == ys[q + n]:
            n += 1
        while _FEW <= n < most:
            differ = np.flatnonzero(x[p + n: p + min(n + width, most)] != y[q + n: q + min(n + width, most)])
            if len(differ):
                n += int(differ[0])
                break
            n, width = min(n + width, most), 2 * width
        if not n:
            return
        yield p, q, n
        p, q = p + n, q + n
        ahead = ys[q: q + reach]
        nearest = dict(zip(reversed(ahead), range(len(ahead) - 1, -1, -1)))
        met = [(i + j, abs(i - j), i, j) for i, run in enumerate(xs[p: p + reach]) if (j := nearest.get(run)) is not None]
        if not met:
            return
        _, _, i, j = min(met)
        p, q = p + i, q + j


def _passages(own: np.ndarray, other: np.ndarray, seeds: np.ndarray, least: int, similarity: float, runs: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple]:
    """(first, last, other first, other last, similarity) of verified passages around seeds
    (place, other place), word places from 0; ``last`` is included. ``runs`` of both texts may be known."""
    if len(own) >= least and np.array_equal(own, other):
        return [(0, len(own) - 1, 0, len(own) - 1, 1.0)]
    x, y = runs or (_runs(own), _runs(other))
    xs, ys = x.tolist(), y.tolist()
    back = (x[::-1], y[::-1], xs[::-1], ys[::-1])
    found: list[tuple] = []  # none within another, so sorted by first and by last place at once
    seen: dict[int, list[tuple[int, int]]] = {}

    def likeness(a: int, b: int, c: int, d: int) -> float:
        u, v = set(xs[a: b - SHINGLE + 1]), set(ys[c: d - SHINGLE + 1])
        shared = len(u & v)
        return shared / (len(u) + len(v) - shared)

    def add(a: int, b: int, c: int, d: int, value: float) -> None:
        before = bisect_right(found, a, key=lambda f: f[0])
        if before and found[before - 1][1] >= b - 1:
            return
        start = bisect_left(found, a, key=lambda f: f[0])
        found[start: max(start, bisect_right(found, b - 1, key=lambda f: f[1]))] = [(a, b - 1, c, d - 1, value)]

    def accept(a: int, b: int, c: int, d: int) -> bool:
        if min(b - a, d - c) < least:
            return False
        value = likeness(a, b, c, d)
        if value >= similarity:
            add(a, b, c, d, value)
        return value >= similarity

    for p, q in sorted(map(tuple, np.asarray(seeds).tolist())):
        if found and found[0][1] - found[0][0] == len(own) - 1:
            break  # all of the text is a passage
        if p >= len(xs) or q >= len(ys) or xs[p] != ys[q] or any(s <= p < e for s, e in seen.get(q - p, ())):
            continue
        ahead = list(_walk(x, y, xs, ys, p, q))
        behind = [(len(xs) - s - n, len(ys) - t - n, n) for s, t, n in _walk(*back, len(xs) - 1 - p, len(ys) - 1 - q)]
        joint = (behind[0][0], behind[0][1], behind[0][2] + ahead[0][2] - 1)
        chain = [*behind[:0:-1], joint, *ahead[1:]]
        for s, t, n in chain:
            seen.setdefault(t - s, []).append((s, s + n))
        reach = chain[-1][2] + SHINGLE - 1 + 2 * GAP  # all that may follow, and what ``_lengthened`` may add
        if min(chain[-1][0] - chain[0][0], chain[-1][1] - chain[0][1]) + reach < least:
            continue
        rows = np.array(chain)
        starts, ends = rows[:, :2], rows[:, :2] + rows[:, 2:] + SHINGLE - 1
        (sx, sy), (ex, ey) = starts.T.tolist(), ends.T.tolist()
        if accept(sx[0], ex[-1], sy[0], ey[-1]):
            continue
        # i..j reaches the similarity when shared * (1 + similarity) >= similarity * (runs of both),
        # which is a bound on ``tail[j]``; ``best`` never rises, so the last such j is looked up
        shared = np.cumsum(rows[:, 2])
        tail = (1 + similarity) * shared - similarity * ends.sum(axis=1)
        head = (1 + similarity) * (shared - rows[:, 2]) - similarity * starts.sum(axis=1) - 2 * similarity * (SHINGLE - 1)
        best = np.maximum.accumulate(tail[::-1])[::-1]
        reached = -1
        for i, j in enumerate((np.searchsorted(-best, -(head - 1e-9), side="right") - 1).tolist()):
            if j < i or j <= reached:
                continue
            reached = j
            a, b, c, d = sx[i], ex[j], sy[i], ey[j]
            if min(b - a, d - c) < least:
                a, b, c, d = _lengthened(own, other, a, b, c, d, least)
            k, m = i, j
            # runs that occur twice count once: where that leaves too little, weak ends are trimmed
            while not accept(a, b, c, d) and k < m:
                drop = likeness(sx[k + 1], ex[m], sy[k + 1], ey[m]) >= likeness(sx[k], ex[m - 1], sy[k], ey[m - 1])
                k, m = (k + 1, m) if drop else (k, m - 1)
                a, b, c, d = sx[k], ex[m], sy[k], ey[m]
        for i in np.flatnonzero(ends[:, 0] - starts[:, 0] >= least).tolist():
            add(sx[i], ex[i], sy[i], ey[i], 1.0)
    return found


def _lengthened(own: np.ndarray, other: np.ndarray, a: int, b: int, c: int, d: int, least: int) -> tuple[int, int, int, int]:
    """A stretch too short for a passage with the fewest words beside it that end in an equal word:
    fewer than ``SHINGLE`` equal words at the end of a passage are no run of their own."""
    lack = least - min(b - a, d - c)
    if lack <= 0:
        return a, b, c, d
    before = [0, *(n for n in range(1, GAP + 1) if min(a, c) >= n and own[a - n] == other[c - n])]
    after = [0, *(n for n in range(1, GAP + 1) if max(b + n - len(own), d + n - len(other)) <= 0 and own[b + n - 1] == other[d + n - 1])]
    l, r = min(((l, r) for l in before for r in after if l + r >= lack), key=sum, default=(0, 0))
    return a - l, b + r, c - l, d + r


def _runs(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    count = max(0, len(words) - size + 1)
    out = words[:count].copy()
    for j in range(1, size):
        out = mixed(out) + words[j: count + j]
    return out


def _agreeing(windows: np.ndarray, least: int) -> np.ndarray:
    """Seeds (place, keeper place) of stretches on which enough hash functions agree; ``windows`` are rows
    (f, place, first, last, keeper place)."""
    rows = windows[np.argsort(windows[:, 2], kind="stable")]
    begins = np.flatnonzero(rows[:, 2] > np.r_[-1, np.maximum.accumulate(rows[:, 3])[:-1]])
    functions = np.bitwise_count(np.bitwise_or.reduceat(np.int64(1) << rows[:, 0].astype(np.int64), begins))
    enough = np.repeat(functions >= least, np.diff(np.r_[begins, len(rows)]))
    return np.unique(rows[enough][:, [1, 4]], axis=0)


class _Hashed:
    """Word hashes and runs of the texts met last, so that a text of many pairs is read once."""

    def __init__(self, most_words: int = KEPT_WORDS):
        self.most, self.words, self.known = most_words, 0, OrderedDict()

    def read(self, texts: dict[tuple, str]) -> None:
        """Hashes texts that are not known, together; what was met longest ago goes."""
        new = {key: text for key, text in texts.items() if key not in self.known}
        for key in texts.keys() - new.keys():
            self.known.move_to_end(key)
        keys = list(new)
        for at, words in text_chunks(pa.array(new.values(), pa.large_string())):
            hashes = words.hashes()
            runs = _runs(hashes)
            for i, (a, n) in enumerate(zip(words.first.tolist(), words.counts.tolist())):
                # copies, so that a text that stays does not keep its neighbours
                self.known[keys[at + i]] = hashes[a: a + n].copy(), runs[a: a + max(0, n - SHINGLE + 1)].copy()
                self.words += n
        while self.words > self.most and len(self.known) > max(2, len(texts)):
            _, (oldest, _) = self.known.popitem(last=False)
            self.words -= len(oldest)

    def of(self, key: tuple) -> tuple[np.ndarray, np.ndarray]:
        return self.known[key]


def _verify(frames: Iterator[pd.DataFrame], agreeing: int, least: int, similarity: float) -> Iterator[pd.DataFrame]:
    hashed = _Hashed()
    for frame in frames:
        # copies of a text meet the same keepers at the same places
        out, met = [], {}
        for rows in _together(frame, agreeing):
            hashed.read({key: text for row, _ in rows for key, text in (((row.doc_id, row.part), row.text), ((row.keeper_id, row.keeper_part), row.keeper_text))})
            for row, seeds in rows:
                (own, x), (other, y) = hashed.of((row.doc_id, row.part)), hashed.of((row.keeper_id, row.keeper_part))
                copy = (row.keeper_id, row.keeper_part, own.tobytes(), seeds.tobytes())
                if copy not in met:
                    met[copy] = _passages(own, other, seeds, least, similarity, (x, y))
                out += [(row.doc_id, row.part, a, b, row.keeper_id, row.keeper_part, c, d, s) for a, b, c, d, s in met[copy]]
        yield pd.DataFrame(out, columns=["doc_id", "part", "first_word", "last_word", "keeper_id", "keeper_part", "keeper_first", "keeper_last", "similarity"])


def _together(frame: pd.DataFrame, agreeing: int, most: int = 1 << 21) -> Iterator[list[tuple]]:
    """(row, seeds) of the rows with seeds, as many at a time as have about ``most`` characters."""
    rows, size = [], 0
    for row in frame.itertuples():
        seeds = _agreeing(np.asarray(row.windows).reshape(-1, 5), agreeing)
        if len(seeds):
            rows.append((row, seeds))
            size += len(row.text) + len(row.keeper_text)
        if size > most:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _numbered(documents: DataFrame) -> DataFrame:
    """(doc_id, part, text): rows that share an id are told apart by a hash of their text, so that
    equal rows are one text; ``part`` is 0 where the id is the row's own."""
    texts = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    repeated = stage(texts.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("repeated")), "repeated-ids")
    if repeated.isEmpty():
        return texts.select("doc_id", F.lit(0).cast("long").alias("part"), "text")
    return texts.join(repeated, "doc_id", "left").select("doc_id", F.when(F.col("repeated"), F.xxhash64("text")).otherwise(F.lit(0).cast("long")).alias("part"), "text")


def _with_texts(pairs: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``pairs`` of texts with both texts, and the staged texts."""
    ends = stage(pairs.select("doc_id", "part").unionByName(pairs.select(F.col("keeper_id").alias("doc_id"), F.col("keeper_part").alias("part"))).distinct(), "ends")
    # equal rows are one text
    own = stage(texts.join(ends, ["doc_id", "part"], "left_semi").groupBy("doc_id", "part").agg(F.max("text").alias("text")), "texts")
    keeper = own.select(F.col("doc_id").alias("keeper_id"), F.col("part").alias("keeper_part"), F.col("text").alias("keeper_text"))
    return pairs.join(own, ["doc_id", "part"]).join(keeper, ["keeper_id", "keeper_part"]), own


def by_row(documents: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, hashes: int = HASHES, agreeing: int = AGREEING) -> DataFrame:
    """``duplicates`` with the part of either text, by which ``without_duplicates`` knows the row."""
    texts = _numbered(documents)
    least = words - SHINGLE + 1
    schema = "key long, doc_id long, part long, place int, before int, after int, f int"
    windows = stage(texts.mapInArrow(lambda batches: _windows(batches, hashes, least), schema), "windows")
    held = stage(_held(windows), "held")
    discard(windows)
    met = held.where("doc_id <> keeper_id OR part <> keeper_part")
    window = F.array("f", "place", F.col("place") - F.col("before"), F.col("place") + F.col("after"), "keeper_place")
    # at most the windows of one text come together
    functions = F.bit_count(F.bit_or(F.expr("shiftleft(1L, f)")))
    pairs = met.groupBy("doc_id", "part", "keeper_id", "keeper_part").agg(F.flatten(F.collect_list(window)).alias("windows"), functions.alias("agree")).where(F.col("agree") >= agreeing)
    pairs = stage(pairs.drop("agree"), "pairs")
    first = _found(pairs, texts, agreeing, words, similarity, "first-found")
    further = stage(_further(texts, held, first, words), "further-pairs")
    return first.unionByName(_found(further, texts, 1, words, similarity, "further-found"))


def _found(pairs: DataFrame, texts: DataFrame, agreeing: int, words: int, similarity: float, name: str) -> DataFrame:
    """The passages of ``pairs``, which are read no more afterwards."""
    both, own = _with_texts(pairs, texts)
    found = stage(both.mapInPandas(lambda frames: _verify(frames, agreeing, words, similarity), ROWS), name)
    discard(pairs)
    discard(own)
    return found


def _held(rows: DataFrame, others_only: bool = False) -> DataFrame:
    """``rows`` (key, doc_id, part, place, ...) of keys that different texts hold, with the key's first holder (keeper_id,
    keeper_part, keeper_place) and whether there are more than two rows (many); with ``others_only`` those of other texts.

    A key's rows meet once, sorted by holder, and are passed through. Keys that fill a good part of a batch of rows are
    joined with their first holders instead, where Spark splits a key that is too much for a task."""
    crowded = stage(rows.select("key").mapInArrow(_crowded, "key long").distinct(), "crowded-keys")
    rest = rows if crowded.isEmpty() else rows.join(crowded, "key", "left_anti")
    added = "many boolean, keeper_id long, keeper_part long, keeper_place int"
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), added])
    dealt = rest.repartition("key").sortWithinPartitions("key", "doc_id", "part", "place")
    out = dealt.mapInArrow(lambda batches: _with_keepers(batches, others_only), schema)
    if crowded.isEmpty():
        return out
    shared = stage(rows.join(crowded, "key", "left_semi"), "crowded")
    keepers = shared.groupBy("key").agg(F.min(F.struct("doc_id", "part", "place")).alias("keeper"), F.max(F.struct("doc_id", "part")).alias("top"), F.count(F.lit(1)).alias("holders"))
    keepers = stage(keepers.where("struct(keeper.doc_id, keeper.part) < top").selectExpr(
        "key", "holders > 2 AS many", "keeper.doc_id AS keeper_id", "keeper.part AS keeper_part", "keeper.place AS keeper_place"), "crowded-keepers")
    joined = shared.join(keepers, "key")
    return out.unionByName(joined.where("doc_id <> keeper_id OR part <> keeper_part") if others_only else joined)


def _crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that have at least one in ``CROWDED`` rows of a batch, and several."""
    for batch in batches:
        keys, times = np.unique(np.asarray(batch.column(0)), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(keys[times >= max(8, batch.num_rows // CROWDED)])], ["key"])


def _with_keepers(batches: Iterator[pa.RecordBatch], others_only: bool, most: int = KEY_ROWS) -> Iterator[pa.RecordBatch]:
    """What ``_held`` adds to rows sorted by (key, doc_id, part, place). A key's rows wait for the next batch, which may
    go on with it; of more than ``most``, only the first waits."""
    waiting: list[np.ndarray] | None = None
    begun = False  # the first waiting row was handed on before, as were others of its key
    for batch in chain(batches, [None]):
        columns = [np.asarray(c) for c in batch.columns] if batch is not None else waiting
        if waiting is not None and batch is not None:
            columns = [np.concatenate(c) for c in zip(waiting, columns)]
        if columns is None or not len(columns[0]):
            continue
        names = batch.schema.names if batch is not None else names
        key, doc, part, place = columns[:4]
        begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[begins, len(key)])
        first = np.repeat(begins, sizes)
        other = (doc != doc[first]) | (part != part[first])
        various, many, last = np.logical_or.reduceat(other, begins), sizes > 2, int(begins[-1])
        if begun:
            various[0] = many[0] = True
        whole = batch is None or bool(sizes[-1] > most and various[-1])
        keep = np.repeat(various, sizes) & (other | (not others_only))
        keep[len(key) if whole else last:] = False
        if begun:
            keep[0] = False
        out = [*(c[keep] for c in columns), np.repeat(many, sizes)[keep], *(c[first[keep]] for c in (doc, part, place))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], [*names, "many", "keeper_id", "keeper_part", "keeper_place"])
        begun = whole or (begun and last == 0)
        waiting = [c[last: last + 1 if whole else len(key)] for c in columns]


def _uncovered(rows: DataFrame, spans: DataFrame, low: str, high: str) -> DataFrame:
    """``rows`` of which the stretch from ``low`` to ``high`` lies in no single one of the text's spans: the
    furthest end among the spans that begin no later than the row does not reach ``high``. Rows and spans of
    one text are sorted together, so neither is copied to the other."""
    marks = spans.select("doc_id", "part", F.col("first_word").alias("__at"), F.col("last_word").alias("__reach"))
    order = Window.partitionBy("doc_id", "part").orderBy("__at")
    both = rows.withColumn("__at", F.expr(low)).withColumn("__row", F.lit(True)).unionByName(marks, allowMissingColumns=True)
    both = both.withColumn("__far", F.max("__reach").over(order))
    return both.where(f"__row AND NOT coalesce(__far >= {high}, false)").select(*rows.columns)


def _further(texts: DataFrame, held: DataFrame, first: DataFrame, words: int) -> DataFrame:
    """Pairs of texts for what the first holders leave open: where a key has more holders than the
    two that were compared, and a window with it lies in no passage found, the stretches of all its
    holders are compared by their equal runs of ``words`` and of half as many words. A run has its
    own first holder, who has all of it, so the cost is the number of runs whatever the holders."""
    reach = words - SHINGLE
    spans = stage(first.select("doc_id", "part", "first_word", "last_word").distinct(), "found-spans")
    around = held.where("many").select(
        "key", "doc_id", "part", F.expr(f"place - least(before, {reach})").alias("low"), F.expr(f"place + least(after, {reach}) + {SHINGLE - 1}").alias("high"),
        F.expr("doc_id <> keeper_id OR part <> keeper_part").alias("met"))
    bare = _uncovered(around.where("met").drop("met"), spans, "low", "high")
    stretches = stage(around.join(stage(bare.select("key").distinct(), "open-keys"), "key", "left_semi").groupBy("doc_id", "part").agg(F.flatten(F.collect_set(F.array("low", "high"))).alias("stretches")), "stretches")
    discard(held)
    found = spans.groupBy("doc_id", "part").agg(F.flatten(F.collect_list(F.array("first_word", "last_word"))).alias("spans"))
    open_ = texts.join(stretches, ["doc_id", "part"]).join(found, ["doc_id", "part"], "left").select("doc_id", "part", "text", "stretches", "spans")
    runs = stage(open_.mapInPandas(lambda frames: _equal_runs(frames, [words, words // 2]), "key long, doc_id long, part long, place int, size int, open boolean"), "equal-runs")
    met = _held(runs, others_only=True).where("open")
    window = F.array(F.lit(0), "place", "place", F.expr("place + size - 1"), "keeper_place")
    return met.groupBy("doc_id", "part", "keeper_id", "keeper_part").agg(F.flatten(F.collect_set(window)).alias("windows"))


def _long_runs(words: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """One hash per run of each size, all from the same sums: a polynomial in the run's word hashes."""
    down = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(words), _SHRINK)])
    up = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(words), _GROW)])
    sums = np.r_[np.uint64(0), np.cumsum(words * down[:-1], dtype=np.uint64)]
    counts = [max(0, len(words) - size + 1) for size in sizes]
    return [mixed((sums[size: size + n] - sums[:n]) * up[:n] + np.uint64(size)) for size, n in zip(sizes, counts)]


def _equal_runs(frames: Iterator[pd.DataFrame], sizes: list[int]) -> Iterator[pd.DataFrame]:
    """The runs of so many words within the stretches of a text; those that lie in no single one of its spans are open."""
    for frame in frames:
        out, rows = [], 0
        for row in frame.itertuples():
            own = next(text_chunks(pa.array([row.text])))[1].hashes()
            stretches = np.asarray(row.stretches).reshape(-1, 2)
            spans = np.asarray(row.spans if row.spans is not None else [], dtype=np.int64).reshape(-1, 2)
            spans = spans[np.argsort(spans[:, 0])]
            furthest = np.r_[-1, np.maximum.accumulate(spans[:, 1])]
            for size, runs in zip(sizes, _long_runs(own, sizes)):
                long = stretches[stretches[:, 1] - stretches[:, 0] + 1 >= size]
                edges = np.bincount(long[:, 0], minlength=len(own) + 2)[: len(own) + 2] - np.bincount(long[:, 1] - size + 2, minlength=len(own) + 2)[: len(own) + 2]
                place = np.flatnonzero(np.cumsum(edges)[: len(runs)])
                open_ = furthest[np.searchsorted(spans[:, 0], place, side="right")] < place + size - 1
                out.append((runs[place], size, row.doc_id, row.part, place, open_))
                rows += len(place)
            if rows > RUN_ROWS:
                yield _run_rows(out)
                out, rows = [], 0
        yield _run_rows(out)


def _run_rows(parts: list[tuple]) -> pd.DataFrame:
    lengths = [len(p[0]) for p in parts]
    runs, places, open_ = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, dtype=kind) for i, kind in ((0, np.uint64), (4, np.int64), (5, bool)))
    return pd.DataFrame({"key": signed(runs), "doc_id": np.repeat(np.array([p[2] for p in parts], dtype=np.int64), lengths), "part": np.repeat(np.array([p[3] for p in parts], dtype=np.int64), lengths),
                         "place": places.astype(np.int32), "size": np.repeat([p[1] for p in parts], lengths).astype(np.int32), "open": open_})


def duplicates(documents: DataFrame, words: int = WORDS, similarity: float = SIMILARITY, hashes: int = HASHES, agreeing: int = AGREEING) -> DataFrame:
    """Passages of ``documents`` (doc_id, text) that an earlier text also has: (doc_id, first_word,
    last_word, keeper_id, keeper_first, keeper_last, similarity)."""
    return by_row(documents, words, similarity, hashes, agreeing).drop("part", "keeper_part")


def _cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans, and without the space after them."""
    data = text.encode()
    words = Words(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))
    out, at = [], 0
    for first, last in sorted(spans):
        if first >= len(words.starts):
            continue
        start = int(words.starts[first])
        after = int(words.starts[last + 1]) if last + 1 < len(words.starts) else len(data)
        out.append(data[at: max(at, start)])
        at = max(at, after)
    return b"".join([*out, data[at:]]).decode(errors="ignore")


def _cut_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        frame["text"] = [t if s is None else _cut(t, [tuple(x) for x in np.asarray(s).reshape(-1, 2).tolist()]) for t, s in zip(frame["text"], frame["spans"])]
        yield frame.drop(columns="spans")


def without_duplicates(documents: DataFrame, found: DataFrame) -> DataFrame:
    """``documents`` with the duplicate passages cut out of their texts; texts of which nothing is
    left are dropped. ``found`` is of ``by_row`` where rows share an id. Only changed texts pass
    through Python."""
    parts = found if "part" in found.columns else found.withColumn("part", F.lit(0).cast("long"))
    spans = stage(parts.groupBy(F.col("doc_id").alias("__id"), F.col("part").alias("__part")).agg(F.flatten(F.collect_list(F.array("first_word", "last_word"))).alias("spans")), "spans")
    marked = documents.join(spans, (F.col("doc_id") == F.col("__id")) & ((F.col("__part") == 0) | (F.col("__part") == F.xxhash64("text"))), "left")
    changed = marked.where("spans IS NOT NULL").select(*documents.columns, "spans").mapInPandas(_cut_rows, documents.schema)
    return marked.where("spans IS NULL").select(*documents.columns).unionByName(changed.where(r"regexp_like(text, '[^\\x20\\x09-\\x0D]')"))
