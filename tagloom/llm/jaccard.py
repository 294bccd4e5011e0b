"""N-gram Jaccard join by a blocked sparse product of the document by n-gram incidence.

A text's set is its distinct runs of ``k`` words. Texts with the same set are one class, kept
once. Of every class only a prefix of its set enters the product: two sets that reach the
similarity share a run within both prefixes, whatever order all sets are read in. The order is
by hash, with runs that many classes have moved to the end, so shared passages produce no
candidates unless they are most of a text. Hot runs are counted over the prefixes of all classes,
then over the whole of every text with one; the list is bounded because it only chooses an
order, which never loses a link.

The product is taken per run (a block of the matrix): short lists give their pairs within the
bounds that sizes and places in the order set. A long list is first compared with one pivot, the member that is most like the
rest; members linked to it are one group, and only pairs that the groups leave open are
compared afterwards. So a group of near copies costs its size and not its square, and no link
between groups is lost. All candidates are verified on whole sets.

Defined cases: a text that is null or has no words has an empty set and no link; fewer than k
words are one run; rows with a null id get a null component and link nothing; rows that share an
id are one node; repeated rows are one class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tagloom.llm.components import connected_components
from tagloom.llm.words import mixed, signed, text_chunks
from tagloom.operators.staging import discard, stage

K = 4
PERCENT = 85
HOT = 32  # a run in the prefixes of so many classes is hot
MOST_HOT = 1 << 17  # hot runs that are moved to the end of the order, the most frequent first
SHORT = 12  # lists of up to so many classes give all their pairs
_KEY = "k1 long, k2 long"


def prefix_size(n, percent: int = PERCENT):
    """n - ceil(n * percent / 100) + 1 runs decide whether a set of n can reach the similarity."""
    return n - -(-n * percent // 100) + 1


def _sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct run hashes of every text."""
    for _, sets in _chunks(texts, k):
        yield from sets


def _chunks(texts: pa.Array, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(index of the first text, sets) for stretches of bounded size, so that no more than the
    sets of one stretch are held or sent at a time."""
    for at, words in text_chunks(texts):
        hashes, runs = words.shingles(k)
        ends = np.cumsum(runs)
        yield at, [np.unique(hashes[a:b]) for a, b in zip(ends - runs, ends)]


def _set_key(s: np.ndarray) -> tuple[int, int]:
    both = np.array([np.bitwise_xor.reduce(mixed(s)) if len(s) else 0, mixed(s + np.uint64(len(s))).sum() if len(s) else 0], dtype=np.uint64)
    return tuple(signed(both).tolist())


def _keys(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [(len(s), *_set_key(s)) for s in _sets(batch.column(1), k)]
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())], ["doc_id", "n", "k1", "k2"])


def _heads(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The first runs by hash: enough for most prefixes after hot runs have moved."""
    for batch in batches:
        for at, sets in _chunks(batch.column(1), k):
            heads = [signed(s[: 2 * prefix_size(len(s), percent) + 16]) for s in sets]
            keys = [_set_key(s) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array([a for a, _ in keys], pa.int64()), pa.array([b for _, b in keys], pa.int64()),
                                              pa.array(heads, pa.list_(pa.int64()))], ["doc_id", "n", "k1", "k2", "head"])


def _is_hot(s: np.ndarray, hot: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(hot, s), max(0, len(hot) - 1))
    return hot[at] == s if len(hot) else np.zeros(len(s), dtype=bool)


def _ordered_prefix(s: np.ndarray, size: int, hot: np.ndarray) -> np.ndarray:
    marked = _is_hot(s, hot)
    return np.concatenate([s[~marked], s[marked]])[:size]


def _rows(reps, ns, prefixes) -> pa.RecordBatch:
    lengths = np.fromiter(map(len, prefixes), dtype=np.int64, count=len(prefixes))
    runs = np.concatenate(prefixes) if prefixes else np.zeros(0, dtype=np.int64)
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths) + 1
    columns = [runs.view(np.int64), np.repeat(reps, lengths), np.repeat(ns, lengths), place]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["run", "rep", "n", "place"])


def _postings(batches: Iterator[pa.RecordBatch], hot: np.ndarray, percent: int, whole: bool) -> Iterator[pa.RecordBatch]:
    """Prefix rows of heads; with ``whole`` only what the heads can answer for certain."""
    for batch in batches:
        reps, ns = (np.asarray(batch.column(i)) for i in (0, 1))
        bounds, flat = np.asarray(batch.column(2).offsets), np.asarray(batch.column(2).values).view(np.uint64)
        prefixes = []
        for i, n in enumerate(ns.tolist()):
            head, size = flat[bounds[i]: bounds[i + 1]], prefix_size(n, percent)
            cold = len(head) - int(_is_hot(head, hot).sum())
            known = len(head) == n or cold >= size
            prefixes.append(_ordered_prefix(head, size, hot) if known or not whole else head[:0])
        yield _rows(reps, ns, prefixes)


def _runs_beside(batches: Iterator[pa.RecordBatch], hot: np.ndarray, k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """All runs of the texts that have a hot run in their prefix: what stands beside it in a
    passage or in a group of near copies is likely to be hot too."""
    for batch in batches:
        for _, sets in _chunks(batch.column(1), k):
            beside = [s for s in sets if _is_hot(s[: prefix_size(len(s), percent)], hot).any()]
            # counted here, before rows are made: copies in the same stretch are one row per run
            runs, times = np.unique(np.concatenate(beside) if beside else np.zeros(0, dtype=np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(runs)), pa.array(times, pa.int64())], ["run", "times"])


def _open_heads(batches: Iterator[pa.RecordBatch], hot: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    """Classes whose heads are too hot to hold their prefix."""
    for batch in batches:
        ns, heads = np.asarray(batch.column(1)).tolist(), batch.column(2)
        bounds, flat = np.asarray(heads.offsets), np.asarray(heads.values).view(np.uint64)
        cold = [bounds[i + 1] - bounds[i] - int(_is_hot(flat[bounds[i]: bounds[i + 1]], hot).sum()) for i in range(len(ns))]
        keep = [bounds[i + 1] - bounds[i] < n and cold[i] < prefix_size(n, percent) for i, n in enumerate(ns)]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_()))], ["rep"])


def _whole_prefixes(batches: Iterator[pa.RecordBatch], hot: np.ndarray, k: int, percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        reps = np.asarray(batch.column(0))
        for at, sets in _chunks(batch.column(1), k):
            ns = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
            yield _rows(reps[at: at + len(sets)], ns, [_ordered_prefix(s, prefix_size(len(s), percent), hot) for s in sets])


def _set_bytes(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, sets in _chunks(batch.column(1), k):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], ["rep", "runs"])


def _verified(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    for frame in batches:
        keep = []
        for x, y in zip(frame["runs_a"], frame["runs_b"]):
            x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        yield frame.loc[keep, ["a", "b"]]


class Join:
    """The steps over one table of (doc_id, text)."""

    def __init__(self, documents: DataFrame, k: int = K, percent: int = PERCENT):
        self.spark, self.k, self.percent = documents.sparkSession, k, percent
        self.texts = documents.select("doc_id", "text")
        keyed = self.texts.mapInArrow(lambda batches: _keys(batches, k), f"doc_id {self._id()}, n long, {_KEY}")
        self.keys = stage(keyed, "set-keys")

    def _id(self) -> str:
        return self.texts.schema["doc_id"].dataType.simpleString()

    def _classes(self) -> DataFrame:
        """(rep, n, head): every distinct non-empty set once, under the smallest id that has it."""
        k, percent = self.k, self.percent
        heads = self.texts.where("doc_id IS NOT NULL").mapInArrow(lambda batches: _heads(batches, k, percent), f"doc_id {self._id()}, n long, {_KEY}, head array<long>")
        first = heads.where("n > 0").groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "n", "head")).alias("first"))
        return stage(first.select(F.col("first.doc_id").cast("long").alias("rep"), "first.n", "first.head"), "classes")

    def postings(self) -> DataFrame:
        """(run, rep, n, place): the prefix rows of every class; places count from 1."""
        classes, percent, k = self._classes(), self.percent, self.k
        schema = "run long, rep long, n long, place long"
        none = np.zeros(0, dtype=np.uint64)
        first = self._frequent(classes.mapInArrow(lambda batches: _postings(batches, none, percent, False), schema))
        seen = self.spark.sparkContext.broadcast(first)
        hot = np.union1d(first, self._frequent(self.texts.mapInArrow(lambda batches: _runs_beside(batches, seen.value, k, percent), "run long, times long")))
        shared = self.spark.sparkContext.broadcast(hot)
        rows = classes.mapInArrow(lambda batches: _postings(batches, shared.value, percent, True), schema)
        opened = stage(classes.mapInArrow(lambda batches: _open_heads(batches, shared.value, percent), "rep long"), "open")
        whole = self._texts_of(opened).mapInArrow(lambda batches: _whole_prefixes(batches, shared.value, k, percent), schema)
        postings = stage(rows.unionByName(whole), "postings")
        discard(classes)
        return postings

    def _frequent(self, rows: DataFrame) -> np.ndarray:
        times = F.sum("times") if "times" in rows.columns else F.count(F.lit(1))
        counted = stage(rows.groupBy("run").agg(times.alias("count")).where(F.col("count") >= HOT), "frequent")  # of a shuffle much larger than it
        most = counted.orderBy(F.desc("count"), "run").limit(MOST_HOT)
        return np.sort(np.array([r.run for r in most.select("run").toLocalIterator()], dtype=np.int64).view(np.uint64))

    def _texts_of(self, reps: DataFrame) -> DataFrame:
        """(rep, text) of classes; of rows that share an id, the one that the class was made from."""
        sized = self.texts.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("rep"), "text")
        return sized.join(reps, "rep", "left_semi").select("rep", "text")

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose whole sets reach the similarity."""
        k, percent = self.k, self.percent
        ends = stage(pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct(), "ends")
        sets = stage(self._texts_of(ends).mapInArrow(lambda batches: _set_bytes(batches, k), "rep long, runs binary"), "sets")
        a, b = (sets.select(F.col("rep").alias(side), F.col("runs").alias(f"runs_{side}")) for side in "ab")
        found = stage(pairs.join(b, "b").join(a, "a").mapInPandas(lambda frames: _verified(frames, percent), "a long, b long").distinct(), "linked")
        discard(sets)
        return found

    def fits(self, x: str, y: str) -> Column:
        """Whether sets that meet in a run for the first time can reach the similarity: what is
        left of both after their places bounds what they share. A linked pair always can in the
        first run that it shares, so no link is lost."""
        left = f"1 + least({x}n - {x}place, {y}n - {y}place)"
        return F.expr(f"({left}) * {100 + self.percent} >= {self.percent} * ({x}n + {y}n)")


def _pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def links(join: Join) -> DataFrame:
    """Edges (a, b) between classes, as many as the groups need: two classes are connected by
    edges exactly when they are connected by links."""
    rows = join.postings()
    lists = stage(rows.groupBy("run").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("rep", "n", "place")).alias("x"), F.max(F.struct("rep", "n", "place")).alias("y")).where("m > 1"), "lists")
    two = lists.where("m = 2").where(join.fits("x.", "y.")).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    more = stage(rows.join(lists.where("m > 2").select("run", "m"), "run"), "long-lists")
    discard(rows)

    few = more.where(F.col("m") <= SHORT).groupBy("run").agg(F.array_sort(F.collect_list(F.struct("rep", "n", "place"))).alias("members"))
    few = few.select("members", F.posexplode("members").alias("i", "x")).select("x", F.explode(F.slice("members", F.col("i") + 2, SHORT)).alias("y"))
    few = few.where(join.fits("x.", "y.")).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))

    many = more.where(F.col("m") > SHORT)
    # the class that has most of its prefix in long lists is the most like their members
    common = many.groupBy("rep").agg((F.count(F.lit(1)) / F.expr(f"max(n - ceil(n * {join.percent} / 100) + 1)")).alias("common"))
    many = stage(many.join(common, "rep"), "hot-lists")
    pivots = stage(many.groupBy("run").agg(F.max(F.struct("common", "n", (-F.col("rep")).alias("rep"), "place")).alias("best")).select("run", (-F.col("best.rep")).alias("pivot"), F.col("best.n").alias("pivot_n"), F.col("best.place").alias("pivot_place")), "pivots")
    star = many.join(pivots, "run").where("rep <> pivot").where(join.fits("", "pivot_")).select(*_pair(F.col("rep"), F.col("pivot")))
    found = join.linked(stage(two.unionByName(few).unionByName(star).distinct(), "pairs"))

    # what the groups leave open: members outside the pivot's group against all others
    groups = stage(connected_components(found.select(F.col("a").alias("src"), F.col("b").alias("dst"))), "groups").withColumnRenamed("node", "rep")
    member = stage(many.select("run", "rep", "n", "place").join(groups, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "members")
    homes = groups.select(F.col("rep").alias("pivot"), F.col("component").alias("home"))
    centre = stage(pivots.join(homes, "pivot", "left").select("run", F.coalesce("home", "pivot").alias("home"), "pivot"), "centres")
    seen = member.join(centre, "run").where("rep <> pivot")
    outside = seen.where("component <> home").select("run", F.col("rep").alias("u"), F.col("n").alias("u_n"), F.col("place").alias("u_place"), F.col("component").alias("u_component"))
    open_ = outside.join(seen, "run").where("component <> u_component").where(join.fits("", "u_")).select(*_pair(F.col("u"), F.col("rep")))
    return found.unionByName(join.linked(stage(open_.distinct(), "open-pairs")))


def components(documents: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``documents`` (doc_id, text)."""
    join = Join(documents, k, percent)
    known = join.keys.where("doc_id IS NOT NULL AND n > 0")
    reps = stage(known.groupBy("k1", "k2").agg(F.min("doc_id").cast("long").alias("rep")), "reps")
    # rows that share an id tie their classes
    ids = known.groupBy("doc_id").agg(F.countDistinct("k1", "k2").alias("classes")).where("classes > 1").select("doc_id")
    tied = known.join(ids, "doc_id").join(reps, ["k1", "k2"]).select(F.col("doc_id").cast("long").alias("src"), F.col("rep").alias("dst"))
    edges = links(join).select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(tied)
    groups = stage(connected_components(edges), "components")
    placed = stage(reps.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component")), "placed")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", F.col("doc_id").cast("long")))
    return join.keys.join(placed, ["k1", "k2"], "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
