"""Exact top-N by inner product without scoring every pair.

A score is at most the length of the user's vector times the length of the item's. Items are visited
in blocks of falling length: when a user's own length times the longest length to come is below
the N-th score found, nothing that follows can enter the list, and the user stops.

Items travel to the tasks in slices of bounded size, so no side is ever broadcast whole by its
own right and no user meets an item through a join: there is no shuffle of users. A pass over one
slice serves all users that are still open; a catalogue of up to ``SLICE_ITEMS`` items needs one pass, and of a
larger one the slices behind the last open user are never read. Users' lists between passes are
staged, so a lost task redoes its own users.

Scores are sums of products in component order, in double precision, whatever the blocks; matrix products in
between only choose what is summed, with more slack than their rounding. Equal scores go to the smaller item.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagloom.operators.numbering import numbered
from tagloom.operators.staging import stage

SLICE_ITEMS = 1 << 18  # items that are broadcast at a time
BLOCK_ITEMS = 256  # of a slice, between two looks at who can stop
USER_ROWS = 4096  # users that are served together
_SLACK = 1e-9  # of lengths' products; more than the rounding of double sums
_LISTS = "id long, features array<float>, items array<long>, scores array<double>, scored long, open boolean"


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Products of equally many rows, summed in component order."""
    total = np.zeros(len(x))
    for k in range(x.shape[1]):
        total += x[:, k] * y[:, k]
    return total


class Lists:
    """The n best items of some users so far: high scores first, then small items."""

    def __init__(self, features: np.ndarray, n: int):
        self.x, self.n = features, n
        self.length = np.sqrt(_exact(features, features))
        self.items = np.full((len(features), n), np.iinfo(np.int64).max)
        self.scores = np.full((len(features), n), -np.inf)
        self.scored = np.zeros(len(features), dtype=np.int64)

    def within_reach(self, longest: float) -> np.ndarray:
        """Users for whom an item of at most this length can enter the list, ties included."""
        return self.length * longest * (1 + _SLACK) >= self.scores[:, -1]

    def visit(self, items: np.ndarray, y: np.ndarray, longest: float) -> bool:
        """Looks at a block of items; False when no user needed to."""
        users = np.flatnonzero(self.within_reach(longest))
        if not len(users):
            return False
        self.scored[users] += len(items)
        near = self.x[users] @ y.T
        least = self.scores[users, -1]
        unfilled = np.flatnonzero(np.isneginf(least))  # later, a full list is bound enough: few items of a block pass it
        if len(items) > self.n and len(unfilled):
            least[unfilled] = np.partition(near[unfilled], len(items) - self.n, axis=1)[:, len(items) - self.n]
        i, j = np.nonzero(near >= (least - 2 * _SLACK * self.length[users] * longest)[:, None])
        self._enter(users[np.unique(i)], users[i], items[j], _exact(self.x[users[i]], y[j]))
        return True

    def _enter(self, users: np.ndarray, user: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        """Merges found (user, item, score) rows with the lists of ``users``: those, ascending, that have such rows."""
        user = np.concatenate([np.repeat(users, self.n), user])
        item = np.concatenate([self.items[users].ravel(), item])
        score = np.concatenate([self.scores[users].ravel(), score])
        order = np.lexsort((item, -score, user))
        user, item, score = user[order], item[order], score[order]
        begins = np.flatnonzero(np.r_[True, user[1:] != user[:-1]])
        rank = np.arange(len(user)) - np.repeat(begins, np.diff(np.r_[begins, len(user)]))
        kept = rank < self.n  # every user has n entries, empty ones included
        self.items[users], self.scores[users] = item[kept].reshape(-1, self.n), score[kept].reshape(-1, self.n)


def _rows(column: pa.Array, width: int, kind) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind).reshape(len(column), width)


def _served(batches: Iterator[pa.RecordBatch], n: int, items: np.ndarray, y: np.ndarray, lengths: np.ndarray, following: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), USER_ROWS):
            part = batch.slice(at, USER_ROWS)
            lists = Lists(_rows(part.column("features"), y.shape[1], np.float64), n)
            if "items" in part.schema.names:
                lists.items, lists.scores = _rows(part.column("items"), n, np.int64), _rows(part.column("scores"), n, np.float64)
                lists.scored = np.array(part.column("scored"))
            for first in range(0, len(items), BLOCK_ITEMS):
                block = slice(first, first + BLOCK_ITEMS)
                if not lists.visit(items[block], y[block], lengths[first]):
                    break
            columns = [pa.array(list(rows)) for rows in (lists.items, lists.scores)]
            yield pa.RecordBatch.from_arrays([part.column("id"), part.column("features"), *columns, pa.array(lists.scored), pa.array(lists.within_reach(following))],
                                             ["id", "features", "items", "scores", "scored", "open"])


def best_lists(users: DataFrame, items: DataFrame, n: int, slice_items: int = SLICE_ITEMS) -> DataFrame:
    """(id, items, scores, scored) per row of ``users`` (id, features): its n best of ``items`` (item, features),
    or all when there are fewer, and the number of items that were scored for it.

    All vectors have one length; rows without a vector do not take part.
    """
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    known = items.select(F.col("item").cast("long").alias("item"), "features", length.alias("length")).where("features IS NOT NULL")
    visited = stage(numbered(known, [F.desc("length"), "item"]), "items-by-length")
    catalogue = visited.count()
    n_best = min(n, catalogue)
    schema = "id long, items array<long>, scores array<double>, scored long"
    open_ = users.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<float>").alias("features")).where("features IS NOT NULL")
    if not n_best:
        return open_.select("id", F.array().cast("array<long>").alias("items"), F.array().cast("array<double>").alias("scores"), F.lit(0).cast("long").alias("scored"))
    closed = []
    for first in range(0, catalogue, slice_items):
        # one item more than the slice: its length is the longest that follows
        table = visited.where(F.col("number").between(first, first + slice_items)).select("number", "item", "features", "length").toArrow()
        order = np.argsort(np.asarray(table["number"]))
        ids, lengths, y = np.asarray(table["item"])[order], np.asarray(table["length"])[order], np.array(table["features"].to_pylist(), dtype=np.float64)[order]
        last = len(ids) <= slice_items
        here = slice(0, slice_items)
        shared = users.sparkSession.sparkContext.broadcast((ids[here], y[here], lengths[here], -np.inf if last else float(lengths[-1])))
        served = stage(open_.mapInArrow(lambda batches, shared=shared: _served(batches, n_best, *shared.value), _LISTS), "lists")
        closed.append(served if last else served.where("NOT open"))
        open_ = served.where("open").drop("open")
        if last or open_.isEmpty():
            break
    result = closed[0]
    for more in closed[1:]:
        result = result.unionByName(more)
    return result.select("id", "items", "scores", "scored")


def ranked(lists: DataFrame, item: str) -> DataFrame:
    """(id, rank, item, score) of the lists, ranks from 0."""
    pairs = lists.select("id", F.posexplode(F.arrays_zip("items", "scores")).alias("rank", "best"))
    return pairs.select("id", "rank", F.col("best.items").alias(item), F.col("best.scores").alias("score"))
