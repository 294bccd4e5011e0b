"""Vector code compression: parts of vectors replaced by the nearest entry of a codebook per part.

Components become whole numbers, vectors are cut into equal parts, and every part position has a
codebook that a fixed number of rounds moves to the means of its parts (floored, component by
component). Everything that decides is whole-number arithmetic; floats only save work.

Drake and Hamerly's bounds: with every part its entry is stored with an upper bound of the distance,
its ``b`` next closest entries in order with lower bounds, and one outer bound below all the others. When
entries move, bounds move by as much and are put in order again. A part whose upper bound is under its first lower
bound keeps its entry unread. Otherwise the exact squared distance to its entry is taken, and those
entries of the list whose bounds do not exceed it are measured exactly, ties to the lower index; only if the outer
bound does not exceed it either, the whole codebook is. Bounds are rounded outwards to 16 bits, so
they never settle a tie. ``b`` adapts: from entries / 8 on, each slice of rows keeps as many as settled
``SETTLED`` of its uncertain parts, entries / 16 at least.

The state is a table of one row per vector, staged in the shared folder after each round, so a lost task redoes its own rows.
Codebooks are entries x width numbers, whatever the table's size: they alone are collected and
broadcast. Their sums are added up per task first.

Defined cases: vectors that are null or hold null or non-finite components are dropped; shorter vectors
count as ending in zeros, up to the longest length rounded up to whole parts; with fewer rows
than entries the codebooks have one entry per row; the first entries are those of the smallest ids, null ids last,
equal ids by vector; repeated rows are rows of their own; an empty table gives an empty result; a
component of 2^24 / scale or more is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagloom.llm.vectors import matrix, products, whole_vectors
from tagloom.operators.staging import discard, scratch, stage

PARTS, ENTRIES, SCALE, ROUNDS = 16, 64, 256, 2
SETTLED = 0.95
SLICE = 1024  # rows measured at a time
_STATE = "vec_id long, label {label}, vector array<int>, entry binary, upper binary, near binary, lower binary"


def _up(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):  # what is too long for 16 bits is unbounded, and measured
        return np.nextafter(np.asarray(x, dtype=np.float64).astype(np.float16), np.float16(np.inf))


def _down(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nextafter(np.asarray(x, dtype=np.float64).astype(np.float16), np.float16(-np.inf))


def _ordered(lower: np.ndarray) -> np.ndarray:
    """Lower bounds that do not fall from left to right: each is also below all that follow."""
    return np.minimum.accumulate(lower[:, ::-1], axis=1)[:, ::-1]


def _all_squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] + (book * book).sum(1)[None, :] - 2 * products(x, book)


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((x - entries) ** 2).sum(-1)


class Bounds:
    """What is known of one part of some rows: entry, upper, near (b), lower (b and the outer one)."""

    def __init__(self, entry, upper, near, lower):
        self.entry, self.upper, self.near, self.lower = entry, upper, near, lower

    @classmethod
    def measured(cls, x: np.ndarray, book: np.ndarray, b: int) -> Bounds:
        """From the distances to the whole book."""
        squares = _all_squares(x, book)
        order = np.argsort(squares, axis=1, kind="stable")
        lengths = np.sqrt(np.take_along_axis(squares, order, 1))
        beyond = _down(lengths[:, b + 1: b + 2]) if b + 1 < len(book) else np.full((len(x), 1), np.inf, dtype=np.float16)
        return cls(order[:, 0], _up(lengths[:, 0]), order[:, 1: b + 1], np.concatenate([_down(lengths[:, 1: b + 1]), beyond], axis=1))

    def _put(self, rows: np.ndarray, new: Bounds) -> None:
        self.entry[rows], self.upper[rows], self.near[rows], self.lower[rows] = new.entry, new.upper, new.near, new.lower

    def move(self, x: np.ndarray, book: np.ndarray, moved: np.ndarray) -> np.ndarray:
        """The nearest entries after entry i has moved by at most ``moved[i]``. Returns how many
        bounds each uncertain row had to look behind."""
        b = self.near.shape[1]
        self.upper = _up(self.upper.astype(np.float64) + moved[self.entry])
        fallen = np.concatenate([moved[self.near], np.full((len(x), 1), moved.max())], axis=1)
        self.lower = _ordered(_down(self.lower.astype(np.float64) - fallen))
        maybe = np.flatnonzero(self.upper >= self.lower[:, 0])
        own = _squares(x[maybe], book[self.entry[maybe]])
        self.upper[maybe] = _up(np.sqrt(own))
        depth = (self.lower[maybe] <= self.upper[maybe][:, None]).sum(1)
        all_ = maybe[depth > b]
        if len(all_):
            self._put(all_, Bounds.measured(x[all_], book, b))
        some = (depth > 0) & (depth <= b)
        if some.any():
            self._sort(maybe[some], depth[some], own[some], x, book)
        return depth[depth > 0]

    def _sort(self, rows: np.ndarray, depth: np.ndarray, own: np.ndarray, x: np.ndarray, book: np.ndarray) -> None:
        """Measures the first ``depth`` entries of each row's list and puts them and its own in order."""
        b = self.near.shape[1]
        entries = np.concatenate([self.entry[rows][:, None], self.near[rows]], axis=1)
        squares = np.full(entries.shape, np.iinfo(np.int64).max)
        squares[:, 0] = own
        i, j = np.nonzero(np.arange(1, b + 1)[None, :] <= depth[:, None])
        squares[i, j + 1] = _squares(x[rows[i]], book[entries[i, j + 1]])
        known = np.arange(b + 1)[None, :] <= depth[:, None]
        ties = np.where(known, entries, len(book) + np.arange(b + 1)[None, :])  # the rest stays in place
        order = np.lexsort((ties, squares), axis=-1)
        entries, squares = np.take_along_axis(entries, order, 1), np.take_along_axis(squares, order, 1)
        lower = self.lower[rows].copy()
        lengths = np.sqrt(squares.astype(np.float64))
        lower[:, :b] = np.where(known[:, 1:], _down(lengths[:, 1:]), lower[:, :b])
        self._put(rows, Bounds(entries[:, 0], _up(lengths[:, 0]), entries[:, 1:], _ordered(lower)))

    def keep(self, b: int) -> None:
        """Shortens the lists; the first bound that goes is the new outer one."""
        self.near, self.lower = self.near[:, :b], self.lower[:, : b + 1]


def _state(batch: pa.RecordBatch | pa.Table, bounds: list[Bounds]) -> pa.RecordBatch:
    """Rows with the bounds of all parts, packed part by part."""
    def packed(name: str, kind) -> pa.Array:
        joined = np.ascontiguousarray(np.stack([np.asarray(getattr(p, name), dtype=kind).reshape(len(batch), -1) for p in bounds], axis=1))
        return pa.array([row.tobytes() for row in joined], type=pa.binary())
    columns = [batch.column("vec_id"), batch.column("label"), batch.column("vector"), packed("entry", np.uint8), packed("upper", np.float16), packed("near", np.uint8), packed("lower", np.float16)]
    return pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector", "entry", "upper", "near", "lower"])


def _unpacked(batch: pa.RecordBatch, parts: int) -> list[Bounds]:
    def matrix_of(name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), dtype=kind).reshape(len(batch), parts, -1)
    entry, upper, near, lower = matrix_of("entry", np.uint8), matrix_of("upper", np.float16), matrix_of("near", np.uint8), matrix_of("lower", np.float16)
    return [Bounds(entry[:, p, 0].astype(np.int64), upper[:, p, 0].copy(), near[:, p].astype(np.int64), lower[:, p].copy()) for p in range(parts)]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.slice(at, SLICE)


def _start(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts, entries, width = books.shape
    b = min(max(1, entries // 8), entries - 1)
    for batch in _slices(batches):
        x = matrix(batch.column("vector"), parts * width).reshape(len(batch), parts, width)
        yield _state(batch, [Bounds.measured(x[:, p], books[p], b) for p in range(parts)])


def _same_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of rows whose lists are equally long."""
    for batch in _slices(batches):
        lengths = np.array([len(n) for n in batch.column("near").to_pylist()])
        for length in np.unique(lengths):
            yield batch if (lengths == length).all() else batch.filter(pa.array(lengths == length))


def _moved(batches: Iterator[pa.RecordBatch], books: np.ndarray, moved: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts, entries, width = books.shape
    for batch in _same_lists(batches):
        x = matrix(batch.column("vector"), parts * width).reshape(len(batch), parts, width)
        bounds = _unpacked(batch, parts)
        depths = np.concatenate([p.move(x[:, i], books[i], moved[i]) for i, p in enumerate(bounds)])
        b = bounds[0].near.shape[1]
        used = int(np.quantile(depths, SETTLED, method="higher")) if len(depths) else 0
        for p in bounds:
            p.keep(min(b, max(entries // 16, used)))
        yield _state(batch, bounds)


def _sums(batches: Iterator[pa.RecordBatch], parts: int, entries: int, width: int) -> Iterator[pa.RecordBatch]:
    """(part, entry, place, total) of a task's rows; place -1 counts them."""
    totals = np.zeros((parts, entries, width + 1), dtype=np.int64)
    for batch in _slices(batches):
        x = matrix(batch.column("vector"), parts * width).reshape(len(batch), parts, width)
        entry = np.frombuffer(b"".join(batch.column("entry").to_pylist()), dtype=np.uint8).reshape(-1, parts)
        for p in range(parts):
            np.add.at(totals[p], entry[:, p], np.concatenate([x[:, p], np.ones((len(x), 1), dtype=np.int64)], axis=1))
    part, entry, place = np.nonzero(totals)
    columns = [part, entry, np.where(place == width, -1, place)]
    yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int32)) for c in columns), pa.array(totals[part, entry, place])], ["part", "entry", "place", "total"])


def _means(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Floored means of the parts of each entry; an entry without parts stays."""
    parts, entries, width = books.shape
    sums = state.select("vector", "entry").mapInArrow(lambda batches: _sums(batches, parts, entries, width), "part int, entry int, place int, total long")
    totals = np.zeros((parts, entries, width + 1), dtype=np.int64)
    for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect():  # at most a codebook
        totals[r.part, r.entry, r.place] = r.total
    counts = totals[:, :, -1:]
    return np.where(counts > 0, totals[:, :, :-1] // np.maximum(counts, 1), books)


def _coded(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[pa.RecordBatch]:
    parts, _, width = books.shape
    for batch in _slices(batches):
        x = matrix(batch.column("vector"), parts * width).reshape(len(batch), parts, width)
        packed = batch.column("entry").to_pylist()
        entry = np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(-1, parts)
        error = sum((_squares(x[:, p], books[p][entry[:, p]]) for p in range(parts)), np.zeros(len(x), dtype=np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([c.hex() for c in packed]), pa.array(error)], ["vec_id", "label", "code", "error"])


def fit(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """The codes (vec_id, label, code, error) and the codebooks (part, entry, place). Two hex digits
    per part: at most 256 entries."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits per part: 1 to 256 entries")
    spark = embeddings.sparkSession
    rows, width, number = whole_vectors(embeddings, "embedding", scale, [F.col("vec_id").cast("long").alias("vec_id"), F.col("label")], multiple=parts)
    kind = rows.schema["label"].dataType.simpleString()
    rows = rows.select("vec_id", "label", "vector")
    if not number:
        return spark.createDataFrame([], f"vec_id long, label {kind}, code string, error long"), np.zeros((parts, 0, 0), dtype=np.int64)
    first = [r.vector for r in rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()]
    books = np.array(first, dtype=np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2)
    schema = _STATE.format(label=kind)
    state = stage(rows.mapInArrow(lambda batches, books=books: _start(batches, books), schema), "codes")
    for _ in range(rounds):
        old, books, before = books, _means(state, books), state
        lengths = np.nextafter(np.sqrt(_squares(books, old)), np.inf)
        state = stage(state.mapInArrow(lambda batches, books=books, lengths=lengths: _moved(batches, books, lengths), schema), "codes")
        discard(before)
    return state.mapInArrow(lambda batches: _coded(batches, books), f"vec_id long, label {kind}, code string, error long"), books


def compress(embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row per kept row of ``embeddings``
    (vec_id, embedding, label)."""
    with scratch(embeddings.sparkSession):
        coded, books = fit(embeddings, parts, entries, scale, rounds)
        coded = stage(coded, "coded")
        digest = sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
        # staged, so that the rows of a hot label can be split in the join
        labels = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "own")
        whole = coded.join(labels, F.col("label").eqNullSafe(F.col("own")))
        return stage(whole.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")), "compressed", kept=True)
