"""Exact top-k by inner product: a uniform threshold in three phases.

Components are cut into ``LISTS`` consecutive slices. A slice is a list: for a query it scores every
candidate by its part of the inner product. No list holds a whole score, so the best of one list
need not be the best of the sum.

1. Gather: of every list the best few entries of every block of candidates are resolved to whole
   scores. The k-th best score gathered for a query is its cutoff; the true k-th best is not lower.
2. Collect: the cutoff goes with the query to every block of candidates. A sum of ``LISTS`` parts that
   reaches the cutoff has a part that reaches cutoff / ``LISTS``, so each list gives up just the
   entries that do, ties included.
3. Resolve: the other parts of those entries are added, and what falls short of the cutoff is
   dropped. The k best of a block, then of all blocks, are the result.

Queries and candidates are dealt to blocks by row; a task takes one block of each and holds their
products only, so memory is bounded and a lost task is redone alone. The pairs of a block never
leave their task: it returns at most k entries for a query. Queries are a share of the table, so
the products of the two grow with both; that is the stated work.

Numbers are whole (see ``vectors``), sums exact. Defined cases: vectors that are null or hold null or
non-finite components take no part; shorter vectors count as ending in zeros, an empty one as
all zeros; a query is left out of its own list by its row, so another row with its id can be in
it; a query given twice is answered twice; equal scores go to the smaller id, null ids last; a row
whose id is null can be found but asks nothing; an empty table gives an empty result; a component
of 2^24 / scale or more is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagloom.llm.vectors import matrix, products, whole_vectors
from tagloom.operators.staging import scratch, stage

LISTS = 2
QUERY_ROWS, CANDIDATE_ROWS = 2048, 8192  # rows of a block, about; a task holds their products
LEAST_ROWS = 256  # smaller blocks are not worth a task
BLOCKS = 64  # so many blocks of candidates at least, as far as there are rows for them
GATHERED = 4  # entries that all blocks of a list give in the first phase, as a multiple of k
SLICE = 256  # queries scored at a time

_FOUND = pa.schema([("query_row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _slices(width: int) -> list[slice]:
    edges = [width * i // LISTS for i in range(LISTS + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def _first_per_query(query: np.ndarray, score: np.ndarray, ids: np.ndarray, lost: np.ndarray, most: int) -> np.ndarray:
    """Places of the best entries of each query: high scores first, then small ids, null ids last."""
    order = np.lexsort((ids, lost, -score, query))
    sorted_ = query[order]
    begins = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]]) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.r_[begins, len(order)]))
    return order[rank < most]


def _searched(queries: pa.Table, candidates: pa.Table, width: int, most: int, gather: int | None) -> pa.Table:
    """Entries of a block of queries and a block of candidates: the ``gather`` best of every list,
    or, without, those that reach the queries' cutoffs, at most ``most`` for a query."""
    if not len(queries) or not len(candidates):
        return _FOUND.empty_table()
    x, y = matrix(queries["vector"], width), matrix(candidates["vector"], width)
    asking, offered = np.asarray(queries["row"]), np.asarray(candidates["row"])
    lost = np.asarray(candidates["vec_id"].is_null())
    ids = np.asarray(candidates["vec_id"].fill_null(0))
    cutoffs = None if gather else np.asarray(queries["cutoff"].fill_null(np.iinfo(np.int64).min))
    found = []
    for at in range(0, len(x), SLICE):
        part = slice(at, at + SLICE)
        lists = [products(x[part, s], y[:, s]) for s in _slices(width)]
        own = asking[part, None] == offered[None, :]
        chosen = np.zeros(own.shape, dtype=bool)
        for scores in lists:
            if gather is None:
                chosen |= scores >= (cutoffs[part, None] + LISTS - 1) // LISTS
            elif gather >= len(y):
                chosen[:] = True
            else:
                best = np.argpartition(-scores, gather - 1, axis=1)[:, :gather]
                np.put_along_axis(chosen, best, True, axis=1)
        i, j = np.nonzero(chosen & ~own)
        score = sum(scores[i, j] for scores in lists)
        if gather is None:
            enough = score >= cutoffs[part][i]
            i, j, score = i[enough], j[enough], score[enough]
        kept = _first_per_query(i, score, ids[j], lost[j], most)
        i, j = i[kept], j[kept]
        found.append(pa.table([pa.array(asking[part][i]), pa.array(ids[j], mask=lost[j]), pa.array(score[kept])], schema=_FOUND))
    return pa.concat_tables(found)


def _blocks(rows: int, size: int, least: int) -> int:
    return max(1, -(-rows // size), min(least, rows // LEAST_ROWS))


def _in_blocks(queries: DataFrame, candidates: DataFrame, across: int, down: int, search) -> DataFrame:
    """``search`` over every block of queries and every block of candidates."""
    def dealt(rows: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        fresh = rows.select(*[F.col(c).alias(c) for c in rows.columns])  # both sides come of one table
        placed = fresh.withColumn(own, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).groupBy("across", "down")
    asked, offered = dealt(queries, "across", across, "down", down), dealt(candidates, "down", down, "across", across)
    return asked.cogroup(offered).applyInArrow(search, "query_row long, vec_id long, score long")


def search(vectors: DataFrame, is_query: Column, k: int, scale: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` (vec_id, embedding) with the highest
    inner products with each row for which ``is_query`` holds; components count as floor(scale * x)."""
    columns = [F.col("vec_id").cast("long").alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks")]
    with scratch(vectors.sparkSession):
        rows, width, number = whole_vectors(vectors, "embedding", scale, columns)
        queries = rows.where("asks").select("row", "vector")
        candidates = rows.select("row", "vec_id", "vector")
        across, down = _blocks(queries.count(), QUERY_ROWS, 1), _blocks(number, CANDIDATE_ROWS, BLOCKS)
        gather = 1 + min(k, max(1, -(-GATHERED * k // down)))  # one more, which may be the query itself

        gathered = _in_blocks(queries, candidates, across, down, lambda q, c: _searched(q, c, width, most=gather * LISTS, gather=gather))
        best = gathered.withColumn("rank", F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score")))).where(F.col("rank") <= k)
        # fewer than k gathered: no cutoff, everything is collected
        cutoffs = best.groupBy("query_row").agg(F.when(F.count(F.lit(1)) == k, F.min("score")).alias("cutoff"))
        cutoffs = stage(cutoffs, "cutoffs")

        aimed = queries.join(cutoffs.withColumnRenamed("query_row", "row"), "row", "left")
        collected = _in_blocks(aimed, candidates, across, down, lambda q, c: _searched(q, c, width, most=k, gather=None))
        order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
        ranked = collected.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        named = ranked.join(rows.where("asks").select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id")), "query_row")
        return stage(named.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "topk", kept=True)
