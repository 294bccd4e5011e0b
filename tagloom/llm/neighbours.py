"""Approximate nearest neighbours: one hierarchical navigable small-world graph per shard.

Vectors are dealt to shards of about ``SHARD_ROWS`` distinct vectors by a hash, so a graph is built
and searched within one task of bounded memory. A graph is stored as a table: a row per node with
its vector, the ids that have it, and its neighbours on every level as flat arrays. Candidates for
links are found by blocked products within the shard; links are kept when they lead nearer than
the links already kept, run both ways, and every node can be reached from the entry.

A query descends greedily to the lowest level, searches it with a beam, and gets exact double
distances; the shards' results are merged by distance, then id. All queries of a block are
searched together. Query blocks are dealt to all shards of their vector length.

Defined cases: vectors that are null, zero or hold null or non-finite components take no part;
lengths are never mixed; equal vectors are one node with all its ids, of which the smallest
``k + 1`` can be needed; rows with a null id are no candidates and no queries; a query given twice
is answered twice; rows that have the query's own id are not its neighbours; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagloom.llm.embedding_dedup import usable
from tagloom.operators.staging import stage

SHARD_ROWS = 2048
QUERY_ROWS = 2048  # queries that are searched together
LINKS, LOWEST_LINKS = 16, 32  # most neighbours per node on upper levels and on the lowest
CANDIDATES = 96
BEAM = 128
_LEVEL_SCALE = 1 / np.log(LINKS)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, for search; results are measured anew."""
    return (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)


def _level_links(x: np.ndarray, most: int) -> np.ndarray:
    """Neighbours on one level, padded with -1."""
    n = len(x)
    wanted = min(CANDIDATES, n - 1)
    links = [[] for _ in range(n)]
    if wanted < 1:
        return np.full((n, most), -1, dtype=np.int32)
    for at in range(0, n, 512):
        d = _distances(x[at: at + 512], x)
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        near = np.argpartition(d, wanted - 1, axis=1)[:, :wanted]
        near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1), 1)
        for i, row in enumerate(near):
            between = _distances(x[row], x[row])
            reach, open_ = d[i, row], np.ones(len(row), dtype=bool)
            while open_.any() and len(links[at + i]) < most // 2:
                c = int(open_.argmax())  # the nearest that no kept neighbour is nearer to
                links[at + i].append(int(row[c]))
                open_ &= between[c] > reach
                open_[c] = False
    both = [dict.fromkeys(own) for own in links]
    for i, own in enumerate(links):
        for j in own:
            both[j].setdefault(i)
    # a node's own choices stay; links back to it fill up what is left, nearest first
    table = np.full((n, most), -1, dtype=np.int32)
    for i, all_ in enumerate(both):
        own, back = links[i], [j for j in all_ if j not in set(links[i])]
        back = [back[k] for k in np.argsort(((x[back] - x[i]) ** 2).sum(1), kind="stable")] if back else []
        kept = (own + back)[:most]
        table[i, : len(kept)] = kept
    return _connected(x, table)


def _connected(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Adds links from reached to unreached nodes until node 0 reaches all."""
    reached = np.zeros(len(x), dtype=bool)
    reached[0] = True
    front = np.array([0])
    while True:
        while len(front):
            nxt = np.unique(table[front])
            nxt = nxt[nxt >= 0]
            front = nxt[~reached[nxt]]
            reached[front] = True
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return table
        known = np.flatnonzero(reached)
        start = int(known[_distances(x[lost[:1]], x[known])[0].argmin()])
        free = np.flatnonzero(table[start] < 0)
        if not len(free):
            table = np.concatenate([table, np.full((len(table), 1), -1, dtype=np.int32)], axis=1)
            free = [table.shape[1] - 1]
        table[start, free[0]] = lost[0]
        reached[lost[0]] = True
        front = lost[:1]


def build(shard: pd.DataFrame) -> pd.DataFrame:
    """Graph rows of one shard of (width, shard, vector, ids)."""
    shard = shard.assign(key=shard["ids"].map(lambda ids: ids[0])).sort_values("key", ignore_index=True)
    x = np.array(shard["vector"].tolist(), dtype=np.float64)
    draws = np.random.default_rng(1).random(len(x))
    levels = np.floor(-np.log(1 - draws) * _LEVEL_SCALE).astype(int)
    links: list[list[np.ndarray]] = [[] for _ in range(len(x))]
    for level in range(levels.max() + 1):
        nodes = np.flatnonzero(levels >= level)
        nodes = np.concatenate([nodes[levels[nodes] == levels.max()][:1], nodes[nodes != nodes[levels[nodes] == levels.max()][0]]])  # the entry first
        table = _level_links(x[nodes], LOWEST_LINKS if level == 0 else LINKS)
        for node, row in zip(nodes, table):
            links[node].append(nodes[row[row >= 0]].astype("int32"))
    return pd.DataFrame({"width": shard["width"], "shard": shard["shard"], "node": np.arange(len(x), dtype="int32"), "vector": shard["vector"], "ids": shard["ids"], "links": links})


class Graph:
    """One shard's graph as flat arrays."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values("node", ignore_index=True)
        self.x = np.array(rows["vector"].tolist(), dtype=np.float64)
        self.ids = rows["ids"].tolist()
        links = rows["links"].tolist()
        depth = np.fromiter(map(len, links), dtype=int, count=len(links))
        self.entry = int(depth.argmax())
        self.tables = []
        for level in range(depth.max()):
            width = max(1, max(len(own[level]) for own in links if len(own) > level))
            table = np.full((len(links), width), -1, dtype=np.int64)
            for i, own in enumerate(links):
                if len(own) > level:
                    table[i, : len(own[level])] = own[level]
            self.tables.append(table)

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """Nodes nearest to each query, nearest first, padded with -1."""
        q, n = len(queries), len(self.x)
        at = np.full(q, self.entry)
        best = self._far(queries, at[:, None])[:, 0]
        for table in self.tables[:0:-1]:
            moved = np.ones(q, dtype=bool)
            while moved.any():
                around = table[at]
                far = self._far(queries, around)
                nearest = far.argmin(axis=1)
                lower = far[np.arange(q), nearest]
                moved = lower < best
                at = np.where(moved, around[np.arange(q), nearest], at)
                best = np.where(moved, lower, best)
        beam = min(beam, n)
        nodes, far = np.full((q, beam), -1), np.full((q, beam), np.inf)
        nodes[:, 0], far[:, 0] = at, best
        done = np.ones((q, beam), dtype=bool)
        done[:, 0] = False
        seen = np.zeros((q, n), dtype=bool)
        seen[np.arange(q), at] = True
        rows = np.arange(q)
        while len(rows):
            nearest = np.where(done[rows], np.inf, far[rows]).argmin(axis=1)
            done[rows, nearest] = True
            around = self.tables[0][nodes[rows, nearest]]
            around = np.where((around >= 0) & ~seen[rows[:, None], around], around, -1)
            r, c = np.nonzero(around >= 0)
            seen[rows[r], around[r, c]] = True
            new = self._far(queries[rows], around)
            all_far = np.concatenate([far[rows], new], axis=1)
            order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            far[rows] = np.take_along_axis(all_far, order, 1)
            nodes[rows] = np.take_along_axis(np.concatenate([nodes[rows], around], axis=1), order, 1)
            done[rows] = np.take_along_axis(np.concatenate([done[rows], around < 0], axis=1), order, 1)
            rows = rows[~done[rows].all(axis=1)]
        return nodes

    def _far(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        d = self.x[nodes] - queries[:, None, :]
        return np.where(nodes >= 0, np.einsum("qcd,qcd->qc", d, d), np.inf)


def _answer(graph_rows: pd.DataFrame, queries: pd.DataFrame, k: int, beam: int) -> pd.DataFrame:
    out = []
    if len(graph_rows) and len(queries):
        graph = Graph(graph_rows)
        wanted = np.array(queries["vector"].tolist(), dtype=np.float64)
        nodes = graph.search(wanted, max(beam, k + 1))
        for row, query_id, vector, found in zip(queries["query_row"], queries["query_id"], wanted, nodes):
            found = found[found >= 0]
            score = np.sqrt(((graph.x[found] - vector) ** 2).sum(axis=1))
            own = [(s, i) for s, node in zip(score.tolist(), found) for i in graph.ids[node] if i != query_id]
            out += [(row, query_id, i, s) for s, i in sorted(own)[:k]]
    return pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "score"])


def build_index(vectors: DataFrame, k: int) -> DataFrame:
    """The graph table over (vec_id, vector)."""
    low = F.slice(F.array_sort(F.collect_set("vec_id")), 1, k + 1)
    # ids of equal vectors are cut to the k + 1 smallest in two steps, so that no group of copies meets whole
    salted = vectors.groupBy("vector", F.pmod(F.xxhash64("vec_id"), F.lit(256)).alias("salt")).agg(low.alias("some"))
    nodes = stage(salted.groupBy("vector").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("some")))), 1, k + 1).alias("ids")).withColumn("width", F.size("vector")), "nodes")
    sizes = F.broadcast(nodes.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards")))  # a row per vector length
    dealt = nodes.join(sizes, "width").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")).cast("int"))
    schema = "width int, shard int, node int, vector array<double>, ids array<long>, links array<array<int>>"
    return stage(dealt.select("width", "shard", "vector", "ids").groupBy("width", "shard").applyInPandas(build, schema), "graph")


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries (query_id, vector)."""
    known = stage(queries.select("query_id", "vector", F.size("vector").alias("width"), F.monotonically_increasing_id().alias("query_row")), "queries")
    blocks = -(-known.count() // QUERY_ROWS)
    if blocks == 0:
        return known.select("query_id", F.lit(0).alias("rank"), F.col("query_id").alias("vec_id"), F.lit(0.0).alias("score"))
    sizes = F.broadcast(index.groupBy("width").agg((F.max("shard") + 1).alias("shards")))  # a row per vector length
    asked = known.join(sizes, "width").withColumn("block", F.pmod(F.xxhash64("query_row"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    graphs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["width", "shard", "block"]
    found = graphs.groupBy(*keys).cogroup(asked.select(*keys, "query_row", "query_id", "vector").groupBy(*keys)).applyInPandas(
        lambda g, q: _answer(g, q, k, beam), "query_row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """The k nearest other rows of every query row of ``embeddings`` (vec_id, embedding)."""
    vector = F.col("embedding").cast("array<double>")
    vectors = stage(embeddings.where(usable(F.col("embedding"))).where("vec_id IS NOT NULL").select("vec_id", vector.alias("vector"), is_query.alias("asks")), "vectors")
    index = build_index(vectors.select("vec_id", "vector"), k)
    return search(index, vectors.where("asks").select(F.col("vec_id").alias("query_id"), "vector"), k)
