"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagloom.operators.staging import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst): the smallest node it reaches.

    Alternates large-star steps (every node hands its larger neighbours to its smallest one)
    and small-star steps (its smaller neighbours likewise) until the edges no longer change.
    The edges then are one star per component. Edges never grow in number; every step is a
    pre-aggregated minimum per node and a join whose hot nodes Spark can split, and is staged
    in the shared folder. Rows with a null end are left out; self-loops only name a node.
    """
    # nodes met only in self-loops stay alone; their rows ride along as (node, node)
    pairs = stage(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "edges")
    nodes = pairs.select(F.col("src").alias("node")).unionByName(pairs.select(F.col("dst").alias("node"))).distinct()
    links = pairs.where("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct()
    last = None
    while True:
        links = stage(_small_star(stage(_large_star(links), "large-star")), "small-star")
        now = tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst")), F.sum(F.xxhash64("dst", "src").bitwiseAND(F.lit(0xFFFFFFFF)))).first())
        if now == last:
            break
        last = now
    return nodes.join(links.select(F.col("src").alias("node"), "dst"), "node", "left").select("node", F.coalesce("dst", "node").alias("component"))


def _smallest(sides: DataFrame) -> DataFrame:
    """The smallest of a node and its neighbours; staged, so that both sides of the join that
    follows have an exchange of their own and a hot node can be split."""
    return stage(sides.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low")).withColumn("low", F.least("node", "low")), "lows")


def _large_star(links: DataFrame) -> DataFrame:
    sides = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    joined = sides.where("dst > src").join(_smallest(sides), F.col("src") == F.col("node"))
    return joined.select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` run from a node to a smaller one."""
    joined = links.join(_smallest(links), F.col("src") == F.col("node"))
    moved = joined.select(F.col("dst").alias("src"), F.col("low").alias("dst")).where("src <> dst")
    return moved.unionByName(joined.select("src", F.col("low").alias("dst"))).distinct()
