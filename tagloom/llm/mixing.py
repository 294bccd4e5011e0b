"""Mixing sources to target weights by Pareto order sampling.

Sources get shares of the total size by their weights, capped at a multiple of their own size.
A document is expected ``target / source size`` times in the mix: the whole part of that is
allocated for certain, the rest is drawn. Every document gets the rank

    (u / (1 - u)) / (p / (1 - p))

with u a hash of its id and p its inclusion probability, and each source takes documents in
rank order until the words it still lacks are reached: a fixed-size sample in words. With
``appeal`` the inclusion probabilities within a source are unequal, in proportion to it.

The cut is found from histograms over the ranks, pre-aggregated per source: no source, however
large, is ordered in one task. Only documents of the one fine rank cell that holds the cut are
ordered exactly.

Defined cases: a null or empty text has size 0, is never wanted for words, and gets the certain
copies only; a null source is a source of its own, last in order; a null document id draws like
the text ``null``; equal ranks are taken by id, then size; repeated rows are separate documents;
an empty table gives an empty mix; columns of other names are kept out of the way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagloom.operators.numbering import numbered
from tagloom.operators.staging import stage

CAP = 3.0  # a source, and so a document, is repeated at most so often
CELLS = 4096  # rank cells per source and level
LEAST, MOST = 1e-9, 1 - 1e-9  # bounds of the drawn inclusion probabilities

SIZE = r"cast(coalesce(regexp_count(text, '[^\\x20\\x09-\\x0D]+'), 0) as bigint)"


def rotating_weights(sources: DataFrame) -> DataFrame:
    """Sources by code point, null last, weigh 1, 2, 3, 1, 2, 3, ..."""
    placed = numbered(sources, [F.col("source").asc_nulls_last()], "place")
    return placed.withColumn("weight", (F.col("place") % 3 + 1).cast("double")).drop("place")


def targets(sources: DataFrame, cap: float = CAP) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size, weight).

    The shared rate is raised until the targets, each at most ``cap`` times its source, add up
    to the total size. Every round fixes the sources that have reached their cap; one row of
    sums per round reaches the driver.
    """
    limit = F.col("source_size") * F.lit(cap)
    total = None
    rate, fixed = 0.0, -1
    while True:
        full = limit < F.col("weight") * F.lit(rate)
        sums = sources.agg(F.sum("source_size"), F.count_if(full), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("weight")))).first()
        total = sums[0] if total is None else total
        if sums[1] == fixed or not sums[3]:
            break
        fixed = sums[1]
        rate = ((total or 0) - (sums[2] or 0.0)) / sums[3]
    return sources.withColumn("target", F.least(limit, F.col("weight") * F.lit(rate)))


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) from a hash of the key: the same on every run and in other engines."""
    digits = F.substring(F.md5(F.concat_ws("#", F.coalesce(key.cast("string"), F.lit("null")), F.lit(str(seed)))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def mix(documents: DataFrame, weights=rotating_weights, cap: float = CAP, appeal: Column | None = None, seed: int = 7, keep: Sequence[str] = ()) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken) and ``keep``, one row per document.

    ``weights`` turns (source, source_size) rows into (source, source_size, weight) rows.
    """
    drawn = documents.select("doc_id", "source", F.expr(SIZE).alias("size"), (F.lit(1.0) if appeal is None else appeal.cast("double")).alias("appeal"), *keep)
    sized = stage(drawn, "sizes")
    appealing = F.col("appeal") * F.col("size")
    # sums of equal appeal stay exact: they are sums of longs
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(F.col("size") if appeal is None else appealing).alias("appeal_size"))
    sources = stage(sums, "sources")
    aimed = stage(targets(weights(sources), cap), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    plan = aimed.withColumn("whole", F.floor(ratio)).withColumn("part", ratio - F.floor(ratio)) \
        .withColumn("lacking", F.col("target") - F.col("whole") * F.col("source_size")).withColumnRenamed("source", "__source")
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")

    fair = F.coalesce(F.col("source_size") / F.col("appeal_size"), F.lit(1.0))
    p = F.greatest(F.lit(LEAST), F.least(F.lit(MOST), F.col("part") * F.col("appeal") * fair))
    u = uniform(F.col("doc_id"), seed)
    # the rank q is kept as q / (1 + q), which grows with it and lies between 0 and 1
    rank = (u * (1 - p)) / (u * (1 - p) + p * (1 - u))
    fine = F.least(F.floor(rank * (CELLS * CELLS)), F.lit(CELLS * CELLS - 1)).cast("long")
    ranked = stage(joined.withColumn("rank", rank).withColumn("cell", fine), "ranked").withColumn("coarse", F.floor(F.col("cell") / CELLS))

    coarse = _cut(ranked.groupBy("source", "coarse", "lacking").agg(F.sum("size").alias("cell_size")), "coarse")
    found = coarse.select(F.col("source").alias("__source"), F.col("coarse").alias("__coarse"), "before")
    inside = F.col("source").eqNullSafe(F.col("__source")) & (F.col("coarse") == F.col("__coarse"))
    finer = ranked.join(found, inside).withColumn("lacking", F.col("lacking") - F.col("before"))
    at = stage(_cut(finer.groupBy("source", "cell", "lacking").agg(F.sum("size").alias("cell_size")), "cell"), "cuts")

    # documents before the cut cell are in, those after it out; within the cell they are taken in
    # rank order, and the one that crosses the line when that comes nearer to it
    cut = at.select(F.col("source").alias("__source"), F.col("cell").alias("cut"), F.col("lacking").alias("left"), F.col("before").alias("passed"))
    marked = ranked.join(cut, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    order = Window.partitionBy("source", "cell").orderBy("rank", "doc_id", "size")
    cell = marked.where("cell = cut").withColumn("sum", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    middle = F.col("sum") - F.col("size") / 2 <= F.col("left") - F.col("passed")
    inside = cell.withColumn("drawn", (middle & (F.col("size") > 0)).cast("int")).drop("sum")
    outside = marked.where("cut IS NULL OR cell <> cut").withColumn("drawn", F.coalesce(((F.col("cell") < F.col("cut")) & (F.col("size") > 0)).cast("int"), F.lit(0)))
    copies = F.col("whole") + F.col("drawn")
    return inside.unionByName(outside).select("doc_id", "size", "source", "source_size", "target", copies.cast("long").alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), *keep)


def _cut(cells: DataFrame, by: str) -> DataFrame:
    """Per source the cell in which the running size passes what is lacking, with the size
    ``before`` it. At most CELLS rows per source meet in a task."""
    order = Window.partitionBy("source").orderBy(by)
    run = F.coalesce(F.sum("cell_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    summed = cells.withColumn("before", run).where("lacking > 0 AND before < lacking AND before + cell_size >= lacking")
    return summed.select("source", by, "lacking", "before")
