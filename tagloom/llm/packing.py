"""Best-fit packing of texts into sequences of several permitted lengths.

Pieces are placed longest first into the open bin they fill best. When none has room, a bin of
the size with the least cost per word still to come is opened; at the end every bin is cut down
to the smallest permitted length that holds its contents. Each shard tries this opening rule and
the rules that open bins of at least one given length, and keeps the cheapest plan.

Texts longer than the longest sequence are cut into full pieces and a rest, so no word is lost.
Texts are dealt to shards of about ``PIECES`` pieces by a hash, so a shard is packed within one
task of bounded memory and the loss at shard ends stays below a bin of each length per shard.
Equal rows share a hash: where they alone would fill a shard, they are dealt by a seeded draw.

Defined cases: a null or empty text has length 0 and gets one row without a bin; null ids are
kept; equal lengths are placed by id, then piece; repeated rows are packed separately; an empty
table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tagloom.operators.staging import stage

CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 32  # what a sequence costs besides its length
PIECES = 4096  # pieces per shard, about
WORD = r"[^\x20\x09-\x0D]+"
LENGTH = rf"cast(coalesce(regexp_count(text, '{WORD}'), 0) as bigint)".replace("\\", "\\\\")


def _place(lengths: Sequence[int], opened) -> tuple[list[int], list[int]]:
    """Bin of every piece (longest first) and the contents of every bin."""
    room: list[tuple[int, int]] = []  # (free words, bin), ascending
    bins, contents = [], []
    for i, length in enumerate(lengths):
        at = bisect_left(room, (length, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = opened(i, length), len(contents)
            contents.append(0)
        contents[b] += length
        bins.append(b)
        insort(room, (free - length, b))
    return bins, contents


def best_fit(lengths: Sequence[int], capacities: Sequence[int], overhead: int) -> tuple[list[int], list[int]]:
    """Bins of the pieces, which come longest first, and the downsized capacity of every bin."""
    sizes = sorted(capacities)
    left = np.cumsum(np.asarray(lengths, dtype=np.int64)[::-1])[::-1]  # words from here on

    def cheapest(i: int, length: int) -> int:
        return min((c for c in sizes if c >= length), key=lambda c: ((c + overhead) / min(c, int(left[i])), c))

    def at_least(size: int):
        return lambda i, length: next(c for c in sizes if c >= max(size, length))

    best = None
    for rule in [cheapest, *map(at_least, sizes)]:
        bins, contents = _place(lengths, rule)
        cut = [sizes[bisect_left(sizes, c)] for c in contents]
        cost = sum(cut) + overhead * len(cut)
        if best is None or cost < best[0]:
            best = (cost, bins, cut)
    return best[1:]


def pack(documents: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD, length: str = LENGTH) -> DataFrame:
    """(doc_id, part, first, length, bin, capacity, place): every piece of every text, the word it
    begins with, its sequence, that sequence's length and the piece's first place in it."""
    longest = max(capacities)
    measured = stage(documents.select("doc_id", F.expr(length).alias("__words"), F.xxhash64("doc_id", "text").alias("__draw")), "measured")
    cut_into = F.greatest(F.lit(1), F.ceil(F.col("__words") / longest))
    hot = measured.groupBy("__draw").agg(F.sum(cut_into).alias("__pieces"), F.count(F.lit(1)).alias("__rows")).where(f"__rows > 1 AND __pieces > {PIECES // 4}")
    hot = hot.select(F.col("__draw").alias("__hot"), F.lit(True).alias("__many"))
    dealt = F.when(F.col("__many"), F.xxhash64("__draw", F.rand(7))).otherwise(F.col("__draw"))
    measured = stage(measured.join(hot, F.col("__draw") == F.col("__hot"), "left").select("doc_id", "__words", dealt.alias("__draw")), "dealt")
    # every text is cut by its own length only: one row per piece
    cuts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.col("__words") - 1) / longest)).cast("int"))
    pieces = measured.select("doc_id", "__words", "__draw", F.explode(cuts).alias("part"))
    pieces = pieces.select("doc_id", "part", (F.col("part") * F.lit(longest)).cast("long").alias("first"),
                           F.least(F.lit(longest), F.col("__words") - F.col("part") * longest).cast("int").alias("length"), F.xxhash64("__draw", "part").alias("draw"))
    total = measured.agg(F.sum(cut_into)).first()[0] or 0
    shards = max(1, -(-int(total) // PIECES))
    schema = "doc_id {}, part int, first long, length int, bin long, capacity int, place int".format(documents.schema["doc_id"].dataType.simpleString())
    filled = pieces.where("length > 0").withColumn("shard", F.pmod("draw", F.lit(shards)))

    def packed(shard: pd.DataFrame) -> pd.DataFrame:
        rows = shard.sort_values(["length", "doc_id", "part"], ascending=[False, True, True], na_position="last", ignore_index=True)
        bins, cut = best_fit(rows["length"].tolist(), capacities, overhead)
        rows["bin"] = (int(rows["shard"].iloc[0]) << 32) + np.asarray(bins, dtype=np.int64)
        rows["capacity"] = np.asarray(cut, dtype=np.int32)[bins]
        rows["place"] = (rows.groupby("bin")["length"].cumsum() - rows["length"]).astype("int32")
        return rows[["doc_id", "part", "first", "length", "bin", "capacity", "place"]]

    empty = pieces.where("length = 0").select("doc_id", "part", "first", "length", F.lit(None).cast("long").alias("bin"), F.lit(None).cast("int").alias("capacity"), F.lit(None).cast("int").alias("place"))
    return filled.groupBy("shard").applyInPandas(packed, schema).unionByName(empty)


def sequences(documents: DataFrame, packing: DataFrame) -> DataFrame:
    """(bin, capacity, words, text): the packed sequences with their words in order. Ids must be
    unique here. At most ``capacity`` words meet in one row."""
    words = documents.select("doc_id", F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)).alias("__words"))
    pieces = packing.where("bin IS NOT NULL").join(words, "doc_id")
    piece = F.struct("place", F.array_join(F.slice("__words", F.col("first").cast("int") + 1, F.col("length")), " ").alias("text"))
    gathered = pieces.groupBy("bin", "capacity").agg(F.sum("length").cast("int").alias("words"), F.array_sort(F.collect_list(piece)).alias("pieces"))
    return gathered.select("bin", "capacity", "words", F.array_join("pieces.text", " ").alias("text"))
