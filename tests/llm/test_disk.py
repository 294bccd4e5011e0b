"""What the text operators leave on disk while they run, and the join of windows with their first holders."""

from __future__ import annotations

import time
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import jaccard, passages
from tagloom.operators.staging import scratch, stage
from tagloom.session import shared_dir


def _shuffle_files(spark) -> int:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    with scratch(spark):
        rows = spark.range(1000).withColumn("k", F.col("id") % 7)
        counted = stage(rows.groupBy("k").count(), "counted")
        until = time.time() + 20  # files go a moment after the query
        while _shuffle_files(spark) > before and time.time() < until:
            time.sleep(0.2)
        assert _shuffle_files(spark) <= before
        assert counted.count() == 7


def test_staging_keeps_the_sessions_setting(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with scratch(spark):
        stage(spark.range(3), "three")
    assert spark.conf.get(name, None) == before


def _folders(spark) -> set[str]:
    return {p.name.rsplit("-", 1)[0] for p in Path(shared_dir(spark).removeprefix("file:")).glob("*")}


def test_tables_of_the_join_go_when_they_are_read_no_more(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = spark.createDataFrame([(i, f"{text} end{i}" if i < 20 else f"other words of text {i} alone") for i in range(30)], "doc_id long, text string")
    with scratch(spark):
        before = _folders(spark)
        edges = jaccard.links(jaccard.Join(rows))
        assert not (_folders(spark) - before) & {"classes", "postings", "sets"}
        assert {x for row in edges.collect() for x in (row.a, row.b)} == set(range(20))


def _rows(seed: int, n: int, keys: int, texts: int) -> list[tuple]:
    draw = np.random.default_rng(seed)
    found = {(int(k), int(d), int(d % 3 == 0), int(p)) for k, d, p in zip(draw.integers(0, keys, n), draw.integers(0, texts, n), draw.integers(0, 4, n))}
    return sorted(found)


def _brute_force(rows: list[tuple], others_only: bool) -> list[tuple]:
    by_key = defaultdict(list)
    for row in sorted(rows):
        by_key[row[0]].append(row)
    out = []
    for held in by_key.values():
        keeper = held[0][1:]
        if any(r[1:3] != keeper[:2] for r in held):
            out += [(*r, len(held) > 2, *keeper) for r in held if not others_only or r[1:3] != keeper[:2]]
    return sorted(out)


@pytest.mark.parametrize("others_only", [False, True])
@pytest.mark.parametrize("keys, size, most", [(200, 7, 1 << 16), (40, 1, 5), (3, 16, 10), (1, 5, 3), (25, 1000, 1)])
def test_first_holders_of_sorted_rows_in_batches_of_any_size(keys, size, most, others_only):
    rows = _rows(keys, 400, keys, 30)
    columns = [np.array(c, dtype=t) for c, t in zip(zip(*rows), ("i8", "i8", "i8", "i4"))]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[at: at + size]) for c in columns], ["key", "doc_id", "part", "place"]) for at in range(0, len(rows), size)]
    got = [tuple(r.values()) for b in passages._with_keepers(iter([batches[0].slice(0, 0), *batches]), others_only, most) for r in b.to_pylist()]
    assert sorted(got) == _brute_force(rows, others_only)


def test_no_rows_have_no_first_holders():
    assert not list(passages._with_keepers(iter([]), False))


@pytest.mark.parametrize("others_only", [False, True])
def test_crowded_keys_have_the_same_first_holders(spark, others_only):
    rows = [*_rows(5, 500, 300, 80), *((1000, d, 0, p) for d in range(90) for p in (1, 2))]  # key 1000 is crowded
    with scratch(spark):
        table = spark.createDataFrame(rows, "key long, doc_id long, part long, place int").repartition(3)
        got = sorted(tuple(r) for r in passages._held(table, others_only).collect())
    assert got == _brute_force(rows, others_only)


def test_runs_within_one_found_span_are_not_open():
    import pandas as pd

    text = " ".join(f"w{i}" for i in range(60))
    frame = pd.DataFrame({"doc_id": [1, 2], "part": [0, 0], "text": [text, text], "stretches": [np.array([0, 59])] * 2, "spans": [np.array([30, 59, 0, 34]), None]})
    got = pd.concat(passages._equal_runs(iter([frame]), [10]))
    open_ = got[(got.doc_id == 1) & got.open].place.tolist()
    assert open_ == [p for p in range(51) if not (p + 9 <= 34 or p >= 30)]
    assert got[got.doc_id == 2].open.all() and len(got) == 2 * 51
