"""Vector codes, phrase collocations and exact top-k search against brute force, and their edge cases."""

import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import rows_of
from conftest import SMALL
from tagloom.llm import codes, phrases, topk

VECTORS = "vec_id long, embedding array<double>, label int, row string, vector string, rank string"
NAN, INF = float("nan"), float("inf")


def _table(spark, rows):
    return spark.createDataFrame([(i, v, l, "clash", "clash", "clash") for i, v, l in rows], VECTORS)


def _usable(rows):
    kept = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    return kept, max([len(v) for _, v, _ in kept], default=0)


EDGES = [(5, [.5, -.25, 1.0], 1), (5, [.5, -.25, 1.0], 1), (40, [.5], None), (None, [1.0, 1.0, 1.0, 1.0], None), (20, [], 2), (60, [0.0, 0.0], 2),
         (7, None, 1), (8, [1.0, None], 1), (9, [NAN], 1), (10, [INF], 1), (-20, [-1.0, -1.0, .003], 3), (-20, [-1.0, -1.0, .003], 3), (1, [-.001, .001], None)]


def _random(n, width, seed, ties):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(max(2, n // 40), width))
    x = centres[draw.integers(len(centres), size=n)] + draw.normal(size=(n, width)) * .2
    x = np.round(x * ties) / ties if ties else x
    return [(int(i), [float(c) for c in v], int(i % 7) if i % 5 else None) for i, v in zip(draw.permutation(n), x)]


# ---- op13 -------------------------------------------------------------------------

def _topk_brute(rows, k, scale=64, every=20):
    kept, width = _usable(rows)
    whole = np.array([[int(np.floor(scale * x)) for x in v] + [0] * (width - len(v)) for _, v, _ in kept], dtype=np.int64).reshape(len(kept), width)
    out = []
    for q, (i, _, _) in enumerate(kept):
        if i is not None and i % every == 0:
            scores = whole @ whole[q]
            order = sorted((c for c in range(len(kept)) if c != q), key=lambda c: (-scores[c], kept[c][0] is None, kept[c][0] or 0))[:k]
            out += [(i, r + 1, kept[c][0], int(scores[c])) for r, c in enumerate(order)]
    return out


def _same(found, expected):
    columns = found.columns
    assert rows_of(columns, [tuple(r) for r in found.collect()]) == rows_of(columns, expected)


@pytest.mark.parametrize("rows", [EDGES, _random(700, 6, 1, 4), _random(900, 9, 2, 0)], ids=["edges", "ties", "spread"])
@pytest.mark.parametrize("k", [3, 20])
def test_topk(spark, monkeypatch, rows, k):
    monkeypatch.setattr(topk, "LEAST_ROWS", 60)  # several blocks in a small table
    monkeypatch.setattr(topk, "QUERY_ROWS", 20)
    found = topk.search(_table(spark, rows), F.expr("vec_id % 20 = 0"), k, 64)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    _same(found, _topk_brute(rows, k))


def test_topk_collects_no_more_than_the_cutoff_asks(monkeypatch):
    """A list gives up only entries whose part reaches an equal share of the cutoff."""
    x = np.random.default_rng(3).integers(-50, 50, size=(300, 8))
    table = topk.pa.table({"row": np.arange(300), "vec_id": np.arange(300), "vector": list(x.astype(np.int32)), "cutoff": np.full(300, 4000)})
    found = topk._searched(table, table, 8, 300, None).to_pydict()
    scores = x @ x.T
    np.fill_diagonal(scores, -1)
    assert sorted(zip(found["query_row"], found["vec_id"])) == sorted(zip(*(a.tolist() for a in np.nonzero(scores >= 4000))))


def test_topk_of_nothing(spark):
    assert topk.search(_table(spark, []), F.expr("vec_id % 20 = 0"), 20, 64).count() == 0
    assert topk.search(_table(spark, [(1, [1.0], 1)]), F.expr("vec_id % 20 = 0"), 20, 64).count() == 0
    with pytest.raises(Exception, match="not below"):
        topk.search(_table(spark, [(20, [1e300], 1)]), F.expr("vec_id % 20 = 0"), 20, 64).count()


# ---- op11 -------------------------------------------------------------------------

def _codes_brute(rows, parts, entries, rounds, scale=256):
    kept, width = _usable(rows)
    width = -(-width // parts) * parts
    kept = [(i, [int(np.floor(scale * x)) for x in v] + [0] * (width - len(v)), l) for i, v, l in kept]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = width // parts
    x = np.array([v for _, v, _ in kept], dtype=object).reshape(len(kept), parts, w)
    books = [[list(x[e, p]) for e in range(min(entries, len(kept)))] for p in range(parts)]

    def assigned():
        best = []
        for row in x:
            best.append([min((sum((a - b) ** 2 for a, b in zip(row[p], e)), n) for n, e in enumerate(books[p])) for p in range(parts)])
        return best
    for _ in range(rounds):
        best = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [x[r, p] for r in range(len(x)) if best[r][p][1] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine)]
    best = assigned()
    errors = [sum(d for d, _ in b) for b in best]
    totals = Counter()
    for (_, _, l), e in zip(kept, errors):
        totals[l] += e
    digest = sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return [(i, "".join(f"{n:02x}" for _, n in b), e, totals[l], digest) for (i, _, l), b, e in zip(kept, best, errors)]


@pytest.mark.parametrize("rows,parts,entries,rounds", [(EDGES, 2, 64, 2), (EDGES, 1, 2, 3), (_random(400, 8, 4, 2), 4, 16, 2), (_random(600, 10, 5, 0), 3, 24, 4), (_random(80, 4, 6, 1), 2, 1, 2)],
                         ids=["edges", "few entries", "ties", "spread", "one entry"])
def test_codes(spark, rows, parts, entries, rounds):
    found = codes.compress(_table(spark, rows), parts, entries, 256, rounds)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    _same(found, _codes_brute(rows, parts, entries, rounds))


def test_bounds_hold_and_save_work():
    """Bounds never exceed what they bound from below, nor fall under what they bound from above; and
    most parts keep their entry unread when entries move little."""
    draw = np.random.default_rng(8)
    book = draw.integers(-400, 400, size=(64, 4))
    x = book[draw.integers(64, size=2000)] + draw.integers(-20, 20, size=(2000, 4))
    known = codes.Bounds.measured(x, book, 8)
    for step in (1, 3, 30, 200):
        after = book + draw.integers(-step, step + 1, size=book.shape)
        depths = known.move(x, after, np.nextafter(np.sqrt(((after - book) ** 2).sum(1)), np.inf))
        book = after
        squares = ((x[:, None] - book[None]) ** 2).sum(-1)
        assert (known.entry == squares.argmin(1)).all()
        assert (known.upper.astype(float) ** 2 >= squares.min(1)).all()
        listed = np.take_along_axis(squares, known.near, 1)
        assert (known.lower[:, :-1].astype(float) ** 2 <= listed).all() and (np.diff(known.lower, axis=1) >= 0).all()
        np.put_along_axis(squares, np.concatenate([known.entry[:, None], known.near], axis=1), np.iinfo(np.int64).max, 1)
        assert (known.lower[:, -1].astype(float) ** 2 <= squares.min(1)).all()
        assert step > 3 or len(depths) < 0.1 * len(x)
    known.keep(4)
    assert known.near.shape[1] == 4 and known.lower.shape[1] == 5


def test_codes_of_nothing(spark):
    found = codes.compress(_table(spark, []))
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and found.count() == 0
    assert codes.compress(_table(spark, [(1, [], 1)])).first().code == "00" * 16
    with pytest.raises(ValueError):
        codes.compress(_table(spark, EDGES), entries=257)


# ---- op12 -------------------------------------------------------------------------

def _collocations_brute(rows, top, least):
    counts = {}
    for text, lang in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            for n in range(1, 5):
                own.update(tuple(words[i: i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))) for p, a in f.items() if len(p) > 1 and a >= least}
        hidden = set()
        for p in found:
            inner = {p[i: j] for i in range(len(p)) for j in range(i + 2, len(p) + 1)} - {p}
            hidden |= {q for q in inner if 100 * f[p] >= 80 * f[q]}
        best = sorted((-s, -f[p], " ".join(p).encode(), p, k) for p, (s, k) in found.items() if p not in hidden)[:top]
        out += [(lang, i + 1, " ".join(p), -a, f[p[:k]], f[p[k:]], n, -s) for i, (s, a, _, p, k) in enumerate(best)]
    return out


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def _phrases(spark, rows):
    return spark.createDataFrame([(t, l, "clash", 1, 2) for t, l in rows], "text string, lang string, phrase string, n int, a int")


@pytest.mark.parametrize("top,least", [(5, 3), (400, 2), (100000, 4)])
def test_collocations(spark, top, least):
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect()]
    found = phrases.collocations(_phrases(spark, rows), top, least)
    assert found.columns == COLUMNS
    _same(found, _collocations_brute(rows, top, least))


def test_collocations_with_crowded_bounds(spark):
    """Places shared by many phrases loosen bounds and change nothing else; so do stretches."""
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").limit(25).collect()]
    _same(phrases.collocations(_phrases(spark, rows), 30, 3, table=16, stretch=300), _collocations_brute(rows, 30, 3))


def test_collocations_of_odd_texts(spark):
    rows = [("New York, new york. NEW YORK!new\tyork\x0bnew york", None), ("new  york new york", "und"), (None, "en"), ("", "en"), (" .,\n", "en"), ("ÄÖ a a a a a a a", "de"),
            ("z " * 4000 + "ß é", "fr"), ("tie a. tie b. tie a. tie b. tie a. tie b.", "es"), ("x" * 5000 + " y, " + "x" * 5000 + " y, " + "x" * 5000 + " y", "x")]
    for top in (1, 3, 100):
        _same(phrases.collocations(_phrases(spark, rows), top, 3), _collocations_brute(rows, top, 3))
    none = phrases.collocations(_phrases(spark, rows).limit(0))
    assert none.columns == COLUMNS and none.count() == 0
    assert phrases.collocations(_phrases(spark, [(None, None)])).count() == 0
