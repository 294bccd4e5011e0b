"""Text operators on small tables with nulls, empty and long texts, ties, repeats and no rows."""

import hashlib
import re
import textwrap
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import compare, database
from conftest import SMALL
from tagloom.llm import embedding_dedup, jaccard, language, licences, mixing, neighbours, packing, passages, pieces, token_counts, url_filter
from tagloom.llm.components import connected_components
from tagloom.llm.licence_texts import LICENCES
from tagloom.llm.queries import ORACLES, QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, score string"
BASE = " ".join(f"w{i}" for i in range(120))
TEXTS = [(1, BASE, "en", "a"), (2, BASE, "en", "a"), (3, BASE.replace("w60 ", "x "), "en", None), (4, "o t h e r", "de", "b"), (5, None, "de", "b"), (6, "", None, "b"),
         (7, " \t ", "fr", "b"), (8, "A b", "fr", "c"), (8, "a B", "fr", "c"), (None, "lost and found", "en", "c"), (9, "y" * 3000, "en", None), (10, "ǆ " * 5000 + BASE, "en", "a")]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([(i, t, l, s, len(t or ""), "clash", "clash") for i, t, l, s in TEXTS], SCHEMA)


@pytest.fixture(scope="module")
def nothing(documents):
    return documents.limit(0)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert compare(QUERIES[name](spark, SMALL), database(SMALL), ORACLES[name]) is None


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (7, 7), (None, 4), (3, 1)] + [(100, i) for i in range(101, 160)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 7: 7, 100: 100} | {i: 100 for i in range(101, 160)}


def test_forward_sums_all_segmentations():
    p = pieces.Pieces(["a", "b", "ab", "▁", "▁a", "bb"])
    shares = np.array([[.1], [.2], [.3], [.15], [.05], [.2], [1e-7]])

    def brute(word):
        if not word:
            return 1.0
        return sum((shares[p.number.get(word[:n], -1), 0] if word[:n] in p.number else (1e-7 if n == 1 else 0)) * brute(word[n:]) for n in range(1, min(2, len(word)) + 1))

    words = ["ab", "abba", "c", "bbbb"]
    assert np.exp(language.word_scores(p, shares, words)[:, 0]) == pytest.approx([brute("▁" + w) for w in words])
    assert language._long_word(p, shares, "▁abbacab")[0] == pytest.approx(np.log(brute("▁abbacab")))


def test_long_words_count_like_short_ones():
    p = pieces.Pieces(["a", "b", "ab", "▁", "▁a", "bb"])
    shares = np.array([[.1, .2], [.2, .1], [.3, .1], [.15, .3], [.05, .1], [.2, .2], [1e-7, 1e-7]])
    words, weights = ["abba", "c", "bbbbab", "abcab"], np.array([[2., 0], [1, 3], [0, 1], [1, 1]])
    counts = np.zeros_like(shares)
    for word, row in zip(words, weights):
        for i in np.flatnonzero(row):
            language._expected_long(p, shares[:, i], "▁" + word, row[i], counts[:, i])
    assert counts == pytest.approx(language.expected_pieces(p, shares, words, weights))
    # 3,000 characters underflow no sum: the pieces cover the word
    long = language.expected_pieces(p, shares, ["ab" * 1500], np.array([[1., 0]]))
    assert (long[:, 0] * [1, 1, 2, 1, 2, 2, 1]).sum() == pytest.approx(3001) and not long[:, 1].any()


def test_languages_without_spaces_are_told_apart(spark):
    rng = np.random.default_rng(3)
    signs = {"zh": "的一是在不了有和人这中大为上个国我以要他", "ja": "のにはをたがでてとしれさあいうかこなもら"}
    rows = [(i, "".join(rng.choice(list(signs[lang]), 56)) + "," + "".join(rng.choice(list(signs[lang]), 60)), lang) for i, lang in enumerate(["zh", "ja"] * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, F.expr("doc_id < 40"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(docs, model, ["doc_id"]).collect()}
    assert all(got[i][0] == lang and got[i][1] > 0.9 for i, _, lang in rows)


def test_language(spark, documents, nothing):
    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = QUERIES["op1_language_id"](spark, SMALL).join(small.select("doc_id", "lang"), "doc_id").where("held_out")
    assert found.where("lang = lang_pred").count() >= 0.95 * found.count()
    model = language.train(documents)
    got = {r.doc_id: r for r in language.predict(documents.withColumnRenamed("score", "s"), model, ["doc_id", "words"]).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {5, 6, 7} and all(0 <= r.score <= 1 for r in got.values())
    assert language.predict(nothing, language.train(nothing), ["doc_id"]).count() == 0


def _jaccard_brute(rows):
    sets = {}
    for n, (i, t, *_) in enumerate(rows):
        w = (t or "").encode().lower().split()
        sets[n] = (i, {tuple(w[j: j + 4]) for j in range(len(w) - 3)} or ({tuple(w)} if w else set()))
    group = {n: n for n in sets}
    for _ in sets:
        for n, (i, s) in sets.items():
            for m, (j, t) in sets.items():
                if i is not None and j is not None and (i == j and s and t or s and t and 100 * len(s & t) >= 85 * len(s | t)):
                    group[n] = group[m] = min(group[n], group[m])
    low = {}
    for n, (i, s) in sets.items():
        low[group[n]] = min(low.get(group[n], i), i) if i is not None else None
    return sorted(((i, len(s), low[group[n]]) for n, (i, s) in sets.items()), key=str)


def test_jaccard(spark, documents, nothing):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.components(documents).collect()), key=str)
    assert got == _jaccard_brute(TEXTS)
    # a large group of near copies: every copy differs from the base in one or two words
    words = BASE.split()
    many = [(0, BASE)] + [(i, " ".join("z%d" % i if j in (i % 100, (i * 7) % 100 if i % 2 else i % 100) else w for j, w in enumerate(words))) for i in range(1, 80)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.components(spark.createDataFrame(many, "doc_id long, text string")).collect()), key=str)
    assert got == _jaccard_brute(many)
    assert jaccard.components(nothing).count() == 0


def test_token_counts(documents, nothing):
    p, scores = token_counts.Pieces(token_counts.read_pieces()), token_counts.piece_scores(token_counts.read_pieces())
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(documents).collect()}
    for i, t, *_ in TEXTS:
        assert got[i] == (None if t is None else sum(token_counts.word_count(p, scores, pieces.MARK + w) for w in t.split()))
    assert token_counts.count_tokens(nothing).count() == 0


def test_licences(spark, documents, nothing):
    rows = [(i, f"The {n} License\n\nCopyright (c) 2020 A B\n\n{t.upper().replace(' ', chr(10))}") for i, (n, t) in enumerate(LICENCES.items())] + [(50, LICENCES["MIT"] + " more"), (51, "x\nReleased under the MIT  Licence\r\n")]
    got = {r.doc_id: (r.licence, r.notices) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i][0] for i in range(len(LICENCES))] == list(LICENCES) and got[50] == (None, "") and got[51] == (None, "MIT")
    assert licences.scan(documents).where("licence IS NOT NULL OR notices <> ''").count() == 0
    assert licences.scan(nothing).count() == 0


def _scanned(spark, texts):
    found = {r.doc_id: r.licence for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    return [found[i] for i in range(len(texts))]


@pytest.mark.parametrize("form", ["published", 60, 100, "one line", "commented"])
def test_long_licences(spark, form):
    files = sorted((Path(licences.__file__).parent / "licence_data").glob("*.txt"))
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"} <= {f.stem for f in files}

    def formed(text):
        if form == "one line":
            return " ".join(text.split())
        if form == "commented":
            return "\r\n".join(f" * {line}" for line in text.splitlines())
        return text if form == "published" else "\n\n".join(textwrap.fill(paragraph, form) for paragraph in re.split(r"\n\s*\n", text))

    texts = [formed(f.read_text()) for f in files]
    assert _scanned(spark, texts + [text[:-200] for text in texts]) == [f.stem for f in files] + [None] * len(files)


def test_licence_headers(spark):
    mit, bsd = LICENCES["MIT"], LICENCES["BSD-3-Clause"]
    heads = ["Copyright (c) 2020 A B\nAll rights reserved.\n\n", "Copyright (c) 2020 A B,\n  C D and others\n\n", "The MIT License (MIT)\nCopyright © 2020 A\n", "(C) 2019 A\n(C) 2020 B\n\n",
             "MIT License Copyright (c) 2020 A B ", "MIT License\n\nCopyright 2020 A\n\nCopyright 2021 B\n\n", "Copyright by A. All rights reserved. "]
    found = [head + text for head in heads for text in (mit, bsd)]
    assert _scanned(spark, found) == ["MIT", "BSD-3-Clause"] * len(heads)
    wrapped = re.sub("copyright holder", "copyright\nowner", mit, flags=re.I)
    other = ["Copyright 2020 A. You may not sell this.\n\n" + mit, "Copyright 2020 A.\n\nNot for sale.\n\n" + mit, "Copyright 2020 A\n\n", "All rights reserved.", mit + "\n\nSome more."]
    assert _scanned(spark, [wrapped, *other]) == ["MIT"] + [None] * len(other)


def test_licences_as_sql(spark, tmp_path):
    """The statement and the operator agree on headers, wraps and cases that the tables lack."""
    texts = [None, "", "©", "All rights reserved.", "x\n\nCopyright 2020 É\r\rReleased under the MIT License.", "Copyright (c) 2020 A\n\nCopyright by B " + LICENCES["MIT"]]
    texts += [" ".join(text.split()) for text in LICENCES.values()] + [f"The X License\n© 2020 A\nall rights reserved\n\n{text}" for text in LICENCES.values()]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(QUERIES["op4_license_scan"](spark, str(tmp_path)), connection, ORACLES["op4_license_scan"]) is None


def test_mixing(documents, nothing):
    rows = mixing.mix(documents).collect()
    assert len(rows) == len(TEXTS) and all(r.taken <= 3 * r["size"] for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own) / 2 + 1e-6
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert sorted(mixing.mix(documents.repartition(5)).collect(), key=str) == sorted(rows, key=str)
    assert mixing.mix(nothing).count() == 0


def test_passages(documents, nothing):
    found = passages.duplicates(documents)
    got = {(r.doc_id, r.keeper_id) for r in found.collect()}
    assert {(2, 1), (3, 1), (10, 1)} <= got and all(i in (2, 3, 10) for i, _ in got)
    left = {r.doc_id: r.text for r in passages.without_duplicates(documents.where("doc_id IN (1, 2, 4, 10)"), found).collect()}
    assert left == {1: BASE, 4: "o t h e r", 10: "ǆ " * 5000}
    assert passages.duplicates(nothing).count() == 0


def _edited(rng, length, edit):
    """A passage in two foreign contexts, the copy edited in the middle, and one equal word beside it."""
    word = iter(range(10**6))
    fresh = lambda n: [f"f{next(word)}" for _ in range(n)]
    passage = [f"p{i}" for i in range(length)]
    at = length // 2 + int(rng.integers(-3, 4))
    copy = {"replaced": passage[:at] + ["new"] + passage[at + 1:], "added": passage[:at] + ["new"] + passage[at:], "left out": passage[:at] + passage[at + 1:]}[edit]
    own, other = fresh(40) + passage + fresh(40), fresh(55) + copy + fresh(40)
    off = int(rng.integers(2, 12))
    own[40 - 1 - off] = other[55 - 1 - off] = "same"
    own[40 + length + off - 1] = other[55 + len(copy) + off - 1] = "too"
    return own, other, [(40, 40 + length - 1), (55, 55 + len(copy) - 1)]


@pytest.mark.parametrize("edit", ["replaced", "added", "left out"])
def test_edited_passages_in_foreign_context(edit):
    rng = np.random.default_rng(3)
    for length in range(60, 99, 2):
        own, other, (mine, theirs) = _edited(rng, length, edit)
        x, y = (np.array([hash(w) & (1 << 62) - 1 for w in t], dtype=np.uint64) for t in (own, other))
        runs = [[tuple(t[i: i + 5]) for i in range(len(t) - 4)] for t in (own, other)]
        seed = runs[0].index(tuple(own[mine[0] + 7: mine[0] + 12])), runs[1].index(tuple(own[mine[0] + 7: mine[0] + 12]))
        got = passages._passages(x, y, np.array([seed]), 50, 0.8)
        # brute force: the longest stretches of at least 50 words and similarity 0.8 that begin and end with the same run
        u, v = set(runs[0][mine[0]: mine[1] - 3]), set(runs[1][theirs[0]: theirs[1] - 3])
        assert len(u & v) / len(u | v) >= 0.8
        assert [(a, b, c, d) for a, b, c, d, _ in got] == [(*mine, *theirs)], length
        assert got[0][4] == pytest.approx(len(u & v) / len(u | v))
    # an edit so near the end that the rest is no run of its own
    own, other = ([f"{t}{i}" for i in range(30)] + [f"p{i}" for i in range(48)] + [t, "x", "y", "z"] + [f"{t}{i}" for i in range(30, 60)] for t in "ab")
    x, y = (np.array([hash(w) & (1 << 62) - 1 for w in t], dtype=np.uint64) for t in (own, other))
    assert [f[:4] for f in passages._passages(x, y, np.array([[35, 35]]), 50, 0.8)] == [(30, 79, 30, 79)]


def test_passages_of_rows_that_share_an_id(spark):
    shared, long = " ".join(f"s{i}" for i in range(60)), " ".join(f"l{i}" for i in range(90))
    rows = [(1, shared), (8, "only here " + shared), (8, long), (9, long), (9, long), (7, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.first_word, r.last_word, r.keeper_id, r.keeper_first, r.keeper_last) for r in passages.duplicates(df).collect()}
    assert got == {(8, 2, 61, 1, 0, 59), (9, 0, 89, 8, 0, 89)}
    left = passages.without_duplicates(df, passages.by_row(df)).collect()
    assert sorted((r.doc_id, r.text) for r in left) == [(1, shared), (7, "a b"), (8, long), (8, "only here ")]


def _partly_held(rng, length):
    """Texts 1 and 2 hold one half each of a passage that 3 and 4 hold whole."""
    tag = int(rng.integers(1 << 40))
    p = [f"p{tag}x{i}" for i in range(length)]
    parts = [p[: length // 2 + 2], p[length // 2 - 2:], p, p]
    return [" ".join([*(f"a{tag}x{n}x{i}" for i in range(30)), *part, *(f"b{tag}x{n}x{i}" for i in range(30))]) for n, part in enumerate(parts)]


def test_passages_whose_parts_are_held_earlier(spark):
    rng = np.random.default_rng(5)
    lengths = [50, 55, 60, 70, 80] * 8
    rows = [(4 * n + k, t) for n, length in enumerate(lengths) for k, t in enumerate(_partly_held(rng, length))]
    got = {(r.doc_id, r.first_word, r.last_word, r.keeper_id, r.keeper_first, r.keeper_last) for r in passages.duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(4 * n + 3, 30, 29 + length, 4 * n + 2, 30, 29 + length) for n, length in enumerate(lengths)}


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    vectors = [(i, rng.normal(size=8).tolist()) for i in range(600)] + [(600 + i, [1.0] * 8) for i in range(30)] + [(700, None), (701, [0.0] * 8), (702, [float("nan")] * 8), (703, [1.0, 2.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.expr("vec_id % 20 = 0")).toPandas()
    known = {i: np.array(v) for i, v in vectors if i is not None and v and len(v) == 8 and np.any(v) and np.isfinite(v).all()}
    hits = total = 0
    for q in [i for i in known if i % 20 == 0]:
        want = sorted((float(np.sqrt(((v - known[q]) ** 2).sum())), i) for i, v in known.items() if i != q)[:10]
        own = found[found.query_id == q].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 11)) and own["score"].is_monotonic_increasing
        hits, total = hits + len(set(own.vec_id) & {i for _, i in want}), total + 10
    assert hits >= 0.9 * total and found[found.query_id == 600].vec_id.tolist() == list(range(601, 611))
    assert neighbours.nearest(df.limit(0), F.expr("vec_id % 20 = 0")).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 16))
    vectors = [(i, (base[i % 40] + 0.05 * rng.normal(size=16)).tolist()) for i in range(400)] + [(400, base[0].tolist()), (401, base[0].tolist()), (402, None), (403, [0.0] * 16), (404, [1.0])]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(vectors, "vec_id long, embedding array<double>")).collect()}
    x = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors if v and len(v) == 16 and np.any(v)}
    for i, v in x.items():
        assert got[i].n_links == sum(float(v @ w) >= 0.9 for j, w in x.items() if j != i)
    assert got[401].component_id == got[0].component_id and got[402].component_id == 402 and got[402].kept and got[403].n_links == 0
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_no_embedding_link_is_missed_between_far_cells(spark, monkeypatch):
    """Vectors spread evenly between orthogonal directions, so that many links cross cells; components."""
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 30)
    rng = np.random.default_rng(5)
    angle = np.linspace(0, np.pi / 2, 100)
    arcs = [np.stack([np.cos(angle), np.sin(angle)], axis=1) @ np.eye(6)[[a, b]] for a, b in ((0, 1), (2, 3), (1, 4))]
    x = np.concatenate(arcs) * rng.choice([1.0, 1e-3, 50.0], size=(300, 1))
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    assert [got[i].n_links for i in range(300)] == (linked.sum(1) - 1).tolist()
    low = np.arange(300)
    for _ in range(300):
        low = np.array([low[linked[i]].min() for i in range(300)])
    assert [got[i].component_id for i in range(300)] == low.tolist()


def test_embeddings_are_not_copied_for_their_visits(spark, monkeypatch):
    """Small cells with many visitors and a hot one: slices of cells and of one cell, links of copies, components."""
    plans = []
    for name, value in (("CELL_ROWS", 30), ("TILE_ROWS", 16), ("SLICE_ROWS", 64)):
        monkeypatch.setattr(embedding_dedup, name, value, raising=False)
    monkeypatch.setattr(embedding_dedup, "stage", lambda df, name="stage", *a, stage=embedding_dedup.stage, **k: plans.append((name, df._jdf.queryExecution().toString())) or stage(df, name, *a, **k))
    rng = np.random.default_rng(8)
    spread = rng.normal(size=(240, 5))
    hot = np.array([3.0, 1, 0, 0, 0]) + 0.02 * rng.normal(size=(200, 5))
    x = np.concatenate([spread, hot, spread[:20], spread[:20]])
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = u @ u.T >= 0.9
    assert [got[i].n_links for i in range(480)] == (linked.sum(1) - 1).tolist()
    low = np.arange(480)
    for _ in range(480):
        low = np.array([low[linked[i]].min() for i in range(480)])
    assert [got[i].component_id for i in range(480)] == low.tolist()
    links = [plan for name, plan in plans if name == "links"]
    assert len(links) > 4 and not any("Generate" in plan or "Exchange" in plan for plan in links)


def test_tiny_and_huge_embeddings_link_by_direction(spark):
    rows = [(1, [1e-200, 0.0]), (2, [3e-200, 1e-201]), (3, [0.0, 1e-200]), (4, [1e180, 0.0]), (5, [0.0, -1e300]), (6, [5e-324, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (3, 1), 2: (3, 1), 4: (3, 1), 6: (3, 1), 3: (0, 3), 5: (0, 5)}


def test_packing(spark, documents, nothing):
    df = packing.pack(documents, capacities=(16, 64, 128)).toPandas()
    full = df[df["length"] > 0]
    assert len(df[df.bin.isna()]) == 3 and full["length"].sum() == sum(len((t or "").encode().split()) for _, t, *_ in TEXTS)
    for _, own in full.groupby("bin"):
        assert own["length"].sum() <= own.capacity.iloc[0] and own.capacity.nunique() == 1
        assert own.capacity.iloc[0] == min(c for c in (16, 64, 128) if c >= own["length"].sum())
        assert sorted(own.place) == sorted(own["length"].cumsum() - own["length"])
    assert packing.pack(nothing).count() == 0
    unique = documents.where("doc_id <> 8")
    texts = packing.sequences(unique, packing.pack(unique)).agg(F.sum("words")).first()[0]
    assert texts == sum(len((t or "").encode().split()) for i, t, *_ in TEXTS if i not in (8, None))


def test_packing_deals_one_hot_row_to_many_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES", 64)
    rows = [(7, "same words here")] * 700 + [(i, f"w{i} " * (i % 9)) for i in range(100, 900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = packing.pack(df, capacities=(16, 32)).collect()
    hot = [r for r in got if r.doc_id == 7]
    assert len(got) == len(rows) and len(hot) == 700
    shards = [r.bin >> 32 for r in hot]
    assert max(map(shards.count, set(shards))) < 3 * 700 / len(set(r.bin >> 32 for r in got if r.bin is not None)) + 64 and len(set(shards)) > 10
    filled = {}
    for r in got:
        if r.bin is not None:
            filled.setdefault((r.bin, r.capacity), []).append((r.place, r.length))
    for (_, capacity), parts in filled.items():
        parts.sort()
        assert sum(n for _, n in parts) <= capacity and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))


def test_url_filter(spark):
    pages = [(1, "http://A.net/x", "h"), (2, "http://q.org/z?a=1#t", '<LINK href="http://a.net/x" rel="canonical">'), (3, None, None), (4, "nourl", "x"), (5, "http://u.org/1", '<meta http-equiv="refresh" content="0; url=2">'),
             (6, "http://u.org/2", '<meta content="0;URL=http://sub.example.com/de/1" http-equiv=refresh>'), (7, "http://example.net/en/5", "<link rel='canonical' href='//a.net/'>"), (8, "http://net", "a"), (1, "http://A.net/x", "h")]
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block")], "host string, path string, verdict string")
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = sorted(((r.page_id, r.rule, r.verdict) for r in url_filter.judge(df, rules).collect() if r.page_id != 3), key=str)
    assert got == sorted([(1, "net/", "block")] * 2 + [(2, None, "block"), (4, None, "allow"), (5, None, "block"), (6, None, "block"), (7, "example.net/en/", "allow"), (8, None, "allow")], key=str)
    assert url_filter.judge(df.limit(0), rules).count() == 0


def test_pipeline(spark, documents, tmp_path):
    documents.drop("words", "score").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(stage(spark, docs, str(tmp_path)))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r.doc_id for r in docs.collect()})
    assert kept[0] == {1, 2, 3, 4, 8, 9, 10, None} and kept[1] == {1, 4, 8, 9, None} and kept[2] == kept[1]
    pieces_of = {}
    for r in corpus_pipeline.packed(spark, docs, str(tmp_path)).collect():
        pieces_of[r.doc_id] = pieces_of.get(r.doc_id, 0) + r.length
    assert pieces_of == {i: sum(len((r.text or "").split()) for r in docs.collect() if r.doc_id == i) for i in {r.doc_id for r in docs.collect()}}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def _mix_brute(rows):
    """Copies of every row, equal rows and equal ids together."""
    sized = [(i, text, source, len((text or "").split())) for i, text, source in rows]
    names = sorted({r[2] for r in sized}, key=lambda s: (s is None, s))
    weight, total = {s: n % 3 + 1 for n, s in enumerate(names)}, sum(r[3] for r in sized)
    size = {s: sum(r[3] for r in sized if r[2] == s) for s in names}
    target, open_ = {}, set(names)
    while True:
        rate = (total - sum(target.values())) / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if 3 * size[s] < weight[s] * rate}
        if not full:
            break
        target |= {s: 3 * size[s] for s in full}
        open_ -= full
    target |= {s: weight[s] * rate for s in open_}
    taken = []
    for s in names:
        whole = int(target[s] // size[s]) if size[s] else 0
        part, lacking, run = target[s] / size[s] - whole if size[s] else 0, target[s] - whole * size[s], 0
        part = min(1 - 1e-9, max(1e-9, part))
        draws = []
        for i, text, source, n in (r for r in sized if r[2] == s):
            u = (int(hashlib.md5(f"{'null' if i is None else i}#7".encode()).hexdigest()[:12], 16) + .5) / 2 ** 48
            draws.append((u * (1 - part) / (u * (1 - part) + part * (1 - u)), i, n))
        for _, i, n in sorted(draws):
            run += n
            taken += [(i, s)] * (whole + (lacking > 0 and n > 0 and run - n / 2 <= lacking and run - n < lacking))
    return sorted(taken, key=str)


@pytest.mark.parametrize("stored", [True, False])
def test_source_mix(spark, tmp_path, stored):
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(0, 40)), ["a", "b", "c", None][int(rng.integers(0, 4)) if i % 3 else 0]) for i in range(400)]
    docs = spark.createDataFrame(rows + rows[:20], "doc_id long, text string, source string")
    if stored:
        docs.repartition(5).write.parquet(f"{tmp_path}/docs")
        docs = spark.read.parquet(f"{tmp_path}/docs")
    got = sorted(((r.doc_id, r.source) for r in corpus_pipeline.source_mix(spark, docs, "").collect()), key=str)
    assert got == _mix_brute(rows + rows[:20])


def test_near_duplicates_are_judged_by_row(spark):
    rng = np.random.default_rng(6)
    a, b, c = (" ".join(f"v{n}" for n in rng.integers(0, 10 ** 6, 80)) for _ in range(3))
    rows = [(0, a), (1, a), (1, b), (1, b), (2, b + " end"), (3, c), (3, c), (None, a), (4, ""), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(0, a), (1, b), (3, c), (None, a), (4, "")], key=str)


def test_pipeline_groups_five_word_runs_from_four_fifths(spark):
    words = [f"w{i}" for i in range(120)]
    docs = spark.createDataFrame([(1, " ".join(words[:100])), (2, " ".join(words)), (3, " ".join(words[:95] + [f"x{i}" for i in range(40)]))], "doc_id long, text string")
    assert 96 / 116 >= 0.8 and 97 / 117 < 0.85
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [1, 3]
