"""Phrase collocations, whitening and lattice hashing against plain definitions, and on odd tables."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import collocations, lattice_dedup, queries, whitening

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_collocations(rows, least=100, width=5, top=2000):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, width + 1):
                for i in range(len(words) - k + 1):
                    f[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang in n:
        often = {p: a for p, a in f[lang].items() if a >= least and len(p) > 1}
        dropped = {q[i : i + k] for q, b in often.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if 100 * b >= 100 * often[q[i : i + k]]}
        ranked = []
        for p, a in often.items():
            if p not in dropped:
                score, k = min((1000 * a * n[lang] // (f[lang][p[:k]] * f[lang][p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[lang][p[:k]], f[lang][p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_collocations_of_the_given_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_collocations([(r.text, r.lang) for r in docs.select("text", "lang").collect()])
    assert want and rows_of(queries.op11_phrase_collocations(spark, SF)) == want


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(4)
    words = ["The", "cat", "sat", "on", "été", "😀", "x" * 70, "a\x00b", "Mat", "\xff", "rare"]
    rows = [(None, "en"), ("", None), (" \t\n.;", "en"), ("one", "two words"), ("the cat sat on the cat sat " * 3000, "en"), ("End. of\tPiece, and\x0bmore", None)]
    for lang in ("en", None, "und", "two words", "two", ""):
        for _ in range(40):
            rows.append(("".join(rng.choice(words[:9] if lang == "en" else words) + rng.choice("  \t .\n") for _ in range(rng.randint(0, 60))), lang))
    return rows + rows[-30:]


@pytest.mark.parametrize("least,book,run", [(1, 1 << 18, 1 << 20), (1, 4, 50), (3, 0, 7), (20, 1 << 18, 1), (20, 5, 300)])
def test_collocations_of_odd_texts(spark, odd_texts, monkeypatch, least, book, run):
    monkeypatch.setattr(collocations, "RUN_ROWS", run)
    monkeypatch.setattr(collocations, "PARTITION_ROWS", 40 * run)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 3000)
    rows = odd_texts if run > 10 else odd_texts[6:60]
    docs = spark.createDataFrame([(t, l, None, "clash") for t, l in rows], "text string, lang string, word string, n string").repartition(3)
    assert rows_of(collocations.collocations(docs, least=least, top=50, book=book)) == plain_collocations(rows, least, top=50)


def test_keys_are_dealt_by_the_bounds_they_reach():
    rng = random.Random(3)
    for edges, size in ((0, 50), (1, 50), (40, 6), (40, 400)):
        bounds = sorted({bytes(rng.choices(b"abc", k=rng.randint(1, 4))) for _ in range(edges)})
        keys = sorted(bytes(rng.choices(b"abc", k=rng.randint(1, 5))) for _ in range(size))
        assert collocations._places(keys, bounds).tolist() == [sum(b <= k for b in bounds) for k in keys]


def test_bounds_cut_the_windows_into_even_parts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = spark.sparkContext.broadcast(collocations.make_book(collocations.word_counts(docs), 5, 1000))
    bounds = collocations.range_bounds(docs, made, 5, 7)
    assert 0 < len(bounds) < 7 and bounds == sorted(set(bounds))
    rows = collocations.windows(docs, made, 5, spark.sparkContext.broadcast(bounds)).groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n")).orderBy("part").collect()
    assert all(bytes(a.high) < bytes(b.low) for a, b in zip(rows, rows[1:]))
    assert max(r.n for r in rows) < 3 * sum(r.n for r in rows) / 7


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations.collocations(docs).collect() == []
    some = spark.createDataFrame([(None, None), ("a b", None), (None, "a b c d e f")], "lang string, text string")
    assert collocations.collocations(some).collect() == []
    assert [tuple(r) for r in collocations.collocations(some, least=1).where("lang = 'und' AND a = 1 AND phrase = 'b c d e f'").select("l", "r", "n", "score").collect()] == [(1, 1, 6, 6000)]


def plain_whitening(matrix):
    x = np.floor(256 * matrix).astype(np.int64)
    once = np.unique(x, axis=0)
    values, vectors = np.linalg.eigh(np.cov(once.T, bias=True).reshape(x.shape[1], -1))
    order = np.argsort(-values)[:4]
    return x, once, values, order, (x - once.mean(axis=0)) @ vectors[:, order] / np.sqrt(values[order])


def test_whitening_against_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    given = {r.vec_id: r.embedding for r in table.collect()}
    got = queries.op12_embedding_whitening(spark, SF).collect()
    ids = sorted(given)
    x, once, values, order, want = plain_whitening(np.array([given[i] for i in ids], dtype=float))
    assert len(got) == 4 * len(ids) and {r.n for r in got} == {len(once)}
    mine = np.zeros(want.shape)
    for r in got:
        mine[ids.index(r.vec_id), r.component - 1] = r.whitened
        assert r.deviation == int(((len(once) * x[ids.index(r.vec_id)] - once.sum(axis=0)) ** 2).sum()) == int(r.deviation_wide)
        assert abs(r.explained / (values[order[r.component - 1]] / values.sum()) - 1) < 1e-9
        assert 0 <= r.identity_error < 1e-9
    assert np.abs(mine * np.sign((mine * want).sum(axis=0)) - want).max() < 1e-8


def test_covariance_is_exact():
    rng = np.random.default_rng(3)
    x = rng.integers(-900, 900, size=(77, 5))
    centre = np.round(x.mean(axis=0)).astype(np.int64)
    y = x - centre
    pairs = np.array([((y[:, i] + y[:, j]) ** 2).sum() for i in range(5) for j in range(i + 1, 5)])
    got = whitening.covariance(77, x.sum(axis=0), centre, (y * y).sum(axis=0), pairs)
    c = 77 * x - x.sum(axis=0)
    assert np.array_equal(got, (c.T @ c) / 77**3)


def test_whitening_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, n string, x string, label int"
    bad = [None, [], [None, 1.0, 2.0], [float("nan"), 1.0, 2.0], [float("inf"), 1.0, 2.0], [1.0, 2.0]]
    good = [[1.0, 0.5, -0.25], [0.0, 0.0, 0.0], [1.0, 0.5, -0.25], [-3.0, 2.0, 1e-3], [1e5, 1.0, 1.0]]
    table = spark.createDataFrame([(i, v, "clash", "clash", None) for i, v in enumerate(bad)] + [(None if i == 1 else i % 2, v, "clash", "clash", 3) for i, v in enumerate(good)], schema)
    got = whitening.whiten(table).collect()
    x, once, _, _, _ = plain_whitening(np.array(good))
    assert len(once) == 4 and {r.n for r in got} == {4} and len(got) == 5 * max(r.component for r in got)
    exact = collections.Counter((None if i == 1 else i % 2, int(((4 * v - once.sum(axis=0)) ** 2).sum())) for i, v in enumerate(x))
    assert collections.Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == exact
    assert all(r.identity_error < 1e-4 for r in got)
    assert whitening.whiten(table.limit(0)).collect() == []
    assert whitening.whiten(table.where("vec_id = 0 AND n IS NULL")).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [0.5]), (1, [0.5])], "vec_id long, embedding array<double>")).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [0.5]), (2, [-0.5])], "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in one) == [(1, 1, 2, 65536, 1.0, 1.0), (2, 1, 2, 65536, 1.0, 1.0)]


def test_nearest_lattice_points():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 8)) * 3
    near = lattice_dedup.nearest(x)
    doubled = np.rint(near * 2).astype(int)
    assert ((doubled % 2 == doubled[:, :1] % 2).all(axis=1) & (doubled.sum(axis=1) % 4 == 0)).all()  # points of E8
    own = ((x - near) ** 2).sum(axis=1)
    others = ((x[:, None, :] - near[:, None, :] - lattice_dedup.SHORTEST) ** 2).sum(axis=2)
    assert (own <= others.min(axis=1) + 1e-9).all() and (own <= 1 + 1e-9).all()  # covering radius 1
    assert ((lattice_dedup.SHORTEST**2).sum(axis=1) == 2).all() and len(np.unique(lattice_dedup.SHORTEST, axis=0)) == 240


def plain_links(ids, vectors, cosine=0.9):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = unit @ unit.T >= cosine
    np.fill_diagonal(links, False)
    least = np.array(ids)
    while True:
        new = np.array([min([least[i], *least[links[i]]]) for i in range(len(ids))])
        if (new == least).all():
            return links, least
        least = new


def clusters(rng, sizes, noise, length=64):
    out = []
    for size in sizes:
        c = rng.normal(size=length)
        out += [c / np.linalg.norm(c) + noise * rng.normal(size=length) / np.sqrt(length) for _ in range(size)]
    return np.array(out, dtype=np.float32)


@pytest.mark.parametrize("block", [8, 1024])
def test_links_equal_brute_force(spark, block):
    rng = np.random.default_rng(6)
    v = np.vstack([clusters(rng, [60, 5, 2, 2, 1, 1, 30], 0.15), clusters(rng, [1] * 200, 0)])
    v = np.vstack([v, v[:20], v[:1], v[:1], 7.5 * v[3:4]])
    ids = rng.permutation(len(v)).tolist()
    table = spark.createDataFrame([(i, x.tolist()) for i, x in zip(ids, v)], "vec_id long, embedding array<float>").repartition(5)
    links, least = plain_links(ids, v.astype(float))
    got = {r.vec_id: r for r in lattice_dedup.near_duplicates(table, block=block).collect()}
    assert {i: (got[i].n_links, got[i].component_id, got[i].kept) for i in ids} == {i: (int(links[k].sum()), int(least[k]), i == least[k]) for k, i in enumerate(ids)}


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(8)
    a = rng.normal(size=(400, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    o = rng.normal(size=(400, 64))
    o -= (o * a).sum(axis=1, keepdims=True) * a
    o /= np.linalg.norm(o, axis=1, keepdims=True)
    b = 0.9005 * a + np.sqrt(1 - 0.9005**2) * o
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(np.vstack([a, b]))], "vec_id long, embedding array<double>")
    got = lattice_dedup.near_duplicates(table).where("n_links = 1").count()
    assert got >= 0.95 * 800


def test_links_of_given_vectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    links, least = plain_links([r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=float))
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.op13_lattice_dedup(spark, SF).collect()}
    assert got == {r.vec_id: (int(links[k].sum()), int(least[k])) for k, r in enumerate(rows)}


def test_links_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, node string, links string, raw string, label int"
    nan, inf = float("nan"), float("inf")
    vectors = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [3e38, 3e38]), (8, [1e-40, 1e-40]), (9, [1.0, 1.0, 1.0]),
               (12, [1.0, -1.0]), (12, [1.0, -1.0]), (11, [2.0, -2.0]), (None, [-1.0, 0.0]), (None, None), (20, [-0.0, -1.0]), (21, [0.0, -1.0]), (22, [5.0])]
    table = spark.createDataFrame([(i, v, "clash", "clash", "clash", 0) for i, v in vectors], schema)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in lattice_dedup.near_duplicates(table).collect())
    assert got == [
        (0, 0, None, True), (0, 0, None, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 1, 7, True), (8, 1, 7, False),
        (9, 0, 9, True), (11, 2, 11, True), (12, 2, 11, False), (12, 2, 11, False), (20, 1, 20, True), (21, 1, 20, False), (22, 0, 22, True),
    ]
    assert lattice_dedup.near_duplicates(table.limit(0)).collect() == []
    assert lattice_dedup.near_duplicates(table.where("vec_id < 7")).where(F.col("n_links") > 0).count() == 0
