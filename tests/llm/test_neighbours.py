from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from silexa.llm import neighbours, queries

KIND = "chunk_id bigint, vector array<float>"


def _rows(n=900, d=16, seed=4):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n // 3, d))
    x = np.concatenate([base, base + 0.15 * rng.standard_normal(base.shape), rng.standard_normal((n - 2 * (n // 3), d))]).astype(np.float32)
    return [(i + 1, [float(v) for v in row]) for i, row in enumerate(x)]


def _brute(rows, k, least=None):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).astype(np.float64)
    s = x @ x.T
    np.fill_diagonal(s, -9)
    out = {}
    for r, i in enumerate(ids):
        order = np.lexsort((ids, -s[r]))[:k]
        out[i] = [(ids[j], s[r, j]) for j in order if least is None or s[r, j] >= least]
    return out


@pytest.mark.parametrize(("least", "tables"), [(0.85, 1), (None, 2)])
def test_recall(spark, least, tables):
    rows = _rows()
    got = neighbours.nearest(spark.createDataFrame(rows, KIND), 5, least=least, recall=0.97, tables=tables, dimension=16).collect()
    truth = {(i, o) for i, list_ in _brute(rows, 5, least).items() for o, _ in list_}
    have = {(r["id"], r["other"]) for r in got}
    assert len(truth & have) >= 0.95 * len(truth)
    if least is not None:
        assert all(r["similarity"] >= least for r in got)
    assert all(r["rank"] <= 5 for r in got)


def test_reach_of_the_query_grows_with_the_hashes(spark, monkeypatch, tmp_path):
    """As many hashes as a million rows have: distant neighbours are found as they are in a small table."""
    rows = [(i, [float(v) for v in x]) for i, x in enumerate(np.random.default_rng(5).standard_normal((3000, 64)), 1)]
    spark.createDataFrame(rows, KIND).write.parquet(str(tmp_path / "chunks.parquet"))
    monkeypatch.setattr(neighbours, "CELL", 3000 / neighbours.SLOTS**8)
    monkeypatch.setattr(neighbours, "REGION", 100)
    got = {(r["id"], r["other"]) for r in queries.p3_neighbours(spark, str(tmp_path)).collect()}
    truth = {(i, o) for i, list_ in _brute(rows, 5).items() for o, _ in list_ if i % 100 == 0}
    assert len(truth) == 150 and len(truth & got) >= 0.95 * len(truth)


def test_blocks_and_deeper_regions_lose_nothing(spark, monkeypatch):
    rows = _rows()
    plain = neighbours.nearest(spark.createDataFrame(rows, KIND), 5, least=0.8, dimension=16).collect()
    for name, value in (("HEAVY", 7), ("ASKED", 40), ("PAIRS", 9)):
        monkeypatch.setattr(neighbours, name, value)
    cut = neighbours.nearest(spark.createDataFrame(rows, KIND), 5, least=0.8, dimension=16).collect()
    assert {(r["id"], r["other"], r["rank"]) for r in cut} == {(r["id"], r["other"], r["rank"]) for r in plain}


def test_many_copies(spark):
    """A third and more of all vectors are one; each gets the copies of smallest id."""
    rows = _rows(600) + [(i, [1.0] * 16) for i in range(2000, 2500)]
    got = {}
    for r in neighbours.nearest(spark.createDataFrame(rows, KIND), 3, least=0.85, dimension=16).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["other"]))
    assert [o for _, o in sorted(got[2000])] == [2001, 2002, 2003] and [o for _, o in sorted(got[2400])] == [2000, 2001, 2002]


def test_many_copies_without_a_least_similarity(spark, monkeypatch):
    """The copies of smallest id, in whatever order the rows come and in blocks too."""
    rows = [(i, [1.0] * 16) for i in range(2499, 1999, -1)] + _rows(600)
    np.random.default_rng(1).shuffle(rows)
    for changes in ({}, {"HEAVY": 150, "ASKED": 90, "PAIRS": 70}):
        for name, value in changes.items():
            monkeypatch.setattr(neighbours, name, value)
        got = {}
        for r in neighbours.nearest(spark.createDataFrame(rows, KIND), 3, dimension=16).collect():
            got.setdefault(r["id"], []).append((r["rank"], r["other"]))
        assert all([o for _, o in sorted(got[i])] == [o for o in range(2000, 2004) if o != i][:3] for i in range(2000, 2500))


def test_unusable_vectors_and_ties(spark):
    e = [1.0, 0.0, 0.0, 0.0]
    rows = [(1, e), (2, e), (3, [2.0, 0.0, 0.0, 0.0]), (4, e), (5, None), (6, [0.0] * 4), (7, [1.0, 2.0]), (8, [float("nan"), 1.0, 0.0, 0.0]), (9, [float("inf"), 1.0, 0.0, 0.0]), (None, e), (10, [0.0, 1.0, 0.0, 0.0]), (11, [1.0, None, 0.0, 0.0])]
    frame = spark.createDataFrame([(*r, 1.0, "x") for r in rows], KIND + ", similarity double, id string")
    got = {}
    for r in neighbours.nearest(frame, 2, least=0.85, dimension=4).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["other"]))
    assert {i: [o for _, o in sorted(v)] for i, v in got.items()} == {1: [2, 3], 2: [1, 3], 3: [1, 2], 4: [1, 2]}
    pairs = neighbours.similar_pairs(neighbours.nearest(frame, 2, least=0.85, dimension=4))
    assert {tuple(r) for r in pairs.collect()} == {(1, 2), (1, 3), (2, 3), (1, 4), (2, 4)}
    some = neighbours.nearest(frame, 2, queries=F.col("chunk_id") == 4, dimension=4)
    assert [(r["id"], r["other"]) for r in some.orderBy("rank").collect()] == [(4, 1), (4, 2)]
    assert neighbours.nearest(spark.createDataFrame([], KIND), 2).count() == 0


@pytest.mark.parametrize("hashes", [8, 11, 14])
def test_recall_does_not_fall_with_the_hashes(spark, monkeypatch, hashes):
    """Regions and cells as of millions of rows; neighbours at the least cosine and the nearest at random."""
    rng = np.random.default_rng(hashes)
    x = rng.standard_normal((500, 64))
    y = rng.standard_normal((500, 64))
    x, y = x / np.linalg.norm(x, axis=1, keepdims=True), y / np.linalg.norm(y, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.86 * x + np.sqrt(1 - 0.86**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(np.concatenate([x, y]), 1)]
    monkeypatch.setattr(neighbours, "REGION", 1000 / neighbours.SLOTS ** (hashes - 4))
    frame = spark.createDataFrame(rows, KIND)
    found = {(r["id"], r["other"]) for r in neighbours.nearest(frame, 5, least=0.85, recall=0.95, hashes=hashes).collect()}
    assert sum((i, i + 500) in found for i in range(1, 501)) >= 0.93 * 500
    near = {(r["id"], r["other"]) for r in neighbours.nearest(frame, 5, queries=F.col("chunk_id") % 10 == 0, recall=0.95, hashes=hashes).collect()}
    truth = {(i, o) for i, list_ in _brute(rows, 5).items() for o, _ in list_ if i % 10 == 0}
    assert len(truth & near) >= 0.92 * len(truth)
