from __future__ import annotations

import math
import random

import numpy as np
import pytest

from ledgerstrata.llm import vectors
from ledgerstrata.llm.vectors import search

SCHEMA = "vec_id long, embedding array<float>, label int, score string, v string, ids string, cell string"


def brute(rows, asked, k):
    usable = [(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e, *_ in rows
              if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, qv in usable:
        if asked(q):
            best = sorted((-sum(a * b for a, b in zip(qv, v, strict=True)), i) for i, v in usable if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def made(n, spread, copies):
    rng = random.Random(n)
    middles = [[rng.gauss(0, spread) for _ in range(8)] for _ in range(6)]
    rows = [(i, [m + rng.gauss(0, 0.1) for m in rng.choice(middles)], 1) for i in range(n)]
    rows += [(n + i, rows[5][1], 2) for i in range(copies)]
    rows += [(10_000, None, 1), (10_050, [0.1] * 7 + [None], 1), (10_100, [float("nan")] * 8, 1), (10_150, [], 1),
             (10_200, [float("inf")] * 8, 1), (None, [0.5] * 8, 1), (10_250, [0.0] * 8, 1), (10_300, [-3.0] * 8, 1)]
    return [(*r, "x", "x", "x", "x") for r in rows]


@pytest.mark.parametrize(("n", "spread", "copies"), [(400, 1.0, 150), (60, 0.0, 0), (3, 1.0, 0)])
def test_equals_brute_force(spark, n, spread, copies):
    rows = made(n, spread, copies)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = search(df, df.where("vec_id % 25 = 0"), 5)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 25 == 0, 5)


def test_annuli_are_skipped(spark, monkeypatch):
    """Small annuli far from a query are not compared, and nothing is lost by it."""
    monkeypatch.setattr(vectors, "ANNULUS", 16)
    rows = made(500, 3.0, 0)
    df = spark.createDataFrame(rows, SCHEMA)
    found = search(df, df.where("vec_id % 25 = 0"), 3)
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 25 == 0, 3)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert search(df, df).collect() == []


def test_large_components(spark):
    rows = [(i, [3e6 * (i - 2), 1.0], 1, "", "", "", "") for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, search(df, df, 2).collect())) == brute(rows, lambda i: True, 2)


def test_every_length_apart(spark):
    """Vectors are compared with those of their length; bytes of unlike lengths are never taken for one another."""
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range((8, 3, 1, 4)[i % 4 if i % 2 else 0])], 1, "", "", "", "") for i in range(240)]
    rows += [(300, [0.0] * 4, 1, "", "", "", ""), (301, [-0.0] * 4, 1, "", "", "", ""), (302, [1e30], 1, "", "", "", ""),
             (303, [0.0], 1, "", "", "", ""), (304, [0.5] * 700, 1, "", "", "", ""), (305, [0.25] * 700, 1, "", "", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = sorted(map(tuple, search(df, df, 4).collect()))
    wanted = []
    for n in {len(r[1]) for r in rows}:
        wanted += brute([r for r in rows if len(r[1]) == n], lambda i: True, 4)
    assert found == [(q, r, i, max(-(2**63), min(2**63 - 1, s))) for q, r, i, s in sorted(wanted)]


def test_wide_scores_are_exact_then_cut():
    a = np.array([[2.0**40, 1.0], [2.0**70, 3.0], [3.0, 2.0]])
    found = vectors.products(a, np.array([[2.0**20, 1.0], [-1.0, 0.0]]))
    assert found.tolist() == [[2**60 + 1, -(2**40)], [2**63 - 1, -(2**63)], [3 * 2**20 + 2, -3]]
    assert vectors.decoded([vectors.encoded([0.5, -1.25]), vectors.encoded([1e9, -0.0])]).tolist() == [
        [128.0, -320.0], [256e9, 0.0]]


def test_annuli_are_opened_outwards_until_the_bound_closes_the_rest():
    """Of a sorted row of annuli a query opens only those that its last score leaves within reach, and misses nothing."""
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (4096, 3))
    x = np.floor(4000 * x / np.sqrt((x**2).sum(axis=1))[:, None])
    pivots = vectors.Pivots(3, x[:512], float((x**2).sum(axis=1).max()), 1)
    d = pivots.distances(pivots.lifted(x))[:, 0]
    x, d = x[np.argsort(d)], np.sort(d)
    q = x[::500]
    opened = []
    real = vectors.products

    def counted(a, b):
        opened.append(len(a))
        return real(a, b)

    row = {"qs": [vectors.encoded((r / 256).tolist()) for r in q], "vs": [vectors.encoded((r / 256).tolist()) for r in x],
           "d": pivots.asked(q)[:, 0].tolist(), "worst": [-math.inf] * len(q), "ids": [[i] for i in range(len(x))],
           "edges": [[d[i], d[i + 511]] for i in range(0, 4096, 512)]}
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(vectors, "products", counted)
        found = vectors._expanded(row, 3, pivots).to_pylist()
    assert sum(opened) < 0.5 * len(q) * 8
    scores = (q @ x.T).astype(int)
    for text, score in zip(row["qs"], scores.tolist(), strict=True):
        kth = sorted(score)[-3]
        assert sorted(r["ids"][0] for r in found if r["qv"] == text) == [i for i, s in enumerate(score) if s >= kth]
