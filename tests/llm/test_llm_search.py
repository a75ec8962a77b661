"""Nearest vectors against brute force."""

import random

import numpy as np

from fraudspark.llm import search

SCHEMA = "vec_id long, embedding array<float>, score string, cell int, p string"


def expected(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if v and len(v) == 4 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for i, v in good:
        if i % 20 == 0:
            ranked = sorted(((-float(w @ v), j) for j, w in good if j != i))[:k]
            out.setdefault(i, []).extend((j, round(-s, 9)) for s, j in ranked)
    return out


def run(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    found = search.nearest(df, **settings).toPandas().sort_values(["query_id", "rank"])
    return {q: [(int(r.vec_id), round(r.score, 9)) for r in part.itertuples()] for q, part in found.groupby("query_id")}


def test_odd_vectors_ties_and_few_candidates(spark):
    eighth = [1.0, 0.5, 0.25, -0.5]
    rows = [
        (0, eighth), (1, eighth), (2, eighth), (20, [2.0, 0.0, 0.0, 1.0]), (3, None), (4, []), (5, [0.0] * 4),
        (6, [1.0, None, 0.0, 0.0]), (7, [float("nan"), 0.0, 0.0, 1.0]), (8, [float("inf"), 0.0, 0.0, 1.0]), (9, [1.0, 1.0]),
        (40, [0.0, 0.0, 0.0, 0.5]),
    ]
    assert run(spark, rows, k=20) == expected(rows, 20)


def test_recall(spark):
    rng = random.Random(2)
    centers = [[rng.gauss(0, 1) for _ in range(4)] for _ in range(12)]
    rows = [(i, [float(np.float32(c + rng.gauss(0, 0.3))) for c in rng.choice(centers)]) for i in range(3000)]
    rows += [(i, [1.0, 2.0, 0.5, 0.25]) for i in range(3000, 4200)]  # one very common vector
    got, right = run(spark, rows, k=20, cell_rows=300, sample_rows=500), expected(rows, 20)
    assert got.keys() == right.keys()
    shared = sum(len({j for j, _ in got[q]} & {j for j, _ in right[q]}) for q in right)
    assert shared >= 0.9 * 20 * len(right)


def test_recall_in_64_dimensions(spark):
    """Vectors around ten centers, with exact copies: recall, exact scores, ties by id."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(10, 64))
    x = centers[rng.integers(0, 10, 8000)] + rng.normal(size=(8000, 64)) * 1.5
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[200:230] = x[200]
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = search.nearest(df, cell_rows=1000).toPandas().sort_values(["query_id", "rank"])
    assert len(found) == 400 * 20
    y, hits = x.astype(float), 0
    for q, part in found.groupby("query_id"):
        scores = (y * y[q]).sum(axis=1)
        scores[q] = -np.inf
        order = np.lexsort((np.arange(len(y)), -scores))[:20]
        hits += len(set(order) & set(part["vec_id"]))
        assert np.allclose(scores[part["vec_id"]], part["score"], rtol=0, atol=1e-12)
        assert (np.diff(part["score"]) <= 0).all() and part["rank"].tolist() == list(range(1, 21))
    assert hits >= 0.9 * 20 * 400
    copies = found[found["query_id"] == 200]["vec_id"].tolist()
    assert copies == list(range(201, 221))


def test_empty(spark):
    assert search.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert search.nearest(spark.createDataFrame([(0, [0.0], "", 1, "")], SCHEMA)).count() == 0


def test_chi_square():
    assert abs(search.chi_square_share(np.array([15.507]), 8)[0] - 0.95) < 1e-4
    assert abs(search.chi_square_value(0.95, 8) - 15.507) < 1e-3
