"""Largest inner products against a search of all vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hostvane.llm import topk

COLUMNS = "vec_id long, embedding array<float>, score string, rank string, vector string"


def brute_force(rows, k=5, step=50):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in kept:
        if q % step == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in kept if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "s", "r", "v") for i, v in rows], COLUMNS)


def clustered(n, dim=6, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(5, dim))
    return [(int(i), [float(np.float32(x)) for x in centers[i % 5] + 0.2 * rng.normal(size=dim)]) for i in range(n)]


@pytest.mark.parametrize("sizes", [{}, {"shard": 40, "leaf": 4, "group": 2, "block": 3}])
def test_against_brute_force(spark, sizes):
    rows = clustered(600)
    rows += [(700, None), (701, [None, 1.0]), (702, [float("nan")] * 6), (703, [float("inf")] + [0.0] * 5), (None, [1.0] * 6)]
    rows += [(750, []), (800, [2.0]), (801, [3.0] * 9), (850, [1e9] * 6), (851, [-1e9, 1e9]), (50, [0.5] * 6), (3, rows[3][1])]
    got = topk.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, **sizes)
    assert sorted(tuple(r) for r in got.collect()) == brute_force(rows)


def test_ties_and_few_rows(spark):
    rows = [(k, [1.0, 2.0]) for k in range(120)]
    got = topk.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, shard=10, leaf=2, group=3, block=1)
    assert sorted(tuple(r) for r in got.collect()) == brute_force(rows)
    few = rows[:3]
    assert sorted(tuple(r) for r in topk.top_k(table(spark, few), F.col("vec_id") % 50 == 0).collect()) == brute_force(few)
    for none in ([], rows[:1], [(5, [1.0])]):
        assert topk.top_k(table(spark, none), F.col("vec_id") % 50 == 0).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(3)
    vectors = rng.integers(-300, 300, (500, 8)).astype(np.int16)
    tree = topk.BallTree(np.arange(500), vectors, 16)
    assert sorted(tree.ids.tolist()) == list(range(500))
    q = rng.normal(size=8) * 100
    for center, radius, (start, end), children in zip(tree.centers, tree.radii, tree.spans, tree.children, strict=True):
        own = tree.vectors[start:end].astype(float)
        assert (own @ q).max() <= center @ q + radius * np.linalg.norm(q) + 1e-6
        if children[0] >= 0:
            assert [tree.spans[c] for c in children] == [(start, tree.spans[children[0]][1]), (tree.spans[children[0]][1], end)]


def test_far_nodes_are_not_visited():
    rng = np.random.default_rng(4)
    vectors = np.concatenate([rng.normal(100 * k, 1, (200, 4)) for k in (-1, 1)]).astype(np.int64)
    tree, seen = topk.BallTree(np.arange(400), vectors, 16), []
    own = topk.Best(5, None)
    own.add = lambda s, i, add=own.add: (seen.extend(i), add(s, i))
    topk.search(tree, np.array([[50, 50, 50, 50]]), [-1], [own])
    assert min(seen) >= 200
