"""Top-k search against all inner products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexforge.llm import topk


def brute(rows, k=5, every=5):
    fine = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in fine:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for i, q in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in fine if j != i and len(v) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, **more):
    df = spark.createDataFrame([(a, b, 0) for a, b in rows], "vec_id long, embedding array<float>, rank int").repartition(3)
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 5 == 0, **more).collect())


def made(n, dim, seed, values=None):
    rnd = random.Random(seed)
    pick = (lambda: rnd.choice(values)) if values else (lambda: float(np.float32(rnd.gauss(0, 1))))
    return [(i, [pick() for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("dim, values", [(3, None), (16, None), (4, [0.0, 0.5, -0.5])])
def test_many_shards_and_ties(spark, dim, values):
    rows = made(700, dim, dim, values)
    assert run(spark, rows, shard_rows=90, block_rows=50) == brute(rows)


def test_defined_cases(spark):
    rows = made(12, 2, 1) + [(20, None), (25, [1.0, None]), (30, [float("nan"), 1.0]), (35, [float("inf"), 0.0]), (None, [1.0, 1.0]),
                             (40, [1.0, 2.0, 3.0]), (41, [1.0, 2.0, 3.0]), (45, []), (46, []), (5, [9.0, 9.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_tree_bounds_hold():
    rnd = np.random.default_rng(1)
    vectors = np.floor(rnd.normal(size=(500, 6)) * 100)
    tree = topk.Tree(np.arange(500), vectors, leaf=20)
    queries = np.floor(rnd.normal(size=(30, 6)) * 100)
    bounds = tree.bounds(queries)
    for j, node in enumerate(tree.nodes):
        assert (bounds[:, j] >= (queries @ tree.vectors[node.start:node.end].T).max(axis=1)).all()
    assert sorted(tree.ids.tolist()) == list(range(500))
    leaves = [n for n in tree.nodes if n.left < 0]
    assert max(n.end - n.start for n in leaves) <= 20 and sum(n.end - n.start for n in leaves) == 500


def test_search_visits_few_leaves_in_low_dimensions():
    rnd = np.random.default_rng(2)
    vectors = np.floor(rnd.normal(size=(20_000, 2)) * 1000)
    tree = topk.Tree(np.arange(20_000), vectors)
    seen = []
    tree.vectors = type("Seen", (np.ndarray,), {"__getitem__": lambda self, at: (seen.append(at), np.ndarray.__getitem__(self, at))[1]})(vectors.shape)
    tree.vectors[:] = vectors[tree.ids]
    seen.clear()
    tree.search(np.array([-1]), np.array([[3.0, -2.0]]), 5, np.array([-np.inf]))
    assert 0 < len(seen) < 12
