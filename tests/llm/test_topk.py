import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenurelake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10, every=100):
    whole = {}
    for i, v, _ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            whole.setdefault(i, []).append([math.floor(1024 * float(np.float32(x))) for x in v])
    out = []
    for q, vs in whole.items():
        if q % every == 0:
            found = sorted({(-sum(a * b for a, b in zip(v, w)), i) for v in vs for i, ws in whole.items() if i != q for w in ws if len(w) == len(v)})
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def run(spark, rows, k=10):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"v": F.lit(1), "ids": F.lit("x"), "shard": F.lit(2)})
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % 100 == 0, k).collect())


def vectors(n, dim, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(0, spread, dim)], 0) for i in range(n)]


@pytest.mark.parametrize("shard, block", [(100_000, 100_000), (150, 100_000), (97, 3)])
def test_shards_and_blocks_agree_with_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "BLOCK", block)
    rows = vectors(900, 16, 1)
    assert run(spark, rows) == brute(rows)


def test_ties_copies_and_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 64)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-1, 2, 4)], 0) for i in range(500)] + [(i, [1.0, 1.0, 0.0, 0.0], 0) for i in range(500, 800)]
    assert run(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    rows = vectors(30, 3, 3) + [
        (None, [1.0, 2.0, 3.0], 0), (100, None, 0), (200, [], 0), (300, [1.0, None, 2.0], 0), (400, [math.nan, 1.0, 1.0], 0),
        (500, [math.inf, 0.0, 0.0], 0), (600, [1.0, 2.0], 0), (601, [3.0, 4.0], 0), (700, [5.0] * 7, 0), (5, [9.0, 9.0, 9.0], 0),
        (0, [0.5, 0.5, 0.5], 0), (3, [1.0, 1.0, 1.0], 0), (3, [1.0, 1.0, 1.0], 0), (800, [20000.0, -20000.0, 20000.0], 0),
    ]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == [] and run(spark, [(100, [1.0], 0)]) == [] and run(spark, [(1, [1.0], 0)]) == []


def test_large_components_are_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 60_000, 8)], 0) for i in range(300)]
    assert run(spark, rows) == brute(rows)


def test_large_components_of_many_dimensions_are_not_cut(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 50)
    rows = vectors(200, 64, 7)
    for i in range(0, 200, 9):
        rows[i][1][i % 64] = 300_000.0 * (-1) ** i
        rows[i][1][(i + 9) % 64] = 300_000.0
    assert max(s for *_, s in run(spark, rows)) > 2**36 and run(spark, rows) == brute(rows)


def test_scores_are_exact_up_to_64_bits_and_fail_beyond(spark):
    rows = [(0, [1e12, 0.0], 0), (1, [0.0, 1e12], 0), (2, [1.0, 3.0], 0), (3, [1.5, 0.0], 0), (4, [1.25, 1e12], 0), (100, [2.0**-10, 1.0], 0)]
    assert run(spark, rows) == brute(rows)
    with pytest.raises(Exception, match="beyond 64 bits"):
        run(spark, [*rows, (200, [1e12, 1.0], 0)])
    with pytest.raises(Exception, match="beyond 62 bits"):
        run(spark, [*rows, (201, [1e16, 1.0], 0)])


def test_tree_boxes_are_tight_and_bound_scores():
    points = np.array([v for _, v, _ in vectors(500, 5, 5)])
    tree, queries = topk.Tree(points, leaf=16), np.array([v for _, v, _ in vectors(20, 5, 6)])
    for node, (a, b) in enumerate(tree.span):
        own = points[tree.order[a:b]]
        assert (own.min(0) == tree.lo[node]).all() and (own.max(0) == tree.hi[node]).all()
        assert (tree.reach([node], queries)[:, 0] >= (queries @ own.T).max(1) - 1e-9).all()
    assert sorted(tree.order) == list(range(500))
