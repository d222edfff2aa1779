from __future__ import annotations

import heapq
import math

import numpy as np
import pytest
from capstream.llm import op1_topk
from pyspark.sql import functions as F

from tests.llm import tables


def brute(rows, k=5, every=50):
    whole = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.setdefault(i, set()).add(tuple(math.floor(float(np.float32(x)) * 256) for x in v))
    out = set()
    for q in (i for i in whole if i % every == 0):
        scores = {(-sum(a * b for a, b in zip(x, y)), j) for x in whole[q] for j in whole if j != q for y in whole[j]}
        out |= {(q, n, j, -s) for n, (s, j) in enumerate(heapq.nsmallest(k, scores), 1)}
    return out


def run(spark, rows, **sizes):
    df = op1_topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    got = op1_topk.top_k(df, F.col("vec_id") % 50 == 0, **sizes).collect()
    return {tuple(r) for r in got}


@pytest.mark.parametrize("sizes", [{}, {"shard_rows": 16, "query_rows": 2}])
def test_odd_rows_against_brute_force(spark, sizes):
    rows = tables.rows()["embeddings"]
    assert run(spark, rows, **sizes) == brute(rows)


def test_many_ties(spark):
    rows = [(i, [1.0, 0.0] if i % 3 else [0.0, 1.0], 0) for i in range(200)]
    assert run(spark, rows, shard_rows=20, query_rows=3) == brute(rows)


def test_numbers_beyond_doubles(spark):
    rows = [(0, [3e15, 1.0], 0), (1, [3e15, 2.0], 0), (2, [3e15, 1.0], 0), (3, [-3e38, 0.0], 0), (50, [3e38, 0.5], 0)]
    got = run(spark, rows)
    assert (50, 4, 3, op1_topk.LONG_MIN) in got
    assert [s for q, _, _, s in sorted(got) if q == 50][:3] == [op1_topk.LONG_MAX] * 3


def test_tree_opens_few_leaves_and_finds_all():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16)) * 200
    vectors = np.floor(np.repeat(centres, 100, axis=0) + rng.normal(size=(2000, 16)) * 5)
    tree = op1_topk.BallTree(np.arange(2000), vectors, leaf_rows=50)
    queries = vectors[:40:4] * 2
    got = tree.search(np.arange(-10, 0), queries, 5, np.full(10, -np.inf))
    for q in range(10):
        scores = vectors @ queries[q]
        want = sorted(zip(-scores, range(2000)))[:5]
        assert sorted((-s, i) for w, i, s in got if w == q)[:5] == want




def test_far_clusters_are_not_visited(spark):
    """Queries of long vectors go along only to the clusters that can still enter their results."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8)) * 40
    rows = [(i, (centres[i % 12] + rng.normal(size=8)).astype(float).tolist(), 0) for i in range(1200)]
    df = op1_topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    clusters, dealt = op1_topk._clusters(df, 50)
    assert sum(clusters.shards) >= 24
    vectors = np.array([[math.floor(float(np.float32(x)) * 256) for x in v] for _, v, _ in rows], float)
    home, _ = clusters.nearest(vectors[:1])
    block = op1_topk.Block(np.array([0]), vectors[:1], int(home[0]))
    scores = np.sort(vectors[1:] @ vectors[0])[::-1]
    block.kth[:] = scores[4]
    visited = [s for number in (1, 2) for s, _ in block.visits(clusters, number)]
    assert len(visited) < sum(clusters.shards) / 2
    bounds = clusters.bounds(vectors[:1])[0]
    at, _ = clusters.nearest(vectors)
    assert all(bounds[c] >= (vectors[at == c] @ vectors[0]).max() for c in set(at.tolist()))
    assert run(spark, rows, shard_rows=50, query_rows=3) == brute(rows)
