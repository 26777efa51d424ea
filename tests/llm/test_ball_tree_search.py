"""Exact top-k search against all inner products."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from plyspark.llm import ball_tree_search as bt


def brute(rows, k=5, scale=256):
    kept = []
    for vec_id, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) and math.isfinite(x * scale) for x in v):
            kept.append((vec_id, [math.floor(x * scale) for x in v]))
    out = []
    for i, (qid, q) in enumerate(kept):
        if qid is None or qid % 50:
            continue
        found = []
        for j, (cid, c) in enumerate(kept):
            if i != j and len(c) == len(q):
                score = min(max(sum(a * b for a, b in zip(q, c)), -(2**63)), 2**63 - 1)
                found.append((-score, cid is None, cid or 0, cid))
        found.sort(key=lambda x: x[:3])
        out += [(qid, r + 1, cid, -s) for r, (s, _, _, cid) in enumerate(found[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted([(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()], key=str)


def frame(spark, data):
    clash = {c: F.lit("x") for c in ("_id", "_uid", "_query", "_dim", "rank", "score")}
    return spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumns(clash).repartition(3)


QUERY = "vec_id % 50 = 0"


@pytest.mark.parametrize("shard_bytes", [1, 4 << 20])
def test_matches_all_inner_products(spark, shard_bytes):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(6, 8))
    data = [(i, (centre[i % 6] + 0.2 * rng.normal(size=8)).tolist()) for i in range(900)]
    data += [(i, [0.5] * 8) for i in range(1000, 1200)]  # a group of copies
    data += [data[50], data[50], data[51], (None, data[50][1]), (None, None), (1300, None), (1350, [None] * 8)]
    data += [(1400, [math.nan] * 8), (1401, [math.inf] * 8), (1450, [1.0] * 3), (1451, [2.0] * 3), (1500, []), (1550, []), (-50, [0.1] * 8)]
    assert rows(bt.top_inner_products(frame(spark, data), QUERY, shard_bytes=shard_bytes)) == brute(data)


def test_scores_beyond_doubles_stay_exact(spark):
    data = [(0, [3.0e9, 1.0, -7.0]), (1, [2.9e9, 1 / 256, 0.0]), (2, [2.9e9, 2 / 256, 0.0]), (3, [-1.0, 5.0, 6.0]), (4, [1e300, 1.0, 1.0])]
    data += [(50, [1e306, 1.0, 1.0]), (5, [1.7e308, 0.0, 0.0])]
    assert rows(bt.top_inner_products(frame(spark, data), QUERY)) == brute(data)


def test_empty_and_lonely(spark):
    assert bt.top_inner_products(frame(spark, [(0, [1.0])]).limit(0), QUERY).count() == 0
    assert bt.top_inner_products(frame(spark, [(0, [1.0])]), QUERY).count() == 0
    assert bt.top_inner_products(frame(spark, [(1, [1.0]), (2, [1.0])]), QUERY).count() == 0


def test_blocks_of_queries_and_roots(spark, monkeypatch):
    monkeypatch.setattr(bt, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(bt, "BLOCK_ROOTS", 2)
    rng = np.random.default_rng(2)
    data = [(i * 10, rng.normal(size=4).tolist()) for i in range(120)]
    assert rows(bt.top_inner_products(frame(spark, data), QUERY, k=3, shard_bytes=1)) == brute(data, 3)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(16, 12))
    values = np.floor(256 * (centre[rng.integers(0, 16, 4000)] + 0.05 * rng.normal(size=(4000, 12))))
    ids = rng.permutation(4000)
    tree = bt.BallTree(values, ids, np.zeros(4000, bool), np.arange(4000))
    queries = values[:20]
    norm = np.sqrt((queries**2).sum(1))
    for cuts, centres, radius, smallest in tree.levels:
        bound = bt.upper_bounds(queries, norm, centres, radius)
        for j, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            assert (bound[:, j] >= (queries @ tree.values[a:b].T).max(1)).all()
            assert smallest[j] == tree.ids[a:b].min()
    seen = []
    plain = bt.inner_products
    bt.inner_products = lambda v, q, m: seen.append(len(v) * len(q)) or plain(v, q, m)
    try:
        tree.search(queries, np.arange(20), np.full(20, bt._LOW), np.full(20, bt.HIGHEST), 5)
    finally:
        bt.inner_products = plain
    assert sum(seen) < 0.5 * 20 * 4000
