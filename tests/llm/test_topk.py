from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import claimlens.llm.topk as module
from claimlens.llm.queries import op12_pivot_topk
from claimlens.llm.topk import top_products

SCHEMA = "vec_id bigint, embedding array<float>"
LONG = (-(2**63), 2**63 - 1)


def brute(rows, is_query, k=5):
    whole = [(i, [min(max(math.floor(256 * float(x)), LONG[0]), LONG[1]) for x in v]) for i, v in rows]
    out = []
    for q, v in whole:
        if is_query(q):
            scores = [(min(max(sum(a * b for a, b in zip(v, w, strict=True)), LONG[0]), LONG[1]), i) for i, w in whole if i != q and len(w) == len(v)]
            best = sorted(scores, key=lambda s: (-s[0], s[1]))[:k]
            out += [(q, rank, i, s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def answers(frame, is_query="vec_id % 50 = 0", **how):
    return sorted(tuple(r) for r in top_products(frame, F.expr(is_query), **how).collect())


def test_embeddings_against_brute_force(spark, small_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in op12_pivot_topk(spark, small_dir).collect()) == brute(rows, lambda i: i % 50 == 0)


@pytest.mark.parametrize(("shard_rows", "annulus", "queries", "task"), [(40, 8, 3, 2), (10_000, 16, 1000, 20_000), (7, 512, 1024, 1)])
def test_shards_annuli_and_tasks(spark, monkeypatch, shard_rows, annulus, queries, task):
    monkeypatch.setattr(module, "ANNULUS", annulus)
    monkeypatch.setattr(module, "QUERY_ROWS", queries)
    monkeypatch.setattr(module, "TASK_QUERIES", task)
    rng = np.random.default_rng(shard_rows)
    middle = rng.normal(size=(6, 4)) * 3
    rows = [(i, [float(x) for x in (middle[i % 6] + rng.normal(size=4) * 0.2).astype(np.float32)]) for i in range(400)]
    rows += [(i, rows[3][1]) for i in range(400, 450)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert answers(frame, "vec_id % 10 = 0", shard_rows=shard_rows) == brute(rows, lambda i: i % 10 == 0)


def test_bounds_leave_annuli_closed(monkeypatch):
    rng = np.random.default_rng(2)
    middle = rng.normal(size=(20, 8)) * 2000
    points = (middle[np.arange(8000) % 20] + rng.normal(size=(8000, 8)) * 20).astype(np.int64)
    top, largest = float((points**2).sum(axis=1).max()), int(abs(points).max())
    plain = module.Space(np.zeros((1, 9)), top, 8, largest)
    space = module.Space(module.centres(plain.lifted(points[:640]), 40), top, 8, largest)
    away = space.gaps(space.lifted(points))
    pivot, near = away.argmin(axis=1), away.min(axis=1)
    order = np.lexsort((near, pivot))
    counted = []
    products = module.Space.products
    monkeypatch.setattr(module.Space, "products", lambda s, q, p: counted.append(len(q) * len(p)) or products(s, q, p))
    ids = np.arange(8000)
    data = pivot[order], near[order], ids[order], points[order]
    q, near_ids, scores = module.search_shard(space, data, ids[:50], points[:50], np.full(50, module.LOWEST), 5)
    all_scores = points[:50] @ points.T
    all_scores[np.arange(50), np.arange(50)] = module.LOWEST
    assert (np.sort(all_scores, axis=1)[:, :-6:-1].ravel() == scores).all()
    assert sum(counted) < 0.5 * 50 * 8000


def test_large_numbers(spark):
    rows = [(0, [3e4, -2e4]), (1, [4e4, 1.5e9]), (2, [-1e30, 1.0]), (3, [1e30, 1e30]), (4, [0.001, -0.001]), (50, [5e5, 5e5]), (5, [-1e17, 1e17])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for size in (100, 2):
        assert answers(frame, "true", shard_rows=size) == brute(rows, lambda i: True)
    few = [(i, [1e7 + i, 3.0]) for i in range(20)]
    assert answers(spark.createDataFrame(few, "vec_id bigint, embedding array<double>"), "true") == brute(few, lambda i: True)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]),
        (50, [0.0, 0.0]),
        (100, None),
        (150, [nan, 1.0]),
        (200, [inf, 1.0]),
        (250, [None, 1.0]),
        (300, [1.0, 2.0, 3.0]),
        (350, []),
        (400, []),
        (None, [1.0, 1.0]),
        (1, [1.0, 1.0]),
        (2, [1.0, 1.0]),
        (2, [1.0, 1.0]),
        (0, [1.0, 0.5]),
    ]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", rank int, score int")
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    assert answers(frame) == brute(good, lambda i: i % 50 == 0)
    assert answers(frame.limit(0)) == [] and answers(frame.filter("vec_id = 300"), "true") == []
