from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.llm.ann import build_tree, nearest, search_tree, shard_gaps
from claimlens.llm.queries import op7_vp_trees

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, is_query, k=10):
    """(query, rank) to (id, score), from all distances in double precision."""
    out = {}
    for q, v in rows:
        if not is_query(q):
            continue
        near = sorted(
            (float(np.sqrt(((np.array(v, float) - np.array(w, float)) ** 2).sum())), i)
            for i, w in rows
            if i != q and len(w) == len(v)
        )
        for rank, (d, i) in enumerate(near[:k], 1):
            out[q, rank] = (i, d)
    return out


def same(got, want):
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in got} == {k: i for k, (i, _) in want.items()}
    for r in got:
        assert r["score"] == pytest.approx(want[r["query_id"], r["rank"]][1], rel=1e-12, abs=1e-12)


def test_embeddings_against_brute_force(spark, small_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{small_dir}/embeddings.parquet").collect()]
    same(op7_vp_trees(spark, small_dir).collect(), brute(rows, lambda i: i % 100 == 0))


@pytest.mark.parametrize(("shard_rows", "query_block"), [(10_000, 1000), (40, 7)])
def test_shards_and_query_blocks(spark, shard_rows, query_block):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = nearest(frame, F.col("vec_id") % 20 == 0, shard_rows=shard_rows, query_block=query_block).collect()
    same(got, brute(rows, lambda i: i % 20 == 0))


def test_equal_vectors_tie_to_the_smaller_id(spark):
    rows = [(i, [1.0, 2.0]) for i in range(500)] + [(i, [float(i), 1.0]) for i in range(500, 520)]
    got = nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, shard_rows=100).collect()
    same(got, brute(rows, lambda i: i % 100 == 0))


def test_few_shards_are_searched_where_pivots_part_the_vectors(spark):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(40, 3))[rng.integers(40, size=3000)] * 100 + rng.normal(size=(3000, 3))
    rows = [(i, [float(x) for x in p.astype(np.float32)]) for i, p in enumerate(points)]
    got = nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 100 == 0, shard_rows=100)
    same(got.collect(), brute(rows, lambda i: i % 100 == 0))


def test_long_vectors(spark):
    rows = [(i, [float(x) for x in np.random.default_rng(i).normal(size=2000).astype(np.float32)]) for i in range(60)]
    same(nearest(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0, shard_rows=25).collect(), brute(rows, lambda i: i % 20 == 0))


def test_shard_gaps_are_never_too_large():
    rng = np.random.default_rng(6)
    points, pivots = rng.normal(size=(500, 3)), rng.normal(size=(4, 3))
    away = np.sqrt(((points[:, None] - pivots[None]) ** 2).sum(axis=2))
    for p in range(4):
        for part in np.array_split(np.argsort(away[:, p]), 5):
            gap = shard_gaps(away, np.array([p]), away[part, p].min(keepdims=True), away[part, p].max(keepdims=True))[:, 0]
            assert (gap <= np.sqrt(((points[:, None] - points[None, part]) ** 2).sum(axis=2)).min(axis=1)).all()


def test_a_larger_factor_searches_less_and_finds_most():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(4000, 4))
    ids = np.arange(4000)
    tree = build_tree(ids, points, leaf=16)
    want, _ = search_tree(tree, ids[:50], points[:50], 10, 1.0)
    got, _ = search_tree(tree, ids[:50], points[:50], 10, 1.3)
    assert np.mean([len({*a} & {*b}) / 10 for a, b in zip(want.tolist(), got.tolist())]) > 0.9


def test_very_large_and_small_vectors_keep_all_candidates(spark):
    rows = [(0, [3e200, 0.0]), (1, [0.0, 4e200]), (2, [3e-200, 1e-200]), (3, [1e-200, 1e-200]), (4, [-1.5e308, 1.0]), (5, [1.5e308, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for size in (100, 2):
        got = {(r["query_id"], r["vec_id"]): r["score"] for r in nearest(frame, F.lit(True), shard_rows=size).collect()}
        assert len(got) == 30
        assert got[0, 1] == pytest.approx(5e200) and got[2, 3] == pytest.approx(2e-200) and got[4, 5] == float("inf")


def test_trees_of_large_vectors_lose_nothing():
    points = np.random.default_rng(3).normal(size=(600, 3)) * 1e200
    points[::50] *= 3e107
    ids = np.arange(600)
    got, _ = search_tree(build_tree(ids, points, leaf=8), ids, points, 10, 1.0)
    want, _ = search_tree(build_tree(ids, points, leaf=600), ids, points, 10, 1.0)
    assert (got == want).all()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]),
        (100, [0.0, 0.0]),
        (200, None),
        (300, [nan, 1.0]),
        (400, [inf, 1.0]),
        (500, [None, 1.0]),
        (600, [1.0, 2.0, 3.0]),
        (700, []),
        (None, [1.0, 1.0]),
        (1, [1.0, 1.0]),
        (2, [1.0, 1.0]),
        (2, [1.0, 1.0]),
        (0, [1.0, 0.5]),
    ]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", rank int, score int")
    got = nearest(frame, F.col("vec_id") % 100 == 0).collect()
    assert {r["query_id"] for r in got} == {0}
    answers = sorted((r["rank"], r["vec_id"], r["score"]) for r in got)
    assert answers == [(1, 1, 0.5), (1, 1, 1.0), (2, 2, 0.5), (2, 2, 1.0), (3, 2, 0.5), (3, 2, 1.0)]
    assert nearest(frame.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert nearest(frame.filter("vec_id = 600"), F.lit(True)).collect() == []
