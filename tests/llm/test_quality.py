from __future__ import annotations

import zlib

import numpy as np
import pytest

from claimlens.llm.quality import N_FEATURES, AttentionModel, fit_quality, keep_good, score_quality, scores_of
from claimlens.llm.queries import op8_quality


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    x, starts, y = rng.normal(size=(30, 9)), np.array([0, 3, 4, 12, 20]), np.array([1, 0, 1, 0, 1.0])
    model = AttentionModel.fresh(x.mean(0), x.std(0), encoded=5, hidden=4)
    gradient = model.gradient(x, starts, y)

    def loss():
        p = model.forward(x, starts)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, g in gradient.items():
        for at in np.ndindex(g.shape):
            old = model.w[name][at]
            model.w[name][at] = old + 1e-5
            up = loss()
            model.w[name][at] = old - 1e-5
            down = loss()
            model.w[name][at] = old
            assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-7)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = op8_quality(spark, folder).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert len(judged) > 100 and np.mean([p == y for p, y in judged]) > 0.95


def test_attention_sums_to_one_and_order_of_documents_is_free():
    rng = np.random.default_rng(2)
    model = AttentionModel.fresh(np.zeros(N_FEATURES), np.ones(N_FEATURES))
    texts = [b"some words here", None, b"x " * 700, b"", b"UPPER!! CASE!!"]
    scores = scores_of(texts, model.w)
    assert scores[1] == scores[3]
    order = rng.permutation(len(texts))
    assert np.allclose(scores_of([texts[i] for i in order], model.w), scores[order])
    attention = model.forward(rng.normal(size=(6, N_FEATURES)), np.array([0, 1, 4]))["attention"]
    assert np.allclose(np.add.reduceat(attention, [0, 1, 4]), 1)


def test_without_both_labels_one_score_for_all(spark, small_docs):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, quality int")
    assert fit_quality(small_docs, none) == 0.5
    ids = [r["doc_id"] for r in small_docs.select("doc_id").collect()]
    ones = spark.createDataFrame([(i, 1) for i in ids], "doc_id bigint, quality int")
    score = fit_quality(small_docs, ones)
    n = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in ids)
    assert score == pytest.approx((n + 1) / (n + 2))
    assert {r["score"] for r in score_quality(small_docs, score).collect()} == {score}


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (3, 0), (6, 0), (9, 1), (9, 1), (7, None), (99, 1)], "doc_id bigint, quality int")
    model = fit_quality(edge_docs, labels)
    rows = score_quality(edge_docs, model).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r["doc_id"]: r["score"] for r in rows if r["doc_id"] is not None}
    assert by_id[2] == by_id[3] == by_id[4] and by_id[1] == pytest.approx(by_id[8], abs=1e-12)
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    kept = keep_good(edge_docs, model)
    assert kept.schema == edge_docs.schema
    assert kept.count() == sum(r["predicted"] for r in rows)
    assert score_quality(no_docs, model).collect() == [] and keep_good(no_docs, 0.4).collect() == []
    assert fit_quality(no_docs, labels) == 0.5


def test_a_repeated_id_is_fitted_once(spark, monkeypatch):
    from claimlens.llm import quality

    seen = []
    whole = quality.train
    monkeypatch.setattr(quality, "train", lambda x, starts, y: seen.append(len(y)) or whole(x, starts, y, epochs=1))
    docs = spark.createDataFrame([(1 + k % 30, f"text {k}") for k in range(60)] + [(1, f"other text {k}") for k in range(500)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 31)], "doc_id bigint, quality int")
    quality.fit_quality(docs, labels)
    ids = labels.filter(~quality.held_out("doc_id")).count()
    assert seen == [ids]


def test_long_texts_are_fitted_too(spark, monkeypatch):
    """Passages from all over a long text, the same ones whichever way it is read."""
    from claimlens.llm import quality

    groups = quality.passages(b" ".join(b"w%d" % (i * i) for i in range(90_000)))
    chosen = quality.sample(groups, 100)
    at = [groups.index(g) for g in chosen]
    assert len(at) == 100 and at == sorted(at) and at[0] < 100 and at[-1] > 800
    assert quality.sample(groups[:100], 100) == groups[:100]
    # repeated passages tie; the earlier ones are taken
    assert quality.sample([[b"a"]] * 5, 3) == [[b"a"]] * 3

    seen = []
    whole = quality.train
    monkeypatch.setattr(quality, "train", lambda x, starts, y: seen.append((len(x), len(y))) or whole(x, starts, y, epochs=1))
    texts = {1: "word " * 60_000, 2: "other " * 250, 3: "", 4: None}
    ids = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 3 != 1][:4]
    docs = spark.createDataFrame([(i, texts[k]) for k, i in enumerate(ids, 1)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, k % 2) for k, i in enumerate(ids)], "doc_id bigint, quality int")
    quality.fit_quality(docs, labels)
    assert seen == [(100 + 3 + 1 + 1, 4)]
