from __future__ import annotations

from collections import Counter

import corpus_pipeline
from claimlens.llm.decontaminate import find_contamination
from claimlens.llm.quality import fit_quality, score_quality
from claimlens.llm.simhash import simhash_clusters
from claimlens.sources.storage import stage
from llm.conftest import PASSAGE
from llm.test_packing import check_windows
from llm.test_substring import brute


def test_every_stage_on_what_came_before(spark, small_dir, small_docs):
    """Each stage's rows against the plain definition, applied to that stage's own input."""
    steps = dict(corpus_pipeline.STAGES)
    assert 4 <= len(steps) <= 5
    docs = small_docs
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        seen[name] = docs
        docs = stage(step(spark, docs, small_dir), "test")
        if name != "packing":
            assert docs.columns == small_docs.columns
        seen[name + " done"] = docs

    def ids(df):
        return Counter(r["doc_id"] for r in df.select("doc_id").collect())

    name = "quality classifier"
    model = fit_quality(seen[name], spark.read.parquet(f"{small_dir}/labels.parquet"))
    good = [r["doc_id"] for r in score_quality(seen[name], model).collect() if r["score"] >= 0.5]
    assert ids(seen[name + " done"]) == Counter(good)

    name = "simhash near-dedup"
    clusters = simhash_clusters(seen[name]).collect()
    assert ids(seen[name + " done"]) == Counter({r["component_id"] for r in clusters})

    name = "substring dedup"
    want = brute({r["doc_id"]: r["text"] for r in seen[name].collect()})
    got = seen[name + " done"].collect()
    assert {r["doc_id"]: r["text"] for r in got} == {i: t for i, (t, _) in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in got if want[r["doc_id"]][1])

    name = "benchmark decontamination"
    items = spark.read.parquet(f"{small_dir}/benchmark.parquet")
    clean = [r["doc_id"] for r in find_contamination(seen[name], items).collect() if not r["n_hit"]]
    assert ids(seen[name + " done"]) == Counter(clean) and len(clean) < seen[name].count()

    rows = docs.collect()
    check_windows(rows, 4096)
    assert {r["doc_id"] for r in rows} == set(clean)


def test_one_row_without_id_stays_in_a_group_without_ids(spark, small_dir):
    alone = "Quite other words that stand in no text with an id, not even in a similar one."
    rows = [(None, alone), (None, alone), (None, PASSAGE), (7, PASSAGE), (7, PASSAGE), (8, PASSAGE), (None, "A third text that nothing else here is like.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    left = corpus_pipeline.near_duplicates(spark, docs, small_dir)
    assert left.columns == docs.columns
    assert Counter(map(tuple, left.collect())) == Counter([(None, alone), (7, PASSAGE), (7, PASSAGE), rows[-1]])


def test_a_column_named_like_the_key_is_kept(spark, small_dir):
    rows = [(None, "some words that are the same", 5), (None, "some words that are the same", 5), (3, "quite other words stand here", 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `Document Key` int")
    kept = corpus_pipeline.near_duplicates(spark, docs, small_dir)
    assert kept.columns == docs.columns
    assert sorted(r["Document Key"] for r in kept.collect()) == [5, 6]


def test_edges(spark, small_dir, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, step in corpus_pipeline.STAGES:
            after = stage(step(spark, docs, small_dir), "test")
            if name != "packing":
                assert after.columns == docs.columns
            docs = after
    assert docs.collect() == []


def test_run_is_the_stages_in_turn(spark, small_dir):
    rows = corpus_pipeline.run(spark, small_dir).collect()
    assert rows and check_windows(rows, 4096)
