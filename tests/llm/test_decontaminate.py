from __future__ import annotations

import pytest

from claimlens.llm.decontaminate import blocks_of_items, drop_contaminated, find_contamination

ITEMS = [
    (1, "Alpha beta gamma, delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "short item"),
    (3, None),
    (4, " ... "),
    (None, "zeta eta theta iota kappa lambda mu nu xi omicron"),
    (5, "Short ITEM!"),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (1, "So: ALPHA beta-gamma delta; epsilon zeta eta theta iota kappa. End"),
        (2, "alpha beta gamma delta epsilon zeta eta theta iota"),
        (3, "É a short\nitem, short item"),
        (4, None),
        (5, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"),
        (6, "shorts item"),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("block_words", [150_000, 1])
def test_hits_items_and_spans(docs, items, block_words):
    rows = {r["doc_id"]: r for r in find_contamination(docs, items, block_words=block_words).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {i: (r["n_words"], r["n_hit"], r["item_ids"]) for i, r in rows.items()}
    assert got == {
        1: (12, 10, [1]),
        2: (9, 0, []),
        3: (6, 4, [2, 5]),
        4: (0, 0, []),
        5: (15, 14, [1]),
        6: (2, 0, []),
    }
    spans = {i: [texts[i][s["start"] : s["end"]] for s in r["spans"]] for i, r in rows.items() if r["spans"]}
    assert spans == {
        1: ["ALPHA beta-gamma delta; epsilon zeta eta theta iota kappa"],
        3: ["short\nitem, short item"],
        5: ["beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"],
    }
    kept = drop_contaminated(docs, items, block_words=block_words).collect()
    assert sorted(r["doc_id"] for r in kept) == [2, 4, 6]


def test_a_long_item_is_split_and_all_its_windows_stay(spark):
    words = [f"w{i}" for i in range(100)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "a b")], "item_id bigint, text string")
    blocks = list(blocks_of_items(items, "item_id", "text", 40))
    assert all(sum(len(w) for _, w in b) <= 40 for b in blocks)
    docs = spark.createDataFrame([(k, " ".join(words[k : k + 10])) for k in range(91)], "doc_id bigint, text string")
    rows = find_contamination(docs, items, block_words=40).collect()
    assert len(rows) == 91 and all(r["n_hit"] == 10 and r["item_ids"] == [1] for r in rows)
    assert drop_contaminated(docs, items, block_words=40).count() == 0


def test_items_sort_as_strings(spark):
    items = spark.createDataFrame([(10, "x"), (9, "x"), (100, "y")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "y x")], "doc_id bigint, text string")
    assert find_contamination(docs, items).first()["item_ids"] == [10, 100, 9]


def test_edges(spark, edge_docs, no_docs, items):
    empty = items.limit(0)
    assert len(find_contamination(edge_docs, items).collect()) == edge_docs.count()
    assert all(r["n_hit"] == 0 for r in find_contamination(edge_docs, empty).collect())
    assert find_contamination(no_docs, items).collect() == []
    assert drop_contaminated(edge_docs, items).schema == edge_docs.schema
    assert drop_contaminated(edge_docs, empty).count() == edge_docs.count()
    assert drop_contaminated(no_docs, items).collect() == []
