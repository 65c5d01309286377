from __future__ import annotations

from collections import defaultdict

import pytest

from claimlens.llm.queries import op4_histogram_sort
from claimlens.llm.sharding import LOWEST, between, place_expression, shard_rows


def check(rows, n_shards, largest):
    shards = defaultdict(list)
    for r in rows:
        shards[r["shard"]].append(r)
    assert set(shards) <= set(range(n_shards))
    for own in shards.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    total = sum(r["size"] or 0 for r in rows)
    for i in range(n_shards):
        bytes_here = sum(r["size"] or 0 for r in shards[i])
        assert abs(bytes_here - total / n_shards) <= 0.001 * total / n_shards + largest
    keys = [r["key_in"] for i in range(n_shards) for r in sorted(shards[i], key=lambda r: r["slot"])]
    assert keys == sorted(keys, key=lambda k: (k is not None, k))


def test_place_by_decision_tree(spark):
    probes = [(-5, LOWEST), (3, LOWEST), (3, 7), (LOWEST + 4, LOWEST), (9, 2)]
    probes.sort()
    rows = [(k, r) for k in (LOWEST, LOWEST + 4, -6, -5, 2, 3, 8, 9, 10) for r in (0, 2, 6, 7, 8)]
    frame = spark.createDataFrame(rows, "key bigint, row bigint")
    got = frame.selectExpr("key", "row", f"{place_expression(probes)} AS place").collect()
    assert all(r["place"] == sum(p <= (r["key"], r["row"]) for p in probes) for r in got)


def test_probes_lie_strictly_between():
    for low, high in [((0, LOWEST), (100, LOWEST)), ((0, LOWEST), (1, LOWEST)), ((5, 3), (5, 90)), ((5, 3), (5, 4)), ((5, 8), (6, LOWEST))]:
        probes = between(low, high, 7, (0, 1000))
        assert probes == sorted(set(probes)) and all(low < p < high for p in probes)
        assert probes or (low, high) == ((5, 3), (5, 4))


@pytest.mark.parametrize("case", ["spread", "hot", "one key", "far apart", "few"])
def test_near_equal_bytes(spark, case):
    keys = {
        "spread": [i * 37 % 5000 for i in range(5000)],
        "hot": [77 if i % 3 else i for i in range(5000)],
        "one key": [4] * 5000,
        "far apart": [(-1) ** i * 2 ** (i % 62) for i in range(5000)],
        "few": [1, 2, 3],
    }[case]
    rows = [(k, (i * 7919) % 900 + 8, i) for i, k in enumerate(keys)]
    frame = spark.createDataFrame(rows, "key_in bigint, size bigint, place int").repartition(5)
    got = shard_rows(frame, 8, "key_in", "size").collect()
    assert sorted(r["place"] for r in got) == list(range(len(keys)))
    check(got, 8, largest=908)


def test_nulls_clashes_and_empty(spark):
    rows = [(None, 5, "a"), (None, None, "b"), (3, 9, "c"), (3, 9, "c"), (2**63 - 1, 1, None)]
    schema = "key_in bigint, size bigint, shard string"
    got = shard_rows(spark.createDataFrame(rows, schema), 3, "key_in", "size").collect()
    assert len(got) == 5
    check(got, 3, largest=9)
    assert shard_rows(spark.createDataFrame([], schema), 3, "key_in", "size").collect() == []
    assert len(shard_rows(spark.createDataFrame([(1, 0, ""), (2, None, "")], schema), 3, "key_in", "size").collect()) == 2


def test_documents(spark, small_dir, small_docs):
    import zlib

    rows = op4_histogram_sort(spark, small_dir).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in small_docs.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 8, zlib.crc32(texts[r["doc_id"]]))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
    check([{**r.asDict(), "key_in": r["doc_id"]} for r in rows], 24, largest=max(r["size"] for r in rows))


def test_edge_documents(spark, edge_docs):
    sized = edge_docs.selectExpr("*", "coalesce(octet_length(text), 0) + 8 AS size", "doc_id AS key_in")
    got = shard_rows(sized, 4, "doc_id", "size").collect()
    assert len(got) == edge_docs.count()
    check(got, 4, largest=max(r["size"] for r in got))
