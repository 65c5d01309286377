from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from claimlens.llm.components import connected
from claimlens.llm.simhash import fingerprint, near_links, simhash_clusters


def slow_fingerprint(text: str | None) -> int:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(values: dict[int, int], bits: int) -> dict[int, int]:
    """Smallest id reachable, by search over all pairs."""
    ids = sorted(values)
    near = {i: [j for j in ids if (values[i] ^ values[j]).bit_count() <= bits] for i in ids}
    found: dict[int, int] = {}
    for i in ids:
        waiting = [i]
        while waiting:
            j = waiting.pop()
            if j not in found:
                found[j] = i
                waiting += near[j]
    return found


@pytest.mark.parametrize("text", ["", "  ", "One", "two Words", "three small words", "É ß Ü a\x1cb c\xa0d", "a b c d " * 300])
def test_fingerprint_by_definition(text):
    assert fingerprint(text.encode()) == slow_fingerprint(text)


def test_fingerprint_of_a_text_longer_than_a_block(monkeypatch):
    import claimlens.llm.simhash as module

    text = " ".join(f"w{i * i % 517}" for i in range(3000))
    monkeypatch.setattr(module, "HASHES_AT_A_TIME", 700)
    assert fingerprint(text.encode()) == slow_fingerprint(text)


def near_values(seed: int) -> list[int]:
    """Random values, chains of near ones, and a dense ball."""
    rng = np.random.default_rng(seed)
    values = [int(v) for v in rng.integers(0, 2**64, 150, dtype=np.uint64)]
    for start in values[:30]:
        v = start
        for _ in range(4):
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                v ^= 1 << int(b)
            values.append(v)
    ball = values[40]
    values += [ball ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]
    return list(dict.fromkeys([*values, 0, 2**64 - 1, 7, 2**63, 2**63 + 3]))


@pytest.mark.parametrize(("bits", "bound"), [(3, 500_000), (3, 3), (1, 500_000), (2, 5)])
def test_links_against_all_pairs(spark, bits, bound):
    values = near_values(bits)
    rows = [(int(np.uint64(v).view(np.int64)),) for v in values]
    prints = spark.createDataFrame(rows, "fingerprint bigint")
    roots = {r["node"]: r["root"] for r in connected(near_links(prints, bits, bound)).collect()}
    signed = [r[0] for r in rows]
    got = [roots.get(s, s) for s in signed]
    want = brute_components(dict(enumerate(values)), bits)
    groups: dict[int, set] = {}
    for i, root in enumerate(got):
        groups.setdefault(root, set()).add(want[i])
    assert all(len(g) == 1 for g in groups.values())
    assert len(groups) == len(set(want.values()))
    assert all(root == min(s for s, g in zip(signed, got, strict=True) if g == root) for root in groups)


def test_a_chain_of_components(spark):
    n = 200
    order = np.random.default_rng(3).permutation(n)
    edges = spark.createDataFrame([(int(order[i]), int(order[i + 1])) for i in range(n - 1)], "a bigint, b bigint")
    roots = {r["node"]: r["root"] for r in connected(edges).collect()}
    assert roots == {i: 0 for i in range(1, n)}


def test_documents(spark, small_docs):
    rows = simhash_clusters(small_docs).collect()
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in rows}
    assert len(rows) == len(texts)
    for i in list(texts)[:60]:
        assert prints[i] == slow_fingerprint(texts[i])
    want = brute_components(prints, 3)
    assert {r["doc_id"]: r["component_id"] for r in rows} == want


def test_edges(edge_docs, no_docs):
    rows = simhash_clusters(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    component = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert component[2] == component[3] == component[4] == 2 and component[8] == 1
    assert component[9] == 9 and component[6] == 6 and component[7] == 7
    nothing = [r for r in rows if r["doc_id"] is None and r["fingerprint"] == "0" * 16]
    assert [r["component_id"] for r in nothing] == [2]
    assert simhash_clusters(no_docs).collect() == []


def test_only_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id bigint, text string")
    assert [r["component_id"] for r in simhash_clusters(docs).collect()] == [None, None]
