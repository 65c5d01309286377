from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

import claimlens.llm.runs as module
from claimlens.llm.queries import op13_runs
from claimlens.llm.runs import find_runs, runs_of_texts


def brute(words, min_length=24, min_exponent=3):
    """Every stretch with w[i] == w[i + q] as long as it goes, for each q."""
    found = {}
    for q in range(1, len(words) // min_exponent + 1):
        k = 0
        while k < len(words) - q:
            start = k
            while k < len(words) - q and words[k] == words[k + q]:
                k += 1
            if k > start and k - start + q >= max(min_length, min_exponent * q):
                found.setdefault((start, k - start + q), q)
            k += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("many", [0, 1, 16])
def test_against_brute_force(monkeypatch, many):
    monkeypatch.setattr(module, "MANY_CLASSES", many)
    rng = random.Random(many)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(1, 4)):
            words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 60))]
            if words and rng.random() < 0.6:
                p, at = rng.randint(1, len(words)), rng.randrange(len(words))
                words = [w if i < at else words[at + (i - at) % p] for i, w in enumerate(words)]
            texts.append(words)
        length, exponent = rng.choice([2, 4, 10, 24]), rng.choice([2, 3, 4])
        assert runs_of_texts(texts, length, exponent) == [brute(w, length, exponent) for w in texts]


def test_many_left_words_and_one_word_repeated():
    lines = [w for i in range(300) for w in (b"l%d" % i, *(b"k%d" % j for j in range(19)))]
    stretches = [w for i in range(25) for w in (b"l%d" % i, *[b"a"] * 200)]
    assert runs_of_texts([lines, stretches]) == [[], [(1 + 201 * i, 200, 1) for i in range(25)]]
    assert runs_of_texts([[b"a"] * 50_000]) == [[(0, 50_000, 1)]]


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_documents(spark, small_dir, small_docs):
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    got = op13_runs(spark, small_dir).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    some = 0
    for r in got:
        words = planted(r["doc_id"], (texts[r["doc_id"]] or "").encode().split())
        runs = brute(words)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
        assert r["n_runs"] == len(runs)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want
        assert r["runs_sha256"] == hashlib.sha256(listed).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(left).hexdigest()
        some += bool(runs)
    assert some > 5


def test_edges(spark, edge_docs, no_docs):
    docs = edge_docs.withColumnRenamed("rank", "runs").withColumnRenamed("part", "Collapsed")
    got = find_runs(docs, min_length=4, min_exponent=2).collect()
    assert len(got) == docs.count()
    assert all(r["runs"] == [] and r["collapsed"] == "" for r in got if r["doc_id"] in (2, 3, 4))
    assert all(r["kept"] == "x" and r["a column"] == "y" for r in got)
    assert find_runs(no_docs).collect() == []
    rows = spark.createDataFrame([(1, "a\tb\n" * 12), (1, "a\tb\n" * 12), (2, "x " + "\u00e9\xa0 \x0b" * 30)], "doc_id int, text string")
    by_id = {r["doc_id"]: (r["runs"], r["collapsed"]) for r in find_runs(rows).collect()}
    assert by_id == {1: ([(0, 24, 2)], "a b"), 2: ([(1, 30, 1)], "x \u00e9\xa0")}


def test_one_period_or_word_is_refused(no_docs):
    for length, exponent in ((24, 1), (1, 3)):
        with pytest.raises(ValueError):
            find_runs(no_docs, length, exponent)
