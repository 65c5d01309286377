from __future__ import annotations

import os
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from claimlens.llm.packing import combinations, pack_pieces, plan_windows, solve_nnls, tokenize_pieces
from claimlens.llm.queries import op2_packing, tokenizer_file

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def check_windows(rows, window):
    windows = defaultdict(list)
    for r in rows:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    return len(windows)


def test_combinations_fill_the_window_once_each():
    rows = combinations(12)
    assert (rows.sum(axis=1) == 12).all()
    want = {tuple(sorted((a, b, 12 - a - b))) for a in range(13) for b in range(13 - a)}
    assert {tuple(sorted(r)) for r in rows.tolist()} == want and len(rows) == len(want)


@pytest.mark.parametrize("seed", range(4))
def test_least_squares_meets_the_optimality_conditions(seed):
    rng = np.random.default_rng(seed)
    steps = 24
    parts = combinations(steps)
    wanted = rng.poisson(40, steps).astype(float) * (rng.random(steps) < 0.8)
    x = solve_nnls(parts, wanted)
    a = np.zeros((steps + 1, len(parts)))
    for j, row in enumerate(parts):
        for k in row:
            a[k, j] += 1
    a = a[1:]
    pull = a.T @ (wanted - a @ x)
    assert (x >= 0).all() and pull.max() < 1e-4 and np.abs(pull[x > 1e-6]).max(initial=0) < 1e-4


@pytest.mark.parametrize("window", [16, 100, 4096])
@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_plan_places_every_piece_once(window, n):
    rng = np.random.default_rng(n)
    lengths = np.sort(np.clip(rng.lognormal(np.log(window) - 1.2, 1.1, n).astype(int), 1, window))
    plan = plan_windows(np.bincount(lengths, minlength=window + 1), window)
    sequence, offset = plan.place(np.arange(n))
    rows = [dict(sequence_id=s, offset=o, length=k) for s, o, k in zip(sequence.tolist(), offset.tolist(), lengths.tolist())]
    assert check_windows(rows, window) == plan.sequences
    if n == 5000:
        assert 1 - lengths.sum() / (plan.sequences * window) < 0.03


def test_one_length_only():
    counts = np.zeros(4097, dtype=np.int64)
    counts[1500] = 10**9
    assert plan_windows(counts, 4096).sequences == 5 * 10**8


def test_documents_against_the_library(spark, small_dir, small_docs):
    library = Tokenizer.from_file(tokenizer_file())
    ids = {r["doc_id"]: [*library.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in small_docs.collect()}
    rows = op2_packing(spark, small_dir).collect()
    windows = check_windows(rows, 4096)
    assert 1 - sum(map(len, ids.values())) / (4096 * windows) < 0.05
    pieces = defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        part = own[r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(own)
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r["ids_crc32"]
        pieces[r["doc_id"]].append((r["start"], r["length"]))
    assert set(pieces) == set(ids)
    for i, parts in pieces.items():
        parts.sort()
        assert [s for s, _ in parts] == list(range(0, len(ids[i]), 4096))
        assert sum(n for _, n in parts) == len(ids[i])


def test_edges(edge_docs, no_docs):
    pieces = tokenize_pieces(edge_docs, tokenizer_file())
    rows = pack_pieces(pieces.withColumnRenamed("start", "sequence_id")).collect()
    check_windows(rows, 4096)
    assert Counter(r["doc_id"] for r in rows if r["length"] == 1)[2] == 1
    per_row = Counter(r["doc_id"] for r in rows)
    assert per_row[9] == 2 and per_row[None] == 2 and per_row[5] > 1
    assert all(len(r["ids"]) == 4 * r["length"] for r in rows)
    assert pack_pieces(tokenize_pieces(no_docs, tokenizer_file())).collect() == []


def test_a_wrong_length_is_an_error(spark):
    with pytest.raises(Exception, match="lengths must be"):
        pack_pieces(spark.createDataFrame([(5,), (None,)], "length bigint"), window=8).collect()
