"""Token counts by heap-and-linked-list byte-pair merging, with no ids made."""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import few_rows, type_of
from claimlens.llm.tokens import PretokenResults


def merge_ranks(path: str) -> tuple[dict[tuple[str, str], int], str]:
    """Rank of each mergeable pair of symbols, and the mark of a word's last symbol."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    pairs = (tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"])
    return {p: i for i, p in enumerate(pairs)}, model["end_of_word_suffix"] or ""


def count_merged(word: str, ranks: dict[tuple[str, str], int], end_mark: str) -> int:
    """Symbols left of ``word`` when no adjacent pair can be merged any more.

    The heap holds (rank, place) of adjacent pairs, the links the places of a symbol's
    neighbours.  The lowest rank is popped, the leftmost on ties; an entry whose pair has
    changed meanwhile is passed over.
    """
    n = len(word)
    if n < 2:
        return n
    symbols = list(word)
    symbols[-1] += end_mark
    rank_of = ranks.get
    heap = []
    for i in range(n - 1):
        rank = rank_of((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i))
    heapify(heap)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    left = n
    while heap:
        rank, i = heappop(heap)
        if symbols[i] is None or (j := after[i]) >= n or rank_of((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = None
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = rank_of((symbols[i], symbols[k]))
            if rank is not None:
                heappush(heap, (rank, i))
        h = before[i]
        if h >= 0:
            rank = rank_of((symbols[h], symbols[i]))
            if rank is not None:
                heappush(heap, (rank, h))
    return left


def count_tokens(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: id, n_bytes and n_tokens of the whole text, as the tokenizer's library counts.

    ``tokenizer_path`` is a byte-level or word-end BPE file every executor can open.  Counts are
    without begin and end tokens; added tokens written out in a text count one each, as the
    library does by default.  A null or empty text has 0 bytes and 0 tokens.  Repeated rows
    are counted one by one, other columns are not read, an empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, end_mark = merge_ranks(tokenizer_path)
        counter = PretokenResults(
            tokenizer_path, lambda word: count_merged(word, ranks, end_mark), lambda _: 1, sum
        )
        for batch in few_rows(batches):
            counts = [counter.of_text(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text")
    )
    out = narrow.mapInArrow(run, f"id {type_of(narrow, 'id')}, n_bytes bigint, n_tokens bigint")
    return out.withColumnRenamed("id", id_column)
