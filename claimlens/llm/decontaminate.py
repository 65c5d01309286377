"""Benchmark decontamination: one word-level Aho-Corasick automaton, one scan of each text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import few_rows, kept_and, texts_in, type_of, utf8
from claimlens.sources.storage import stage

WINDOW = 10

# Words of benchmark text per automaton.  Each word starts a window of ten, so this is at
# most 1.5 million states, some 100 MB in a Python worker.  A larger benchmark is scanned
# for in several passes.
BLOCK_WORDS = 150_000

# Bytes to what they count as: A-Z lower-cased, other ASCII that is no digit or letter a space.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_NORMAL).split() if text else []


def blocks_of_items(benchmark: DataFrame, item_column: str, text_column: str, block_words: int, window: int = WINDOW):
    """Lists of ``(item id, words)``, each of at most ``block_words`` words (or ``window``, if more).

    A longer item comes in stretches that share ``window`` - 1 words, so that each of its
    windows is in one.

    The benchmark comes to the driver row by row, block by block; a benchmark is a test
    set and does not grow with the corpus.
    """
    block, size = [], 0
    bound = max(block_words, window)
    rows = benchmark.select(F.col(f"`{item_column}`").alias("i"), utf8(text_column).alias("t"))
    for row in rows.toLocalIterator():
        words = words_of(bytes(row["t"]) if row["t"] is not None else None)
        if not words:
            continue
        for at in range(0, max(1, len(words) - window + 1), bound - window + 1):
            stretch = words[at : at + bound]
            if block and size + len(stretch) > block_words:
                yield block
                block, size = [], 0
            block.append((row["i"], stretch))
            size += len(stretch)
    yield block


def build_automaton(items: list[tuple[object, list[bytes]]], window: int):
    """Automaton over word numbers, and the numbers; a match gives its length and items."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    found: dict[tuple[int, ...], set] = {}
    for item, words in items:
        codes = [numbers.setdefault(w, len(numbers) + 1) for w in words]
        for i in range(max(1, len(codes) - window + 1)):
            found.setdefault(tuple(codes[i : i + window]), set()).add(item)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, ids in found.items():
        automaton.add_word(key, (len(key), tuple(ids)))
    if found:
        automaton.make_automaton()
    return automaton if found else None, numbers


def scan(words: list[bytes], automaton, numbers: dict[bytes, int]):
    """Which words lie in a matching window (None: none), and the items that match."""
    if automaton is None or not words:
        return None, ()
    known = numbers.get
    codes = tuple([known(w, 0) for w in words])
    hit, items = None, set()
    for end, (length, ids) in automaton.iter(codes):
        if hit is None:
            hit = np.zeros(len(words), dtype=bool)
        hit[end - length + 1 : end + 1] = True
        items.update(ids)
    return hit, items


def runs_of(hit: np.ndarray) -> list[tuple[int, int]]:
    """Ranges [from, to) of the words that are hit."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def spans_in_text(text: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """The runs as code point offsets in the original text."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", text.translate(_NORMAL))]
    spans, at, chars = [], 0, 0
    for first, after in runs:
        start, end = places[first][0], places[after - 1][1]
        chars += len(text[at:start].decode())
        begun = chars
        chars += len(text[start:end].decode())
        at = end
        spans.append({"start": begun, "end": chars})
    return spans


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """Per row of ``docs``: id, n_words, n_hit, item_ids, spans.

    Words are runs of digits, letters a-z after lower-casing A-Z, and all non-ASCII
    characters.  A window is ``window`` consecutive words of an item, or the whole item if
    it has fewer; document words inside an occurrence are hit.  ``item_ids`` are the items
    with a matching window, sorted as strings, and ``spans`` the hit stretches of the
    original text in code points.

    A null or empty text, and one without words, has zero words and no hit; so has an item,
    which then matches nothing.  An item without id marks words but is not listed.
    Repeated rows are judged one by one, texts of any length are scanned whole, other
    columns are not read, an empty table gives an empty table.
    """
    spark = docs.sparkSession
    id_type, item_type = type_of(docs, id_column), type_of(benchmark, item_column)
    item_arrow = pa.int64() if item_type in ("bigint", "int", "smallint", "tinyint") else pa.string()
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), utf8(text_column).alias("text"))
    rows = rows.withColumns({"hits": F.lit(None).cast("binary"), "items": F.lit(None).cast(f"array<{'bigint' if item_arrow == pa.int64() else 'string'}>")})
    kept = "array<bigint>" if item_arrow == pa.int64() else "array<string>"
    open_schema = f"id {id_type}, text binary, hits binary, items {kept}"
    done_schema = (
        f"id {id_type}, n_words bigint, n_hit bigint, item_ids {kept}, "
        "spans array<struct<start:bigint,end:bigint>>"
    )

    def pass_over(shared, last: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton, numbers = build_automaton(shared.value, window)
            for batch in few_rows(batches):
                yield (finish if last else carry)(batch, automaton, numbers)

        return run

    def step(text, before, items, automaton, numbers):
        words = words_of(text)
        hit, new = scan(words, automaton, numbers)
        if before is not None:
            old = np.unpackbits(np.frombuffer(before, dtype=np.uint8), count=len(words)).astype(bool)
            hit = old if hit is None else hit | old
        return words, hit, {*(items or ()), *new}

    def columns(batch):
        return zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)

    def carry(batch, automaton, numbers):
        hits, items = [], []
        for text, before, listed in columns(batch):
            _, hit, found = step(text, before, listed, automaton, numbers)
            hits.append(None if hit is None else np.packbits(hit).tobytes())
            items.append(list(found))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(hits, pa.binary()), pa.array(items, pa.list_(item_arrow))],
            names=["id", "text", "hits", "items"],
        )

    def finish(batch, automaton, numbers):
        n_words, n_hit, items, spans = [], [], [], []
        for text, before, listed in columns(batch):
            words, hit, found = step(text, before, listed, automaton, numbers)
            n_words.append(len(words))
            n_hit.append(0 if hit is None else int(hit.sum()))
            items.append(sorted((i for i in found if i is not None), key=str))
            spans.append([] if hit is None else spans_in_text(text, runs_of(hit)))
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_words, pa.int64()),
                pa.array(n_hit, pa.int64()),
                pa.array(items, pa.list_(item_arrow)),
                pa.array(spans, pa.list_(span)),
            ],
            names=["id", "n_words", "n_hit", "item_ids", "spans"],
        )

    waiting = None
    for block in blocks_of_items(benchmark, item_column, text_column, block_words, window):
        if waiting is not None:
            rows = stage(rows.mapInArrow(pass_over(waiting, last=False), open_schema), "scanned")
        waiting = spark.sparkContext.broadcast(block)
    out = rows.mapInArrow(pass_over(waiting, last=True), done_schema)
    return out.withColumnRenamed("id", id_column)


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """The rows of ``docs`` in which no word is hit, all columns as they are.

    Words, windows and null or empty texts are as in ``find_contamination``.
    """
    spark = docs.sparkSession
    names = docs.columns
    for block in blocks_of_items(benchmark, item_column, text_column, block_words, window):
        if block:
            docs = _without(docs, spark.sparkContext.broadcast(block), window, text_column)
    return docs.select(*(F.col(f"`{c}`") for c in names))


def _without(docs: DataFrame, shared, window: int, text_column: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, numbers = build_automaton(shared.value, window)
        for batch in few_rows(batches):
            texts = texts_in(batch.column(0), text_column)
            clean = [scan(words_of(t), automaton, numbers)[0] is None for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))

    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("kept"))
    kept = packed.mapInArrow(run, kept_and(packed))
    return kept.select("kept.*")
