"""Packing token pieces into fixed windows by non-negative least squares.

The plan is made from the histogram of piece lengths alone, so it has a fixed size: which
lengths share a window, how often, and what is left for greedy packing.  Every piece then
finds its window from its rank among all pieces sorted by length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import few_rows, kept_and, type_of
from claimlens.llm.tokens import PretokenResults
from claimlens.sources.storage import stage

WINDOW = 4096
END_ID = 2

# Lengths are rounded up to this many steps per window for the combinations.
STEPS = 256


def tokenize_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Token ids of every document, cut into pieces of at most ``window`` ids.

    Per piece: the document's id, ``start`` (ids before it), ``length``, ``ids`` (little-endian
    unsigned 32-bit) and ``doc_tokens``.  A document's ids are the tokenizer's without added
    begin and end tokens, then ``end_id``; a null or empty text has only that.  All pieces
    but a document's last are full windows.  Repeated rows give their pieces once each,
    other columns are not read, an empty table gives an empty table.
    """
    size = 4 * window
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = [i.to_bytes(4, "little") for i in range(1 << 16)]

        def code(i: int) -> bytes:
            return codes[i] if i < len(codes) else i.to_bytes(4, "little")

        def of_pretoken(word: str) -> bytes:
            return b"".join([code(t.id) for t in model.tokenize(word)])

        tokens = PretokenResults(tokenizer_path, of_pretoken, code, b"".join)
        model = tokens.tokenizer.model
        for batch in few_rows(batches):
            row, start, length, ids, total = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                code_bytes = tokens.of_text(text) + end
                for at in range(0, len(code_bytes), size):
                    piece = code_bytes[at : at + size]
                    row.append(i)
                    start.append(at // 4)
                    length.append(len(piece) // 4)
                    ids.append(piece)
                    total.append(len(code_bytes) // 4)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(total, pa.int64()),
                ],
                names=["id", "start", "length", "ids", "doc_tokens"],
            )

    narrow = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text")
    )
    out = narrow.mapInArrow(
        run,
        f"id {type_of(narrow, 'id')}, start bigint, length bigint, ids binary, doc_tokens bigint",
    )
    return out.withColumnRenamed("id", id_column)


def combinations(steps: int) -> np.ndarray:
    """All ways to fill ``steps`` with up to three parts, as rows of part sizes (0: none)."""
    c = np.arange(1, steps + 1)
    a, b = np.meshgrid(np.arange(0, steps + 1), np.arange(0, steps + 1), indexing="ij")
    keep = (a <= b) & (b <= steps - a - b)
    a, b = a[keep], b[keep]
    rows = np.stack([a, b, steps - a - b], axis=1)
    return rows[np.isin(rows[:, 2], c)]


def solve_nnls(parts: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Repeats x >= 0 of the combinations that minimise ``|A x - wanted|``.

    Active-set method: the combination with the steepest descent joins the passive set, the
    unconstrained solution on that set is approached until a repeat would turn negative,
    which then leaves.  ``A`` has a row per part size and up to three entries per column.
    """
    steps = len(wanted)
    n = len(parts)
    scale = wanted.max() or 1.0
    b = wanted / scale

    def columns(chosen: np.ndarray) -> np.ndarray:
        a = np.zeros((steps + 1, len(chosen)))
        for k in range(3):
            np.add.at(a, (parts[chosen, k], np.arange(len(chosen))), 1.0)
        return a[1:]

    x = np.zeros(n)
    passive = np.zeros(n, dtype=bool)
    residual = b.copy()
    for _ in range(3 * steps):
        pull = np.concatenate(([0.0], residual))[parts].sum(axis=1)
        pull[passive] = -np.inf
        best = int(pull.argmax())
        if pull[best] <= 1e-9:
            break
        passive[best] = True
        while True:
            chosen = np.flatnonzero(passive)
            a = columns(chosen)
            z = np.linalg.solve(a.T @ a + 1e-12 * np.eye(len(chosen)), a.T @ b)
            if z.min() > 0:
                break
            old = x[chosen]
            falls = z <= 0
            step = np.min(old[falls] / np.maximum(old[falls] - z[falls], 1e-300))
            x[chosen] = np.maximum(old + step * (z - old), 0)
            drop = chosen[falls & (x[chosen] <= 1e-12)]
            passive[drop] = False
            x[drop] = 0
            if not passive.any():
                break
        chosen = np.flatnonzero(passive)
        x[:] = 0
        if len(chosen):
            x[chosen] = z
            residual = b - columns(chosen) @ z
        if best not in chosen:  # it cannot help at this precision
            break
    return x * scale


@dataclass
class Plan:
    """Slots: ranges of ranks, sorted, that cover all pieces.

    The i-th piece of a slot goes to window ``sequence + i // each`` at ``base`` plus
    ``i % each`` times its length, after the i-th pieces of up to two earlier slots.
    """

    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    base: np.ndarray
    earlier: np.ndarray
    ends: np.ndarray
    sequences: int

    def length_at(self, rank: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, rank, side="right")

    def place(self, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = np.searchsorted(self.first, rank, side="right") - 1
        i = rank - self.first[slot]
        each = self.each[slot]
        offset = self.base[slot] + (i % each) * self.length_at(rank)
        for k in range(2):
            other = self.earlier[slot, k]
            offset += np.where(other >= 0, self.length_at(np.maximum(other, 0) + i), 0)
        return self.sequence[slot] + i // each, offset


def plan_windows(counts: np.ndarray, window: int, steps: int = STEPS) -> Plan:
    """``counts[n]`` pieces of length n, 1 <= n <= window, placed into windows."""
    steps = min(steps, window)
    ends = np.cumsum(counts)  # ranks below ends[n] have a length of at most n
    unit = -(-window // steps)
    steps = -(-window // unit)
    slots: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0
    bucket_ends = ends[np.minimum(np.arange(steps + 1) * unit, window)]
    parts = combinations(window // unit) if window % unit == 0 else np.zeros((0, 3), dtype=int)
    next_rank = bucket_ends[:-1].copy()
    left = np.diff(bucket_ends)
    if len(parts) and left.sum():
        repeats = np.rint(solve_nnls(parts, left.astype(float))).astype(np.int64)
        for s in np.argsort(-repeats, kind="stable"):
            if not repeats[s]:
                break
            sizes = [int(k) - 1 for k in parts[s][::-1] if k]
            times = min(int(repeats[s]), *(int(left[k]) // sizes.count(k) for k in sizes))
            if not times:
                continue
            earlier: list[int] = []
            for k in sizes:
                slots.append((int(next_rank[k]), sequences, 1, 0, *(earlier + [-1, -1])[:2]))
                earlier.append(int(next_rank[k]))
                next_rank[k] += times
                left[k] -= times
            sequences += times
    # What is left, by exact length: fill windows from the longest down.
    size = np.arange(window + 1)
    bucket = np.maximum(-(-size // unit) - 1, 0)
    start = np.maximum(np.concatenate(([0], ends[:-1])), next_rank[bucket])
    rest = np.maximum(ends - start, 0)
    rest[0] = 0
    while rest.any():
        space, base, pattern = window, 0, []
        while space:
            fits = np.flatnonzero(rest[: space + 1])
            fits = fits[~np.isin(fits, [n for n, _, _ in pattern])] if pattern else fits
            if not len(fits):
                break
            n = int(fits[-1])
            each = min(space // n, int(rest[n]))
            pattern.append((n, each, base))
            space -= n * each
            base += n * each
        times = min(int(rest[n]) // each for n, each, _ in pattern)
        for n, each, at in pattern:
            slots.append((int(start[n]), sequences, each, at, -1, -1))
            start[n] += times * each
            rest[n] -= times * each
        sequences += times
    table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 6)
    return Plan(table[:, 0], table[:, 1], table[:, 2], table[:, 3], table[:, 4:6], ends, sequences)


def pack_pieces(pieces: DataFrame, window: int = WINDOW, length_column: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; lengths are 1 to ``window``.

    Pieces of one window lie end to end from offset 0.  Ranks come from counts per written
    partition and length, so no length, however common, is sorted or collected in one
    place.  ``sequence_id`` and ``offset`` columns of the input are replaced.  Lengths that
    are null or outside 1..window are an error.  An empty table gives an empty table.
    """
    spark = pieces.sparkSession
    named = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    length = F.col(f"`{length_column}`").cast("bigint")
    numbered = stage(
        pieces.select(
            F.struct(*(F.col(f"`{c}`") for c in named)).alias("kept"),
            F.when(length.between(1, window), length)
            .otherwise(F.raise_error(F.lit(f"lengths must be 1 to {window}")).cast("bigint"))
            .alias("n"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "pieces",
    ).withColumn("part", F.shiftright("row", 33))
    per_part = numbered.groupBy("part", "n").count()
    counts = np.zeros(window + 1, dtype=np.int64)
    for n, c in per_part.groupBy("n").agg(F.sum("count")).collect():  # at most one per length
        counts[n] = c
    # plain values: the executors need not have this package
    plan = spark.sparkContext.broadcast(vars(plan_windows(counts, window)))
    below = F.sum("count").over(Window.partitionBy("n").orderBy("part")) - F.col("count")
    # Inside a written partition, which is bounded, a length's pieces are numbered by row.
    nth = F.row_number().over(Window.partitionBy("part", "n").orderBy("row")) - 1
    ranked = (
        numbered.withColumn("nth", nth)
        .join(per_part.select("part", "n", below.alias("below")), ["part", "n"])
        .select("kept", "n", (F.col("below") + F.col("nth")).alias("rank"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Plan(**plan.value)
        starts = np.concatenate(([0], p.ends[:-1]))
        for batch in batches:
            n = batch.column(1).to_numpy(zero_copy_only=False)
            rank = starts[n] + batch.column(2).to_numpy(zero_copy_only=False)
            sequence, offset = p.place(rank)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sequence), pa.array(offset)],
                names=["kept", "sequence_id", "offset"],
            )

    placed = ranked.mapInArrow(place, kept_and(ranked, "sequence_id bigint, offset bigint"))
    return placed.select("kept.*", "sequence_id", "offset")
