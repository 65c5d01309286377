"""Average ranks of many columns by one range sort.

All columns are put into one long table (column, value, row), which is range-partitioned on
all three, so that a value held by very many rows spreads over ranges.  A row's rank follows
from its place in its range and from the ranges before it; only equal values that reach
over a border need more, and those are listed with one or two entries per range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.text import quoted, rows
from claimlens.operators.ordering import ROWS_PER_RANGE
from claimlens.sources.storage import stage

_TIED = "_part int, _c int, _v double, _row long, _first long, _last long"


def _mark_ties(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To every row of a sorted range, the places of the first and last row equal to it.

    Rows of one value are held back until the value ends, so at most a range is held.
    """
    held: list[pa.RecordBatch] = []
    first = n_held = 0

    def close() -> Iterator[pa.RecordBatch]:
        for batch in held:
            yield placed(batch, np.full(batch.num_rows, first), np.full(batch.num_rows, first + n_held - 1))

    def placed(batch: pa.RecordBatch, lo: np.ndarray, hi: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(lo, pa.int64()), pa.array(hi, pa.int64())],
            names=["_part", "_c", "_v", "_row", "_first", "_last"],
        )

    def same(a: tuple, b: tuple) -> bool:
        return a[0] == b[0] and (a[1] == b[1] or (a[1] != a[1] and b[1] != b[1]))

    def key(batch: pa.RecordBatch, i: int) -> tuple:
        return batch.column(1)[i].as_py(), batch.column(2)[i].as_py()

    for batch in batches:
        size = batch.num_rows
        if not size:
            continue
        c, v = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        equal = (v[1:] == v[:-1]) | (np.isnan(v[1:]) & np.isnan(v[:-1]))
        starts = np.concatenate(([0], np.flatnonzero((c[1:] != c[:-1]) | ~equal) + 1))
        goes_on = bool(held) and same(key(held[-1], held[-1].num_rows - 1), key(batch, 0))
        if goes_on:
            end = int(starts[1]) if len(starts) > 1 else size
            held.append(batch.slice(0, end))
            n_held += end
            starts = starts[1:]
        if not len(starts):
            continue
        yield from close()
        base = first + n_held - int(starts[0])  # place of the batch's row 0
        whole, last = int(starts[0]), int(starts[-1])
        if last > whole:
            sizes = np.diff(starts)
            lo = np.repeat(base + starts[:-1], sizes)
            yield placed(batch.slice(whole, last - whole), lo, lo + np.repeat(sizes, sizes) - 1)
        held, first, n_held = [batch.slice(last)], base + last, size - last
    yield from close()


def sorted_ranks(df: DataFrame, cols: Sequence[str], name: str = "ranks", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Long table ``_row, _c, mid_rank, total``: of every non-null value of ``cols[_c]`` the
    average rank among the column's values, and how many these are.

    ``df`` is written once with row numbers, its values once in sorted order.  NaN counts as larger than any
    number and equal to itself; nulls have no rank; an empty table gives an empty one.
    """
    casts = [f"CAST({quoted(c)} AS DOUBLE) + 0D AS _{i}" for i, c in enumerate(cols)]
    wide = stage(df.selectExpr(*casts).withColumn("_row", F.monotonically_increasing_id()), f"{name}-rows")
    n_rows = sum(wide.agg(*[F.count(f"_{i}") for i in range(len(cols))]).first())
    long = wide.selectExpr(
        rows([{"_c": str(i), "_v": f"_{i}"} for i in range(len(cols))]), "_row"
    ).filter("_v IS NOT NULL")
    order = ["_c", "_v", "_row"]
    parts = -(-n_rows // rows_per_range)
    if parts > 1:
        ranged = long.repartitionByRange(parts, *order)
    else:  # adaptive execution merges small ranges
        ranged = long.repartitionByRange(*order)
    ordered = ranged.sortWithinPartitions(*order).select(F.spark_partition_id().alias("_part"), *order)
    places = stage(ordered.mapInArrow(_mark_ties, _TIED), f"{name}-places")

    # one row per range and column in it: what follows up to ``edges`` is small by construction
    per_range = places.groupBy("_part", "_c").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_first").alias("start"),
        F.min("_v").alias("head"),
        F.max("_v").alias("tail"),
        (F.min("_last") - F.min("_first")).alias("head_more"),
        (F.max("_last") - F.max("_first")).alias("tail_more"),
    )
    before = Window.partitionBy("_c").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = per_range.withColumns(
        {
            "before": F.coalesce(F.sum("n").over(before), F.lit(0)),
            "total": F.sum("n").over(Window.partitionBy("_c")),
        }
    )
    head = Window.partitionBy("_c", "value")
    borders = ends.select(
        "*",
        F.expr(
            "inline(array("
            "named_struct('at', 'head', 'value', head, 'low', before, 'high', before + head_more),"
            "named_struct('at', 'tail', 'value', tail, 'low', before + n - 1 - tail_more, 'high', before + n - 1)))"
        ),
    ).withColumn("mid", (F.min("low").over(head) + F.max("high").over(head)) / 2 + 1)
    edges = stage(
        borders.groupBy("_part", "_c", "start", "before", "total", "head", "tail").agg(
            F.max(F.when(F.col("at") == "head", F.col("mid"))).alias("head_mid"),
            F.max(F.when(F.col("at") == "tail", F.col("mid"))).alias("tail_mid"),
        ),
        f"{name}-edges",
    )
    inside = F.col("before") - F.col("start") + (F.col("_first") + F.col("_last")) / 2 + 1
    rank = (
        F.when(F.col("_v") == F.col("head"), F.col("head_mid"))
        .when(F.col("_v") == F.col("tail"), F.col("tail_mid"))
        .otherwise(inside)
    )
    return places.join(F.broadcast(edges), ["_part", "_c"]).select("_row", "_c", rank.alias("mid_rank"), "total")


def wide_ranks(ranks: DataFrame, cols: Sequence[str], n_rows: int = 0) -> DataFrame:
    """The long table as one row per row again: one shuffle on the row for all columns.

    ``n_rows``: how many there are, if counted; of many, a task gets ``ROWS_PER_RANGE``.
    The long rows are shuffled as they are.  Adding up before would only widen them, as hardly two of a row meet in a range.
    """
    parts = -(-n_rows // ROWS_PER_RANGE)
    long = ranks.select("_row", "_c", "mid_rank")
    return (
        (long.repartition(parts, "_row") if parts > 1 else long.repartition("_row"))
        .groupBy("_row")
        .agg(*[F.max(F.when(F.col("_c") == i, F.col("mid_rank"))).alias(c) for i, c in enumerate(cols)])
        .drop("_row")
    )
