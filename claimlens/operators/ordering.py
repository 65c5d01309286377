"""Global order without a single-task window.

Rows are range-partitioned on the sort key and sorted inside each partition; the result
is written, so partition number and position are frozen.  Counting per partition (one
row each) then gives every partition its offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.text import quoted
from claimlens.sources.storage import stage

# monotonically_increasing_id = partition number in the bits from 33 up, position below
_POSITION_BITS = 33
_POSITION_MASK = (1 << _POSITION_BITS) - 1

# Rows per range of a global sort.  Sorted in memory, rows are several times as large as in the shuffle, by whose bytes
# adaptive execution would merge ranges: so many that each is sorted without spilling.
ROWS_PER_RANGE = 250_000

# distinct values up to which running counts may be made in one task per column
FEW_VALUES = 300_000


def _sorted_stage(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` should be a written table: it is counted, sampled and sorted in passes of its own."""
    parts = -(-df.count() // ROWS_PER_RANGE)
    if parts > 1:
        ranged = df.repartitionByRange(parts, *order)
    else:  # adaptive execution merges small ranges
        ranged = df.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order)
    return stage(ranged.withColumn("_slot", F.monotonically_increasing_id()), name).withColumn(
        "_part", F.shiftright("_slot", _POSITION_BITS)
    )


def dense_ids(
    df: DataFrame, order: Sequence[Column], id_col: str = "Id", name: str = "sorted"
) -> DataFrame:
    """Number the rows 1..n in the given order.

    ``order`` must be a total order (end it with a unique key); that also keeps a value
    shared by very many rows from landing in one partition.
    """
    staged = _sorted_stage(df, order, name)
    # one row per sort partition: small by construction, as is the broadcast side
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(
        staged.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")),
        f"{name}-offsets",
    )
    position = F.col("_slot").bitwiseAND(F.lit(_POSITION_MASK))
    return staged.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + position + 1).alias(id_col)
    )


def value_ladder(
    df: DataFrame, cols: Sequence[str], name: str = "ladder", few_values: int = FEW_VALUES
) -> DataFrame:
    """Distinct values per column with their counts and running counts.

    Rows are ``feature, value, cnt, cum``: ``cum`` rows of that column are <= ``value``.
    Nulls are left out.  Equal values are merged before the first shuffle, so a value
    held by a large share of the rows is one row per map task.  With at most
    ``few_values`` distinct values in all (counted) a window per column adds them up;
    beyond that the sorted ranges do.
    """
    casts = [f"CAST({quoted(c)} AS DOUBLE) AS {quoted(c)}" for c in cols]
    counts = stage(
        df.selectExpr(*casts)
        .unpivot([], list(cols), "feature", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("cnt")),
        f"{name}-counts",
    )
    if counts.count() <= few_values:
        upto = Window.partitionBy("feature").orderBy("value")
        return counts.withColumn("cum", F.sum("cnt").over(upto))
    staged = _sorted_stage(counts, [F.col("feature"), F.col("value")], name)
    before = (
        Window.partitionBy("feature")
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # one row per column and sort partition
    offsets = stage(
        staged.groupBy("feature", "_part")
        .agg(F.sum("cnt").alias("rows"))
        .select(
            "feature",
            "_part",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_offset"),
        ),
        f"{name}-offsets",
    )
    inside = (
        Window.partitionBy("_part", "feature")
        .orderBy("_slot")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = staged.withColumn("_running", F.sum("cnt").over(inside))
    return running.join(F.broadcast(offsets), ["feature", "_part"]).select(
        "feature", "value", "cnt", (F.col("_offset") + F.col("_running")).alias("cum")
    )
