"""Reproducible learn/test split, shuffle order and validation tail.

All random choices hash the row number, so they do not depend on partitioning, and
nothing is shuffled to make them.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.numeric import hash32
from claimlens.operators.quantiles import FEW_ROWS, order_statistic
from claimlens.schema import SEED, VALIDATION_SPLIT

BLOCK = 5
KEY_SPACE = 1 << 32
RANGES = 4096


def is_test(id_col: str = "Id", seed: int = SEED) -> Column:
    """True for one row in every block of five consecutive ids.

    A pick past the last id selects nothing, so the last short block may have none.
    """
    index = F.col(id_col) - 1
    block = F.floor(index / BLOCK).cast("bigint")
    return index % BLOCK == hash32(seed, block) % BLOCK


def picked_ids(df: DataFrame, id_col: str = "Id", seed: int = SEED) -> DataFrame:
    """The chosen id of every block, whether or not the last block reaches it."""
    block = F.floor((F.col(id_col) - 1) / BLOCK).cast("bigint")
    blocks = df.select(block.alias("block")).distinct()
    return blocks.select(
        (F.col("block") * BLOCK + 1 + hash32(seed, "block") % BLOCK).alias(id_col)
    )


def split_sets(
    df: DataFrame, picked: DataFrame, id_col: str = "Id"
) -> tuple[DataFrame, DataFrame]:
    """(test ids, learn ids) as set operations for picks that come as a table: the ids
    that were picked, and the ids that were not.  Ids are unique, so no key is hot.

    ``with_split`` gives the same split without a join.
    """
    ids = df.select(id_col)
    return ids.intersect(picked.select(id_col)), ids.subtract(picked.select(id_col))


def shuffle_key(id_col: str = "Id", seed: int = SEED) -> Column:
    """Ordering by this key (then by id) is a random permutation of the rows."""
    return hash32(seed + 10, id_col)


def with_split(df: DataFrame, id_col: str = "Id", seed: int = SEED) -> DataFrame:
    """Add ``split`` ('learn' or 'test') and ``shuffle_key``."""
    return df.withColumns(
        {
            "split": F.when(is_test(id_col, seed), "test").otherwise("learn"),
            "shuffle_key": shuffle_key(id_col, seed),
        }
    )


def learn_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "learn")


def test_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "test")


def _boundary(
    df: DataFrame, key: str, id_col: str, fraction: Fraction, few_rows: int
) -> tuple[int, int] | None:
    """(key, id) of the first row of the tail in (key, id) order; None for an empty tail.

    Rows are counted per range of keys (at most ``RANGES`` counts come back), and the
    range holding the boundary is narrowed until it has few rows.  The first pass also
    gives the row count.
    """
    lo, hi, rank = 0, KEY_SPACE, None
    while True:
        width = -(-(hi - lo) // RANGES)
        counts = sorted(
            df.filter((F.col(key) >= lo) & (F.col(key) < hi))
            .groupBy(F.floor((F.col(key) - lo) / width).cast("int").alias("range"))
            .count()
            .collect()
        )
        if rank is None:
            n = sum(c for _, c in counts)
            rank = math.floor(n * (1 - fraction))
            if rank >= n:
                return None
        for index, count in counts:
            if rank < count:
                break
            rank -= count
        lo, hi = lo + index * width, min(lo + (index + 1) * width, hi)
        if count <= few_rows or width == 1:
            break
    inside = df.filter((F.col(key) >= lo) & (F.col(key) < hi))
    if count > few_rows:
        # very many rows share one key, which a hash of unique ids does not produce
        return lo, int(order_statistic(inside, id_col, rank)[0])
    found = inside.agg(F.array_sort(F.collect_list(F.struct(key, id_col))).alias("rows"))
    row = found.select(F.element_at("rows", F.lit(rank + 1))).first()[0]
    return row[0], row[1]


def with_validation(
    df: DataFrame,
    fraction: float = VALIDATION_SPLIT,
    key: str = "shuffle_key",
    id_col: str = "Id",
    flag: str = "is_validation",
    few_rows: int = FEW_ROWS,
) -> DataFrame:
    """Flag the last ``fraction`` of the rows in shuffle order.

    Only the row at the boundary has to be found, so nothing is sorted or shuffled: the
    flag compares each row with it.
    """
    boundary = _boundary(df, key, id_col, Fraction(str(fraction)), few_rows)
    if boundary is None:
        return df.withColumn(flag, F.lit(False))
    k, i = boundary
    key_, id_ = F.col(key), F.col(id_col)
    return df.withColumn(flag, (key_ > k) | ((key_ == k) & (id_ >= i)))
