"""Categorical levels, their codes, and one-hot columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.operators.ordering import dense_ids
from claimlens.sources.storage import stage

MAX_LEVELS = 1000

# A level table up to so many levels and bytes of their names is broadcast.
BROADCAST_LEVELS = 100_000
BROADCAST_BYTES = 8_000_000
# A level with more than one in so many rows is hot; there are fewer hot levels than that.
HOT_SHARE = 1000


def category_levels(
    df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS
) -> dict[str, list[str]]:
    """Sorted distinct values per categorical column (nulls are no level).

    One job for all columns.  The levels come to the driver as model metadata, so their
    number is checked: a column with more than ``max_levels`` has no one-hot columns.  Its codes
    come from ``level_table`` and ``code_by_table``, which know no limit.
    """
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level"))
                    for c in cols
                ]
            )
        ).alias("kv")
    ).select("kv.*")
    rows = (
        long.filter(F.col("level").isNotNull())
        .distinct()
        .limit(max_levels * len(cols) + 1)
        .collect()
    )
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for feature, level in rows:
        levels[feature].append(level)
    for feature, values in levels.items():
        if len(values) > max_levels:
            raise ValueError(f"{feature} has more than {max_levels} levels: code it with level_table")
        values.sort()
    return levels


def level_code(column: str, levels: Sequence[str]) -> Column:
    """1-based position of the value among ``levels``; null for null and for an unseen value,
    which no model can be asked about."""
    known = F.array(*[F.lit(v) for v in levels]) if levels else F.array().cast("array<string>")
    return F.nullif(F.array_position(known, F.col(column).cast("string")).cast("int"), F.lit(0))


def level_codes(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add ``<column>Code`` for every column in ``levels``."""
    return df.withColumns({f"{c}Code": level_code(c, values) for c, values in levels.items()})


def one_hot(df: DataFrame, column: str, prefix: str, levels: Sequence[str]) -> DataFrame:
    """Add one 0/1 integer column per level (all levels, no baseline dropped).

    A null value gives nulls, as comparing it does.
    """
    value = F.col(column).cast("string")
    return df.withColumns(
        {f"{prefix}{i + 1}": (value == F.lit(v)).cast("int") for i, v in enumerate(levels)}
    )


def level_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``feature, level, code, rows``: the sorted levels of every column, numbered from 1, with their row counts.

    Any number of levels: equal values are merged before the first shuffle, and the
    distinct ones are sorted in ranges and numbered by the ranges' counts.  Nulls are no level.
    """
    pairs = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in cols]
    counted = stage(
        df.select(F.explode(F.array(*pairs)).alias("kv"))
        .select("kv.*")
        .filter(F.col("level").isNotNull())
        .groupBy("feature", "level")
        .agg(F.count(F.lit(1)).alias("rows")),
        "levels",
    )
    numbered = dense_ids(counted, [F.col("feature"), F.col("level")], "_n", "sorted-levels")
    # one row per column
    firsts = numbered.groupBy("feature").agg((F.min("_n") - 1).alias("_before"))
    coded = numbered.join(F.broadcast(firsts), "feature")
    return stage(coded.select("feature", "level", (F.col("_n") - F.col("_before")).alias("code"), "rows"), "level-table")


def code_by_table(
    df: DataFrame,
    table: DataFrame,
    cols: Sequence[str],
    broadcast_levels: int = BROADCAST_LEVELS,
    hot_share: int = HOT_SHARE,
) -> DataFrame:
    """Add ``<column>Code`` from a ``level_table``; null for null and for a value without a level.

    Tables counted as small are broadcast.  Beyond that rows meet their level by shuffle; hot levels, of which there are
    fewer than ``hot_share``, are broadcast, and their rows are spread over the shuffle by chance keys
    that match nothing.
    """
    sizes = {
        r["feature"]: r
        for r in table.groupBy("feature")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("level")).alias("bytes"), F.sum("rows").alias("rows"))
        .collect()
    }
    for c in cols:
        own = table.filter(F.col("feature") == c)
        value = F.col(f"`{c}`").cast("string")
        size = sizes.get(c)
        if size is None or (size["n"] <= broadcast_levels and size["bytes"] <= BROADCAST_BYTES):
            codes = own.select(F.col("level").alias("_level"), F.col("code").alias(f"{c}Code"))
            df = df.join(F.broadcast(codes), value == F.col("_level"), "left").drop("_level")
            continue
        hot = F.col("rows") > size["rows"] / hot_share
        few = own.filter(hot).select(F.col("level").alias("_hot"), F.col("code").alias("_hot_code"))
        rest = own.filter(~hot).select(F.col("level").alias("_level"), F.col("code").alias("_code"))
        by_chance = F.concat(F.lit("\u0000"), F.monotonically_increasing_id().cast("string"))
        df = df.join(F.broadcast(few), value == F.col("_hot"), "left")
        df = df.withColumn("_key", F.struct((F.col("_hot_code").isNull() & value.isNotNull()).alias("own"), F.coalesce(F.when(F.col("_hot_code").isNull(), value), by_chance).alias("of")))
        rest = rest.withColumn("_key", F.struct(F.lit(True).alias("own"), F.col("_level").alias("of"))).drop("_level")
        df = df.join(rest, "_key", "left").withColumn(f"{c}Code", F.coalesce("_hot_code", "_code"))
        df = df.drop("_key", "_hot", "_hot_code", "_code")
    return df
