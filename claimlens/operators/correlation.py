"""Pearson and Spearman correlation matrices in long form ``a, b, r``."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.numeric import hash32
from claimlens.functions.text import literal, number, quoted, rows
from claimlens.operators.ordering import value_ladder
from claimlens.operators.ranking import sorted_ranks, wide_ranks
from claimlens.sources.storage import stage

# distinct values up to which a rank table may be broadcast (16 bytes each)
BROADCAST_VALUES = 500_000
# a value is hot when it holds more than 1 / HOT_SHARE of the rows, so there are fewer
# than HOT_SHARE hot values in a column whatever the data looks like
HOT_SHARE = 1000
SPREAD = 256


@dataclass(frozen=True)
class ColumnStats:
    """Rows, and per column: non-null rows, mean, population deviation."""

    n: int
    counts: list[int]
    means: list[float]
    spreads: list[float]


def _column_stats(numeric: DataFrame, cols: Sequence[str]) -> ColumnStats:
    k = len(cols)
    row = numeric.agg(
        F.count(F.lit(1)),
        *[F.count(c) for c in cols],
        *[F.avg(c) for c in cols],
        *[F.stddev_pop(c) for c in cols],
    ).first()
    return ColumnStats(row[0], row[1 : k + 1], row[k + 1 : 2 * k + 1], row[2 * k + 1 :])


def pearson(
    df: DataFrame,
    cols: Sequence[str],
    digits: int | None = 2,
    stats: ColumnStats | None = None,
) -> DataFrame:
    """Correlation of every pair; a column without spread gives null.

    A first aggregation takes means, spreads and null counts (unless known), a second
    the sums of centered products of all pairs.  With nulls present each pair uses its
    own complete rows, as ``corr`` does.
    """
    numeric = df.selectExpr(*[f"CAST({quoted(c)} AS DOUBLE) AS {quoted(c)}" for c in cols])
    stats = stats or _column_stats(numeric, cols)
    complete = all(count == stats.n for count in stats.counts)

    def centered(i: int) -> str:
        return f"({quoted(cols[i])} - {number(stats.means[i])})"

    def pair(i: int, j: int) -> str:
        if not stats.spreads[i] or not stats.spreads[j]:
            return "CAST(NULL AS DOUBLE)"
        if i == j:
            return "1D"
        if not complete:
            return f"corr({quoted(cols[i])}, {quoted(cols[j])})"
        scale = number(stats.n * stats.spreads[i] * stats.spreads[j])
        return f"sum({centered(i)} * {centered(j)}) / {scale}"

    size = range(len(cols))
    pairs = [(i, j) for i in size for j in size if i <= j]
    one_row = numeric.agg(
        F.count(F.lit(1)), *[F.expr(f"{pair(i, j)} AS r{i}_{j}") for i, j in pairs]
    )

    def entry(i: int, j: int) -> dict[str, str]:
        value = f"r{min(i, j)}_{max(i, j)}"
        r = value if digits is None else f"round({value}, {digits})"
        return {"a": literal(cols[i]), "b": literal(cols[j]), "r": r}

    return one_row.selectExpr(rows([entry(i, j) for i in size for j in size]))


def mid_ranks(df: DataFrame, cols: Sequence[str], name: str = "ranks") -> DataFrame:
    """Distinct values per column with the average rank of their rows and the column's
    row count (written once)."""
    ladder = value_ladder(df, cols, name)
    ranked = ladder.withColumn("mid_rank", F.col("cum") - (F.col("cnt") - 1) / 2)
    staged = stage(ranked, f"{name}-mid")
    totals = staged.groupBy("feature").agg(F.max("cum").alias("total"))
    # one row per column
    return staged.join(F.broadcast(totals), "feature").select(
        "feature", "value", "cnt", "mid_rank", "total"
    )


def with_ranks(
    df: DataFrame,
    cols: Sequence[str],
    ranks: DataFrame,
    row_key: str,
    sizes: dict[str, tuple[int, int]],
    broadcast_values: int = BROADCAST_VALUES,
) -> DataFrame:
    """Replace every column by the average rank of its value.

    ``sizes``: distinct values and rows per column.  A column with few distinct values
    takes its ranks from a broadcast table.  One with many is joined by shuffle; its hot
    values are looked up from a broadcast table that is small by the pigeonhole rule, and
    their rows get a join key spread over many partitions, so no partition holds a hot
    value.
    """
    out = df
    for c in cols:
        values, total = sizes.get(c, (0, 0))
        table = ranks.filter(F.col("feature") == c).select(
            F.col("value").alias("_v"), F.col("mid_rank").alias("_r"), "cnt"
        )
        x = F.col(c).cast("double")
        if values <= broadcast_values:
            joined = out.join(F.broadcast(table.drop("cnt")), x == F.col("_v"), "left")
        else:
            hot = table.filter(F.col("cnt") > total / HOT_SHARE).select(
                F.col("_v").alias("_hv"), F.col("_r").alias("_hr")
            )
            cold = table.filter(F.col("cnt") <= total / HOT_SHARE).select("_v", "_r", F.lit(0).alias("_s"))
            # rows with no value join nothing either; they are spread the same way
            settled = F.col("_hr").isNotNull() | x.isNull()
            spread = F.when(settled, 1 + hash32(0, row_key) % SPREAD).otherwise(0).cast("int")
            joined = (
                out.join(F.broadcast(hot), x == F.col("_hv"), "left")
                .withColumns({"_salt": spread, "_key": F.coalesce(x, F.lit(0.0))})
                .join(cold, (F.col("_key") == F.col("_v")) & (F.col("_salt") == F.col("_s")), "left")
                .withColumn("_r", F.coalesce("_hr", "_r"))
            )
        out = joined.withColumn(c, F.col("_r")).select(*df.columns)
    return out


def spearman(df: DataFrame, cols: Sequence[str], digits: int | None = 2) -> DataFrame:
    """Pearson correlation of average ranks.

    The ranks of all columns come from one range sort (``sorted_ranks``) and go back to their rows in one
    shuffle, whatever the columns' number, distinct values or hot values.
    """
    ranks = sorted_ranks(df, cols)
    # ranks of n rows have mean (n + 1) / 2; squares are taken around it
    away = F.col("mid_rank") - (F.col("total") + 1) / 2
    known = {
        r["_c"]: (r["total"], (r["total"] + 1) / 2, math.sqrt(r["variance"]))
        for r in ranks.groupBy("_c", "total").agg(F.avg(away * away).alias("variance")).collect()
    }
    per_column = [known.get(i, (0, 0.0, 0.0)) for i in range(len(cols))]
    n_rows = df.count()
    stats = ColumnStats(n_rows, *[[k[i] for k in per_column] for i in range(3)])
    return pearson(wide_ranks(ranks, cols, n_rows), cols, digits, stats)
