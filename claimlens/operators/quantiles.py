"""Exact order statistics and quantiles over groups of any size.

Groups known to be small use Spark's ``percentile``, which keeps a group's distinct
values in one task.  Larger ones are located by narrowing: count rows per equal-width
bin (partial aggregation, no row is shuffled), keep the bins that hold a wanted rank, and
repeat inside their observed minimum and maximum until each is one value or few rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_GROUP = 300_000
FEW_ROWS = 100_000
BINS = 4096


def _group_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Per group: rows with a value, and how many of them are NaN or infinite.

    NaN counts as larger than any number, as in Spark's order.
    """
    x = F.col(value).cast("double")
    finite = F.when(~F.isnan(x) & (F.abs(x) < math.inf), x)
    return df.groupBy(*by).agg(
        F.count(x).alias("n"),
        F.count_if(x == -math.inf).alias("lowest"),
        F.count_if(x == math.inf).alias("highest"),
        F.count_if(F.isnan(x)).alias("nans"),
        F.min(finite).alias("lo"),
        F.max(finite).alias("hi"),
    )


def _in_intervals(
    values: DataFrame,
    by: Sequence[str],
    key_fields: list[T.StructField],
    groups: list[Row],
    intervals: list[tuple],
) -> DataFrame:
    """Rows that fall in an interval of their group, with the interval's number and ends.

    There is at most one interval per wanted rank, so they are few: literals without
    groups, else the broadcast side of a hash join on the group.
    """
    x = F.col("_x")
    if not by:
        number = F.coalesce(
            *[F.when(x.between(lo, hi), F.lit(i)) for i, (_, lo, hi, *_) in enumerate(intervals)]
        )
        return values.withColumn("_interval", number).filter(F.col("_interval").isNotNull()).select(
            "*",
            F.element_at(F.array(*[F.lit(k[1]) for k in intervals]), F.col("_interval") + 1).alias("_lo"),
            F.element_at(F.array(*[F.lit(k[2]) for k in intervals]), F.col("_interval") + 1).alias("_hi"),
        )
    table = values.sparkSession.createDataFrame(
        [
            (*[groups[k[0]][c] for c in by], i, k[1], k[2])
            for i, k in enumerate(intervals)
        ],
        T.StructType(
            [T.StructField(f"_k{j}", f.dataType) for j, f in enumerate(key_fields)]
            + [
                T.StructField("_interval", T.IntegerType(), False),
                T.StructField("_lo", T.DoubleType(), False),
                T.StructField("_hi", T.DoubleType(), False),
            ]
        ),
    )
    matches = (x >= F.col("_lo")) & (x <= F.col("_hi"))
    for j, c in enumerate(by):
        matches = matches & F.col(c).eqNullSafe(F.col(f"_k{j}"))
    return values.join(F.broadcast(table), matches)


def _locate(
    df: DataFrame,
    value: str,
    by: Sequence[str],
    groups: list[Row],
    ranks: list[set[int]],
    few_rows: int,
    bins: int,
) -> list[dict[int, tuple[float, int]]]:
    """For each group: 0-based rank -> (value, rows below the value's interval)."""
    spark = df.sparkSession
    found: list[dict[int, tuple[float, int]]] = [{} for _ in groups]
    # an interval: (group, lo, hi, rows below it, rows in it) -> wanted ranks
    open_: dict[tuple, set[int]] = {}

    def settle(g: int, lo: float, hi: float, below: int, n: int, wanted: set[int]) -> None:
        if lo == hi:
            for r in wanted:
                found[g][r] = (lo, below)
        else:
            open_.setdefault((g, lo, hi, below, n), set()).update(wanted)

    for g, row in enumerate(groups):
        # infinite values and NaN have ranks of their own, below and above the others
        below = row["lowest"]
        upto = row["n"] - row["nans"] - row["highest"]
        for r in ranks[g]:
            if r < below:
                found[g][r] = (-math.inf, 0)
            elif r >= row["n"] - row["nans"]:
                found[g][r] = (math.nan, row["n"] - row["nans"])
            elif r >= upto:
                found[g][r] = (math.inf, upto)
        inner = {r for r in ranks[g] if below <= r < upto}
        if inner:
            settle(g, row["lo"], row["hi"], below, upto - below, inner)

    key_fields = [df.schema[c] for c in by]
    values = df.select(*by, F.col(value).cast("double").alias("_x"))
    while open_:
        intervals = sorted(open_, key=lambda k: k[:3])
        finish = all(k[4] <= few_rows for k in intervals)
        inside = _in_intervals(values, by, key_fields, groups, intervals)
        wanted = [(i, r, r - k[3]) for i, k in enumerate(intervals) for r in sorted(open_[k])]
        if finish:
            # each interval holds at most few_rows rows (counted in the pass before)
            lists = inside.groupBy("_interval").agg(F.array_sort(F.collect_list("_x")).alias("_xs"))
            lookups = spark.createDataFrame(
                [(i, r, local + 1) for i, r, local in wanted],
                "_interval int, _rank bigint, _at int",
            )
            for row in (
                lists.join(F.broadcast(lookups), "_interval")
                .select(
                    "_interval",
                    "_rank",
                    F.element_at("_xs", F.col("_at")).alias("x"),
                    (F.array_position("_xs", F.element_at("_xs", F.col("_at"))) - 1).alias("less"),
                )
                .collect()
            ):
                k = intervals[row["_interval"]]
                found[k[0]][row["_rank"]] = (row["x"], k[3] + row["less"])
            break
        bin_ = F.least(
            # of halves, whose difference cannot overflow
            F.floor((F.col("_x") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2) * bins),
            F.lit(bins - 1),
        )
        histogram = inside.groupBy("_interval", bin_.alias("_bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi")
        )
        upto = Window.partitionBy("_interval").orderBy("_bin")
        lookups = spark.createDataFrame(wanted, "_interval int, _rank bigint, _local bigint")
        hits = (
            histogram.withColumn("_cum", F.sum("n").over(upto))
            .join(F.broadcast(lookups), "_interval")
            .filter((F.col("_local") < F.col("_cum")) & (F.col("_local") >= F.col("_cum") - F.col("n")))
            .collect()
        )
        previous = intervals
        before = set(open_)
        open_ = {}
        for row in hits:
            g, _, _, below, _ = previous[row["_interval"]]
            settle(
                g, row["lo"], row["hi"], below + row["_cum"] - row["n"], row["n"], {row["_rank"]}
            )
        if before & set(open_):
            raise ArithmeticError("an interval did not get narrower")
    return found


def order_statistic(
    df: DataFrame,
    value: str,
    rank: int,
    few_rows: int = FEW_ROWS,
    bins: int = BINS,
) -> tuple[float, int]:
    """The value at 0-based ``rank`` and the number of rows with a smaller value."""
    row = _group_stats(df, value, []).first()
    if not 0 <= rank < row["n"]:
        raise IndexError(f"rank {rank} outside 0..{row['n'] - 1}")
    ((x, below),) = [
        f[rank] for f in _locate(df, value, [], [row], [{rank}], few_rows, bins)
    ]
    return x, below


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    small_group: int = SMALL_GROUP,
    few_rows: int = FEW_ROWS,
    bins: int = BINS,
    at_most: int | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation between order statistics.

    Returns ``by..., prob, quantile``.  Nulls are skipped; a group without values gives
    null quantiles; NaN counts as larger than any number.  There may be any number of
    groups: only the large ones, at most one per ``small_group`` rows, are located one by one.
    ``at_most`` is a bound on the rows of a group, where the caller has counted already.
    """
    by, probs = list(by), [float(p) for p in probs]
    small = at_most is not None and at_most <= small_group
    large = F.col("n") > small_group
    groups = [] if small else _group_stats(df, value, by).filter(large).collect()
    schema = T.StructType(
        [df.schema[c] for c in by]
        + [T.StructField("prob", T.DoubleType()), T.StructField("quantile", T.DoubleType())]
    )
    rest = None
    if groups and by:
        key_schema = T.StructType([T.StructField(f"_k{j}", df.schema[c].dataType) for j, c in enumerate(by)])
        keys = df.sparkSession.createDataFrame([tuple(g[c] for c in by) for g in groups], key_schema)
        same = [F.col(c).eqNullSafe(F.col(f"_k{j}")) for j, c in enumerate(by)]
        rest = exact_quantiles(
            df.join(keys, same, "left_anti"), value, probs, by, small_group, few_rows, bins, small_group
        )
    if not groups:
        listed = df.groupBy(*by).agg(
            F.percentile(F.col(value).cast("double"), F.array(*[F.lit(p) for p in probs])).alias("_q")
        )
        pairs = F.array(
            *[
                F.struct(F.lit(p).alias("prob"), F.col("_q")[i].alias("quantile"))
                for i, p in enumerate(probs)
            ]
        )
        return listed.select(*by, F.inline(pairs))

    def around(n: int, p: float) -> tuple[int, int, float]:
        h = (n - 1) * p
        low = min(math.floor(h), n - 1)
        return low, min(low + 1, n - 1), h - low

    ranks = [
        {r for p in probs for r in around(g["n"], p)[:2]} if g["n"] else set() for g in groups
    ]
    found = _locate(df, value, by, groups, ranks, few_rows, bins)
    rows = []
    for g, at in zip(groups, found):
        for p in probs:
            q = None
            if g["n"]:
                low, high, part = around(g["n"], p)
                a, b = at[low][0], at[high][0]
                q = a if part == 0 or a == b else (1 - part) * a + part * b
            rows.append((*[g[c] for c in by], p, q))
    located = df.sparkSession.createDataFrame(rows, schema)
    return located if rest is None else located.union(rest)


def approximate_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), accuracy: int = 10_000
) -> DataFrame:
    """One-pass sketch version of ``exact_quantiles``: rank error at most n / accuracy."""
    probs = [float(p) for p in probs]
    listed = df.groupBy(*by).agg(
        F.percentile_approx(F.col(value).cast("double"), probs, accuracy).alias("_q")
    )
    pairs = F.array(
        *[
            F.struct(F.lit(p).alias("prob"), F.col("_q")[i].alias("quantile"))
            for i, p in enumerate(probs)
        ]
    )
    return listed.select(*by, F.inline(pairs))
