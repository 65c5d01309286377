"""Ranges, means and table summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.numeric import days_to_weeks, days_to_years
from claimlens.operators.quantiles import SMALL_GROUP, exact_quantiles


def column_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Minimum, maximum, mean and null count of every column, in one aggregation."""
    one_row = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.min(F.col(c).cast("double")).alias("lo"),
                F.max(F.col(c).cast("double")).alias("hi"),
                F.avg(F.col(c).cast("double")).alias("mean"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
            ).alias(f"r{i}")
            for i, c in enumerate(cols)
        ]
    )
    return one_row.select(F.inline(F.array(*[F.col(f"r{i}") for i in range(len(cols))])))


def delay_range(df: DataFrame, delay: str = "RepDelay") -> DataFrame:
    """Range and mean of a delay in days, with the range in years and weeks."""
    return df.agg(F.min(delay).alias("lo"), F.max(delay).alias("hi"), F.avg(delay).alias("mean")).select(
        F.lit(delay).alias("column"),
        F.col("lo").alias("min_days"),
        F.col("hi").alias("max_days"),
        days_to_years("lo").alias("min_years"),
        days_to_years("hi").alias("max_years"),
        days_to_weeks("lo").alias("min_weeks"),
        days_to_weeks("hi").alias("max_weeks"),
        days_to_weeks("mean").alias("mean_weeks"),
    )


def numeric_summary(
    df: DataFrame, cols: Sequence[str], small_group: int = SMALL_GROUP
) -> DataFrame:
    """Minimum, quartiles, mean, maximum, row and null count for every numeric column."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), "feature", "value"
    )
    basic = [
        F.count("value").alias("n"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
        F.min("value").alias("min"),
        F.avg("value").alias("mean"),
        F.max("value").alias("max"),
    ]
    probs = [0.25, 0.5, 0.75]
    names = ["q1", "median", "q3"]
    # every column has the same number of rows, so one count bounds all groups
    if df.count() <= small_group:
        quartiles = F.percentile("value", F.array(*[F.lit(p) for p in probs]))
        return (
            long.groupBy("feature")
            .agg(*basic, quartiles.alias("q"))
            .select(
                "feature",
                "n",
                "nulls",
                "min",
                *[F.col("q")[i].alias(n) for i, n in enumerate(names)],
                "mean",
                "max",
            )
        )
    located = (
        exact_quantiles(long, "value", probs, by=["feature"], small_group=small_group)
        .groupBy("feature")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in zip(probs, names)])
    )
    return (
        long.groupBy("feature")
        .agg(*basic)
        .join(located, "feature")
        .select("feature", "n", "nulls", "min", *names, "mean", "max")
    )


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def split_means(df: DataFrame, claim: str = "Claim", digits: int = 0) -> DataFrame:
    return df.groupBy("split").agg(F.round(F.sum(claim) / F.count(claim), digits).alias("mean_claim"))


def grid(df: DataFrame, value: str, points: int = 101) -> DataFrame:
    """Equally spaced values from the minimum to the maximum."""
    step = points - 1
    x = F.col("lo") + F.col("i") / step * (F.col("hi") - F.col("lo"))
    return (
        df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
        .select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(step))).alias("i"))
        .select("i", x.alias("x"))
    )
