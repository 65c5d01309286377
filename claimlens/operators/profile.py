"""One-way tables over many features in a single pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.numeric import bin_down, bin_up, clamp


def profile(
    df: DataFrame, features: Sequence[str], aggregates: Mapping[str, Column]
) -> DataFrame:
    """``feature, level`` and the aggregates, for every level of every feature.

    The features are unpivoted next to the measures and grouped once; partial
    aggregation leaves one row per level and task before the shuffle, so a level with
    most of the rows costs no more than any other.  Null is kept as a level.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("level"))
            for f in features
        ]
    )
    long = df.select("*", F.inline(pairs))
    return long.groupBy("feature", "level").agg(*[e.alias(n) for n, e in aggregates.items()])


def binned(df: DataFrame, delay: str = "RepDelay") -> DataFrame:
    """Pay, hours and delay in the bins used for one-way tables."""
    return df.withColumns(
        {
            "WeeklyPay": bin_up("WeeklyPay", 100, hi=1200),
            "HoursWorkedPerWeek": clamp("HoursWorkedPerWeek", hi=60),
            "RepDelay": bin_down(delay, 10, hi=100),
        }
    )


def marginal_profile(df: DataFrame, features: Sequence[str], claim: str = "Claim") -> DataFrame:
    """Claim count and mean claim per level of every feature."""
    return profile(
        df, features, {"vol": F.count(F.lit(1)), "avg": F.avg(claim)}
    )


def uniform_reference(profiled: DataFrame) -> DataFrame:
    """Rows per level if a feature's levels were equally frequent (null is no level)."""
    return profiled.groupBy("feature").agg(
        (F.sum("vol") / F.count("level")).alias("global_n"),
        F.count("level").alias("levels"),
    )


def calibration(
    df: DataFrame,
    features: Sequence[str],
    predictions: Sequence[str],
    claim: str = "Claim",
) -> DataFrame:
    """Mean observed and mean fitted claim per level, all models in one pass."""
    return profile(
        df,
        features,
        {
            "n": F.count(F.lit(1)),
            "obs": F.avg(claim),
            **{f"pred_{p}": F.avg(p) for p in predictions},
        },
    )


def level_counts(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows per level of the categorical columns."""
    return profile(df, features, {"n": F.count(F.lit(1))})


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column.

    Grouping by (feature, value) first merges copies on the map side, so the shuffle
    carries distinct values only, spread over all reducers.
    """
    return (
        profile(df, cols, {"n": F.count(F.lit(1))})
        .groupBy("feature")
        .agg(F.count("level").alias("n_distinct"))
    )


def distinct_counts_by(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    """The same within each value of ``by``."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in cols]
    )
    return (
        df.select(by, F.inline(pairs))
        .distinct()
        .groupBy(by, "feature")
        .agg(F.count("level").alias("n_distinct"))
    )
