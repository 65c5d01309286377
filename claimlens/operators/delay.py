"""Reporting delay in weeks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.sources.storage import stage


def with_weeks(df: DataFrame) -> DataFrame:
    """Add accident week, reporting week and their difference.

    Weeks count from the earliest accident day.  The delay is the difference of two
    whole weeks, not the whole weeks of the delay, and uses uncapped days.
    """
    origin = df.agg(F.min("AccDay")).scalar()
    return df.withColumns(
        {
            "acc_week": F.floor((F.col("AccDay") - origin) / 7).cast("bigint"),
            "rep_week": F.floor((F.col("RepDay") - origin) / 7).cast("bigint"),
        }
    ).withColumn("RepDelay_week", F.col("rep_week") - F.col("acc_week"))


def week_counts(weeks: DataFrame) -> DataFrame:
    """Claims per accident week and reporting week."""
    return weeks.groupBy("acc_week", "rep_week").agg(F.count(F.lit(1)).alias("nr"))


def week_means(weeks: DataFrame) -> DataFrame:
    """Mean weekly delay per accident week."""
    return weeks.groupBy("acc_week").agg(F.avg("RepDelay_week").alias("mm"))


def reporting_scatter(weeks: DataFrame) -> DataFrame:
    """Points of the reporting chart: one per (accident, reporting) week.

    ``y`` counts accident weeks back from the latest; the unflipped week is kept.  The
    mean delay of the accident week is taken over the counts (one row per pair of weeks),
    not over the claims.
    """
    delay = F.col("rep_week") - F.col("acc_week")
    same_week = Window.partitionBy("acc_week")
    mean = F.sum(delay * F.col("nr")).over(same_week) / F.sum("nr").over(same_week)
    # One row per pair of weeks: the claims are read for it once.
    counts = stage(week_counts(weeks), "week-counts")
    last = counts.agg(F.max("acc_week")).scalar()
    return counts.select(
        "acc_week",
        "rep_week",
        delay.alias("x"),
        (last - F.col("acc_week")).alias("y"),
        "nr",
        mean.alias("mm"),
    )
