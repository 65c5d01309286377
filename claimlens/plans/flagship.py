"""The shortest useful path: raw tables, filter, one-way table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.plans.workspace import Workspace


def severity_by_year(spark: SparkSession, data_dir: str) -> DataFrame:
    """Claim count and mean severity by accident year.

    Needs neither row numbers nor features, so it reads the filtered view directly and
    writes nothing.
    """
    return (
        Workspace(spark, data_dir)
        .filtered.groupBy("AccYear")
        .agg(
            F.count(F.lit(1)).alias("claims"),
            F.round(F.avg("Claim"), 4).alias("mean_claim"),
        )
    )
