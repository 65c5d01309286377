"""Constant severity model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mean_severity(learn: DataFrame, claim: str = "Claim", digits: int | None = 0) -> float:
    """Mean learn claim, rounded (to a whole number by default) before it is used."""
    mean = F.avg(claim)
    row = learn.agg(mean if digits is None else F.round(mean, digits)).first()
    if row[0] is None:
        raise ValueError("no claims to average")
    return float(row[0])


def with_mean_severity(
    df: DataFrame, claim: str = "Claim", digits: int | None = 0, name: str = "null_model"
) -> DataFrame:
    """Add the constant prediction, fitted on the learn rows of ``df`` itself."""
    mean = F.avg(F.when(F.col("split") == "learn", F.col(claim)))
    mu = df.agg(mean if digits is None else F.round(mean, digits)).scalar()
    return df.withColumn(name, mu.cast("double"))
