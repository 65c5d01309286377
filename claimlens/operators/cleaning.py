"""Silver table: filtered claims, numbered by descending claim size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.operators.ordering import dense_ids


def filter_claims(df: DataFrame, after_year: int = 1987) -> DataFrame:
    """Claims of later accident years by people who worked any hours.  Nulls drop out."""
    return df.filter((F.col("AccYear") > after_year) & (F.col("HoursWorkedPerWeek") > 0))


def small_claims(df: DataFrame, limit: float = 10_000) -> DataFrame:
    return df.filter(F.col("Claim") <= limit)


def number_claims(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add ``Id`` = 1..n by descending claim; ``key`` (unique) orders equal claims."""
    return dense_ids(df, [F.desc("Claim"), *[F.asc(k) for k in key]], "Id", "sorted-claims")
