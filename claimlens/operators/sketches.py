"""Quantiles and distinct counts from sketches that are kept per part of the data.

A sketch of a few kilobytes stands for any number of rows, and sketches of parts merge to that of the
whole.  So each part (a load, a year) is read once, and later questions read the sketch table
alone.  Replacing a part replaces its sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions.text import literal, quoted, rows

# Size parameters of the quantile sketch (k) and the distinct-count sketch (log2 of its buckets).
QUANTILE_K = 400
DISTINCT_BITS = 12

# Rank error of a quantile and standard error of a distinct count with these sizes; a
# merged sketch has those of its parts.
RANK_ERROR = 0.01
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_BITS / 2)


def sketch_columns(
    df: DataFrame, cols: Sequence[str], part: str | Column, quantile_k: int = QUANTILE_K, distinct_bits: int = DISTINCT_BITS
) -> DataFrame:
    """One row per part and column: ``part, feature, n, n_nan, quantiles, distincts``.

    Every task sketches its own rows before the shuffle, so only sketches travel and a part with most of
    the rows costs no more than another.  Nulls are left out and NaN is counted apart; a column
    without other values has no quantile sketch.  Null and empty parts are one part, called ``null``.
    """
    key = F.nullif((F.col(part) if isinstance(part, str) else part).cast("string"), F.lit(""))
    casts = [{"feature": literal(c), "value": f"CAST({quoted(c)} AS DOUBLE) + 0D"} for c in cols]
    number = F.when(~F.isnan("value"), F.col("value"))
    return (
        df.select(F.coalesce(key, F.lit("null")).alias("part"), *[F.col(quoted(c)) for c in cols])
        .selectExpr("part", rows(casts))
        .filter("value IS NOT NULL")
        .groupBy("part", "feature")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.isnan("value")).alias("n_nan"),
            F.kll_sketch_agg_double(number, quantile_k).alias("quantiles"),
            F.hll_sketch_agg(F.xxhash64("value"), distinct_bits).alias("distincts"),
        )
        .withColumn("quantiles", F.when(F.col("n") > F.col("n_nan"), F.col("quantiles")))
    )


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Put sketches into the table at ``path``; parts that it already has are replaced.

    A load that is repeated therefore does not count twice.  One file per part.
    """
    (
        sketches.repartition("part")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("part")
        .parquet(path)
    )


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The kept sketches; a filter on ``part`` reads the folders of those parts only."""
    schema = "feature string, n bigint, n_nan bigint, quantiles binary, distincts binary, part string"
    return spark.read.schema(schema).parquet(path)


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the parts together, per feature and ``by``."""
    return sketches.groupBy(*by, "feature").agg(
        F.sum("n").alias("n"),
        F.sum("n_nan").alias("n_nan"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.hll_union_agg("distincts").alias("distincts"),
    )


def sketched_quantiles(merged: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """``by..., feature, n, prob, quantile`` of the values that are not NaN (null if there are none)."""
    asked = F.array(*[F.lit(float(p)) for p in probs])
    found = F.when(F.col("n") > F.col("n_nan"), F.kll_sketch_get_quantile_double("quantiles", asked))
    pairs = F.array(
        *[F.struct(F.lit(float(p)).alias("prob"), F.col("_q")[i].alias("quantile")) for i, p in enumerate(probs)]
    )
    numbers = (F.col("n") - F.col("n_nan")).alias("n")
    return merged.withColumn("_q", found).select(*by, "feature", numbers, F.inline(pairs))


def sketched_distinct(merged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by..., feature, n, n_distinct`` (NaN is one value)."""
    return merged.select(*by, "feature", "n", F.hll_sketch_estimate("distincts").alias("n_distinct"))


def rank_errors(df: DataFrame, quantiles: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``feature, prob, n, rank_error``: how far each quantile's exact ranks lie from the rank asked for, as share of n.

    One pass over ``df``; the quantiles, one row per column and probability, are broadcast.
    """
    casts = [{"feature": literal(c), "value": f"CAST({quoted(c)} AS DOUBLE) + 0D"} for c in cols]
    long = df.selectExpr(rows(casts)).filter("value IS NOT NULL AND NOT isnan(value)")
    asked = quantiles.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("prob", "quantile"))).alias("asked"))
    counted = (
        long.join(F.broadcast(asked), "feature")
        .select("feature", "value", F.explode("asked").alias("q"))
        .groupBy("feature", F.col("q.prob").alias("prob"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("value") < F.col("q.quantile")).alias("below"),
            F.count_if(F.col("value") <= F.col("q.quantile")).alias("up_to"),
        )
    )
    wanted = F.col("prob") * F.col("n")
    off = F.greatest(F.col("below") - wanted, wanted - F.col("up_to"), F.lit(0.0))
    return counted.select("feature", "prob", "n", (off / F.col("n")).alias("rank_error"))
