"""Gaussian kernel density on an equally spaced grid."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.operators.quantiles import SMALL_GROUP, exact_quantiles


def reference_bandwidth(n: int, sd: float, iqr: float, first: float) -> float:
    """Rule-of-thumb bandwidth 0.9 * min(sd, IQR / 1.34) * n ** (-1/5), with fallbacks
    for samples without spread."""
    spread = min(sd, iqr / 1.34) or sd or abs(first) or 1.0
    return 0.9 * spread * n ** -0.2


def kernel_density(
    df: DataFrame,
    value: str,
    grid: int = 512,
    bandwidth: float | None = None,
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """Density estimate of ``value`` at ``grid`` points over its range: ``i, x, density``.

    The data is read for the statistics and once to spread each value over its two
    neighbouring grid points (at most ``grid`` partial rows per task).  What follows
    works on ``grid`` weights and does not grow with the data.
    """
    x = F.col(value).cast("double")
    stats = df.agg(
        F.count(x).alias("n"),
        F.min(x).alias("lo"),
        F.max(x).alias("hi"),
        F.stddev_samp(x).alias("sd"),
    ).first()
    n, lo, hi = stats["n"], stats["lo"], stats["hi"]
    if n < 2 or lo == hi:
        raise ValueError("a density needs at least two different values")
    if bandwidth is None:
        quartile = {
            r["prob"]: r["quantile"]
            for r in exact_quantiles(
                df, value, [0.25, 0.75], small_group=small_group, at_most=n
            ).collect()
        }
        bandwidth = reference_bandwidth(n, stats["sd"], quartile[0.75] - quartile[0.25], lo)
    step = (hi - lo) / (grid - 1)
    place = (x - lo) / (hi - lo) * (grid - 1)
    left = F.least(F.floor(place), F.lit(grid - 2)).cast("int")
    cells = (
        df.filter(x.isNotNull())
        .select(left.alias("node"), (place - left).alias("part"))
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("part").alias("right"))
    )
    weights = (
        cells.select(
            F.inline(
                F.array(
                    F.struct(F.col("node"), (F.col("rows") - F.col("right")).alias("w")),
                    F.struct((F.col("node") + 1).alias("node"), F.col("right").alias("w")),
                )
            )
        )
        .groupBy("node")
        .agg(F.sum("w").alias("w"))
    )
    u = (F.col("i") - F.col("node")) * (step / bandwidth)
    return (
        weights.select("node", "w", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("i"))
        .groupBy("i")
        .agg((F.sum(F.col("w") * F.exp(-0.5 * u * u)) / (n * bandwidth * math.sqrt(2 * math.pi))).alias("density"))
        .select("i", (lo + F.col("i") * step).alias("x"), "density")
    )
