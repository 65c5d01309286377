"""Session settings the operators were designed for.

Nothing in the package depends on these being set; they only pick the physical
strategy (adaptive re-planning, skew splitting, partition coalescing).
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "claimlens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session.

    ``shuffle_partitions`` is the number a shuffle starts from; adaptive execution
    merges small ones.  On a cluster take about input bytes of the largest shuffle
    divided by 128 MB; locally the number of cores.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
