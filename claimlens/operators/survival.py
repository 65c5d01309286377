"""Empirical distribution, log-survival points and their local quadratic smooth."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.text import number
from claimlens.operators.ordering import value_ladder

# fixed value: keeps the log of the survival probability finite at the largest claim
SURVIVAL_TOP = 1.00001

# cells of the first look for a bandwidth, and bins into which each following one cuts what is left
FIRST_CELLS = 8192
NEXT_BINS = 64


def ecdf(df: DataFrame, value: str) -> DataFrame:
    """``x, cnt, ecdf``: share of rows with value <= x at every distinct value."""
    total = df.agg(F.count(value)).scalar()
    return value_ladder(df, [value], "ecdf").select(
        F.col("value").alias("x"), "cnt", (F.col("cum") / total).alias("ecdf")
    )


def ecdf_by_id(df: DataFrame, value: str = "Claim", id_col: str = "Id") -> DataFrame:
    """The same for a table numbered 1..n in descending order of ``value``.

    The numbers already are the ranks, so one aggregation is enough and nothing is
    sorted again.  Rows without a value are numbered last and do not count.
    """
    n = df.agg(F.count(value)).scalar()
    return (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("double").alias("x"))
        .agg(F.count(F.lit(1)).alias("cnt"), F.min(id_col).alias("first_id"))
        .select("x", "cnt", ((n - F.col("first_id") + 1) / n).alias("ecdf"))
    )


def log_survival(points: DataFrame) -> DataFrame:
    """Add ``log_x`` and ``log_survival`` to ECDF points (positive values only)."""
    return points.filter(F.col("x") > 0).withColumns(
        {
            "log_x": F.log("x"),
            "log_survival": F.log(F.lit(SURVIVAL_TOP) - F.col("ecdf")),
        }
    )


def bin_points(
    points: DataFrame, x: str, y: str, weight: str, lo: float, hi: float, bins: int = 4096
) -> DataFrame:
    """Merge points into equal-width cells of [lo, hi]: weighted mean x, mean y, weight."""
    cell = F.lit(0)
    if hi > lo:
        cell = F.least(F.floor((F.col(x) - lo) / (hi - lo) * bins), F.lit(bins - 1))
    w = F.col(weight)
    return (
        points.groupBy(cell.alias("cell"))
        .agg(
            (F.sum(w * F.col(x)) / F.sum(w)).alias("x"),
            (F.sum(w * F.col(y)) / F.sum(w)).alias("y"),
            F.sum(w).alias("w"),
        )
        .drop("cell")
    )


def _at_grid(points: DataFrame, rows: list[str], condition: str) -> DataFrame:
    """Each point with those grid points, given as SQL structs ``g``, that the condition allows."""
    grid = f"filter(array({', '.join(rows)}), g -> {condition})"
    return points.selectExpr("x", "y", "w", f"inline({grid})").withColumn("d", F.abs(F.col("x") - F.col("x0")))


def _struct(**fields: float | int) -> str:
    return "named_struct(" + ", ".join(
        f"'{name}', {value if isinstance(value, int) else number(value)}" for name, value in fields.items()
    ) + ")"


def bandwidths(points: DataFrame, at: list[float], needed: float, cells: int = FIRST_CELLS) -> list[float | None]:
    """Per place of ``at`` the least distance within which points of weight ``needed`` lie.

    ``points`` has ``x``, ``y`` and ``w``.  Weights in equal cells bound every distance first; only
    points of the cells at the two edges are looked at again, in ever finer bins, until
    a bin holds a single distance.  What comes to the driver is bounded by the number of
    cells, and by that of places times bins.  None where the weight is never reached.
    """
    ends = points.agg(F.min("x"), F.max("x")).first()
    lo, width = ends[0], (ends[1] - ends[0]) / cells
    cell = f"int(least(floor((x - {number(lo)}) / {number(width)}), {cells - 1}))" if width else "0"
    counted = points.groupBy(F.expr(cell).alias("cell")).agg(F.sum("w"), F.min("x"), F.max("x")).orderBy("cell").collect()
    which = np.array([r[0] for r in counted])
    weight = np.array([float(r[1]) for r in counted])
    least, most = np.array([r[2] for r in counted]), np.array([r[3] for r in counted])

    # per open place the weight known to be nearer than the distances still looked at
    found: list[float | None] = [None] * len(at)
    inside: dict[int, float] = {}
    rows, condition = [], f"{cell} BETWEEN g.l1 AND g.l2 OR {cell} BETWEEN g.r1 AND g.r2"
    for i, x0 in enumerate(at):
        near = np.maximum(np.maximum(least - x0, x0 - most), 0.0)
        far = np.maximum(np.abs(least - x0), np.abs(most - x0))
        if weight.sum() < needed:
            continue
        low, high = (
            d[order][np.searchsorted(np.cumsum(weight[order]), needed)] for d in (near, far) for order in [np.argsort(d)]
        )
        edge = (far >= low) & (near <= high)
        left, right = which[edge & (most <= x0)], which[edge & (most > x0)]
        spans = [int(v) for side in (left, right) for v in ((side[0], side[-1]) if len(side) else (1, 0))]
        inside[i] = float(weight[far < low].sum())
        rows.append(_struct(i=i, x0=x0, lo=float(low), hi=float(high), **dict(zip(("l1", "l2", "r1", "r2"), spans))))
    while inside:
        place = f"int(greatest(0, least({NEXT_BINS - 1}, floor((d - lo) / (hi - lo) * {NEXT_BINS}))))"
        bins = (
            _at_grid(points, rows, condition)
            .groupBy("i", F.expr(f"IF(hi > lo, {place}, 0)").alias("bin"))
            .agg(F.sum("w"), F.min("d"), F.max("d"))
            .orderBy("i", "bin")
            .collect()
        )
        rows, condition = [], "abs(x - g.x0) BETWEEN g.lo AND g.hi"
        narrower: dict[int, float] = {}
        for i, _, w, nearest, farthest in bins:
            if i not in inside:
                continue
            inside[i] += float(w)
            if inside[i] < needed:
                continue
            before = inside.pop(i) - float(w)
            if nearest == farthest:
                found[i] = nearest
            else:
                narrower[i] = before
                rows.append(_struct(i=i, x0=at[i], lo=nearest, hi=farthest))
        inside = narrower
    return found


def local_quadratic(
    points: DataFrame,
    x: str,
    y: str,
    weight: str,
    alpha: float = 0.1,
    grid: int = 101,
    bins: int | None = 4096,
) -> DataFrame:
    """Nearest-neighbour local quadratic regression at ``grid`` points: ``i, x, fit``.

    At each grid point the bandwidth reaches the floor(alpha * n)-th nearest row, rows
    inside get tricube weights, and the value of the weighted quadratic there is the
    fit.  The points are first merged into ``bins`` cells, so the work per grid point is
    bounded.  ``bins=None`` uses every point: the exact bandwidths are found by counting, then
    one pass adds each point to the sums of the grid points whose bandwidth it lies in.
    """
    ends = points.agg(F.min(x), F.max(x), F.sum(weight)).first()
    if ends[0] is None:
        raise ValueError("no points to smooth")
    lo, hi, n = float(ends[0]), float(ends[1]), int(ends[2])
    step = (hi - lo) / (grid - 1)
    needed = math.floor(n * alpha + 1e-9)
    if bins is None:
        each = points.select(F.col(x).cast("double").alias("x"), F.col(y).alias("y"), F.col(weight).alias("w"))
        each = each.filter("x IS NOT NULL")
        at = [lo + i * step for i in range(grid)]
        reach = bandwidths(each, at, needed)
        rows = [_struct(i=i, x0=at[i], h=h) for i, h in enumerate(reach) if h]
        return _quadratic_at(_at_grid(each, rows or [_struct(i=0, x0=lo, h=-1.0)], "abs(x - g.x0) < g.h"))
    cells = bin_points(points, x, y, weight, lo, hi, bins)
    at_grid = cells.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))).withColumn(
        "x0", lo + F.col("i") * step
    )
    # at most ``bins`` rows per grid point
    near = Window.partitionBy("i")
    reached = F.sum("w").over(
        near.orderBy("d").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return _quadratic_at(
        at_grid.withColumn("d", F.abs(F.col("x") - F.col("x0")))
        .withColumn("reached", reached)
        .withColumn("h", F.min(F.when(F.col("reached") >= needed, F.col("d"))).over(near))
        .filter(F.col("d") < F.col("h"))
    )


def _quadratic_at(near: DataFrame) -> DataFrame:
    """``i, x, fit`` from the points (x, y, w) within the bandwidth h of each grid point x0."""
    weighed = near.withColumn("u", (F.col("x") - F.col("x0")) / F.col("h")).withColumn(
        "k", F.col("w") * F.pow(1 - F.pow(F.abs("u"), F.lit(3.0)), F.lit(3.0))
    )
    u, k = F.col("u"), F.col("k")
    moments = weighed.groupBy("i", "x0").agg(
        F.sum(k).alias("s0"),
        F.sum(k * u).alias("s1"),
        F.sum(k * u * u).alias("s2"),
        F.sum(k * u * u * u).alias("s3"),
        F.sum(k * u * u * u * u).alias("s4"),
        F.sum(k * F.col("y")).alias("t0"),
        F.sum(k * u * F.col("y")).alias("t1"),
        F.sum(k * u * u * F.col("y")).alias("t2"),
    )
    # intercept of the weighted quadratic (Cramer's rule on the normal equations)
    s0, s1, s2, s3, s4 = (F.col(f"s{j}") for j in range(5))
    t0, t1, t2 = (F.col(f"t{j}") for j in range(3))
    determinant = (
        s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s2 * s3) + s2 * (s1 * s3 - s2 * s2)
    )
    numerator = t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)
    return moments.select(
        "i",
        F.col("x0").alias("x"),
        (numerator / F.nullif(determinant, F.lit(0.0))).alias("fit"),
    )
