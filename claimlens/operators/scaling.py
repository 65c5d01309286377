"""Column scaling: statistics in one aggregation, applied row by row.

Lazily the statistics are a scalar subquery; fitted, they are plain numbers that can be
stored and applied to other data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.text import number, quoted

Setting = bool | Sequence[float]


def _check(what: str, setting: Setting, n: int) -> None:
    if not isinstance(setting, bool) and len(setting) != n:
        raise ValueError(f"{what} needs one number per column: {n}, not {len(setting)}")


def _statistics(
    cols: Sequence[str], center: Setting, scale: Setting
) -> tuple[list[str], list[str]]:
    """Aggregate expressions for the center and the spread of every column."""
    centers, spreads = [], []
    for i, name in enumerate(cols):
        x = f"CAST({quoted(name)} AS DOUBLE)"
        if center is True:
            middle = f"avg({x})"
            squares = f"var_pop({x}) * count({x})"
        elif center is False:
            middle = "0D"
            squares = f"sum({x} * {x})"
        else:
            middle = number(center[i])
            squares = f"sum(({x} - {middle}) * ({x} - {middle}))"
        if scale is True:
            spread = f"sqrt({squares} / greatest(count({x}) - 1, 1))"
        elif scale is False:
            spread = "1D"
        else:
            spread = number(scale[i])
        centers.append(middle)
        spreads.append(spread)
    return centers, spreads


def _scaled(x: Column, middle: Column, spread: Column) -> Column:
    return (x.cast("double") - middle) / F.nullif(spread, F.lit(0.0))


def standardize(
    df: DataFrame,
    cols: Sequence[str],
    center: Setting = True,
    scale: Setting = True,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add ``(x - center) / scale`` for every column, under ``names[x]`` (``xNN``).

    ``center``: True for the mean, False for none, or given numbers.  ``scale``: True for
    the root of the summed squares (after centering) over n - 1, False for none, or given
    numbers.  Nulls are skipped in the statistics and stay null; a column without spread
    becomes null.
    """
    _check("center", center, len(cols))
    _check("scale", scale, len(cols))
    target = {c: (names or {}).get(c, f"{c}NN") for c in cols}
    if not isinstance(center, bool) and not isinstance(scale, bool):
        return df.withColumns(
            {
                target[c]: F.expr(
                    f"(CAST({quoted(c)} AS DOUBLE) - {number(m)}) / "
                    + (number(s) if s else "CAST(NULL AS DOUBLE)")
                )
                for c, m, s in zip(cols, center, scale)
            }
        )
    centers, spreads = _statistics(cols, center, scale)
    stats = df.agg(
        F.struct(
            *[F.expr(f"{m} AS m{i}") for i, m in enumerate(centers)],
            *[F.expr(f"{s} AS s{i}") for i, s in enumerate(spreads)],
        ).alias("stats")
    ).scalar()
    return df.withColumns(
        {
            target[c]: _scaled(F.col(c), stats[f"m{i}"], stats[f"s{i}"])
            for i, c in enumerate(cols)
        }
    )


def fit_scaling(
    df: DataFrame, cols: Sequence[str], center: Setting = True, scale: Setting = True
) -> tuple[list[float], list[float]]:
    """The numbers ``standardize`` would use: one aggregation, one row to the driver.

    A column without values gets center 0 and spread 0 (so its scaled form is null).
    """
    _check("center", center, len(cols))
    _check("scale", scale, len(cols))
    centers, spreads = _statistics(cols, center, scale)
    row = df.agg(
        F.count(F.lit(1)),
        *[F.expr(f"{m} AS m{i}") for i, m in enumerate(centers)],
        *[F.expr(f"{s} AS s{i}") for i, s in enumerate(spreads)],
    ).first()[1:]
    n = len(cols)
    return (
        [0.0 if v is None else float(v) for v in row[:n]],
        [0.0 if v is None else float(v) for v in row[n:]],
    )


def minmax(
    df: DataFrame, cols: Sequence[str], names: Mapping[str, str] | None = None
) -> DataFrame:
    """Add every column scaled to [-1, 1]; a constant column becomes null."""
    target = {c: (names or {}).get(c, f"{c}MM") for c in cols}
    stats = df.agg(
        F.struct(
            *[F.min(F.col(c).cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
            *[F.max(F.col(c).cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)],
        ).alias("stats")
    ).scalar()
    return df.withColumns(
        {
            target[c]: _scaled(F.col(c), stats[f"lo{i}"], stats[f"hi{i}"] - stats[f"lo{i}"])
            * 2
            - 1
            for i, c in enumerate(cols)
        }
    )
