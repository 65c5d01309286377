"""Null-aware numeric column functions and hash-based random numbers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp(x: ColumnLike, lo: float | None = None, hi: float | None = None) -> Column:
    """Limit ``x`` to [lo, hi].  A null stays null (``least``/``greatest`` skip nulls)."""
    x = col(x)
    bounded = x
    if hi is not None:
        bounded = F.least(bounded, F.lit(hi))
    if lo is not None:
        bounded = F.greatest(bounded, F.lit(lo))
    return F.when(x.isNotNull(), bounded)


def bin_up(x: ColumnLike, width: int, hi: int | None = None) -> Column:
    """Upper edge of the bin holding ``x``, as a whole number."""
    return clamp(F.ceil(col(x) / width).cast("bigint") * width, hi=hi)


def bin_down(x: ColumnLike, width: int, hi: int | None = None) -> Column:
    """Lower edge of the bin holding ``x``, as a whole number."""
    return clamp(F.floor(col(x) / width).cast("bigint") * width, hi=hi)


def positive_log(x: ColumnLike) -> Column:
    """Natural log; null where ``x`` is not positive."""
    x = col(x)
    return F.when(x > 0, F.log(x))


def cube_root(x: ColumnLike) -> Column:
    return F.pow(col(x), F.lit(1.0 / 3.0))


def days_to_years(x: ColumnLike, digits: int = 4) -> Column:
    return F.round(col(x) / 365, digits)


def days_to_weeks(x: ColumnLike, digits: int = 4) -> Column:
    return F.round(col(x) / 7, digits)


def hash32(seed: int, *cols: ColumnLike) -> Column:
    """32-bit hash of the columns: the first eight hex digits of an MD5.

    Depends only on the values, so it is the same for any partitioning, any retry, and
    in any engine with MD5.
    """
    parts: list[Column] = [F.lit(str(seed))]
    for c in cols:
        parts += [F.lit(":"), col(c).cast("string")]
    digest = F.md5(F.concat(*parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_uniform(seed: int, *cols: ColumnLike, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Uniform number strictly inside (lo, hi) from the hash of the columns."""
    unit = (hash32(seed, *cols) + 0.5) / 4294967296.0
    return lo + unit * (hi - lo)


def hash_normal(seed: int, *cols: ColumnLike) -> Column:
    """Standard normal number by the Box-Muller transform of two hash uniforms."""
    u = hash_uniform(seed, *cols)
    v = hash_uniform(seed + 1, *cols)
    return F.sqrt(-2.0 * F.log(u)) * F.cos(2.0 * math.pi * v)
