"""Severity losses as aggregate expressions.

Every function takes the names of the observed and the fitted column and returns the
*mean* loss; ``unit_deviance`` is the term of one row.  Rows where a side is null or not
positive have no deviance and are skipped.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimlens.functions.text import number, quoted


def deviance_text(y: str, mu: str, power: float) -> str:
    """Deviance of one observation under variance ``mu ** power``, as SQL text.

    Powers 2 (gamma) and 3 (inverse Gaussian) have their own forms; the general one is
    singular at 1 and 2.
    """
    y, mu, power = quoted(y), quoted(mu), float(power)
    if power in (0.0, 1.0):
        raise ValueError("severity deviances need a variance power other than 0 and 1")
    if power == 2.0:
        term = f"2D * (({y} - {mu}) / {mu} + ln({mu} / {y}))"
    elif power == 3.0:
        term = f"({y} - {mu}) * ({y} - {mu}) / ({mu} * {mu} * {y})"
    else:
        a, b = 1.0 - power, 2.0 - power
        term = (
            f"2D * (pow({y}, {number(b)}) / {number(a * b)}"
            f" - {y} * pow({mu}, {number(a)}) / {number(a)}"
            f" + pow({mu}, {number(b)}) / {number(b)})"
        )
    return f"CASE WHEN {y} > 0 AND {mu} > 0 THEN {term} END"


def unit_deviance(y: str, mu: str, power: float) -> Column:
    return F.expr(deviance_text(y, mu, power))


def square_loss(y: str, mu: str) -> Column:
    y, mu = quoted(y), quoted(mu)
    return F.expr(f"avg(({y} - {mu}) * ({y} - {mu}))")


def gamma_deviance(y: str, mu: str) -> Column:
    return F.avg(unit_deviance(y, mu, 2.0))


def inverse_gaussian_deviance(y: str, mu: str) -> Column:
    return F.avg(unit_deviance(y, mu, 3.0))


def power_deviance(y: str, mu: str, power: float) -> Column:
    return F.avg(unit_deviance(y, mu, power))
