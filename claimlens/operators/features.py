"""The feature table: cut-offs, scaled columns, one-hot columns, random columns.

Fitting takes two aggregations and yields a small ``FeatureSpec``; applying it is row
by row, so it needs no shuffle and works the same on claims scored later.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.numeric import clamp, hash_normal, hash_uniform
from claimlens.functions.text import quoted
from claimlens.operators.encoding import category_levels, level_code, one_hot
from claimlens.operators.scaling import fit_scaling, standardize
from claimlens.schema import CATEGORICAL, CUT_OFFS, SEED

# scaled column -> the column it is made from
SCALED = {
    "AgeNN": "Age",
    "GenderNN": "GenderCode",
    "DependentChildrenNN": "DependentChildren",
    "DependentsOtherNN": "DependentsOther",
    "WeeklyPayNN": "WeeklyPay",
    "PartTimeFullTimeNN": "PartTimeFullTimeCode",
    "HoursWorkedPerWeekNN": "HoursWorkedPerWeek",
    "DaysWorkedPerWeekNN": "DaysWorkedPerWeek",
    "AccYearNN": "AccYear",
    "AccMonthNN": "AccMonth",
    "AccWeekdayNN": "AccWeekday",
    "AccTimeNN": "AccTime",
    "RepDelayNN": "RepDelayCap",
    "RandNN": "RandNormal",
    "RandUN": "RandUniform",
}


@dataclass(frozen=True)
class FeatureSpec:
    """Everything needed to rebuild the features on other claims."""

    levels: dict[str, list[str]]
    centers: dict[str, float]
    scales: dict[str, float]
    seed: int = SEED

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> FeatureSpec:
        return FeatureSpec(**json.loads(text))


def clamp_claims(df: DataFrame) -> DataFrame:
    """Apply the cut-offs in place; the delay keeps its raw days and gets a capped copy."""
    changes = {
        c: clamp(c, lo=lo, hi=hi) for c, (lo, hi) in CUT_OFFS.items() if c != "RepDelay"
    }
    lo, hi = CUT_OFFS["RepDelay"]
    return df.withColumns({**changes, "RepDelayCap": clamp("RepDelay", lo=lo, hi=hi)})


def _before_scaling(
    df: DataFrame, levels: dict[str, list[str]], seed: int, id_col: str | None
) -> DataFrame:
    columns = {f"{c}Code": level_code(c, levels[c]) for c in ("Gender", "PartTimeFullTime")}
    if id_col is not None:
        root3 = math.sqrt(3.0)
        columns["RandNormal"] = hash_normal(seed + 20, id_col)
        columns["RandUniform"] = hash_uniform(seed + 30, id_col, lo=-root3, hi=root3)
    return clamp_claims(df).withColumns(columns)


def fit_features(df: DataFrame, seed: int = SEED, id_col: str = "Id") -> FeatureSpec:
    """Levels and scaling numbers of ``df`` (pass the learn rows to keep test data out)."""
    levels = category_levels(df, CATEGORICAL)
    sources = list(SCALED.values())
    centers, scales = fit_scaling(_before_scaling(df, levels, seed, id_col), sources)
    return FeatureSpec(
        levels=levels,
        centers=dict(zip(SCALED, centers)),
        scales=dict(zip(SCALED, scales)),
        seed=seed,
    )


def apply_features(df: DataFrame, spec: FeatureSpec, id_col: str | None = "Id") -> DataFrame:
    """Add the feature columns.  The two random columns are made from ``id_col``; without
    one (claims that are only scored) they are left out."""
    raw = _before_scaling(df, spec.levels, spec.seed, id_col)
    scaled = {n: c for n, c in SCALED.items() if c in raw.columns}
    out = standardize(
        raw,
        list(scaled.values()),
        center=[spec.centers[n] for n in scaled],
        scale=[spec.scales[n] for n in scaled],
        names={source: name for name, source in scaled.items()},
    )
    return one_hot(out, "MaritalStatus", "Marital", spec.levels["MaritalStatus"]).drop(
        "RandNormal", "RandUniform"
    )


def design_array(df: DataFrame, features: list[str], name: str = "design") -> DataFrame:
    """Add the model features as one array in fixed order."""
    values = ", ".join(f"CAST({quoted(f)} AS DOUBLE)" for f in features)
    return df.withColumn(name, F.expr(f"array({values})"))
