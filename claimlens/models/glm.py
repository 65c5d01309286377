"""Log-link generalized linear models under the three severity variances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    GeneralizedLinearRegression,
    GeneralizedLinearRegressionModel,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.functions.text import linear


def severity_glm(power: float, **settings: object) -> GeneralizedLinearRegression:
    """Estimator with variance ``mu ** power`` and a log link."""
    common = dict(featuresCol="design", labelCol="Claim", maxIter=50, tol=1e-10)
    common.update(settings)
    if power == 2.0:
        return GeneralizedLinearRegression(family="gamma", link="log", **common)
    return GeneralizedLinearRegression(
        family="tweedie", variancePower=power, linkPower=0.0, **common
    )


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(
        inputCols=list(features), outputCol="design", handleInvalid="skip"
    ).transform(df)


def fit_glm(
    learn: DataFrame, features: Sequence[str], power: float, **settings: object
) -> GeneralizedLinearRegressionModel:
    """Fit on the learn rows.  Every iteration is one distributed pass that sums a
    (features + 1) squared matrix."""
    return severity_glm(power, **settings).fit(assemble(learn, features))


def predict_glm(
    df: DataFrame,
    model: GeneralizedLinearRegressionModel,
    features: Sequence[str],
    name: str,
) -> DataFrame:
    """Add the fitted mean: the exponential of the linear predictor, as a plain column
    expression.  A row with a missing feature gets null."""
    eta = linear(features, list(model.coefficients), model.intercept)
    return df.withColumn(name, F.expr(f"exp({eta})"))
