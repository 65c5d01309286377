"""Predictions of fitted networks as new columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.functions.text import linear, number, quoted
from claimlens.models import nets
from claimlens.models.training import NetModel
from claimlens.operators.features import FeatureSpec, apply_features
from claimlens.schema import CUT_OFFS, MODEL_FEATURES

cloudpickle.register_pickle_by_value(nets)


def _inputs(features: Sequence[str]) -> list[Column]:
    return [F.col(f).cast("double") for f in features]


def score(
    df: DataFrame, models: Sequence[NetModel], features: Sequence[str] = MODEL_FEATURES
) -> DataFrame:
    """Add one prediction column per network, all from one vectorized call per batch.

    A row with a missing feature gets a null prediction.
    """
    fitted = [(m.spec, m.theta) for m in models]
    names = [m.spec.name for m in models]
    predict = nets.predict

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            x = np.column_stack([np.asarray(c, dtype=float) for c in columns])
            yield pd.DataFrame({s.name: predict(s, theta, x) for s, theta in fitted})

    scored = F.pandas_udf(run, ", ".join(f"`{n}` double" for n in names))
    out = df.withColumn("_scores", scored(*_inputs(features)))
    return out.select(
        *df.columns, *[F.nanvl(F.col(f"_scores.`{n}`"), F.lit(None)).alias(n) for n in names]
    )


def score_claims(df: DataFrame, spec: FeatureSpec, models: Sequence[NetModel]) -> DataFrame:
    """Predictions for raw claims from kept models and the kept feature preparation.

    The claims keep their own columns; no id is needed and nothing is shuffled.
    """
    # the cut-offs are applied in place, so the columns they change are carried along
    kept = {c: f"_kept_{c}" for c in CUT_OFFS}
    carried = df.withColumns({k: F.col(c) for c, k in kept.items()})
    scored = score(apply_features(carried, spec, id_col=None), models)
    return scored.select(
        *[F.col(kept[c]).alias(c) if c in kept else c for c in df.columns],
        *[m.spec.name for m in models],
    )


def with_attention(
    df: DataFrame,
    model: NetModel,
    features: Sequence[str] = MODEL_FEATURES,
    name: str = "attention",
) -> DataFrame:
    """Add the feature weights of a ``localglm`` network as ``array<double>``.

    A row with a missing feature gets null, as its prediction is.
    """
    spec, theta = model.spec, model.theta
    weights = nets.attention

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            x = np.column_stack([np.asarray(c, dtype=float) for c in columns])
            whole = ~np.isnan(x).any(axis=1)
            yield pd.Series([w if ok else None for w, ok in zip(weights(spec, theta, x), whole)])

    return df.withColumn(name, F.pandas_udf(run, "array<double>")(*_inputs(features)))


def score_expressions(
    df: DataFrame, model: NetModel, features: Sequence[str] = MODEL_FEATURES
) -> DataFrame:
    """The same prediction as ``score`` from column expressions only (no Python worker).

    Each layer is one projection over the one before it.
    """
    spec = model.spec
    parts = spec.unpack(model.theta)

    keep = [quoted(c) for c in df.columns]
    x = [f"_x{i}" for i in range(len(features))]
    out = df.selectExpr(*keep, *[f"CAST({quoted(f)} AS DOUBLE) AS {n}" for f, n in zip(features, x)])

    def affine(inputs: Sequence[str], w: np.ndarray, b: np.ndarray) -> list[str]:
        return [linear(inputs, w[:, j], b[j]) for j in range(len(b))]

    inputs = x
    for layer in range(len(spec.hidden)):
        nodes = affine(inputs, *parts[layer])
        inputs = [f"_h{layer}_{j}" for j in range(len(nodes))]
        carried = keep + (x if spec.kind == "localglm" else [])
        out = out.selectExpr(*carried, *[f"tanh({t}) AS {n}" for t, n in zip(nodes, inputs)])
    w, b = parts[-1]
    if spec.kind == "ffn":
        (eta,) = affine(inputs, w, b)
    else:
        betas = affine(inputs, *parts[-2])
        total = " + ".join(f"({beta}) * {name}" for beta, name in zip(betas, x))
        eta = f"({total}) * {number(w[0, 0])} + {number(b[0])}"
    return out.selectExpr(*keep, f"exp({eta}) AS {quoted(spec.name)}")
