"""The whole severity workflow on any claims table: clean, fit seven models, keep them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from claimlens import schema
from claimlens.models.baseline import mean_severity
from claimlens.models.minibatch import fit_minibatch
from claimlens.models.nets import NetSpec
from claimlens.models.report import compare_runs, loss_report
from claimlens.models.scoring import score
from claimlens.models.tracking import RunLog
from claimlens.models.training import NetModel, fit_nets, history_table, weights_table
from claimlens.operators.cleaning import filter_claims, number_claims
from claimlens.operators.features import apply_features, fit_features
from claimlens.operators.profile import calibration
from claimlens.operators.split import learn_rows, test_rows, with_split
from claimlens.sources import catalog
from claimlens.sources.storage import stage

NULL_MODEL = "null_model"

# run id -> (shown name, network kind, variance power)
NETWORKS = {
    "ffn_p2": ("Feed-forward, gamma", "ffn", 2.0),
    "ffn_pp": ("Feed-forward, power variance", "ffn", schema.POWER),
    "ffn_p3": ("Feed-forward, inverse Gaussian", "ffn", 3.0),
    "localglm_p2": ("Locally linear network, gamma", "localglm", 2.0),
    "localglm_pp": ("Locally linear network, power variance", "localglm", schema.POWER),
    "localglm_p3": ("Locally linear network, inverse Gaussian", "localglm", 3.0),
}


def network_specs() -> list[NetSpec]:
    return [NetSpec(name, kind, power) for name, (_, kind, power) in NETWORKS.items()]


@dataclass
class SeverityModels:
    """What a workflow leaves behind."""

    scored: DataFrame  # features, split and one prediction column per model
    models: list[NetModel]
    history: DataFrame
    calibration: DataFrame  # observed and fitted means of the test rows by feature level
    comparison: DataFrame
    log: RunLog
    runs: dict[str, str]  # model name -> run id


def build_silver(
    claims: DataFrame,
    key: Sequence[str],
    after_year: int = 1987,
    table: str | None = None,
    path: str | None = None,
) -> DataFrame:
    """Filtered, numbered claims; when named, published below ``path`` as the table's new version, which
    readers see in one step."""
    silver = number_claims(filter_claims(claims, after_year), key)
    if table is None or path is None:
        return silver
    return catalog.publish_version(silver, table, path, "Filtered claims by descending size")


def fit_severity_models(
    silver: DataFrame,
    folder: str,
    experiment: str = "severity",
    features_from: str = "all",
    method: str = "minibatch",
    **fit_settings: object,
) -> SeverityModels:
    """Fit the constant model and six networks, log all seven runs, compare them.

    The networks are fitted in the same passes over the learn rows and scored in one.
    ``features_from='learn'`` takes scaling and levels from the learn rows only.
    ``method='minibatch'`` takes every step on one copy of the weights (see ``fit_minibatch``; with very many rows
    give it larger mini-batches), ``'averaged'`` fits copies on parts of the rows and averages
    them (see ``fit_nets``).  ``fit_settings`` go to the chosen one, ``checkpoint`` among them.
    """
    spark = silver.sparkSession
    fitted_on = silver if features_from == "all" else learn_rows(with_split(silver))
    spec = fit_features(fitted_on)
    prepared = with_split(apply_features(silver, spec))
    learn = learn_rows(prepared)
    mean_claim = mean_severity(learn)
    fit = {"minibatch": fit_minibatch, "averaged": fit_nets}[method]
    models = fit(learn, network_specs(), mean_claim, **fit_settings)
    scored = score(prepared.selectExpr("*", f"{mean_claim!r}D AS {NULL_MODEL}"), models)
    log = RunLog(spark, folder, experiment)
    names = {NULL_MODEL: "Constant", **{n: shown for n, (shown, _, _) in NETWORKS.items()}}
    runs = {name: log.start_run(shown) for name, shown in names.items()}
    log.log_report(loss_report(scored, list(names)), names, runs)
    settings = {
        "batch_size": fit_settings.get("batch_size", schema.BATCH_SIZE),
        "validation_split": fit_settings.get("validation_split", schema.VALIDATION_SPLIT),
    }
    log.log_params(
        {
            runs[m.spec.name]: (
                names[m.spec.name],
                {"epochs": len(m.history), "rows_left_out": m.left_out, **settings},
            )
            for m in models
        }
    )
    history = history_table(spark, models)
    log.log_history(history, runs)
    log.log_weights(weights_table(spark, models), runs)
    log.log_features([runs[name] for name in NETWORKS], spec)
    fitted = stage(calibration(test_rows(scored), schema.CALIBRATION_FEATURES, list(names)), "calibration")
    log.log_calibration(fitted, runs)
    return SeverityModels(
        scored=scored,
        models=models,
        history=history,
        calibration=fitted,
        comparison=compare_runs(log.runs()),
        log=log,
        runs=runs,
    )
