"""Loss reports, loss histories and model comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions.deviance import deviance_text
from claimlens.functions.text import literal, quoted, rows
from claimlens.schema import METRICS, POWER


def loss_report(
    df: DataFrame,
    predictions: Sequence[str],
    claim: str = "Claim",
    power: float = POWER,
) -> DataFrame:
    """``model, key, value``: the seven metrics of every model, in one aggregation.

    Losses are means over the learn and the test rows, rounded to four digits; the
    power-variance loss is in tenths and the inverse-Gaussian loss in thousandths.
    ``avg_size`` is the mean test prediction.
    """
    kinds = [("p2", 2.0, 1), ("pp", power, 10), ("p3", 3.0, 1000)]
    sums, table = [], []
    for m, name in enumerate(predictions):
        for split in ("learn", "test"):
            for kind, p, unit in kinds:
                label = f"m{m}_{split}_{kind}"
                loss = deviance_text(claim, name, p)
                sums.append(f"avg({loss}) FILTER (WHERE split = '{split}') AS {label}")
                table.append((name, f"{split}_{kind}", f"round({label} * {unit}, 4)"))
        sums.append(f"avg({quoted(name)}) FILTER (WHERE split = 'test') AS m{m}_avg")
        table.append((name, "avg_size", f"round(m{m}_avg, 0)"))
    return df.agg(*[F.expr(s) for s in sums]).selectExpr(
        rows([{"model": literal(m), "key": literal(k), "value": v} for m, k, v in table])
    )


def loss_curve(history: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """Epoch losses in long form: ``ids..., epoch, variable, loss``."""
    return history.unpivot(
        [*ids, "epoch"], ["train_loss", "val_loss"], "variable", "loss"
    )


def best_epoch(history: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """Epoch with the smallest validation loss, the first one on ties."""
    found = F.min(F.struct("val_loss", "epoch"))
    return (
        history.filter(F.col("val_loss").isNotNull())
        .groupBy(*ids)
        .agg(found.alias("best"))
        .select(*ids, F.col("best.epoch").alias("epoch"), F.col("best.val_loss").alias("val_loss"))
    )


def compare_runs(runs: DataFrame, by: str = "test_p2") -> DataFrame:
    """One row per run with its metrics side by side, ranked by a test loss within its
    experiment."""
    wide = (
        runs.filter(F.col("kind") == "metric")
        .groupBy("experiment", "run_id", "run_name")
        .pivot("key", METRICS)
        .agg(F.max("value"))
    )
    order = Window.partitionBy("experiment").orderBy(by)
    return wide.withColumn("place", F.rank().over(order))
