"""Run records as append-only tables: parameters, metrics, names, histories, weights.

A run has an id of its own, which ``start_run`` makes; all tables carry the experiment and
the run id, so repeated runs of one model never mix.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators.features import FeatureSpec
from claimlens.schema import RUNS_SCHEMA, WEIGHTS_SCHEMA


_EXPERIMENT = T.StructField("experiment", T.StringType())
_STORED_WEIGHTS = T.StructType([_EXPERIMENT, *WEIGHTS_SCHEMA.fields])
_STORED_FEATURES = "experiment string, run_id string, spec string"
_STORED_HISTORY = "experiment string, run_id string, epoch int, train_loss double, val_loss double"
_STORED_CALIBRATION = (
    "experiment string, run_id string, feature string, level string, n bigint, obs double, pred double"
)


def _mapped(column: str, to: Mapping[str, str] | None) -> Column:
    """The column's value, or what ``to`` has for it."""
    out = F.col(column)
    for old, new in (to or {}).items():
        out = F.when(F.col(column) == old, F.lit(new)).otherwise(out)
    return out


# Parts of an experiment's tables; a run is in one of them.
BUCKETS = 64
_BUCKET = T.StructField("bucket", T.IntegerType())


def _bucket() -> Column:
    return (F.crc32(F.col("run_id").cast("binary")) % BUCKETS).cast("int")


class RunLog:
    """Runs of one experiment, kept as Parquet under a folder.

    Every table is partitioned by experiment and by a bucket of the run id, so that what is read for one run
    is one of ``BUCKETS`` parts of its experiment.
    """

    def __init__(self, spark: SparkSession, folder: str, experiment: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.experiment = experiment

    @property
    def runs_path(self) -> str:
        return f"{self.folder}/model_runs"

    @property
    def weights_path(self) -> str:
        return f"{self.folder}/model_weights"

    @property
    def features_path(self) -> str:
        return f"{self.folder}/model_features"

    @property
    def history_path(self) -> str:
        return f"{self.folder}/model_history"

    @property
    def calibration_path(self) -> str:
        return f"{self.folder}/model_calibration"

    def start_run(self, run_name: str) -> str:
        """A run id never used before, which begins with the name."""
        plain = re.sub(r"[^a-z0-9]+", "-", run_name.lower()).strip("-")
        return f"{plain}-{uuid.uuid4().hex[:12]}"

    def _keep(self, rows: DataFrame, path: str) -> None:
        own = rows.withColumns({"experiment": F.lit(self.experiment), "bucket": _bucket()})
        # a run is a few rows: one file a bucket
        own.coalesce(1).write.mode("append").partitionBy("experiment", "bucket").parquet(path)

    def _kept(self, schema: T.StructType | str, path: str, run_id: str) -> DataFrame:
        """One run's rows; experiment and bucket are known before, so other folders are not read."""
        stored = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        table = self.spark.read.schema(T.StructType([*stored.fields, _BUCKET])).parquet(path)
        bucket = zlib.crc32(run_id.encode()) % BUCKETS
        own = (F.col("experiment") == self.experiment) & (F.col("bucket") == bucket) & (F.col("run_id") == run_id)
        return table.filter(own).drop("bucket")

    def _append(self, rows: DataFrame) -> None:
        self._keep(rows, self.runs_path)

    def log(
        self,
        run_id: str,
        run_name: str,
        params: Mapping[str, float] | None = None,
        metrics: Mapping[str, float] | None = None,
    ) -> None:
        rows = [
            (self.experiment, run_id, run_name, kind, key, float(value))
            for kind, values in (("param", params), ("metric", metrics))
            for key, value in (values or {}).items()
        ]
        self._append(self.spark.createDataFrame(rows, RUNS_SCHEMA))

    def log_report(
        self,
        report: DataFrame,
        names: Mapping[str, str] | None = None,
        ids: Mapping[str, str] | None = None,
    ) -> None:
        """Append a loss report (``model, key, value``), one run per model.

        ``ids`` are the models' run ids; without one a model's name is its run id, which
        then must be new to the experiment.
        """
        self._append(
            report.select(
                F.lit(self.experiment).alias("experiment"),
                _mapped("model", ids).alias("run_id"),
                _mapped("model", names).alias("run_name"),
                F.lit("metric").alias("kind"),
                "key",
                "value",
            )
        )

    def log_weights(self, weights: DataFrame, ids: Mapping[str, str] | None = None) -> None:
        self._keep(weights.withColumn("run_id", _mapped("run_id", ids)), self.weights_path)

    def log_history(self, history: DataFrame, ids: Mapping[str, str] | None = None) -> None:
        """Append loss histories (``model, epoch, train_loss, val_loss``)."""
        rows = history.select(_mapped("model", ids).alias("run_id"), "epoch", "train_loss", "val_loss")
        self._keep(rows, self.history_path)

    def log_calibration(self, table: DataFrame, ids: Mapping[str, str]) -> None:
        """Append calibration tables: of each model in ``ids`` the column ``pred_<model>``."""
        long = table.unpivot(
            ["feature", "level", "n", "obs"], [f"pred_{m}" for m in ids], "model", "pred"
        )
        by_column = {f"pred_{m}": i for m, i in ids.items()}
        rows = long.select(_mapped("model", by_column).alias("run_id"), "feature", "level", "n", "obs", "pred")
        self._keep(rows, self.calibration_path)

    def log_params(self, params: Mapping[str, tuple[str, Mapping[str, float]]]) -> None:
        """Append parameters of several runs: run id -> (name, parameters)."""
        rows = [
            (self.experiment, run_id, run_name, "param", key, float(value))
            for run_id, (run_name, values) in params.items()
            for key, value in values.items()
        ]
        self._append(self.spark.createDataFrame(rows, RUNS_SCHEMA))

    def log_features(self, run_ids: Sequence[str], spec: FeatureSpec) -> None:
        """Keep the feature preparation the models were fitted with."""
        text = spec.to_json()
        rows = self.spark.createDataFrame([(r, text) for r in run_ids], "run_id string, spec string")
        self._keep(rows, self.features_path)

    def features(self, run_id: str) -> FeatureSpec:
        kept = self._kept(_STORED_FEATURES, self.features_path, run_id).select("spec").distinct().take(2)
        if len(kept) != 1:
            raise ValueError(f"{'no' if not kept else 'different'} features kept for run {run_id}")
        return FeatureSpec.from_json(kept[0]["spec"])

    def history(self, run_id: str) -> DataFrame:
        table = self._kept(_STORED_HISTORY, self.history_path, run_id)
        return table.select("epoch", "train_loss", "val_loss")

    def calibration(self, run_id: str) -> DataFrame:
        table = self._kept(_STORED_CALIBRATION, self.calibration_path, run_id)
        return table.drop("experiment", "run_id")

    def runs(self) -> DataFrame:
        table = self.spark.read.schema(RUNS_SCHEMA).parquet(self.runs_path)
        return table.filter(F.col("experiment") == self.experiment).select(*RUNS_SCHEMA.names)

    def weights(self, run_id: str) -> DataFrame:
        return self._kept(_STORED_WEIGHTS, self.weights_path, run_id).select(*WEIGHTS_SCHEMA.names)
