"""Named queries: every operator applied to the claims of a data folder.

Each takes (session, data folder) and returns a DataFrame over the whole tables.
Computed doubles are rounded (four digits, scaled features six), since the order of a
distributed sum changes the last bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens import schema
from claimlens.functions.deviance import square_loss
from claimlens.functions.numeric import cube_root, hash32, positive_log
from claimlens.functions.text import rows as inline_rows
from claimlens.models.baseline import with_mean_severity
from claimlens.models.glm import fit_glm, predict_glm
from claimlens.models.minibatch import fit_minibatch
from claimlens.models.nets import Nadam, NetSpec
from claimlens.models.report import best_epoch, compare_runs, loss_curve, loss_report
from claimlens.models.scoring import score, score_claims, with_attention
from claimlens.models.tracking import RunLog
from claimlens.models.training import (
    NetModel,
    fit_nets,
    history_table,
    load_model,
    mean_gradients,
    weights_table,
)
from claimlens.operators import profile as prof
from claimlens.operators.cleaning import filter_claims, number_claims, small_claims
from claimlens.operators.correlation import pearson, spearman
from claimlens.operators.delay import (
    reporting_scatter,
    week_counts,
    week_means,
    with_weeks,
)
from claimlens.operators.density import kernel_density
from claimlens.operators.encoding import (
    code_by_table,
    level_codes,
    level_table,
    one_hot,
)
from claimlens.operators.features import SCALED, clamp_claims, design_array
from claimlens.operators.quantiles import exact_quantiles
from claimlens.operators.scaling import minmax, standardize
from claimlens.operators.sketches import (
    DISTINCT_ERROR,
    RANK_ERROR,
    merge_sketches,
    rank_errors,
    read_sketches,
    sketch_columns,
    sketched_distinct,
    sketched_quantiles,
    write_sketches,
)
from claimlens.operators.split import (
    learn_rows,
    picked_ids,
    split_sets,
    test_rows,
    with_validation,
)
from claimlens.operators.summary import (
    column_ranges,
    delay_range,
    grid,
    numeric_summary,
    split_means,
    split_sizes,
)
from claimlens.operators.survival import ecdf_by_id, local_quadratic, log_survival
from claimlens.plans.workflow import fit_severity_models
from claimlens.plans.workspace import AFTER_YEAR, DATABASE, Workspace, workspace
from claimlens.sources import catalog
from claimlens.sources.claims import VIEW_KEY, ingest, ingest_checked
from claimlens.sources.storage import stage, stage_path

Query = Callable[[SparkSession, str], DataFrame]

SUMMARY_COLUMNS = [
    "Claim",
    "Age",
    "DependentChildren",
    "DependentsOther",
    "WeeklyPay",
    "HoursWorkedPerWeek",
    "DaysWorkedPerWeek",
    "AccYear",
    "AccMonth",
    "AccWeekday",
    "AccTime",
    "AccDay",
    "RepDay",
    "RepYear",
    "RepDelay",
    "RepDelayCap",
    *SCALED,
    "Marital1",
    "Marital2",
    "Marital3",
]

GLM_GROUPS = ["Gender", "MaritalStatus", "PartTimeFullTime"]

_QUERIES: dict[str, Query] = {}


def query(build: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    """Register a query under the function's name."""

    def run(spark: SparkSession, data_dir: str) -> DataFrame:
        return build(workspace(spark, data_dir))

    run.__doc__ = build.__doc__
    run.__name__ = build.__name__
    _QUERIES[build.__name__] = run
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def r(x: Column | str, digits: int = 4) -> Column:
    return F.round(x, digits)


# --- sources and catalog -----------------------------------------------------------


@query
def bronze_scan(w: Workspace) -> DataFrame:
    """Ingest, write, register as an external table, scan by name."""
    return catalog.scan_table(w.spark, w.bronze_table)


@query
def ingest_scan(w: Workspace) -> DataFrame:
    """Claims files read with the declared schema, which drops what it does not name."""
    path = catalog.write_table(w.bronze, stage_path(w.spark, "claims-files"))
    return ingest(w.spark, path)


@query
def silver_from_bronze(w: Workspace) -> DataFrame:
    """Silver made from the bronze table by name: filtered, numbered, as published."""
    bronze = catalog.scan_table(w.spark, w.bronze_table)
    numbered = number_claims(filter_claims(bronze, AFTER_YEAR), VIEW_KEY)
    return numbered.select(*VIEW_KEY, *[f.name for f in schema.CLAIMS_SCHEMA.fields], "Id")


@query
def database_cycle(w: Workspace) -> DataFrame:
    """A database created, used for a table, read by its plain name, and dropped."""
    name = f"cycle_{uuid.uuid4().hex[:8]}"
    before = w.spark.catalog.currentDatabase()
    catalog.create_database(w.spark, name, stage_path(w.spark, "cycle"))
    try:
        catalog.use_database(w.spark, name)
        counted = w.bronze.groupBy("Gender").agg(F.count(F.lit(1)).alias("n"))
        catalog.publish(counted, "claims_by_gender", stage_path(w.spark, "by-gender"))
        return stage(catalog.scan_table(w.spark, "claims_by_gender"), "by-gender-read")
    finally:
        catalog.use_database(w.spark, before)
        catalog.drop_database(w.spark, name, confirm=True)


@query
def silver_by_path(w: Workspace) -> DataFrame:
    """The written silver table, scanned by its path."""
    path = catalog.write_table(silver_claims(w), stage_path(w.spark, "silver-table"))
    return catalog.scan_path(w.spark, path)


@query
def publish_twice(w: Workspace) -> DataFrame:
    """A table replaced while a reader holds it: what that reader, and one that comes later, see."""
    catalog.create_database(w.spark, DATABASE, stage_path(w.spark, "database"))
    name, folder = f"{DATABASE}.replaced_{uuid.uuid4().hex[:8]}", stage_path(w.spark, "versions")
    columns = ["Id", "Claim", "AccYear"]
    before = catalog.publish_version(w.silver.filter("AccYear <= 1996").select(*columns), name, folder, "First")
    after = catalog.publish_version(w.silver.select(*columns), name, folder, "Second")
    seen = before.select(F.lit("before").alias("reader"), "*").unionByName(after.select(F.lit("after").alias("reader"), "*"))
    found = stage(seen.groupBy("reader", "AccYear").agg(F.count(F.lit(1)).alias("n"), r(F.sum("Claim"), 2).alias("total")), "seen")
    catalog.drop_table(w.spark, name)
    return found


@query
def ingest_rejects(w: Workspace) -> DataFrame:
    """Claims written as text with damaged records, read back: accepted and rejected records by reason."""
    names = [f.name for f in schema.CLAIMS_SCHEMA.fields]
    kind = F.col("l_orderkey") % 10
    fields = {c: F.col(c).cast("string") for c in names}
    fields["Claim"] = F.when(kind == 3, "n/a").when(kind == 5, "").otherwise(fields["Claim"])
    line = F.concat_ws(",", *fields.values())
    line = F.when(kind == 7, F.concat_ws(",", *list(fields.values())[:4])).otherwise(line)
    path = stage_path(w.spark, "claims-text")
    w.bronze.select(line.alias("value")).write.text(path)
    accepted, rejected = ingest_checked(w.spark, path)
    kept = accepted.select(F.lit("accepted").alias("reason"), F.col("Claim"))
    seen = kept.unionByName(rejected.select("reason", F.lit(None).cast("double").alias("Claim")))
    return seen.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), r(F.sum("Claim"), 2).alias("total"))


@query
def large_category_codes(w: Workspace) -> DataFrame:
    """Codes of a category with a level for almost every claim, and of one with three, by shuffled level tables."""
    claims = w.silver.select("Id", "MaritalStatus", F.concat_ws("-", "l_partkey", "l_orderkey").alias("Policy"))
    levels = level_table(claims, ["Policy", "MaritalStatus"])
    coded = code_by_table(claims, levels, ["Policy", "MaritalStatus"], broadcast_levels=0)
    return coded.select("Id", "PolicyCode", "MaritalStatusCode")


@query
def schema_report(w: Workspace) -> DataFrame:
    """Column names, types, non-null counts and the first row's values."""
    return catalog.schema_report(silver_claims(w), F.col("Id") == 1)


@query
def preview_week_counts(w: Workspace) -> DataFrame:
    """First six rows of the week counts in key order."""
    return catalog.preview(week_counts(with_weeks(w.silver)), ["acc_week", "rep_week"])


@query
def preview_week_means(w: Workspace) -> DataFrame:
    means = week_means(with_weeks(w.silver))
    return catalog.preview(means, ["acc_week"]).select("acc_week", r("mm").alias("mm"))


# --- cleaning, ids, split ----------------------------------------------------------


@query
def silver_claims(w: Workspace) -> DataFrame:
    """Filtered claims with their descending rank."""
    return w.silver.drop("split", "shuffle_key")


@query
def dense_ids(w: Workspace) -> DataFrame:
    return w.silver.select("Id", "Claim", *VIEW_KEY)


@query
def small_claim_filter(w: Workspace) -> DataFrame:
    return small_claims(w.silver).select("Id", "Claim")


@query
def split_assignment(w: Workspace) -> DataFrame:
    """Split and shuffle key of every claim."""
    return w.features.select("Id", "split", "shuffle_key")


@query
def split_by_sets(w: Workspace) -> DataFrame:
    """The same split by intersecting and subtracting a table of picked ids."""
    test, learn = split_sets(w.silver, picked_ids(w.silver))
    return test.withColumn("split", F.lit("test")).unionByName(
        learn.withColumn("split", F.lit("learn"))
    )


@query
def split_sizes_query(w: Workspace) -> DataFrame:
    return split_sizes(w.features)


@query
def split_means_query(w: Workspace) -> DataFrame:
    return split_means(w.features)


@query
def split_quantiles(w: Workspace) -> DataFrame:
    """Claim quantiles of learn and test rows."""
    q = exact_quantiles(w.features, "Claim", schema.SPLIT_PROBS, by=["split"])
    return q.select("split", "prob", r("quantile").alias("quantile"))


@query
def split_quantiles_large(w: Workspace) -> DataFrame:
    """The same by narrowing, the way groups of any size go."""
    q = exact_quantiles(
        w.features, "Claim", schema.SPLIT_PROBS, by=["split"], small_group=1, few_rows=50
    )
    return q.select("split", "prob", r("quantile").alias("quantile"))


@query
def shuffle_validation(w: Workspace) -> DataFrame:
    """Learn rows with their place in the fit: training or validation tail."""
    return with_validation(learn_rows(w.features)).select("Id", "shuffle_key", "is_validation")


# --- features ----------------------------------------------------------------------


@query
def clamped_features(w: Workspace) -> DataFrame:
    return clamp_claims(w.silver).select(
        "Id",
        "Age",
        "DependentChildren",
        "DependentsOther",
        "WeeklyPay",
        "HoursWorkedPerWeek",
        "RepDelay",
        "RepDelayCap",
    )


@query
def profile_bins(w: Workspace) -> DataFrame:
    return prof.binned(w.features, delay="RepDelayCap").select(
        "Id", "WeeklyPay", "HoursWorkedPerWeek", "RepDelay"
    )


@query
def category_codes(w: Workspace) -> DataFrame:
    codes = level_codes(w.silver, w.spec.levels)
    return codes.select("Id", *[f"{c}Code" for c in schema.CATEGORICAL])


@query
def standardized(w: Workspace) -> DataFrame:
    """The scaled columns of the model."""
    names = [f for f in schema.MODEL_FEATURES if f.endswith("NN")]
    return w.features.select("Id", *[r(n, 6).alias(n) for n in names])


@query
def standardized_lazily(w: Workspace) -> DataFrame:
    """Centered, uncentered and unscaled forms, with the statistics as a subquery."""
    base = w.silver.select("Id", "WeeklyPay", "RepDelay")
    out = standardize(base, ["WeeklyPay", "RepDelay"])
    out = standardize(
        out, ["WeeklyPay"], center=False, names={"WeeklyPay": "WeeklyPayRms"}
    )
    out = standardize(
        out, ["RepDelay"], scale=False, names={"RepDelay": "RepDelayCentered"}
    )
    names = ["WeeklyPayNN", "RepDelayNN", "WeeklyPayRms", "RepDelayCentered"]
    return out.select("Id", *[r(n).alias(n) for n in names])


@query
def minmax_scaled(w: Workspace) -> DataFrame:
    out = minmax(w.silver, ["Age", "WeeklyPay", "RepDelay"])
    return out.select("Id", *[r(n, 6).alias(n) for n in ("AgeMM", "WeeklyPayMM", "RepDelayMM")])


@query
def onehot_marital(w: Workspace) -> DataFrame:
    out = one_hot(w.silver, "MaritalStatus", "Marital", w.spec.levels["MaritalStatus"])
    return out.select("Id", "MaritalStatus", "Marital1", "Marital2", "Marital3")


@query
def random_features(w: Workspace) -> DataFrame:
    return w.features.select("Id", r("RandNN", 6).alias("RandNN"), r("RandUN", 6).alias("RandUN"))


@query
def design_matrix(w: Workspace) -> DataFrame:
    """The 16 features in fixed order, unfolded to (Id, position, value)."""
    return (
        design_array(w.features, schema.MODEL_FEATURES)
        .select("Id", F.posexplode("design").alias("position", "value"))
        .select("Id", "position", r("value", 6).alias("value"))
    )


# --- summaries ---------------------------------------------------------------------


@query
def claim_mean(w: Workspace) -> DataFrame:
    return w.silver.agg(r(F.avg("Claim")).alias("mean_claim"), F.count(F.lit(1)).alias("n"))


@query
def claim_ranges(w: Workspace) -> DataFrame:
    """Ranges of years, delay and claim."""
    out = column_ranges(w.features, ["AccYear", "RepYear", "RepDelay", "RepDelayCap", "Claim"])
    return out.select("column", "lo", "hi", r("mean").alias("mean"), "nulls")


@query
def delay_ranges(w: Workspace) -> DataFrame:
    """Delay range in days, years and weeks: raw and capped."""
    return delay_range(w.features, "RepDelay").unionByName(delay_range(w.features, "RepDelayCap"))


def _rounded_summary(df: DataFrame) -> DataFrame:
    numbers = ["min", "q1", "median", "q3", "mean", "max"]
    return df.select("feature", "n", "nulls", *[r(c).alias(c) for c in numbers])


@query
def table_summary(w: Workspace) -> DataFrame:
    """Six-number summary of every numeric column."""
    return _rounded_summary(numeric_summary(w.features, SUMMARY_COLUMNS))


@query
def table_summary_large(w: Workspace) -> DataFrame:
    """The same with quartiles by narrowing."""
    return _rounded_summary(numeric_summary(w.features, SUMMARY_COLUMNS, small_group=1))


@query
def claim_summary(w: Workspace) -> DataFrame:
    return _rounded_summary(numeric_summary(w.silver, ["Claim"]))


@query
def level_counts(w: Workspace) -> DataFrame:
    return prof.level_counts(w.features, schema.CATEGORICAL)


@query
def distinct_counts(w: Workspace) -> DataFrame:
    return prof.distinct_counts(w.features, schema.PROFILE_FEATURES)


SKETCHED = ["Claim", "Age", "WeeklyPay", "HoursWorkedPerWeek"]


def _yearly_sketches(w: Workspace) -> DataFrame:
    """Sketches per accident year, two years at a time; the last years are loaded twice."""
    path = stage_path(w.spark, "sketches")
    for years in ("AccYear <= 1996", "AccYear > 1996", "AccYear > 1996"):
        write_sketches(sketch_columns(w.silver.filter(years), SKETCHED, "AccYear"), path)
    return read_sketches(w.spark, path)


@query
def sketch_quantiles(w: Workspace) -> DataFrame:
    """Quantiles merged from yearly sketches, held against their exact ranks."""
    asked = sketched_quantiles(merge_sketches(_yearly_sketches(w)), schema.SPLIT_PROBS)
    errors = rank_errors(w.silver, asked, SKETCHED)
    return errors.select("feature", "prob", "n", (F.col("rank_error") <= RANK_ERROR).alias("within"))


@query
def sketch_distinct(w: Workspace) -> DataFrame:
    """Distinct values per year from sketches, held against exact counts (within four standard errors)."""
    kept = sketched_distinct(merge_sketches(_yearly_sketches(w), ["part"]), ["part"])
    exact = prof.distinct_counts_by(w.silver, SKETCHED, "AccYear").select(
        F.col("AccYear").cast("string").alias("part"), "feature", F.col("n_distinct").alias("exact")
    )
    off = F.abs(F.col("n_distinct") / F.col("exact") - 1)
    return kept.join(exact, ["part", "feature"]).select(
        F.col("part").cast("int").alias("AccYear"),
        "feature",
        "n",
        "exact",
        (off <= 4 * DISTINCT_ERROR).alias("within"),
    )


@query
def claim_grid(w: Workspace) -> DataFrame:
    """101 equally spaced log claims."""
    logs = w.silver.select(positive_log("Claim").alias("log_claim"))
    return grid(logs, "log_claim").select("i", r("x", 6).alias("x"))


@query
def transforms(w: Workspace) -> DataFrame:
    return w.silver.select(
        "Id",
        r(positive_log("Claim"), 6).alias("log_claim"),
        r(cube_root("Claim"), 6).alias("cube_root_claim"),
    )


# --- reporting delay ---------------------------------------------------------------


@query
def delay_weeks(w: Workspace) -> DataFrame:
    return with_weeks(w.silver).select("Id", "acc_week", "rep_week", "RepDelay_week")


@query
def week_counts_query(w: Workspace) -> DataFrame:
    return week_counts(with_weeks(w.silver))


@query
def week_mean_delay(w: Workspace) -> DataFrame:
    return week_means(with_weeks(w.silver)).select("acc_week", r("mm").alias("mm"))


@query
def delay_quantiles(w: Workspace) -> DataFrame:
    """Quantiles of the weekly delay: table values and chart lines."""
    probs = sorted({*schema.DELAY_PROBS, *schema.DELAY_LINE_PROBS})
    q = exact_quantiles(with_weeks(w.silver), "RepDelay_week", probs)
    return q.select("prob", r("quantile").alias("quantile"))


@query
def reporting_scatter_query(w: Workspace) -> DataFrame:
    return reporting_scatter(with_weeks(w.silver)).withColumn("mm", r("mm"))


# --- one-way tables ----------------------------------------------------------------


def _marginal(w: Workspace) -> DataFrame:
    binned = prof.binned(w.features, delay="RepDelayCap")
    return prof.marginal_profile(binned, schema.PROFILE_FEATURES)


@query
def marginal_profile(w: Workspace) -> DataFrame:
    """Claim count and mean claim per level of 14 features."""
    return _marginal(w).select("feature", "level", "vol", r("avg").alias("avg"))


@query
def uniform_reference(w: Workspace) -> DataFrame:
    out = prof.uniform_reference(_marginal(w))
    return out.select("feature", "levels", r("global_n").alias("global_n"))


# --- correlation -------------------------------------------------------------------


def _correlation_input(w: Workspace) -> DataFrame:
    return w.features.withColumn("RepDelay", F.col("RepDelayCap"))


@query
def pearson_matrix(w: Workspace) -> DataFrame:
    return pearson(_correlation_input(w), schema.CORRELATION_COLUMNS)


@query
def spearman_matrix(w: Workspace) -> DataFrame:
    return spearman(_correlation_input(w), schema.CORRELATION_COLUMNS)


# --- distribution ------------------------------------------------------------------


def _density(df: DataFrame) -> DataFrame:
    return kernel_density(df, "v").select(
        "i", r("x", 6).alias("x"), F.round("density", 10).alias("density")
    )


@query
def kde_claim(w: Workspace) -> DataFrame:
    """Density of claims up to 10,000."""
    return _density(small_claims(w.silver).select(F.col("Claim").alias("v")))


@query
def kde_log(w: Workspace) -> DataFrame:
    return _density(w.silver.select(positive_log("Claim").alias("v")))


@query
def kde_cuberoot(w: Workspace) -> DataFrame:
    return _density(w.silver.select(cube_root("Claim").alias("v")))


@query
def ecdf_survival(w: Workspace) -> DataFrame:
    """Empirical distribution and log-survival at every distinct claim."""
    points = log_survival(ecdf_by_id(w.silver))
    return points.select(
        "x",
        "cnt",
        r("ecdf", 6).alias("ecdf"),
        r("log_x", 6).alias("log_x"),
        r("log_survival", 6).alias("log_survival"),
    )


@query
def local_regression(w: Workspace) -> DataFrame:
    """Smoothed log-log survival curve at 101 points."""
    points = log_survival(ecdf_by_id(w.silver))
    fit = local_quadratic(points, "log_x", "log_survival", "cnt")
    return fit.select("i", r("x", 6).alias("x"), r("fit", 6).alias("fit"))


@query
def local_regression_exact(w: Workspace) -> DataFrame:
    """The same smooth from every point, without merging points into cells."""
    points = log_survival(ecdf_by_id(w.silver))
    fit = local_quadratic(points, "log_x", "log_survival", "cnt", bins=None)
    return fit.select("i", r("x", 6).alias("x"), r("fit", 6).alias("fit"))


# --- models ------------------------------------------------------------------------


def fixed_net(
    kind: str,
    name: str,
    mean_claim: float,
    power: float = 2.0,
    inputs: int = 16,
    hidden: tuple[int, ...] = (20, 15, 10),
) -> NetModel:
    """A network with weights from a formula, so that another engine can repeat it.

    Entry (i, j) of every hidden matrix is ((7 i + 3 j) mod 11 - 5) / 50, bias j is
    (j mod 5 - 2) / 50; the output bias is the log of the mean claim.
    """
    spec = NetSpec(name, kind, power, inputs, hidden)
    theta = np.zeros(spec.size)
    for (layer, a, b), (w, bias) in zip(spec.layers, spec.unpack(theta)):
        i, j = np.indices((a, b))
        w[:] = ((7 * i + 3 * j) % 11 - 5) / 50
        bias[:] = (np.arange(b) % 5 - 2) / 50
        if layer == "output":
            bias[:] = np.log(mean_claim)
            if kind == "localglm":
                w[:] = 0.5
    return NetModel(spec, theta)


def _fixed_nets(w: Workspace) -> list[NetModel]:
    return [
        fixed_net("ffn", "ffn_fixed", w.mean_claim),
        fixed_net("localglm", "localglm_fixed", w.mean_claim),
    ]


@query
def null_model_losses(w: Workspace) -> DataFrame:
    return loss_report(with_mean_severity(w.features), ["null_model"])


@query
def square_loss_null(w: Workspace) -> DataFrame:
    scored = with_mean_severity(w.features)
    return scored.groupBy("split").agg(r(square_loss("Claim", "null_model"), 2).alias("square_loss"))


@query
def ffn_forward_fixed(w: Workspace) -> DataFrame:
    scored = score(w.features, _fixed_nets(w)[:1])
    return scored.select("Id", r("ffn_fixed").alias("mu"))


@query
def localglm_forward_fixed(w: Workspace) -> DataFrame:
    scored = score(w.features, _fixed_nets(w)[1:])
    return scored.select("Id", r("localglm_fixed").alias("mu"))


@query
def localglm_attention_fixed(w: Workspace) -> DataFrame:
    """Feature weights of every claim in long form."""
    out = with_attention(w.features, _fixed_nets(w)[1])
    return out.select("Id", F.posexplode("attention").alias("position", "beta")).select(
        "Id", "position", r("beta", 6).alias("beta")
    )


@query
def loss_report_fixed(w: Workspace) -> DataFrame:
    """The seven metrics of three models in one pass."""
    scored = score(with_mean_severity(w.features), _fixed_nets(w))
    return loss_report(scored, ["null_model", "ffn_fixed", "localglm_fixed"])


@query
def calibration(w: Workspace) -> DataFrame:
    """Observed and fitted means of the test rows by age, gender, month and year."""
    scored = score(test_rows(w.features), _fixed_nets(w))
    out = prof.calibration(
        scored, schema.CALIBRATION_FEATURES, ["ffn_fixed", "localglm_fixed"]
    )
    numbers = ["obs", "pred_ffn_fixed", "pred_localglm_fixed"]
    return out.select("feature", "level", "n", *[r(c).alias(c) for c in numbers])


FIXED_POWERS = {"p2": 2.0, "pp": schema.POWER, "p3": 3.0}


def _powered_nets(w: Workspace) -> list[NetModel]:
    return [
        fixed_net(kind, f"{kind}_{label}", w.mean_claim, power)
        for kind in ("ffn", "localglm")
        for label, power in FIXED_POWERS.items()
    ]


def _parameter_rows(w: Workspace, models: list[NetModel], digits: int) -> DataFrame:
    rows = weights_table(w.spark, models).select("model", "layer", "i", "j", "value")
    return rows.withColumn("value", r("value", digits) + 0.0)


@query
def net_gradient_fixed(w: Workspace) -> DataFrame:
    """Mean gradient over the learn rows of six formula-weight networks.

    Multiplied by the mean claim to the power p - 2, which makes all powers alike in size.
    """
    models = _powered_nets(w)
    found = mean_gradients(learn_rows(w.features), models)
    scaled = [
        NetModel(m.spec, g * w.mean_claim ** (m.spec.power - 2)) for m, (_, g) in zip(models, found)
    ]
    return _parameter_rows(w, scaled, 6)


@query
def nadam_step_fixed(w: Workspace) -> DataFrame:
    """Parameters of the same networks after one optimizer step on the whole gradient."""
    models = _powered_nets(w)
    stepped = []
    for m, (_, gradient) in zip(models, mean_gradients(learn_rows(w.features), models)):
        state = Nadam(m.theta, np.zeros(m.spec.size), np.zeros(m.spec.size))
        state.update(gradient)
        stepped.append(NetModel(m.spec, state.theta))
    return _parameter_rows(w, stepped, 6)


# Networks small enough for two steps of their training to be written as SQL.
SMALL_INPUTS = ["AgeNN", "WeeklyPayNN", "RepDelayNN"]
SMALL_POWERS = {"small_p2": 2.0, "small_p3": 3.0}


def _fit_small(w: Workspace, epochs: int, batch_size: int, checkpoint: str | None = None) -> list[NetModel]:
    nets = [fixed_net("ffn", name, w.mean_claim, p, len(SMALL_INPUTS), (2,)) for name, p in SMALL_POWERS.items()]
    return fit_minibatch(
        learn_rows(w.features),
        [n.spec for n in nets],
        w.mean_claim,
        SMALL_INPUTS,
        epochs=epochs,
        batch_size=batch_size,
        warm_start=[n.theta for n in nets],
        precision=np.float64,
        checkpoint=checkpoint,
    )


@query
def fit_two_steps(w: Workspace) -> DataFrame:
    """Parameters of two small networks after one epoch of two mini-batches, from formula weights."""
    n_train = learn_rows(w.silver).count() * 4 // 5
    return _parameter_rows(w, _fit_small(w, 1, -(-n_train // 2)), 6)


@query
def fit_resumed(w: Workspace) -> DataFrame:
    """Losses of the same networks over two epochs of one step each, the second from the first one's checkpoint.

    Multiplied by the mean claim to the power p - 2, as all powers are then alike in size.
    """
    folder = stage_path(w.spark, "fit")
    n = learn_rows(w.silver).count()
    _fit_small(w, 1, n, folder)
    models = _fit_small(w, 2, n, folder)
    rows = [
        (m.spec.name, epoch, *(x * w.mean_claim ** (m.spec.power - 2) for x in losses), epoch == m.best_epoch)
        for m in models
        for epoch, *losses in m.history
    ]
    made = w.spark.createDataFrame(rows, "model string, epoch int, train_loss double, val_loss double, kept boolean")
    return made.withColumns({c: r(c, 6) for c in ("train_loss", "val_loss")})


@query
def batch_scoring(w: Workspace) -> DataFrame:
    """Keep a model and its features as tables, load them back, score every numbered claim."""
    log = RunLog(w.spark, stage_path(w.spark, "kept-model"), "severity")
    log.log_weights(weights_table(w.spark, _fixed_nets(w)))
    log.log_features(["localglm_fixed"], w.spec)
    kept = load_model(log.weights("localglm_fixed"))
    scored = score_claims(w.silver, log.features("localglm_fixed"), [kept])
    return scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), r(F.avg("localglm_fixed")).alias("mean_prediction")
    )


def _saturated(w: Workspace, column: str) -> DataFrame:
    """Gamma GLM on the one-hot levels of one column: its fit is the group mean."""
    levels = w.spec.levels[column]
    inputs = [f"_g{i + 1}" for i in range(1, len(levels))]
    coded = one_hot(w.features, column, "_g", levels)
    model = fit_glm(learn_rows(coded), inputs, 2.0)
    return predict_glm(coded, model, inputs, f"glm_{column}").drop(
        *[f"_g{i + 1}" for i in range(len(levels))]
    )


@query
def glm_saturated_groups(w: Workspace) -> DataFrame:
    parts = None
    for column in GLM_GROUPS:
        part = (
            _saturated(w, column)
            .groupBy(F.lit(column).alias("feature"), F.col(column).alias("level"))
            .agg(r(F.avg(f"glm_{column}"), 2).alias("fitted"))
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query
def model_comparison(w: Workspace) -> DataFrame:
    """Five runs logged to the run table, read back and compared."""
    log = RunLog(w.spark, stage_path(w.spark, "runs"), "severity")
    log.log_report(
        loss_report(
            score(with_mean_severity(w.features), _fixed_nets(w)),
            ["null_model", "ffn_fixed", "localglm_fixed"],
        ),
        {"null_model": "Constant"},
    )
    for column in ("Gender", "MaritalStatus"):
        log.log_report(loss_report(_saturated(w, column), [f"glm_{column}"]))
    return compare_runs(log.runs()).withColumn("place", F.col("place").cast("bigint"))


@query
def run_log(w: Workspace) -> DataFrame:
    """Parameters and metrics of a run as stored rows."""
    log = RunLog(w.spark, stage_path(w.spark, "log"), "severity")
    report = loss_report(with_mean_severity(w.features), ["null_model"])
    log.log_report(report, {"null_model": "Constant"})
    log.log(
        "null_model",
        "Constant",
        params={
            "epochs": schema.EPOCHS,
            "batch_size": schema.BATCH_SIZE,
            "validation_split": schema.VALIDATION_SPLIT,
        },
    )
    return log.runs()


@query
def repeated_runs(w: Workspace) -> DataFrame:
    """The same two models logged twice in each of two experiments, and compared there."""
    folder = stage_path(w.spark, "repeated-runs")
    models = ["null_model", "ffn_fixed"]
    report = loss_report(score(with_mean_severity(w.features), _fixed_nets(w)[:1]), models)
    compared = None
    for experiment in ("first", "second"):
        log = RunLog(w.spark, folder, experiment)
        for _ in range(2):
            log.log_report(report, ids={m: log.start_run(m) for m in models})
        runs = compare_runs(log.runs())
        compared = runs if compared is None else compared.union(runs)
    return compared.drop("run_id").withColumn("place", F.col("place").cast("bigint"))


# points of the history below: sizes from half to one and a half times the mean
CURVE_POINTS = 100


def constant_history(w: Workspace) -> DataFrame:
    """Loss history of the constant model moved through a range of sizes.

    The gamma deviance of a constant needs only the mean and the mean log of the claims,
    so 100 "epochs" for training and validation rows take one aggregation.
    """
    rows = with_validation(learn_rows(w.features))
    held = F.col("is_validation")
    one = rows.agg(
        F.avg(F.when(~held, F.col("Claim"))).alias("ty"),
        F.avg(F.when(~held, F.log("Claim"))).alias("tl"),
        F.avg(F.when(held, F.col("Claim"))).alias("vy"),
        F.avg(F.when(held, F.log("Claim"))).alias("vl"),
    )
    mu = F.col("ty") * (0.5 + F.col("epoch") / CURVE_POINTS)

    def loss(mean: str, log_mean: str) -> Column:
        return 2 * (F.col(mean) / F.col("mu") - 1 + F.log("mu") - F.col(log_mean))

    return (
        one.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(CURVE_POINTS))))
        .withColumn("mu", mu)
        .select(
            "epoch", loss("ty", "tl").alias("train_loss"), loss("vy", "vl").alias("val_loss")
        )
    )


@query
def loss_curve_long(w: Workspace) -> DataFrame:
    return loss_curve(constant_history(w)).withColumn("loss", r("loss", 6))


@query
def best_epoch_query(w: Workspace) -> DataFrame:
    return best_epoch(constant_history(w)).withColumn("val_loss", r("val_loss", 6))


def _glm_report(w: Workspace, powers: dict[str, float]) -> DataFrame:
    # one marital level is the baseline, so the intercept is identified
    inputs = [f for f in schema.MODEL_FEATURES if f != "Marital1"]
    learn = learn_rows(w.features).select("Claim", *inputs).persist()
    try:
        models = {n: fit_glm(learn, inputs, p) for n, p in powers.items()}
    finally:
        learn.unpersist()
    scored = w.features
    for name, model in models.items():
        scored = predict_glm(scored, model, inputs, name)
    return loss_report(scored, list(models))


@query
def glm_gamma(w: Workspace) -> DataFrame:
    """Gamma GLM on all features: its seven metrics."""
    return _glm_report(w, {"glm_p2": 2.0})


@query
def glm_tweedie(w: Workspace) -> DataFrame:
    """GLMs with variance power 2.5 and 3: their metrics."""
    return _glm_report(w, {"glm_pp": schema.POWER, "glm_p3": 3.0})


@query
def glm_score(w: Workspace) -> DataFrame:
    """First-order condition of the fitted GLMs: the mean of (y - mu) mu^(1-p) x is zero.

    Per feature, as a share of the mean of its size; ``intercept`` is x = 1.
    """
    inputs = [f for f in schema.MODEL_FEATURES if f != "Marital1"]
    learn = learn_rows(w.features).select("Claim", *inputs).persist()
    try:
        models = {n: (fit_glm(learn, inputs, p), p) for n, p in GLM_POWERS.items()}
    finally:
        learn.unpersist()
    scored = learn
    sums, table = [], []
    for name, (model, p) in models.items():
        scored = predict_glm(scored, model, inputs, name)
        for k, x in enumerate(["1", *inputs]):
            pull = f"(Claim - {name}) * pow({name}, {1 - p}) * {x}"
            sums += [f"sum({pull}) AS s_{name}_{k}", f"sum(abs({pull})) AS a_{name}_{k}"]
            shown = "intercept" if x == "1" else x
            table.append({"model": f"'{name}'", "feature": f"'{shown}'", "score": f"round(try_divide(s_{name}_{k}, a_{name}_{k}), 4) + 0D"})
    return scored.selectExpr(*sums).selectExpr(inline_rows(table))


GLM_POWERS = {"glm_p2": 2.0, "glm_pp": schema.POWER, "glm_p3": 3.0}


def _net_report(w: Workspace, kind: str) -> DataFrame:
    specs = [
        NetSpec(f"{kind}_{label}", kind, power)
        for label, power in (("p2", 2.0), ("pp", schema.POWER), ("p3", 3.0))
    ]
    models = fit_nets(learn_rows(w.features), specs, w.mean_claim)
    report = loss_report(score(w.features, models), [s.name for s in specs])
    epochs = best_epoch(history_table(w.spark, models), ["model"]).select(
        "model", F.lit("best_epoch").alias("key"), F.col("epoch").cast("double").alias("value")
    )
    return report.unionByName(epochs)


@query
def ffn_fit(w: Workspace) -> DataFrame:
    """Three feed-forward networks fitted in the same passes: metrics and best epochs."""
    return _net_report(w, "ffn")


@query
def localglm_fit(w: Workspace) -> DataFrame:
    """Three locally linear networks fitted in the same passes: metrics and best epochs."""
    return _net_report(w, "localglm")


@query
def seven_models(w: Workspace) -> DataFrame:
    """The whole modelling run: seven models fitted, logged and compared."""
    folder = stage_path(w.spark, "seven-models")
    return fit_severity_models(silver_claims(w), folder).comparison


@query
def hash_values(w: Workspace) -> DataFrame:
    """The hash behind all random choices."""
    return w.silver.select("Id", hash32(schema.SEED, "Id").alias("hash"))


for _name in ("split_sizes", "split_means", "week_counts", "reporting_scatter", "best_epoch"):
    _QUERIES[_name] = _QUERIES.pop(f"{_name}_query")
