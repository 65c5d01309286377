"""Column contract of the claims table and the fixed column lists built on it."""

from __future__ import annotations

from pyspark.sql import types as T

CLAIMS_SCHEMA = T.StructType(
    [
        T.StructField("Claim", T.DoubleType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Gender", T.StringType()),
        T.StructField("MaritalStatus", T.StringType()),
        T.StructField("PartTimeFullTime", T.StringType()),
        T.StructField("DependentChildren", T.IntegerType()),
        T.StructField("DependentsOther", T.IntegerType()),
        T.StructField("WeeklyPay", T.DoubleType()),
        T.StructField("HoursWorkedPerWeek", T.DoubleType()),
        T.StructField("DaysWorkedPerWeek", T.IntegerType()),
        T.StructField("AccYear", T.IntegerType()),
        T.StructField("AccMonth", T.IntegerType()),
        T.StructField("AccWeekday", T.IntegerType()),
        T.StructField("AccTime", T.IntegerType()),
        T.StructField("AccDay", T.IntegerType()),
        T.StructField("RepDay", T.IntegerType()),
        T.StructField("RepYear", T.IntegerType()),
        T.StructField("RepDelay", T.IntegerType()),
    ]
)

RUNS_SCHEMA = T.StructType(
    [
        T.StructField("experiment", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

WEIGHTS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("power", T.DoubleType()),
        T.StructField("layer", T.StringType()),
        T.StructField("i", T.IntegerType()),
        T.StructField("j", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# ---------------------------------------------------------------------------
# They must equal the reference's for equal results.
# ---------------------------------------------------------------------------

CATEGORICAL = ["Gender", "MaritalStatus", "PartTimeFullTime"]

# column -> (lower bound, upper bound)
CUT_OFFS = {
    "Age": (16, 70),
    "DependentChildren": (None, 1),
    "DependentsOther": (None, 1),
    "WeeklyPay": (None, 1200),
    "HoursWorkedPerWeek": (None, 60),
    "RepDelay": (None, 100),
}

MODEL_FEATURES = [
    "AgeNN",
    "GenderNN",
    "DependentChildrenNN",
    "DependentsOtherNN",
    "WeeklyPayNN",
    "PartTimeFullTimeNN",
    "HoursWorkedPerWeekNN",
    "DaysWorkedPerWeekNN",
    "AccYearNN",
    "AccMonthNN",
    "AccWeekdayNN",
    "AccTimeNN",
    "RepDelayNN",
    "Marital1",
    "Marital2",
    "Marital3",
]

PROFILE_FEATURES = [
    "Age",
    "Gender",
    "MaritalStatus",
    "DependentChildren",
    "DependentsOther",
    "WeeklyPay",
    "PartTimeFullTime",
    "HoursWorkedPerWeek",
    "DaysWorkedPerWeek",
    "AccYear",
    "AccMonth",
    "AccWeekday",
    "AccTime",
    "RepDelay",
]

CORRELATION_COLUMNS = [
    "Age",
    "WeeklyPay",
    "HoursWorkedPerWeek",
    "DaysWorkedPerWeek",
    "AccYear",
    "AccMonth",
    "AccWeekday",
    "AccTime",
    "RepDelay",
]

CALIBRATION_FEATURES = ["Age", "Gender", "AccMonth", "AccYear"]

METRICS = ["learn_p2", "learn_pp", "learn_p3", "test_p2", "test_pp", "test_p3", "avg_size"]

SPLIT_PROBS = [0.1, 0.25, 0.5, 0.75, 0.9]
DELAY_PROBS = [0.9, 0.98, 0.99]
DELAY_LINE_PROBS = [0.9, 0.975, 0.99]

SEED = 100
POWER = 2.5
HIDDEN_LAYERS = (20, 15, 10)
EPOCHS = 100
BATCH_SIZE = 5000
VALIDATION_SPLIT = 0.2
