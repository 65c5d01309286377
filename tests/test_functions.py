from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens.functions.deviance import (
    gamma_deviance,
    inverse_gaussian_deviance,
    power_deviance,
    square_loss,
)
from claimlens.functions.numeric import (
    bin_down,
    bin_up,
    clamp,
    hash32,
    hash_normal,
    hash_uniform,
    positive_log,
)
from claimlens.functions.text import number, quoted
from claimlens.models.report import best_epoch, loss_curve


def values(df, column):
    return [r[0] for r in df.orderBy("k").select(column).collect()]


@pytest.fixture(scope="module")
def clamp_nulls(spark):
    rows = list(enumerate([None, 10.0, 16.0, 43.0, 70.0, 90.0]))
    return spark.createDataFrame(rows, "k int, x double")


def test_clamp_keeps_null(clamp_nulls):
    assert values(clamp_nulls, clamp("x", 16, 70)) == [None, 16, 16, 43, 70, 70]
    assert values(clamp_nulls, clamp("x", hi=43)) == [None, 10, 16, 43, 43, 43]


def test_bins(spark):
    df = spark.createDataFrame(
        list(enumerate([None, 0.0, 0.5, 100.0, 100.1, 1199.0, 5000.0])), "k int, x double"
    )
    assert values(df, bin_up("x", 100, hi=1200)) == [None, 0, 100, 100, 200, 1200, 1200]
    assert values(df, bin_down("x", 10, hi=100)) == [None, 0, 0, 100, 100, 100, 100]


def test_positive_log(spark):
    df = spark.createDataFrame([(0, 0.0), (1, -1.0), (2, 1.0), (3, None)], "k int, x double")
    assert values(df, positive_log("x")) == [None, None, 0.0, None]


def test_hash_agrees_with_duckdb(spark):
    ids = spark.range(1, 1001)
    ours = ids.agg(F.sum(hash32(100, "id"))).first()[0]
    sql = (
        "SELECT sum(CAST('0x' || substr(md5('100:' || CAST(i AS VARCHAR)), 1, 8) AS BIGINT)) "
        "FROM range(1, 1001) t(i)"
    )
    assert ours == duckdb.connect().execute(sql).fetchone()[0]


def test_random_columns_do_not_depend_on_partitions(spark):
    def draw(df):
        return df.select("id", hash_normal(1, "id"), hash_uniform(2, "id")).orderBy("id").collect()

    base = spark.range(500)
    assert draw(base.repartition(1)) == draw(base.repartition(7, "id"))


def test_random_columns_have_the_right_moments(spark):
    row = (
        spark.range(50_000)
        .select(hash_normal(5, "id").alias("z"), hash_uniform(7, "id", lo=-1, hi=1).alias("u"))
        .agg(F.avg("z"), F.stddev("z"), F.avg("u"), F.min("u"), F.max("u"))
        .first()
    )
    assert abs(row[0]) < 0.02 and abs(row[1] - 1) < 0.02 and abs(row[2]) < 0.02
    assert -1 < row[3] < -0.99 and 0.99 < row[4] < 1


def test_text_helpers():
    assert quoted("a`b") == "`a``b`"
    assert number(0.1) == "0.1D" and number(-2) == "(-2.0D)"
    with pytest.raises(ValueError):
        number(float("nan"))


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (1.0, 2.0)], "y double, mu double")


def test_deviances_vanish_only_at_equality(pairs):
    for loss in (
        gamma_deviance("y", "mu"),
        inverse_gaussian_deviance("y", "mu"),
        power_deviance("y", "mu", 2.5),
    ):
        assert pairs.filter("y = mu").agg(loss).first()[0] == pytest.approx(0, abs=1e-12)
        assert pairs.filter("y != mu").agg(loss).first()[0] > 0


def test_power_deviance_meets_its_special_cases(pairs):
    gamma, ig, at3, near2, square = pairs.agg(
        gamma_deviance("y", "mu"),
        inverse_gaussian_deviance("y", "mu"),
        power_deviance("y", "mu", 3),
        power_deviance("y", "mu", 2.0001),
        square_loss("y", "mu"),
    ).first()
    assert at3 == pytest.approx(ig)
    assert near2 == pytest.approx(gamma, abs=1e-4)
    assert gamma == pytest.approx(2 / 3 * (1 + np.log(1 / 2) - 0.5 + np.log(2)))
    assert square == pytest.approx(2 / 3)


def test_deviance_skips_impossible_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 2.0), (None, 2.0)], "y double, mu double")
    alone = df.filter("y = 1").agg(gamma_deviance("y", "mu")).first()[0]
    assert df.agg(gamma_deviance("y", "mu")).first()[0] == alone
    with pytest.raises(ValueError):
        power_deviance("y", "mu", 1)


def test_best_epoch_takes_the_first_on_ties(spark):
    history = spark.createDataFrame(
        [(1, 0.3, 0.2), (2, 0.2, 0.1), (3, 0.1, 0.1)],
        "epoch int, train_loss double, val_loss double",
    )
    assert best_epoch(history).first()["epoch"] == 2
    long = loss_curve(history)
    assert long.count() == 6
    assert {r["variable"] for r in long.collect()} == {"train_loss", "val_loss"}
