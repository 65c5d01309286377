"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from claimlens import schema
from compare import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
FITS = ("ffn_fit", "glm_gamma", "glm_tweedie", "localglm_fit")


@pytest.fixture(scope="session")
def con(small_dir):
    return connect(small_dir)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(r["claims"] > 0 for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, con, small_dir, name):
    assert compare(QUERIES[name](spark, small_dir), con, ORACLES[name]) is None


def test_seven_models(spark, small_dir):
    rows = QUERIES["seven_models"](spark, small_dir).collect()
    assert len(rows) == 7 and min(r["place"] for r in rows) == 1
    assert all(r[m] > 0 for r in rows for m in schema.METRICS)


@pytest.mark.parametrize("name", FITS)
def test_model_reports(spark, small_dir, name):
    rows = QUERIES[name](spark, small_dir).collect()
    assert rows and all(r["value"] is not None for r in rows)
    losses = [r["value"] for r in rows if r["key"].startswith(("learn", "test"))]
    assert all(v > 0 for v in losses)
