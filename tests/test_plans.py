"""What the physical plans must look like to hold at scale."""

from __future__ import annotations

import contextlib
import io
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from claimlens.operators.cleaning import small_claims
from claimlens.operators.correlation import mid_ranks, with_ranks
from claimlens.operators import ordering
from claimlens.operators.ranking import sorted_ranks, wide_ranks
from claimlens.sources.claims import claims_of
from claimlens.sources.storage import SORTED_BYTES, sorted_in_memory
from claimlens.plans.flagship import severity_by_year

QUERIES = entry.queries()
FITTED = {"seven_models", "ffn_fit", "localglm_fit", "glm_gamma", "glm_tweedie", "glm_saturated_groups", "model_comparison"}


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_cross_join(spark, small_dir, name):
    text = plan(QUERIES[name](spark, small_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_source_filters_reach_the_scans(spark, small_dir):
    text = plan(severity_by_year(spark, small_dir))
    pushed = re.findall(r"PushedFilters: \[(.*)\]", text)
    assert any("GreaterThanOrEqual(l_shipdate" in p for p in pushed)
    assert any("GreaterThanOrEqual(o_orderdate" in p for p in pushed)
    lineitem = next(s for s in re.findall(r"ReadSchema: struct<(.*)>", text) if "l_orderkey" in s)
    assert "l_tax" not in lineitem and "l_discount" not in lineitem


def test_hot_join_key_is_split_and_the_result_is_whole(spark, small_dir, tmp_path):
    """A third of the lines on one order, joined by sort-merge: the hot partition is split."""
    for table in ("orders", "customer", "part"):
        source = spark.read.parquet(f"{small_dir}/{table}.parquet")
        source.write.parquet(str(tmp_path / f"{table}.parquet"))
    lines = spark.read.parquet(f"{small_dir}/lineitem.parquet")
    early = spark.read.parquet(f"{small_dir}/orders.parquet").filter("year(o_orderdate) = 1996")
    hot = early.agg(F.min("o_orderkey")).first()[0]
    third = F.hash("l_partkey", "l_suppkey", "l_extendedprice") % 3 == 0
    lines.withColumn("l_orderkey", F.when(third, F.lit(hot)).otherwise(F.col("l_orderkey"))).repartition(
        8
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    data_dir = str(tmp_path)
    want = sorted(map(tuple, severity_by_year(spark, data_dir).collect()))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = severity_by_year(spark, data_dir)
        got = sorted(map(tuple, df.collect()))
        text = plan(df)
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert got == want
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert "SortMergeJoin(skew=true)" in text


def test_silver_filter_and_columns_reach_the_written_table(lab):
    text = plan(small_claims(lab.silver).select("Claim"))
    assert "LessThanOrEqual(Claim,10000.0)" in text
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert any("Claim" in s and "Age" not in s for s in schemas)


def test_features_are_row_local(lab):
    text = plan(lab.features)
    assert "Exchange hashpartitioning" not in text and "Window" not in text


def test_large_rank_tables_are_not_broadcast(lab):
    df = lab.silver.select("Id", "Claim")
    joined = with_ranks(df, ["Claim"], mid_ranks(df, ["Claim"]), "Id", {"Claim": (10**9, 10**12)}, 0)

    def hints(frame):
        return frame._jdf.queryExecution().analyzed().toString().count("strategy=broadcast")

    # the only broadcast asked for is the bounded table of hot values
    assert hints(joined) - hints(df) - hints(mid_ranks(df, ["Claim"])) * 2 == 1


def test_no_row_at_a_time_python_and_no_local_checkpoints():
    for path in (Path(entry.__file__).parent / "claimlens").rglob("*.py"):
        text = path.read_text()
        assert not re.search(r"F\.udf\(|localCheckpoint|toPandas\(|crossJoin\(|\.rdd\b", text), path


def test_queries_read_whole_tables(spark, small_dir, lab):
    n = lab.silver.count()
    for name in ("silver_claims", "standardized", "ffn_forward_fixed", "delay_weeks"):
        assert QUERIES[name](spark, small_dir).count() == n
    assert lab.features.filter(F.col("split").isNull()).count() == 0


def test_ranks_of_any_number_of_columns_take_one_shuffle_back(lab):
    """Above the sorted table there is one exchange, on the row, and one join with a small table."""
    cols = ["Claim", "Age", "WeeklyPay", "RepDelay"]
    text = plan(wide_ranks(sorted_ranks(lab.features, cols), cols), "simple")
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text and "Window" not in text


def test_ranks_are_shuffled_as_long_rows(lab):
    """No column per rank before the shuffle: hardly two values of a row meet there."""
    cols = ["Claim", "Age"]
    text = plan(wide_ranks(sorted_ranks(lab.features, cols), cols), "simple")
    assert "Aggregate" not in text.partition("Exchange hashpartitioning")[2]


def test_silver_is_joined_and_sorted_as_source_columns(spark, lab):
    """The claims' own columns are made when silver is written, and are those of the view."""
    sources = lab.filtered_sources
    assert not {"AccYear", "RepDelay", "WeeklyPay"} & set(sources.columns)
    made = claims_of(sources).select(*lab.filtered.columns)
    assert made.exceptAll(lab.filtered).count() == lab.filtered.exceptAll(made).count() == 0
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    with sorted_in_memory(spark):
        assert spark.conf.get(key) == str(SORTED_BYTES)
    assert spark.conf.get(key) == before


def test_large_sorts_keep_their_ranges(spark, monkeypatch):
    """Adaptive execution does not merge the ranges of a counted sort by their bytes in the shuffle."""
    monkeypatch.setattr(ordering, "ROWS_PER_RANGE", 150)
    df = spark.range(1000).withColumn("v", F.col("id") * 7 % 1000)
    staged = ordering._sorted_stage(df, [F.col("v")], "ranges")
    assert staged.select("_part").distinct().count() > 4
    numbered = ordering.dense_ids(df, [F.col("v")], "n")
    assert numbered.filter("n = v + 1").count() == 1000
