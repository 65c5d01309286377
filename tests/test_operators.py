from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlens import schema
from claimlens.operators.cleaning import filter_claims
from claimlens.operators.correlation import mid_ranks, pearson, spearman, with_ranks
from claimlens.operators.delay import with_weeks
from claimlens.operators.density import kernel_density, reference_bandwidth
from claimlens.operators.encoding import category_levels, level_code, one_hot
from claimlens.operators.features import FeatureSpec, apply_features, fit_features
from claimlens.operators.ordering import _sorted_stage, dense_ids, value_ladder
from claimlens.operators.ranking import sorted_ranks, wide_ranks
from claimlens.operators.profile import distinct_counts, marginal_profile, uniform_reference
from claimlens.operators.quantiles import (
    approximate_quantiles,
    exact_quantiles,
    order_statistic,
)
from claimlens.operators.scaling import fit_scaling, minmax, standardize
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
from claimlens.operators.split import learn_rows, with_split, with_validation
from claimlens.operators.summary import numeric_summary
from claimlens.plans.workspace import workspace
from claimlens.operators.survival import bandwidths, ecdf, ecdf_by_id, local_quadratic, log_survival


@pytest.fixture(scope="module")
def hot(spark):
    """5,000 rows; one value of ``x`` holds a third of them, ``z`` is heavy-tailed."""
    rng = np.random.default_rng(3)
    x = np.where(rng.random(5000) < 1 / 3, 7.0, np.round(rng.normal(0, 50, 5000), 1))
    z = np.exp(rng.normal(0, 6, 5000))
    g = np.where(rng.random(5000) < 0.8, "a", "b")
    rows = [(i, float(x[i]), float(z[i]), str(g[i])) for i in range(5000)]
    return spark.createDataFrame(rows, "k long, x double, z double, g string").repartition(6)


# --- scaling -----------------------------------------------------------------------


def test_standardize_against_numpy(spark):
    x = np.array([1.0, 2.0, 4.0, 9.0])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)] + [(9, None)], "k int, x double")

    def got(**how):
        out = standardize(df, ["x"], **how).orderBy("k").select("xNN").collect()
        assert out[-1][0] is None
        return np.array([r[0] for r in out[:-1]])

    n1 = len(x) - 1
    centered = x - x.mean()
    np.testing.assert_allclose(got(), centered / np.sqrt((centered**2).sum() / n1))
    np.testing.assert_allclose(got(center=False), x / np.sqrt((x**2).sum() / n1))
    np.testing.assert_allclose(got(scale=False), centered)
    np.testing.assert_allclose(got(center=False, scale=False), x)
    np.testing.assert_allclose(got(center=[2.0]), (x - 2) / np.sqrt(((x - 2) ** 2).sum() / n1))
    np.testing.assert_allclose(got(scale=[4.0]), centered / 4)
    np.testing.assert_allclose(got(center=[2.0], scale=[4.0]), (x - 2) / 4)


def test_scaling_edge_frames(spark):
    constant = spark.createDataFrame([(5.0,)] * 3, "x double")
    single = spark.createDataFrame([(5.0,)], "x double")
    for df in (constant, single):
        assert all(r[0] is None for r in standardize(df, ["x"]).select("xNN").collect())
        assert all(r[0] is None for r in minmax(df, ["x"]).select("xMM").collect())
    # one row, not centered: 5 / sqrt(25 / max(1, 0)) = 1
    assert standardize(single, ["x"], center=False).first()["xNN"] == 1.0
    assert fit_scaling(single, ["x"]) == ([5.0], [0.0])


def test_scaling_checks_lengths(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    with pytest.raises(ValueError):
        standardize(df, ["x", "y"], center=[1.0])
    with pytest.raises(ValueError):
        standardize(df, ["x", "y"], scale=[1.0])


def test_standardized_features_have_mean_zero_and_unit_sd(lab):
    names = [f for f in schema.MODEL_FEATURES if f.endswith("NN")] + ["RandNN", "RandUN"]
    row = lab.features.agg(
        *[F.avg(n).alias(n) for n in names], *[F.stddev(n).alias(f"{n}_sd") for n in names]
    ).first()
    for n in names:
        assert row[n] == pytest.approx(0, abs=1e-9) and row[f"{n}_sd"] == pytest.approx(1)


# --- encoding ----------------------------------------------------------------------


def test_lost_level_does_not_shift_codes(spark):
    df = spark.createDataFrame(
        [("A", 1), ("B", 0), ("C", 1), (None, 1)], "c string, keep int"
    ).filter("keep = 1")
    levels = category_levels(df, ["c"])
    assert levels == {"c": ["A", "C"]}
    out = one_hot(df.withColumn("code", level_code("c", levels["c"])), "c", "m", levels["c"])
    assert {tuple(r) for r in out.select("c", "code", "m1", "m2").collect()} == {
        ("A", 1, 1, 0),
        ("C", 2, 0, 1),
        (None, None, None, None),
    }


def test_too_many_levels_is_an_error(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError):
        category_levels(df, ["c"], max_levels=10)


def test_feature_spec_round_trip_and_learn_only_fit(lab):
    spec = FeatureSpec.from_json(lab.spec.to_json())
    assert spec == lab.spec
    again = apply_features(lab.silver, spec).select("Id", "AgeNN", "Marital1").orderBy("Id")
    assert again.collect() == lab.features.select("Id", "AgeNN", "Marital1").orderBy("Id").collect()
    learn_only = fit_features(learn_rows(with_split(lab.silver)))
    assert learn_only.centers["AgeNN"] != lab.spec.centers["AgeNN"]


# --- order, ids, split -------------------------------------------------------------


def test_dense_ids_do_not_depend_on_partitions(spark, hot):
    def ids(df):
        out = dense_ids(df, [F.desc("x"), F.asc("k")], "Id", "test-ids")
        return {r["k"]: r["Id"] for r in out.collect()}

    first, second = ids(hot), ids(hot.repartition(3, "g"))
    assert first == second
    rows = sorted(hot.collect(), key=lambda r: (-r["x"], r["k"]))
    assert first == {r["k"]: i + 1 for i, r in enumerate(rows)}


def test_equal_claims_spread_over_sort_partitions(spark):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        df = spark.range(0, 8000, 1, 4).select(F.lit(5.0).alias("Claim"), F.col("id").alias("k"))
        parts = _sorted_stage(df, [F.desc("Claim"), F.asc("k")], "hot-claim")
        sizes = [r["count"] for r in parts.groupBy("_part").count().collect()]
    finally:
        spark.conf.set(setting, before)
    assert len(sizes) == 8 and max(sizes) < 8000 / 4


@pytest.mark.parametrize("few_values", [0, 10**6])
def test_value_ladder(hot, few_values):
    rows = value_ladder(hot, ["x", "z"], few_values=few_values).collect()
    for feature in ("x", "z"):
        values = np.sort([r[feature] for r in hot.collect()])
        for r in rows:
            if r["feature"] == feature:
                assert r["cum"] == np.searchsorted(values, r["value"], side="right")
    assert sum(r["cnt"] for r in rows) == 10_000


@pytest.mark.parametrize("n", [5, 6, 7, 8, 9, 10])
def test_split_takes_one_row_per_full_block(spark, n):
    rows = with_split(spark.range(1, n + 1).withColumnRenamed("id", "Id")).collect()
    assert len(rows) == n
    for block in range(n // 5):
        picked = [r for r in rows if (r["Id"] - 1) // 5 == block and r["split"] == "test"]
        assert len(picked) == 1
    tail = [r for r in rows if (r["Id"] - 1) // 5 == n // 5 and r["split"] == "test"]
    assert len(tail) <= 1


def test_split_does_not_depend_on_partitions(lab):
    def pick(df):
        return {r["Id"] for r in with_split(df).filter("split = 'test'").select("Id").collect()}

    silver = lab.silver.select("Id")
    assert pick(silver) == pick(silver.repartition(5, "Id"))


@pytest.mark.parametrize("n, few_rows", [(1, 10), (4, 10), (5, 1), (7, 10), (1000, 1), (9000, 2)])
def test_validation_tail(spark, n, few_rows):
    df = with_split(spark.range(1, n + 1).withColumnRenamed("id", "Id"))
    rows = sorted(with_validation(df, few_rows=few_rows).collect(), key=lambda r: (r["shuffle_key"], r["Id"]))
    kept = n * 4 // 5
    assert [r["is_validation"] for r in rows] == [False] * kept + [True] * (n - kept)


def test_validation_tail_with_equal_keys(spark):
    df = spark.range(1, 101).select(F.col("id").alias("Id"), F.lit(5).cast("bigint").alias("shuffle_key"))
    for few_rows in (10, 1000):
        flagged = with_validation(df, few_rows=few_rows).filter("is_validation")
        assert {r["Id"] for r in flagged.collect()} == set(range(81, 101))


# --- quantiles and summaries -------------------------------------------------------

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]


@pytest.mark.parametrize("few_rows, bins", [(1, 512), (50, 16), (100_000, 16)])
def test_quantiles_by_narrowing(hot, few_rows, bins):
    rows = hot.collect()
    for value in ("x", "z"):
        got = exact_quantiles(hot, value, PROBS, ["g"], small_group=10, few_rows=few_rows, bins=bins)
        for r in got.collect():
            want = np.quantile([q[value] for q in rows if q["g"] == r["g"]], r["prob"])
            assert r["quantile"] == pytest.approx(want, rel=1e-12)
        got = exact_quantiles(hot, value, PROBS, small_group=10, few_rows=few_rows, bins=bins)
        for r in got.collect():
            assert r["quantile"] == pytest.approx(np.quantile([q[value] for q in rows], r["prob"]))


def test_quantiles_of_ten(spark):
    df = spark.range(1, 11).select(F.col("id").cast("int").alias("x"))
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    for small in (100, 1):
        got = exact_quantiles(df, "x", probs, small_group=small).orderBy("prob").collect()
        assert [r["quantile"] for r in got] == pytest.approx([1.9, 3.25, 5.5, 7.75, 9.1])
    assert approximate_quantiles(df, "x", [0.5]).first()["quantile"] == 5


def test_quantiles_of_empty_and_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", None), (None, 4.0)], "g string, x double")
    for small in (100, 0):
        got = {r["g"]: r["quantile"] for r in exact_quantiles(df, "x", [0.5], ["g"], small_group=small).collect()}
        assert got == {"a": 1.0, "b": None, None: 4.0}


def test_order_statistic(hot):
    xs = np.sort([r["x"] for r in hot.collect()])
    for rank in (0, 1, 2500, 4999):
        value, below = order_statistic(hot, "x", rank, few_rows=10, bins=8)
        assert value == xs[rank] and below <= rank
        assert below == np.searchsorted(xs, value)
    with pytest.raises(IndexError):
        order_statistic(hot, "x", 5000)


def test_numeric_summary_both_ways(hot):
    def sorted_rows(df):
        return [tuple(r) for r in df.orderBy("feature").collect()]

    near = sorted_rows(numeric_summary(hot, ["x", "z"]))
    far = sorted_rows(numeric_summary(hot, ["x", "z"], small_group=10))
    for a, b in zip(near, far):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:])
    x = [r["x"] for r in hot.collect()]
    assert near[0][4] == pytest.approx(np.quantile(x, 0.25))


def test_sketches_merge_and_replace(spark, tmp_path):
    """Hot, missing and special values; a part loaded twice counts once; an empty load changes nothing."""
    path = str(tmp_path / "sketches")
    value = "CASE WHEN id % 3 = 0 THEN 7D WHEN id % 50 = 1 THEN double('NaN') WHEN id % 50 = 2 THEN NULL ELSE rand(5) * 1000 END"
    made = spark.range(60_000).selectExpr(
        "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 11 = 1 THEN '' ELSE concat('p/', id % 4) END AS part",
        f"{value} AS `a b`", "CAST(NULL AS DOUBLE) AS none", "if(id % 2 = 0, 0D, -0D) AS zero",
    )
    made.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    cols = ["a b", "none", "zero"]
    for rows in (df, df.filter("part = 'p/1'"), df.filter("part = 'no'")):
        write_sketches(sketch_columns(rows, cols, "part"), path)
    kept = read_sketches(spark, path)
    assert {r["part"] for r in kept.collect()} == {"p/0", "p/1", "p/2", "p/3", "null"}
    merged = merge_sketches(kept)
    asked = sketched_quantiles(merged, [0.0, 0.01, 0.5, 0.9, 1.0])
    errors = rank_errors(df, asked, cols).collect()
    assert len(errors) == 10 and all(r["rank_error"] <= RANK_ERROR for r in errors)
    assert {r["n"] for r in errors} == {df.filter("`a b` IS NOT NULL AND NOT isnan(`a b`)").count(), 60_000}
    distinct = {r["feature"]: r["n_distinct"] for r in sketched_distinct(merged).collect()}
    exact = df.select("a b").filter("`a b` IS NOT NULL").distinct().count()
    assert abs(distinct["a b"] / exact - 1) <= 4 * DISTINCT_ERROR and distinct["zero"] == 1
    one = merge_sketches(kept.filter("part = 'p/1'"), ["part"])
    assert {r["n"] for r in sketched_distinct(one, ["part"]).filter("feature = 'zero'").collect()} == {
        df.filter("part = 'p/1'").count()
    }


# --- profiles ----------------------------------------------------------------------


def test_profile_volumes_add_up(lab):
    n = lab.silver.count()
    rows = marginal_profile(lab.features, schema.PROFILE_FEATURES)
    totals = rows.groupBy("feature").agg(F.sum("vol").alias("n")).collect()
    assert len(totals) == 14 and all(r["n"] == n for r in totals)


def test_null_is_a_group_but_not_a_level(spark):
    df = spark.createDataFrame([("A", 1.0), (None, 2.0), (None, 4.0)], "c string, Claim double")
    profiled = marginal_profile(df, ["c"])
    assert {(r["level"], r["vol"], r["avg"]) for r in profiled.collect()} == {("A", 1, 1.0), (None, 2, 3.0)}
    assert uniform_reference(profiled).first()["global_n"] == 3.0
    assert distinct_counts(df, ["c"]).first()["n_distinct"] == 1


def test_week_delay_is_a_difference_of_floors(spark):
    df = spark.createDataFrame([(0, 0), (6, 7), (0, 6), (3, 13)], "AccDay int, RepDay int")
    got = {(r["AccDay"], r["RepDay"]): r["RepDelay_week"] for r in with_weeks(df).collect()}
    assert got == {(0, 0): 0, (6, 7): 1, (0, 6): 0, (3, 13): 1}


def test_filter_drops_nulls(spark):
    df = spark.createDataFrame(
        [(1988, 1.0), (1987, 1.0), (None, 1.0), (1990, 0.0), (1990, None)],
        "AccYear int, HoursWorkedPerWeek double",
    )
    assert [tuple(r) for r in filter_claims(df).collect()] == [(1988, 1.0)]


# --- correlation -------------------------------------------------------------------


def test_spearman_with_ties(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 4.0), (3, 2.0, 7.0), (4, 9.0, 1.0)], "Id int, x double, y double")
    got = {(r["a"], r["b"]): r["r"] for r in spearman(df, ["x", "y"], digits=None).collect()}
    assert got["x", "y"] == pytest.approx(-0.6324555320336759)
    assert got["y", "x"] == got["x", "y"] and got["x", "x"] == 1.0


def test_ranks_by_broadcast_and_by_shuffle(hot):
    table = hot.withColumn("x", F.when(F.col("k") % 50 > 0, F.col("x")))
    ranks = mid_ranks(table, ["x", "z"])

    def collect(limit):
        sizes = {c: (table.select(c).distinct().count(), 4900) for c in ("x", "z")}
        out = with_ranks(table.select("k", "x", "z"), ["x", "z"], ranks, "k", sizes, limit)
        return {r["k"]: (r["x"], r["z"]) for r in out.collect()}

    near, far = collect(10**6), collect(0)
    assert near == far and len(near) == 5000
    rows = sorted((r for r in table.collect() if r["x"] is not None), key=lambda r: r["x"])
    xs = np.array([r["x"] for r in rows])
    for r in rows:
        low, high = np.searchsorted(xs, r["x"]), np.searchsorted(xs, r["x"], side="right")
        assert near[r["k"]][0] == (low + 1 + high) / 2
    assert sum(v[0] is None for v in near.values()) == 100


def test_spearman_ignores_monotone_transforms(hot):
    changed = hot.withColumn("w", F.log("z"))
    got = {(r["a"], r["b"]): r["r"] for r in spearman(changed, ["x", "z", "w"], digits=None).collect()}
    data = [(r["x"], r["z"]) for r in hot.collect()]
    ranks = np.array([[(np.searchsorted(s, v) + np.searchsorted(s, v, "right") + 1) / 2 for v in column]
                      for column in zip(*data) for s in [np.sort(column)]])
    assert got["x", "z"] == pytest.approx(np.corrcoef(ranks)[0, 1])
    assert got["x", "z"] == pytest.approx(got["x", "w"]) and got["z", "w"] == pytest.approx(1)


@pytest.mark.parametrize("rows_per_range", [40, 10**6])
def test_ranks_by_one_sort(spark, rows_per_range):
    """Nulls, NaN, infinities, both zeros, repeated rows, and a value over most of the ranges."""
    rng = np.random.default_rng(5)
    x = np.where(rng.random(1500) < 1 / 3, 7.0, np.round(rng.normal(0, 20, 1500)))
    x[:40], x[40:60], x[60:70], x[70:80] = np.nan, np.inf, -np.inf, -0.0
    y = rng.normal(size=1500)
    data = [(float(a), None if i % 4 == 0 else float(b), None, 3) for i, (a, b) in enumerate(zip(x, y))] * 2
    df = spark.createDataFrame(data, "`a b` double, y double, empty double, same int").repartition(5)
    cols = df.columns
    ranks = sorted_ranks(df, cols, rows_per_range=rows_per_range)
    got = Counter((r["_c"], r["mid_rank"], r["total"]) for r in ranks.collect())
    want = Counter()
    for i, column in enumerate(zip(*data)):
        values = np.sort(np.array([v for v in column if v is not None], dtype=float))
        low = np.searchsorted(values, values)
        high = np.searchsorted(values, values, side="right")
        want.update((i, (a + 1 + b) / 2, len(values)) for a, b in zip(low, high))
    assert got == want
    wide = wide_ranks(ranks, cols)
    assert wide.columns == cols and wide.count() == len(data)
    by_value = {i: {} for i in (0, 1)}
    for i, column in ((0, [r[0] for r in data]), (1, [r[1] for r in data])):
        values = np.sort(np.array([v for v in column if v is not None], dtype=float))
        for v in values:
            by_value[i][str(v + 0.0)] = (np.searchsorted(values, v) + 1 + np.searchsorted(values, v, "right")) / 2
    pairs = Counter(
        (by_value[0][str(a + 0.0)], None if b is None else by_value[1][str(b)], None, (len(data) + 1) / 2)
        for a, b, _, _ in data
    )
    assert Counter(map(tuple, wide.collect())) == pairs
    assert sorted_ranks(df.filter("same = 4"), cols).count() == 0
    nothing = {tuple(r) for r in spearman(df.filter("same = 4"), ["y", "same"]).collect()}
    assert len(nothing) == 4 and all(r[2] is None for r in nothing)


def test_pearson_with_nulls_and_constants(spark, hot):
    holes = hot.withColumn("z", F.when(F.col("k") % 7 > 0, F.col("z"))).withColumn("c", F.lit(3.0))
    got = {(r["a"], r["b"]): r["r"] for r in pearson(holes, ["x", "z", "c"], None).collect()}
    rows = [(r["x"], r["z"]) for r in holes.collect() if r["z"] is not None]
    assert got["x", "z"] == pytest.approx(np.corrcoef(np.array(rows).T)[0, 1])
    assert got["x", "c"] is None and got["c", "c"] is None and got["x", "x"] == 1.0
    whole = {(r["a"], r["b"]): r["r"] for r in pearson(hot, ["x", "z"], None).collect()}
    data = np.array([(r["x"], r["z"]) for r in hot.collect()])
    assert whole["x", "z"] == pytest.approx(np.corrcoef(data.T)[0, 1])


# --- distribution ------------------------------------------------------------------


def test_density_against_direct_sum(hot):
    xs = np.array([r["x"] for r in hot.collect()])
    got = kernel_density(hot, "x", grid=64, bandwidth=8.0).orderBy("i").collect()
    grid = np.linspace(xs.min(), xs.max(), 64)
    # what linear binning means: each value split over its two neighbouring grid points
    step = grid[1] - grid[0]
    place = (xs - grid[0]) / step
    left = np.minimum(np.floor(place), 62).astype(int)
    w = np.bincount(left, 1 - (place - left), 64) + np.bincount(left + 1, place - left, 64)
    u = (grid[:, None] - grid[None, :]) / 8.0
    want = (np.exp(-0.5 * u * u) * w).sum(1) / (len(xs) * 8.0 * np.sqrt(2 * np.pi))
    np.testing.assert_allclose([r["density"] for r in got], want)


def test_density_integrates_to_about_one(spark):
    silver = workspace(spark, "/root/testdata/sf0.01").silver
    logs = silver.select(F.log("Claim").alias("v"))
    row = kernel_density(logs, "v").agg(F.sum("density"), F.min("x"), F.max("x")).first()
    assert 0.95 < row[0] * (row[2] - row[1]) / 511 < 1.0


def test_bandwidth_fallbacks():
    assert reference_bandwidth(32, 2.0, 1.34, 5.0) == pytest.approx(0.45)
    assert reference_bandwidth(32, 2.0, 0.0, 5.0) == pytest.approx(0.9)
    assert reference_bandwidth(32, 0.0, 0.0, -5.0) == pytest.approx(2.25)
    assert reference_bandwidth(32, 0.0, 0.0, 0.0) == pytest.approx(0.45)


def test_density_needs_two_values(spark):
    with pytest.raises(ValueError):
        kernel_density(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x")


def test_ecdf_with_ties(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (3.0,)], "x double")
    assert [(r["x"], r["cnt"], r["ecdf"]) for r in ecdf(df, "x").orderBy("x").collect()] == [
        (1.0, 2, 0.5),
        (2.0, 1, 0.75),
        (3.0, 1, 1.0),
    ]


def test_ecdf_from_ids_is_the_same(lab):
    a = ecdf(lab.silver, "Claim").orderBy("x").collect()
    b = ecdf_by_id(lab.silver).orderBy("x").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
    assert b[-1]["ecdf"] == 1.0


def test_local_regression_direct_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = np.sort(rng.uniform(0, 10, 300))
    y = np.sin(x) + rng.normal(0, 0.1, 300)
    df = spark.createDataFrame([(float(a), float(b), 1) for a, b in zip(x, y)], "x double, y double, n int")
    got = local_quadratic(df, "x", "y", "n", alpha=0.2, grid=21, bins=None).orderBy("i").collect()
    for r in got:
        d = np.abs(x - r["x"])
        h = np.sort(d)[59]
        k = np.where(d < h, (1 - (d / h) ** 3) ** 3, 0)
        want = np.polyfit(x - r["x"], y, 2, w=np.sqrt(k))[-1]
        assert r["fit"] == pytest.approx(want, rel=1e-6, abs=1e-9)


@pytest.mark.parametrize("cells", [1, 7, 8192])
def test_bandwidths_are_exact(spark, cells):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.uniform(0, 10, 400), np.full(200, 3.0), rng.normal(3, 1e-9, 200), [1e6]])
    w = rng.integers(1, 5, len(x))
    frame = spark.createDataFrame([(float(a), 0.0, int(b)) for a, b in zip(x, w)], "x double, y double, w bigint")
    at = [0.0, 2.9, 3.0, 7.5, 12.0, 1e6]
    for needed in (1, 333, int(w.sum())):
        got = bandwidths(frame, at, needed, cells)
        for x0, h in zip(at, got, strict=True):
            d = np.abs(x - x0)
            order = np.argsort(d)
            assert h == d[order][np.searchsorted(np.cumsum(w[order]), needed)]
    assert bandwidths(frame, at, int(w.sum()) + 1, cells) == [None] * len(at)


def test_exact_smoothing_has_no_limit_and_joins_nothing(spark):
    df = spark.range(300_000).selectExpr("id / 300000 AS x", "id * id / 9e10 AS y", "1L AS n")
    fit = local_quadratic(df, "x", "y", "n", grid=11, bins=None)
    plan = fit._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    assert all(r["fit"] == pytest.approx(r["x"] ** 2, abs=1e-9) for r in fit.collect())


def test_exact_smoothing_of_one_place_has_no_fit(spark):
    assert local_quadratic(spark.createDataFrame([(1.0, 2.0, 3)], "x double, y double, n int"), "x", "y", "n", bins=None).collect() == []


def test_local_regression_binned_is_close_to_direct(lab):
    points = log_survival(ecdf_by_id(lab.silver))
    args = (points, "log_x", "log_survival", "cnt")
    direct = {r["i"]: r["fit"] for r in local_quadratic(*args, bins=None).collect()}
    binned = {r["i"]: r["fit"] for r in local_quadratic(*args).collect()}
    assert len(binned) == 101
    assert max(abs(direct[i] - binned[i]) for i in range(98)) < 1e-3


# --- values beyond the finite numbers -----------------------------------------------


@pytest.mark.parametrize("small", [10**6, 1])
@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, float("nan"), 4.0, None, 3.0],
        [float("-inf"), 5.0, 1.0, float("inf"), 2.0, float("nan"), float("nan")],
        [-1.7e308, 1.7e308, 0.0, 1.0, 2.0, -3.0],
        [float("nan")] * 3,
        [float("inf"), float("inf"), float("-inf")],
    ],
    ids=["nan", "all", "wide", "only nan", "only infinite"],
)
def test_quantiles_of_any_double(spark, values, small):
    n = sum(v is not None for v in values)
    probs = [k / (n - 1) for k in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantiles(df, "x", probs, small_group=small, few_rows=1, bins=4).orderBy("prob").collect()
    want = sorted((v for v in values if v is not None), key=lambda v: (v != v, v if v == v else 0.0))
    for g, w in zip(got, want, strict=True):
        assert g["quantile"] == w or (w != w and g["quantile"] != g["quantile"]) or abs(g["quantile"] - w) < 1e-12 * abs(w)


def test_quantiles_of_very_many_groups(spark):
    df = spark.range(30_000).selectExpr("id AS g", "CAST(id AS DOUBLE) AS x").union(
        spark.range(50).selectExpr("7 AS g", "CAST(id AS DOUBLE) AS x")
    )
    got = exact_quantiles(df, "x", [0.5], ["g"], small_group=20, few_rows=5)
    assert got.count() == 30_000
    assert got.filter("g = 7").first()["quantile"] == 24.0
    assert got.filter("g = 29999").first()["quantile"] == 29999.0


def test_ecdf_with_missing_claims(spark):
    rows = [(1, 30.0), (2, 20.0), (3, 20.0), (4, 10.0), (5, None), (6, None)]
    df = spark.createDataFrame(rows, "Id bigint, Claim double")
    by_id = [tuple(r) for r in ecdf_by_id(df).orderBy("x").collect()]
    assert by_id == [(10.0, 1, 0.25), (20.0, 2, 0.75), (30.0, 1, 1.0)]
    assert by_id == [tuple(r) for r in ecdf(df, "Claim").orderBy("x").collect()]


def test_an_unseen_level_has_no_code(spark):
    df = spark.createDataFrame([("A",), ("Z",), (None,)], "c string")
    assert [r[0] for r in df.select(level_code("c", ["A", "B"])).collect()] == [1, None, None]


def test_level_tables_of_any_size(spark):
    from claimlens.operators.encoding import code_by_table, level_table

    rows = spark.range(200_000).select(
        "id",
        F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("v"), F.col("id").cast("string"))).alias("big"),
        (F.col("id") % 5).cast("int").alias("small"),
    )
    table = level_table(rows, ["big", "small"])
    want = {v: i + 1 for i, v in enumerate(sorted({r["big"] for r in rows.select("big").distinct().collect()} - {None}))}
    for how in ({}, {"broadcast_levels": 0}):
        coded = code_by_table(rows, table, ["big", "small"], **how)
        assert coded.columns == ["id", "big", "small", "bigCode", "smallCode"]
        got = coded.collect()
        assert len(got) == 200_000
        assert all(r["bigCode"] == want.get(r["big"]) and r["smallCode"] == r["small"] + 1 for r in got)
    unseen = spark.createDataFrame([("zz", 9), ("hot", 1)], "big string, small int")
    assert sorted(tuple(r) for r in code_by_table(unseen, table, ["big", "small"], broadcast_levels=0).collect()) == [
        ("hot", 1, want["hot"], 2),
        ("zz", 9, None, None),
    ]
    empty = level_table(rows.limit(0), ["big"])
    assert empty.count() == 0 and code_by_table(unseen, empty, ["big"]).filter("bigCode IS NOT NULL").count() == 0


def test_large_level_tables_are_not_broadcast_and_hot_levels_spread(spark):
    from claimlens.operators.encoding import code_by_table, level_table

    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("c"), "id")
    coded = code_by_table(rows, level_table(rows, ["c"]), ["c"], broadcast_levels=0)
    plan = coded._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") + plan.count("BroadcastExchange") <= 4
    parts = coded.filter("c = 'hot'").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    assert max(r["count"] for r in parts) < 20_000
