from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimlens import schema
from claimlens.models import training
from claimlens.models.baseline import mean_severity, with_mean_severity
from claimlens.models.glm import fit_glm, predict_glm
from claimlens.models.minibatch import best_so_far, fit_minibatch
from claimlens.models.nets import (
    Nadam,
    NetSpec,
    attention,
    deviance,
    loss_and_gradient,
    predict,
    stacked_gradients,
    stacked_losses,
    stacks,
)
from claimlens.models.report import loss_report
from claimlens.models.scoring import score, score_expressions, with_attention
from claimlens.models.tracking import RunLog
from claimlens.models.training import (
    NetModel,
    fit_nets,
    history_table,
    load_model,
    weights_table,
)
from claimlens.operators.split import learn_rows, shuffle_key
from claimlens.plans.registry import fixed_net
from claimlens.sources.checkpoints import Checkpoints

SPECS = [NetSpec(f"{k}_{p}", k, p) for k in ("ffn", "localglm") for p in (2.0, 2.5, 3.0)]


@pytest.fixture(scope="module")
def signal(spark):
    """y = exp(1 + 0.5 a - 0.3 b) times noise between 0.5 and 1.5."""
    rng = np.random.default_rng(11)
    a, b = rng.uniform(-1, 1, (2, 2000))
    y = np.exp(1 + 0.5 * a - 0.3 * b) * rng.uniform(0.5, 1.5, 2000)
    rows = [(i + 1, float(a[i]), float(b[i]), float(y[i])) for i in range(2000)]
    df = spark.createDataFrame(rows, "Id long, a double, b double, Claim double")
    return df.withColumn("shuffle_key", F.hash("Id").cast("bigint"))


def test_parameter_counts():
    assert NetSpec("n", "ffn").size == 826
    assert NetSpec("n", "localglm").size == 993
    with pytest.raises(ValueError):
        NetSpec("n", "tree").size


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
def test_gradient(spec):
    rng = np.random.default_rng(0)
    theta = spec.start(3.0, 1) + rng.normal(0, 0.1, spec.size)
    x, y = rng.normal(size=(7, 16)), rng.uniform(1, 5, 7)
    loss, gradient = loss_and_gradient(spec, theta, x, y)
    assert loss == pytest.approx(deviance(y, predict(spec, theta, x), spec.power).sum())
    for k in rng.choice(spec.size, 40, replace=False):
        step = np.zeros(spec.size)
        step[k] = 1e-6
        up, down = (loss_and_gradient(spec, theta + s, x, y)[0] for s in (step, -step))
        assert gradient[k] == pytest.approx((up - down) / 2e-6, rel=1e-4, abs=1e-6)


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
def test_fitting_starts_at_the_mean(spec):
    x = np.random.default_rng(0).normal(size=(5, 16))
    np.testing.assert_allclose(predict(spec, spec.start(1234.0, 9), x), 1234.0)


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
def test_single_precision_is_close(spec):
    rng = np.random.default_rng(0)
    theta = spec.start(3.0, 1) + rng.normal(0, 0.1, spec.size)
    x, y = rng.normal(size=(50, 16)), rng.uniform(1, 5, 50)
    loss, gradient = loss_and_gradient(spec, theta, x, y)
    near, close = loss_and_gradient(spec, theta, x.astype(np.float32), y)
    assert near == pytest.approx(loss, rel=1e-5)
    np.testing.assert_allclose(close, gradient, rtol=1e-3, atol=1e-3 * np.abs(gradient).max())


def test_nadam_finds_a_minimum():
    state = Nadam(np.array([5.0, -3.0]), np.zeros(2), np.zeros(2), rate=0.05)
    for _ in range(2000):
        state.update(2 * (state.theta - np.array([1.0, 2.0])))
    np.testing.assert_allclose(state.theta, [1, 2], atol=1e-3)


@pytest.mark.parametrize("mode, rate, epochs", [("local", 0.005, 40), ("full", 0.02, 60)])
def test_networks_learn_the_signal(signal, mode, rate, epochs):
    specs = [
        NetSpec("f", "ffn", 2.0, 2, (5,)),
        NetSpec("l", "localglm", 2.0, 2, (5,)),
        NetSpec("l3", "localglm", 3.0, 2, (5,)),
    ]
    mean = mean_severity(signal, digits=None)
    models = fit_nets(
        signal, specs, mean, ["a", "b"], mode=mode, rate=rate, epochs=epochs, batch_size=64, partitions=3
    )
    for m in models:
        assert [e for e, _, _ in m.history] == list(range(1, epochs + 1))
        losses = [v for _, _, v in m.history]
        assert m.best_epoch == 1 + int(np.argmin(losses))
        assert min(losses) < losses[0] * 0.8
    scored = score(signal, models, ["a", "b"])
    ratio = scored.agg(*[F.avg(s.name) / F.avg("Claim") for s in specs]).first()
    assert list(ratio) == pytest.approx([1, 1, 1], abs=0.1)


def test_fit_repeats_exactly_and_ignores_input_partitions(signal, monkeypatch):
    spec = [NetSpec("f", "ffn", 2.0, 2, (4,))]

    def fit(df):
        (m,) = fit_nets(df, spec, 3.0, ["a", "b"], epochs=3, batch_size=100, partitions=4)
        return m.theta

    once = fit(signal)
    np.testing.assert_array_equal(once, fit(signal.repartition(7, "Id")))
    # the grouped sum that replaces the direct one with many partitions
    monkeypatch.setattr(training, "DIRECT_PARTS", 1)
    np.testing.assert_allclose(once, fit(signal), rtol=1e-12)


def test_tasks_follow_from_the_rows(monkeypatch):
    assert [training.parts_for(n) for n in (0, 1, 25_000, 25_001, 10**12)] == [1, 1, 1, 2, 40_000_000]


@pytest.mark.parametrize("cuts", [1, 8, 64])
def test_fitting_does_not_depend_on_input_partitions(signal, monkeypatch, cuts):
    monkeypatch.setattr(training, "ROWS_PER_PART", 600)
    spec = [NetSpec("f", "ffn", 2.0, 2, (4,))]
    fits = [
        fit_nets(df, spec, 3.0, ["a", "b"], epochs=2, batch_size=100)[0].theta
        for df in (signal, signal.repartition(cuts))
    ]
    np.testing.assert_array_equal(*fits)


def test_rows_that_cannot_be_fitted_are_left_out(signal):
    spec = [NetSpec("f", "ffn", 2.0, 2, (4,))]
    bad = [0.0, -1.0, None, float("nan"), float("inf")]
    cases = F.element_at(F.array(*[F.lit(b).cast("double") for b in bad]), (F.col("Id") % 5 + 1).cast("int"))
    spoiled = signal.withColumn("Claim", F.when(F.col("Id") <= 25, cases).otherwise(F.col("Claim")))
    spoiled = spoiled.withColumn("a", F.when(F.col("Id") != 26, F.col("a")))
    (m,) = fit_nets(spoiled, spec, 3.0, ["a", "b"], epochs=3, batch_size=200, partitions=1)
    assert m.left_out == 26 and m.best_epoch > 0
    assert all(np.isfinite([t, v]).all() for _, t, v in m.history)


def test_tasks_of_several_parts_give_the_sums_of_the_parts(signal, monkeypatch):
    """Parts and results stay the same; an epoch shuffles nothing and has no more tasks than can be collected."""
    specs = [NetSpec("f", "ffn", 2.0, 2, (4,)), NetSpec("l", "localglm", 3.0, 2, (4,))]
    sums = []
    real = training._total
    monkeypatch.setattr(training, "_total", lambda parts, n: sums.append((parts.count(), n)) or real(parts, n))

    def fit(mode="local"):
        sums.clear()
        return fit_nets(signal, specs, 3.0, ["a", "b"], epochs=2, batch_size=100, partitions=11, mode=mode)

    for mode in ("local", "full"):
        whole = fit(mode)
        assert set(sums) == {(11, 11)}
        monkeypatch.setattr(training, "DIRECT_PARTS", 3)
        for most, tasks in ((64, 3), (2, 6)):
            monkeypatch.setattr(training, "PARTS_PER_TASK", most)
            for a, b in zip(fit(mode), whole):
                assert np.allclose(a.history, b.history, rtol=1e-9)
                assert a.theta == pytest.approx(b.theta, rel=1e-6, abs=1e-9)
            assert set(sums) == {(tasks, tasks)}
        monkeypatch.setattr(training, "DIRECT_PARTS", 256)


def test_no_epoch_with_a_finite_loss_is_an_error(signal):
    spec = [NetSpec("f", "ffn", 3.0, 2, (4,))]
    broken = [np.full(spec[0].size, np.nan)]
    with pytest.raises(ValueError, match="finite loss"):
        fit_nets(signal, spec, 3.0, ["a", "b"], epochs=2, partitions=1, warm_start=broken)


def test_kept_epoch_has_the_smallest_validation_loss(signal):
    from claimlens.operators.split import with_validation

    spec = NetSpec("f", "ffn", 2.0, 2, (4,))
    (m,) = fit_nets(signal, [spec], 3.0, ["a", "b"], epochs=12, rate=0.2, batch_size=200, partitions=2)
    losses = [v for _, _, v in m.history]
    assert m.best_epoch == 1 + losses.index(min(losses))
    held = with_validation(signal).filter("is_validation")
    kept = held.select("a", "b", "Claim").toPandas().to_numpy(float)
    loss, _ = loss_and_gradient(spec, m.theta, kept[:, :2].astype(np.float32), kept[:, 2])
    assert loss / len(kept) == pytest.approx(min(losses), rel=1e-4)


def test_one_partition_is_plain_minibatch_training(signal):
    spec = NetSpec("f", "ffn", 2.0, 2, (4,))
    (m,) = fit_nets(
        signal, [spec], 3.0, ["a", "b"], epochs=2, batch_size=300, partitions=1, validation_split=0.0, seed=5
    )
    rows = sorted(signal.collect(), key=lambda r: (r["shuffle_key"], r["Id"]))
    x = np.array([(r["a"], r["b"]) for r in rows], dtype=np.float32)
    y = np.array([r["Claim"] for r in rows])
    state = Nadam(spec.start(3.0, 5), np.zeros(spec.size), np.zeros(spec.size))
    losses, states = [], []
    for _ in range(2):
        total = 0.0
        for at in range(0, len(y), 300):
            loss, gradient = loss_and_gradient(spec, state.theta, x[at : at + 300], y[at : at + 300])
            total += loss
            state.update(gradient / len(y[at : at + 300]))
        losses.append(total / len(y))
        states.append(state.theta.copy())
    assert [t for _, t, _ in m.history] == pytest.approx(losses)
    np.testing.assert_allclose(m.theta, states[m.best_epoch - 1], rtol=1e-5)


def test_patience_and_warm_start(signal):
    spec = NetSpec("f", "ffn", 2.0, 2, (4,))
    (m,) = fit_nets(signal, [spec], 3.0, ["a", "b"], epochs=30, rate=2.0, patience=2, partitions=2)
    assert len(m.history) < 30
    (n,) = fit_nets(signal, [spec], 3.0, ["a", "b"], epochs=1, rate=0.0, warm_start=[m.theta], partitions=2)
    np.testing.assert_allclose(n.theta, m.theta)
    with pytest.raises(ValueError):
        fit_nets(signal, [spec], 3.0, ["a", "b"], mode="other")


def test_glm_recovers_the_signal(signal):
    for power in (2.0, 2.5, 3.0):
        model = fit_glm(signal, ["a", "b"], power)
        assert list(model.coefficients) == pytest.approx([0.5, -0.3], abs=0.05)
        assert model.intercept == pytest.approx(1, abs=0.05)
        scored = predict_glm(signal, model, ["a", "b"], "mu")
        from claimlens.functions.deviance import power_deviance

        mean = scored.agg(power_deviance("Claim", "mu", power)).first()[0]
        assert model.summary.deviance == pytest.approx(2000 * mean, rel=1e-6)


def test_constant_model_is_the_best_constant(lab):
    mean = mean_severity(learn_rows(lab.features), digits=None)
    assert mean_severity(learn_rows(lab.features)) == round(mean)
    losses = {}
    for shift in (0.9, 1.0, 1.1):
        df = lab.features.withColumn("c", F.lit(mean * shift))
        losses[shift] = {r["key"]: r["value"] for r in loss_report(df, ["c"]).collect()}
    for key in ("learn_p2", "learn_pp", "learn_p3"):
        assert losses[1.0][key] == min(row[key] for row in losses.values())
    assert with_mean_severity(lab.features).first()["null_model"] == round(mean)


def test_scoring_by_udf_and_by_expressions(lab):
    for kind in ("ffn", "localglm"):
        model = fixed_net(kind, "m", 5000.0)
        by_udf = score(lab.features, [model])
        both = score_expressions(by_udf, NetModel(NetSpec("e", kind), model.theta))
        gap = both.agg(F.max(F.abs(F.col("m") / F.col("e") - 1)), F.count("m"), F.count(F.lit(1))).first()
        assert gap[0] < 1e-12 and gap[1] == gap[2] > 0


def test_missing_feature_gives_no_prediction(lab):
    holes = lab.features.withColumn("AgeNN", F.when(F.col("Id") > 1, F.col("AgeNN")))
    models = [fixed_net("ffn", "f", 5000.0), fixed_net("localglm", "l", 5000.0)]
    row = score(holes, models).agg(F.count("f"), F.count("l"), F.count(F.lit(1))).first()
    assert row[0] == row[1] == row[2] - 1


def test_attention_explains_the_prediction(lab):
    model = fixed_net("localglm", "l", 5000.0)
    holes = lab.features.filter("Id < 5").withColumn("AgeNN", F.lit(None).cast("double"))
    assert with_attention(holes, model).filter("attention IS NOT NULL").count() == 0
    df = with_attention(score(lab.features, [model]), model).limit(20).collect()
    for r in df:
        x = np.array([float(r[f]) for f in schema.MODEL_FEATURES])
        assert np.exp(0.5 * (x @ np.array(r["attention"])) + np.log(5000)) == pytest.approx(r["l"])
        assert r["attention"] == pytest.approx(attention(model.spec, model.theta, x[None])[0].tolist())


@pytest.mark.parametrize("kind", ["ffn", "localglm"])
def test_weights_table_round_trip(spark, tmp_path, kind):
    model = NetModel(NetSpec("m", kind, 2.5), NetSpec("m", kind).start(10.0, 3))
    log = RunLog(spark, str(tmp_path), "e")
    log.log_weights(weights_table(spark, [model]))
    kept = load_model(log.weights("m"))
    assert kept.spec == model.spec
    np.testing.assert_array_equal(kept.theta, model.theta)
    with pytest.raises(ValueError):
        load_model(log.weights("other"))
    # another experiment does not see the run, and two runs in one are refused
    with pytest.raises(ValueError):
        load_model(RunLog(spark, str(tmp_path), "f").weights("m"))
    RunLog(spark, str(tmp_path), "f").log_weights(weights_table(spark, [model]))
    assert load_model(log.weights("m")).spec == model.spec
    log.log_weights(weights_table(spark, [model]))
    with pytest.raises(ValueError, match="same place"):
        load_model(log.weights("m"))


def test_layers_beyond_nine_keep_their_order(spark, tmp_path):
    spec = NetSpec("deep", "ffn", 2.0, 3, tuple(range(3, 15)))
    log = RunLog(spark, str(tmp_path), "e")
    run = log.start_run("Deep net")
    assert run.startswith("deep-net-") and run != log.start_run("Deep net")
    log.log_weights(weights_table(spark, [NetModel(spec, spec.start(2.0, 1))]), {"deep": run})
    kept = load_model(log.weights(run))
    assert kept.spec.hidden == spec.hidden
    np.testing.assert_array_equal(kept.theta, spec.start(2.0, 1))


def test_run_log_appends_and_separates_experiments(spark, tmp_path):
    one, two = (RunLog(spark, str(tmp_path), name) for name in ("one", "two"))
    one.log("r1", "first", params={"epochs": 100}, metrics={"test_p2": 0.5})
    one.log("r2", "second", metrics={"test_p2": 0.4})
    two.log("r3", "third", metrics={"test_p2": 0.1})
    assert one.runs().count() == 3 and two.runs().count() == 1
    assert one.runs().columns == [f.name for f in schema.RUNS_SCHEMA]


def test_history_table(spark):
    model = NetModel(NetSpec("m", "ffn"), np.zeros(826), [(1, 0.5, 0.6), (2, 0.4, None)])
    assert [tuple(r) for r in history_table(spark, [model]).collect()] == [("m", 1, 0.5, 0.6), ("m", 2, 0.4, None)]


MINI = [NetSpec("plain", "ffn", 2.0, 2, (4,)), NetSpec("local", "localglm", 3.0, 2, (4,))]


@pytest.fixture(scope="module")
def shuffled(signal):
    return signal.withColumn("shuffle_key", shuffle_key("Id"))


def test_minibatch_is_the_same_for_any_tasks_and_jobs(shuffled):
    def fit(**how):
        models = fit_minibatch(shuffled, MINI, 3.0, ["a", "b"], epochs=2, batch_size=800, **how)
        return [(m.history, m.best_epoch, m.theta.tolist()) for m in models]

    one = fit()
    assert fit(tasks=3, epochs_per_job=1) == one
    assert fit(tasks=8, held_rows=1) == one


@pytest.mark.parametrize("held", [1, 700])
def test_more_rows_than_a_task_holds_are_gone_round_in_segments(spark, shuffled, held):
    """Segments (also a single mini-batch each), ends by patience and no held-out rows give the same as one task."""
    barriers, real = [], type(shuffled).mapInArrow

    def fit(**how):
        found = fit_minibatch(shuffled, MINI, 3.0, ["a", "b"], batch_size=300, **how)
        return [(m.history, m.best_epoch, m.theta.tolist()) for m in found]

    def watched(self, *args, barrier=False, **more):
        barriers.append(barrier)
        return real(self, *args, barrier=barrier, **more)

    ways = [{"epochs": 3, "epochs_per_job": 2}, {"epochs": 6, "patience": 1, "rate": 0.5}, {"epochs": 2, "validation_split": 0.0}]
    for way in ways:
        one = fit(**way)
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(type(shuffled), "mapInArrow", watched)
            assert fit(held_rows=held, **way) == one
    assert barriers and not any(barriers)  # no step waits for an exchange


@pytest.mark.parametrize("spec", SPECS, ids=lambda s: s.name)
def test_a_stack_gives_what_its_blocks_give(spec):
    """Blocks of any sizes, stacked as they come: the losses and gradients of each block, whatever stands beside it."""
    rng = np.random.default_rng(5)
    theta = spec.start(3.0, 1) + rng.normal(0, 0.1, spec.size)
    sizes = [(0, 0, 60), (0, 1, 60), (0, 2, 60), (0, 2, 60), (0, 3, 7), (1, 0, 7), (1, 1, 1), (1, 2, 200)]
    blocks = [(b, u, rng.gamma(2.0, 2.0, n), rng.normal(size=(n, spec.inputs)).astype(np.float32)) for b, u, n in sizes]
    made, memory = list(stacks(blocks, 180)), {}
    assert [(batch, units, x.shape[:2]) for batch, units, _, x in made] == [
        (0, [0, 1, 2], (60, 3)), (0, [2], (60, 1)), (0, [3], (7, 1)), (1, [0], (7, 1)), (1, [1], (1, 1)), (1, [2], (200, 1))
    ]
    at = iter(blocks)
    for _, _, y, x in made:
        losses, gradients = stacked_gradients(spec, theta, x, y, memory)
        held_out = stacked_losses(spec, theta, x, y, memory)
        for k in range(len(y)):
            _, _, claims, rows = next(at)
            loss, gradient = loss_and_gradient(spec, theta, rows, claims)
            alone = stacked_gradients(spec, theta, rows[:, None], claims[None], {})
            assert losses[k] == alone[0][0] and (gradients[k] == alone[1][0]).all()
            assert losses[k] == pytest.approx(loss, rel=1e-6) and np.allclose(gradients[k], gradient, rtol=1e-4, atol=1e-5)
            assert held_out[k] == pytest.approx(deviance(claims, predict(spec, theta, rows), spec.power).sum(), rel=1e-6)
    assert next(at, None) is None


def test_rows_that_fit_into_a_task_are_not_gone_round(shuffled, monkeypatch):
    """More rows than a segment has stay with each network's task for the epochs of a job; packed in any number of parts."""
    from claimlens.models import minibatch

    def fit(**how):
        found = fit_minibatch(shuffled, MINI, 3.0, ["a", "b"], epochs=3, epochs_per_job=2, batch_size=300, **how)
        return [(m.history, m.best_epoch, m.theta.tolist()) for m in found]

    gone_round = fit(held_rows=1)
    monkeypatch.setattr(minibatch, "_relay", None)
    monkeypatch.setattr(minibatch, "SEGMENT_ROWS", 500)
    assert fit() == gone_round
    monkeypatch.setattr(minibatch, "ROWS_PER_RANGE", 700)
    assert fit() == gone_round
    sent = shuffled.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert int(sent) != minibatch.BLOCKS_SENT  # the setting is as before


def test_a_unit_of_many_rows_is_cut_into_blocks(shuffled, monkeypatch):
    """A mini-batch of all rows is never one array: blocks are bounded, whatever the tasks."""
    from claimlens.models import minibatch

    rows = [(0, 0, float(i + 1), float(i), 1.0) for i in range(25)] + [(0, 1, 1.0, 2.0, 3.0)]
    table = pa.table({n: list(c) for n, c in zip(("batch", "unit", "y", "a", "b"), zip(*rows))})
    monkeypatch.setattr(minibatch, "BLOCK_ROWS", 10)
    made = [b.to_pylist()[0] for b in minibatch._pack(np.float64)(iter(table.to_batches(max_chunksize=7)))]
    assert [(b["unit"], len(b["y"]) // 8) for b in made] == [(0, 10), (0, 10), (0, 5), (1, 1)]
    assert np.concatenate([np.frombuffer(b["y"]) for b in made]).tolist() == [r[2] for r in rows]

    def fit(**how):
        found = fit_minibatch(shuffled, MINI, 3.0, ["a", "b"], epochs=2, batch_size=10**6, precision=np.float64, **how)
        return [(m.history, m.theta.tolist()) for m in found]

    cut = fit(tasks=1)
    assert fit(tasks=3) == cut == fit(tasks=1, held_rows=1)
    monkeypatch.setattr(minibatch, "BLOCK_ROWS", 10**6)
    for (h, t), (h_whole, t_whole) in zip(cut, fit(tasks=1)):
        assert np.allclose(h, h_whole, rtol=1e-9) and np.allclose(t, t_whole, rtol=1e-9, atol=1e-12)


def test_minibatch_is_plain_training(shuffled):
    """The same steps in one process over the rows in shuffle order."""
    rows = shuffled.orderBy("shuffle_key", "Id").toPandas()
    x, y = rows[["a", "b"]].to_numpy(np.float64), rows["Claim"].to_numpy()
    n = int(len(y) * 0.8)
    models = fit_minibatch(shuffled, MINI, 3.0, ["a", "b"], epochs=3, batch_size=300, precision=np.float64)
    for k, (spec, got) in enumerate(zip(MINI, models)):
        start = spec.start(3.0, schema.SEED + k)
        state = Nadam(start, np.zeros(spec.size), np.zeros(spec.size))
        for epoch, train, val in got.history:
            total = 0.0
            for at in range(0, n, 300):
                part = slice(at, min(at + 300, n))
                loss, gradient = loss_and_gradient(spec, state.theta, x[part], y[part])
                total += loss
                state.update(gradient / (part.stop - part.start))
            assert train == pytest.approx(total / n, rel=1e-9)
            assert val == pytest.approx(deviance(y[n:], predict(spec, state.theta, x[n:]), spec.power).mean(), rel=1e-9)
        assert got.best_epoch == 3 and np.allclose(got.theta, state.theta, rtol=1e-9, atol=1e-12)


def test_a_fit_goes_on_from_its_last_whole_checkpoint(spark, shuffled, tmp_path):
    def fit(epochs, folder=None, **how):
        return fit_minibatch(
            shuffled, MINI, 3.0, ["a", "b"], epochs=epochs, batch_size=400, checkpoint=folder and f"{tmp_path}/{folder}", **how
        )

    def numbers(models):
        return [(m.history, m.best_epoch, m.theta.tolist()) for m in models]

    whole = numbers(fit(5))
    for stop in (1, 3):
        fit(stop, f"stop{stop}")
        so_far = best_so_far(spark, f"{tmp_path}/stop{stop}", MINI)
        assert [len(m.history) for m in so_far] == [stop, stop]
        # A job that was lost while writing leaves files without a marker.
        (tmp_path / f"stop{stop}" / "at-000000004").mkdir()
        (tmp_path / f"stop{stop}" / "at-000000004" / "part-0.parquet").write_bytes(b"half")
        assert numbers(fit(5, f"stop{stop}", epochs_per_job=1)) == whole
        assert Checkpoints(spark, f"{tmp_path}/stop{stop}").last() == 5
    assert numbers(fit(5, "stop1")) == whole
    with pytest.raises(ValueError, match="rate"):
        fit(6, "stop1", rate=0.1)
    with pytest.raises(ValueError, match="networks"):
        fit_minibatch(shuffled, MINI[:1], 3.0, ["a", "b"], checkpoint=f"{tmp_path}/stop1")
    with pytest.raises(ValueError, match="no whole"):
        best_so_far(spark, f"{tmp_path}/nothing", MINI)


def test_minibatch_patience_ends_each_network_for_itself(shuffled):
    wild = fit_minibatch(shuffled, MINI, 3.0, ["a", "b"], epochs=9, batch_size=100, patience=1, rate=0.5)
    for m in wild:
        scores = [v for _, _, v in m.history]
        assert len(scores) <= m.best_epoch + 1 and m.best_epoch == int(np.argmin(scores)) + 1


def test_minibatch_refuses_what_it_cannot_fit(shuffled):
    with pytest.raises(ValueError, match="no learn rows"):
        fit_minibatch(shuffled.withColumn("Claim", F.lit(-1.0)), MINI, 3.0, ["a", "b"])
    with pytest.raises(ValueError, match="names"):
        fit_minibatch(shuffled, [MINI[0], MINI[0]], 3.0, ["a", "b"])


def test_one_run_is_read_from_one_partition(spark, tmp_path):
    log = RunLog(spark, str(tmp_path), "many runs")
    models = [NetModel(s, s.start(2.0, 1)) for s in MINI]
    ids = [log.start_run("A run") for _ in range(6)]
    for run in ids:
        log.log_weights(weights_table(spark, models[:1]), {"plain": run})
        log.log(run, "A run", {"epochs": 3}, {"loss": 0.5})
    RunLog(spark, str(tmp_path), "others").log_weights(weights_table(spark, models[:1]), {"plain": ids[0]})
    kept = log.weights(ids[0])
    assert kept.count() == MINI[0].size
    files = {f.partition("/model_weights/")[2].rpartition("/")[0] for f in kept.inputFiles()}
    scan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(experiment" in scan and "bucket" in scan.partition("PartitionFilters")[2][:200]
    assert len(files) > 1  # what is there; the filters leave one of them
    assert kept.select(F.input_file_name().alias("f")).distinct().count() == 1
    assert log.runs().count() == 12 and {r["run_id"] for r in log.runs().collect()} == set(ids)
