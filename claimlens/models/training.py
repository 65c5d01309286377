"""Data-parallel fitting of several networks in the same passes over the learn rows.

The rows are packed once into blocks, one row per mini-batch with its features as one
binary matrix, and persisted; passing them to Python again costs next to nothing.  Then
one Spark job per epoch: every task walks through its blocks, starting from the current
parameters of all networks, and returns one row.  In ``local`` mode a
task takes optimizer steps on mini-batches of its rows, and the resulting parameters are
averaged with the row counts as weights (one partition is plain mini-batch training).
How many parts there are follows from the row count alone, never from the cluster.  A task
has one part or, of very many, several, each from the same parameters; it returns their sum, so an epoch
shuffles nothing.
In ``full`` mode tasks only sum gradients and the step is taken once per epoch.
The validation loss of an epoch's parameters is measured while the next one reads the
data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.models import nets
from claimlens.models.nets import NetSpec
from claimlens.operators.split import with_validation
from claimlens.schema import (
    BATCH_SIZE,
    EPOCHS,
    MODEL_FEATURES,
    SEED,
    VALIDATION_SPLIT,
    WEIGHTS_SCHEMA,
)

# tasks get the network functions by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(nets)

# partial results collected directly up to this many; more are summed in groups first
DIRECT_PARTS = 256
# Parts that a task may have, one after the other, before there are more than DIRECT_PARTS tasks.
PARTS_PER_TASK = 64
# Training parts: one per so many rows.  Part of the method, like the batch size: it decides
# between which rows steps are averaged.
ROWS_PER_PART = 25_000
# weights of one model that may come to the driver
MOST_WEIGHTS = 1_000_000
BLOCK_SCHEMA = "part int, held boolean, y binary, x binary"
PART_SCHEMA = "part int, payload array<double>"


@dataclass
class NetModel:
    """A fitted network: best parameters and the loss of every epoch."""

    spec: NetSpec
    theta: np.ndarray
    history: list[tuple[int, float, float | None]] = field(default_factory=list)
    best_epoch: int = 0
    left_out: int = 0  # rows that could not be fitted on


def parts_for(rows: int) -> int:
    """Number of training parts for so many rows."""
    return max(1, math.ceil(rows / ROWS_PER_PART))


def tasks_for(parts: int) -> int:
    """Number of tasks for so many parts."""
    return parts if parts <= DIRECT_PARTS else max(DIRECT_PARTS, math.ceil(parts / PARTS_PER_TASK))


def _blocks(rows: DataFrame, n_parts: int, id_col: str, order: Sequence[str], batch: int, precision: type) -> DataFrame:
    """Blocks of the rows (held, claim, features, then ``order``), which are dealt over the parts by ``id_col``."""
    part = F.pmod(F.hash(id_col), F.lit(n_parts)).alias("_part")
    return (
        rows.select(part, "*")
        .repartitionById(tasks_for(n_parts), F.col("_part") % tasks_for(n_parts))
        .sortWithinPartitions("_part", *order)
        .drop(*order)
        .mapInArrow(_pack_task(batch, precision), BLOCK_SCHEMA)
    )


def _pack_task(batch: int, precision: type = np.float32):
    """Pack rows (part, held, claim, features...) into blocks of ``batch`` rows of a part, in order;
    held-out rows get blocks of their own.  Features get the given precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[bool, list[tuple[np.ndarray, np.ndarray]]] = {False: [], True: []}
        of = None

        def blocks(held: bool, last: bool) -> Iterator[pa.RecordBatch]:
            n = sum(len(y) for y, _ in waiting[held])
            if n < batch and not (last and n):
                return
            y = np.concatenate([part for part, _ in waiting[held]])
            x = np.concatenate([part for _, part in waiting[held]])
            whole = n if last else n // batch * batch
            for at in range(0, whole, batch):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([of], pa.int32()),
                        pa.array([held], pa.bool_()),
                        pa.array([y[at : at + batch].tobytes()], pa.binary()),
                        pa.array([x[at : at + batch].tobytes()], pa.binary()),
                    ],
                    names=["part", "held", "y", "x"],
                )
            waiting[held] = [(y[whole:], x[whole:])]

        for record in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in record.columns]
            parts, held_out, y = columns[0], columns[1].astype(bool), columns[2]
            x = np.column_stack(columns[3:]).astype(precision)
            cuts = np.flatnonzero(parts[1:] != parts[:-1]) + 1
            for a, b in zip([0, *cuts], [*cuts, len(y)]):
                if a == b:
                    continue
                if of != parts[a]:
                    for held in (False, True):
                        yield from blocks(held, last=True)
                    waiting, of = {False: [], True: []}, int(parts[a])
                for held in (False, True):
                    chosen = held_out[a:b] == held
                    waiting[held].append((y[a:b][chosen], x[a:b][chosen]))
                    yield from blocks(held, last=False)
        for held in (False, True):
            yield from blocks(held, last=True)

    return run


def _epoch_task(
    mode: str, specs: list[NetSpec], states: list[nets.Nadam], precision: type = np.float32
):
    """The function run on every partition.  Its row: the task's number and, in this order, the
    row counts (train, validation), then per network validation and train loss sums,
    followed by parameters and moments times the train count (local) or gradient (full); all
    added up over the task's parts in their order."""
    step_batch = nets.loss_and_gradient
    predict, deviance, optimizer = nets.predict, nets.deviance, nets.Nadam

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total, of = None, None

        def start() -> None:
            nonlocal local, train_loss, val_loss, gradients, n_train, n_val
            local = [
                optimizer(s.theta, s.m, s.v, s.step, s.momentum_product, s.rate) for s in states
            ]
            train_loss, val_loss = np.zeros(len(specs)), np.zeros(len(specs))
            gradients = [np.zeros(s.size) for s in specs]
            n_train = n_val = 0

        def close() -> np.ndarray:
            payload = [np.array([n_train, n_val], dtype=float)]
            for k in range(len(specs)):
                payload.append(np.array([val_loss[k], train_loss[k]]))
                if mode == "local":
                    s = local[k]
                    clock = np.array([s.step, s.momentum_product])
                    payload += [n_train * part for part in (s.theta, s.m, s.v, clock)]
                else:
                    payload.append(gradients[k])
            found = np.concatenate(payload)
            return found if total is None else total + found

        local = train_loss = val_loss = gradients = n_train = n_val = None
        start()
        for record in batches:
            for part, held, y_bytes, x_bytes in zip(*record.columns):
                if of not in (None, part):
                    total = close()
                    start()
                of = part
                y = np.frombuffer(y_bytes.as_buffer(), dtype=float)
                x = np.frombuffer(x_bytes.as_buffer(), dtype=precision).reshape(len(y), -1)
                if held.as_py():
                    n_val += len(y)
                    for k, spec in enumerate(specs):
                        mu = predict(spec, states[k].theta, x)
                        val_loss[k] += float(deviance(y, mu, spec.power).sum())
                    continue
                n_train += len(y)
                for k, spec in enumerate(specs):
                    loss, gradient = step_batch(spec, local[k].theta, x, y)
                    train_loss[k] += loss
                    if mode == "local":
                        local[k].update(gradient / len(y))
                    else:
                        gradients[k] += gradient
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([task], pa.int32()), pa.array([close()], pa.list_(pa.float64()))],
            names=["part", "payload"],
        )

    return run


def _total(parts: DataFrame, n_tasks: int) -> np.ndarray:
    """Sum of the partial results in a fixed order, so that a rerun gives the same floats."""

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("part")
        total = np.sum(np.stack(ordered["payload"].to_list()), axis=0)
        return pd.DataFrame({"part": [int(ordered["part"].iloc[0])], "payload": [total]})

    if n_tasks > DIRECT_PARTS:
        groups = math.isqrt(n_tasks)
        parts = parts.groupBy((F.col("part") % groups).alias("_g")).applyInPandas(
            add_up, PART_SCHEMA
        )
    rows = sorted(parts.collect(), key=lambda r: r["part"])
    return np.sum(np.array([r["payload"] for r in rows]), axis=0)


def fit_nets(
    learn: DataFrame,
    specs: Sequence[NetSpec],
    mean_claim: float,
    features: Sequence[str] = MODEL_FEATURES,
    claim: str = "Claim",
    epochs: int = EPOCHS,
    batch_size: int = BATCH_SIZE,
    validation_split: float = VALIDATION_SPLIT,
    mode: str = "local",
    rate: float = 0.001,
    patience: int | None = None,
    partitions: int | None = None,
    seed: int = SEED,
    warm_start: Sequence[np.ndarray] | None = None,
    id_col: str = "Id",
) -> list[NetModel]:
    """Fit every network on the learn rows and keep its best epoch.

    ``learn`` carries the features, the claim, ``shuffle_key`` and a unique id; rows with
    a missing feature, or without a positive finite claim, cannot be fitted on and are left
    out; ``left_out`` of the models tells how many.  Training ends after ``epochs``, or, if
    ``patience`` is given, when no network has improved its validation loss for so many
    epochs; a network without any epoch of finite loss is an error.  The result
    depends on ``partitions`` (default: ``parts_for`` the rows fitted on), neither on the
    cluster nor on how the input happens to be partitioned.
    """
    if mode not in ("local", "full"):
        raise ValueError(f"unknown mode {mode!r}")
    specs = list(specs)
    flagged = with_validation(learn, validation_split, id_col=id_col).select(
        "is_validation",
        F.col(claim).cast("double").alias("_y"),
        *[F.col(f).cast("float").alias(f) for f in features],
        "shuffle_key",
        id_col,
    )
    can_fit = _can_fit(features)
    n_rows, n_fit = flagged.agg(F.count(F.lit(1)), F.count_if(can_fit)).first()
    n_parts = partitions or parts_for(n_fit)
    n_tasks = tasks_for(n_parts)
    blocks = _blocks(
        flagged.filter(can_fit), n_parts, id_col, ["shuffle_key", id_col], batch_size, np.float32
    ).persist(StorageLevel.MEMORY_AND_DISK)
    start = warm_start or [s.start(mean_claim, seed + k) for k, s in enumerate(specs)]
    states = [
        nets.Nadam(np.asarray(t, dtype=float), np.zeros(s.size), np.zeros(s.size), rate=rate)
        for s, t in zip(specs, start)
    ]
    models = [NetModel(s, st.theta.copy(), left_out=n_rows - n_fit) for s, st in zip(specs, states)]
    best = [math.inf] * len(specs)
    train_losses: list[list[float]] = [[] for _ in specs]
    since_best = 0
    try:
        # pass e applies the steps of epoch e and measures the parameters of epoch e - 1;
        # the last pass only measures
        for epoch in range(1, epochs + 2):
            measure_only = epoch == epochs + 1
            task = _epoch_task("full" if measure_only else mode, specs, states)
            total = _total(blocks.mapInArrow(task, PART_SCHEMA), n_tasks)
            n_train, n_val = total[0], total[1]
            if n_train == 0:
                raise ValueError("no learn rows to fit on")
            at, improved = 2, False
            for k, spec in enumerate(specs):
                val = float(total[at] / n_val) if n_val else None
                train = float(total[at + 1] / n_train)
                at += 2
                if epoch > 1:
                    measured = epoch - 1
                    models[k].history.append((measured, train_losses[k][-1], val))
                    score = val if val is not None else train_losses[k][-1]
                    if score < best[k]:
                        best[k], improved = score, True
                        models[k].theta = states[k].theta.copy()
                        models[k].best_epoch = measured
                train_losses[k].append(train)
                if measure_only or mode == "full":
                    gradient = total[at : at + spec.size] / n_train
                    at += spec.size
                    if not measure_only:
                        states[k].update(gradient)
                else:
                    size = spec.size
                    mean = total[at : at + 3 * size + 2] / n_train
                    at += 3 * size + 2
                    states[k] = nets.Nadam(
                        mean[:size],
                        mean[size : 2 * size],
                        mean[2 * size : 3 * size],
                        step=float(mean[-2]),
                        momentum_product=float(mean[-1]),
                        rate=rate,
                    )
            since_best = 0 if improved or epoch == 1 else since_best + 1
            if patience is not None and since_best >= patience:
                break
    finally:
        blocks.unpersist()
    lost = [m.spec.name for m in models if m.history and not m.best_epoch]
    if lost:
        raise ValueError(f"no epoch with a finite loss: {', '.join(lost)}")
    return models


def _can_fit(features: Sequence[str]) -> Column:
    """Positive finite claim ``_y`` and no missing feature."""
    fits = (F.col("_y") > 0) & (F.col("_y") < math.inf)
    for f in features:
        fits = fits & F.col(f).isNotNull() & ~F.isnan(f)
    return F.coalesce(fits, F.lit(False))


def mean_gradients(
    df: DataFrame,
    models: Sequence[NetModel],
    features: Sequence[str] = MODEL_FEATURES,
    claim: str = "Claim",
    batch_size: int = BATCH_SIZE,
    id_col: str = "Id",
) -> list[tuple[float, np.ndarray]]:
    """Mean loss and its gradient over all rows, per network, in double precision.

    The tasks and sums are those of fitting in ``full`` mode; rows that cannot be fitted on are
    left out.
    """
    rows = df.select(
        F.lit(False).alias("_held"),
        F.col(claim).cast("double").alias("_y"),
        *[F.col(f).cast("double").alias(f) for f in features],
        F.col(id_col).alias("_id"),
    ).filter(_can_fit(features))
    n_parts = parts_for(rows.count())
    blocks = _blocks(rows, n_parts, "_id", ["_id"], batch_size, np.float64)
    specs = [m.spec for m in models]
    states = [nets.Nadam(m.theta, np.zeros(m.spec.size), np.zeros(m.spec.size)) for m in models]
    total = _total(blocks.mapInArrow(_epoch_task("full", specs, states, np.float64), PART_SCHEMA), tasks_for(n_parts))
    n, at, out = total[0], 2, []
    if n == 0:
        raise ValueError("no rows to fit on")
    for spec in specs:
        out.append((float(total[at + 1] / n), total[at + 2 : at + 2 + spec.size] / n))
        at += 2 + spec.size
    return out


def history_table(spark: SparkSession, models: Sequence[NetModel]) -> DataFrame:
    """``model, epoch, train_loss, val_loss`` (epochs times models rows)."""
    return spark.createDataFrame(
        [(m.spec.name, *row) for m in models for row in m.history],
        "model string, epoch int, train_loss double, val_loss double",
    )


def weights_table(spark: SparkSession, models: Sequence[NetModel]) -> DataFrame:
    """Every parameter as a row; the bias of a layer has ``i`` = -1."""
    rows = []
    for m in models:
        s = m.spec
        for (layer, a, b), (w, bias) in zip(s.layers, s.unpack(m.theta)):
            head = (s.name, s.name, s.kind, float(s.power), layer)
            rows += [(*head, i, j, float(w[i, j])) for i in range(a) for j in range(b)]
            rows += [(*head, -1, j, float(bias[j])) for j in range(b)]
    return spark.createDataFrame(rows, WEIGHTS_SCHEMA)


def load_model(weights: DataFrame) -> NetModel:
    """Rebuild a network from the weight rows of one run (about a thousand numbers)."""
    rows = weights.limit(MOST_WEIGHTS + 1).collect()
    if not rows:
        raise ValueError("no weights for this run")
    if len(rows) > MOST_WEIGHTS:
        raise ValueError(f"more than {MOST_WEIGHTS} weights")
    if len({(r["layer"], r["i"], r["j"]) for r in rows}) < len(rows):
        raise ValueError("more than one weight in the same place: not the rows of one run")
    shapes: dict[str, tuple[int, int]] = {}
    for r in rows:
        a, b = shapes.get(r["layer"], (0, 0))
        shapes[r["layer"]] = (max(a, r["i"] + 1), max(b, r["j"] + 1))
    hidden = sorted((n for n in shapes if n.startswith("layer")), key=lambda n: int(n[5:]))
    spec = NetSpec(
        rows[0]["model"],
        rows[0]["kind"],
        rows[0]["power"],
        shapes["layer1"][0],
        tuple(shapes[name][1] for name in hidden),
    )
    theta = np.zeros(spec.size)
    parts = {layer: p for (layer, _, _), p in zip(spec.layers, spec.unpack(theta))}
    for r in rows:
        w, bias = parts[r["layer"]]
        if r["i"] < 0:
            bias[r["j"]] = r["value"]
        else:
            w[r["i"], r["j"]] = r["value"]
    return NetModel(spec, theta)
