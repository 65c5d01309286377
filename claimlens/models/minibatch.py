"""Mini-batch fitting with one copy of the weights, whatever the number of rows or tasks.

Rows are numbered in shuffle order; each ``batch_size`` of them are a mini-batch, and
a mini-batch has a fixed number of units.  Units are dealt out over the tasks of a barrier stage.  For every
mini-batch each task sends the gradients of its units to all others, everyone adds up
all units in the same order and takes the same optimizer step.  So the weights never differ between
tasks, nothing is averaged, and any number of tasks gives the same numbers to the last bit.

Networks are fitted beside each other by groups of tasks; while the rows fit into one task's memory a group is
one task, which has nothing to exchange: it reads the rows once for all epochs of a job.  With more rows, and mini-batches too
small to be worth an exchange, the rows are cut into segments of whole mini-batches, and the networks go round them: in every leg each network has
another segment, whose task takes that segment's steps and hands the weights on.  So no task reads more than a segment,
rows are kept once for all networks, and a step costs what its rows cost.  The steps and their order stay the same.

A job (or a round of legs) runs one or more epochs and leaves one table: weights, optimizer state, best weights and
losses so far.  It is a checkpoint: a fit that ends after any job goes on from there with the same result.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.models import nets
from claimlens.models.nets import NetSpec
from claimlens.models.training import NetModel, _can_fit
from claimlens.operators.ordering import ROWS_PER_RANGE, dense_ids
from claimlens.operators.split import with_validation
from claimlens.schema import (
    BATCH_SIZE,
    EPOCHS,
    MODEL_FEATURES,
    SEED,
    VALIDATION_SPLIT,
)
from claimlens.sources.checkpoints import Checkpoints
from claimlens.sources.storage import stage, stage_path, unstage

cloudpickle.register_pickle_by_value(nets)

# Units of a mini-batch: the order in which gradients are added, and the most tasks that can share one.
UNITS = 8
# Bytes of rows that the task of a network may keep in memory between the epochs of a job: 12.5 million rows of 16
# features in single precision.
HELD_BYTES = 900_000_000
# Rows of a segment, and those that a task may keep if it shares mini-batches with others.  With more rows such tasks get
# jobs of one epoch, and read them again for the next.
SEGMENT_ROWS = 2_000_000
# Rows of a mini-batch that are worth a task of its own: an exchange takes Spark about a second.
ROWS_PER_TASK = 200_000
EPOCHS_PER_JOB = 10
# Rows of a block at most: what a unit of very many rows is cut into, for the memory of tasks.
BLOCK_ROWS = 5_000
# Rows of a stack of blocks: few enough for a core's cache, and long enough for the calls on it.
STACK_ROWS = 2_500
# Blocks that go to a task's Python at once, so that it computes on some while the next are on their way.
BLOCKS_SENT = 64
_SENT = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Rows of a state that may come to the driver.
MOST_ROWS = 6_000_000

BLOCK_SCHEMA = "batch bigint, unit int, y binary, x binary"
STATE_SCHEMA = "model string, part string, i int, value double"
LEG_SCHEMA = "net int, segment int, losses binary, state binary"


@contextmanager
def _blocks_in_small_batches(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_SENT)
    spark.conf.set(_SENT, str(BLOCKS_SENT))
    try:
        yield
    finally:
        spark.conf.set(_SENT, before)


def _pack(precision: type):
    """Rows (batch, unit, claim, features...) in that order, as blocks of one batch and unit: the
    first ``BLOCK_ROWS`` of its rows, the next, and so on."""
    most = BLOCK_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        of, n_waiting = None, 0

        def block() -> pa.RecordBatch:
            y, x = (np.concatenate(part) for part in zip(*waiting))
            columns = [
                pa.array([of[0]], pa.int64()),
                pa.array([of[1]], pa.int32()),
                pa.array([y.tobytes()], pa.binary()),
                pa.array([x.tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["batch", "unit", "y", "x"])

        for record in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in record.columns]
            batch, unit, y = columns[:3]
            x = np.column_stack(columns[3:]).astype(precision)
            cuts = np.flatnonzero((batch[1:] != batch[:-1]) | (unit[1:] != unit[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(y)]):
                if a == b:
                    continue
                if of != (batch[a], unit[a]):
                    if waiting:
                        yield block()
                    waiting, n_waiting, of = [], 0, (batch[a], unit[a])
                while a < b:
                    taken = min(b - a, most - n_waiting)
                    waiting.append((y[a : a + taken], x[a : a + taken]))
                    a, n_waiting = a + taken, n_waiting + taken
                    if n_waiting == most:
                        yield block()
                        waiting, n_waiting = [], 0
        if waiting:
            yield block()

    return run


def _job(specs: list[NetSpec], state: dict, first: int, last: int, settings: dict):
    """The task: epochs ``first`` to ``last`` from ``state``, for the networks of its group.

    The first task of a group returns its networks' new state.
    """
    step_batch, held_out_losses, optimizer, stacks = nets.stacked_gradients, nets.stacked_losses, nets.Nadam, nets.stacks
    most_rows = STACK_ROWS
    precision, n_train, n_val = settings["precision"], settings["n_train"], settings["n_val"]
    rate, patience, batch_size = settings["rate"], settings["patience"], settings["batch_size"]
    n_tasks, n_groups, n_batches = settings["n_tasks"], settings["n_groups"], settings["n_batches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext, TaskContext

        context = TaskContext.get() if n_tasks == 1 else BarrierTaskContext.get()
        group, task = divmod(context.partitionId(), n_tasks)
        own = specs[group::n_groups]

        def blocks():
            for record in batches:
                for batch, unit, y, x in zip(*record.columns):
                    claims = np.frombuffer(y.as_buffer(), dtype=float)
                    rows = np.frombuffer(x.as_buffer(), dtype=precision).reshape(len(claims), -1)
                    yield batch.as_py(), unit.as_py(), claims, rows

        def exchange(units: list[tuple[int, np.ndarray, np.ndarray]], width: int) -> tuple[np.ndarray, np.ndarray]:
            """Sums of losses and vectors over the units of all tasks of the group, in the order of the units."""
            found = units
            if n_tasks > 1:
                packed = b"".join(np.int64(u).tobytes() + a.tobytes() + v.tobytes() for u, a, v in units)
                found = []
                length = 8 + 8 * len(own) + width * np.dtype(precision).itemsize
                for of, message in enumerate(context.allGather(base64.b64encode(packed).decode())):
                    if of // n_tasks != group:
                        continue
                    raw = base64.b64decode(message)
                    for at in range(0, len(raw), length):
                        losses = np.frombuffer(raw, float, len(own), at + 8)
                        vector = np.frombuffer(raw, precision, width, at + 8 + 8 * len(own))
                        found.append((int(np.frombuffer(raw, np.int64, 1, at)[0]), losses, vector))
            loss, total = np.zeros(len(own)), np.zeros(width)
            for _, losses, vector in sorted(found, key=lambda f: f[0]):
                loss += losses
                total += vector
            return loss, total

        def add(units: list, unit: int, losses: np.ndarray, vector: np.ndarray) -> None:
            """One more block's sums: of the unit before, or of a new one."""
            if units and units[-1][0] == unit:
                _, a, g = units.pop()
                losses, vector = a + losses, g + vector
            units.append((unit, losses, vector))

        sizes = [s.size for s in own]
        local = [optimizer(*(state[s.name][p].copy() for p in ("theta", "m", "v")), *state[s.name]["clock"], rate) for s in own]
        best = [(state[s.name]["best"].copy(), *state[s.name]["best_of"]) for s in own]
        losses_of = []
        memory: dict = {}
        held = list(stacks(blocks(), most_rows)) if last > first else None
        for epoch in range(first, last + 1):
            going = [patience is None or since < patience for *_, since in best]
            mine = iter(held) if held is not None else stacks(blocks(), most_rows)
            waiting = next(mine, None)
            train_loss = np.zeros(len(own))
            for batch in range(n_batches):
                units = []
                while waiting is not None and waiting[0] == batch:
                    _, of, y, x = waiting
                    found = [
                        step_batch(spec, s.theta, x, y, memory) if go else (np.zeros(len(of)), np.zeros((len(of), spec.size)))
                        for spec, s, go in zip(own, local, going)
                    ]
                    losses, gradients = np.stack([a for a, _ in found], axis=1), np.concatenate([g for _, g in found], axis=1)
                    for unit, a, g in zip(of, losses, gradients):
                        add(units, unit, a, g)
                    waiting = next(mine, None)
                loss, total = exchange([(u, a, g.astype(precision)) for u, a, g in units], sum(sizes))
                train_loss += loss
                in_batch = min(batch_size, n_train - batch * batch_size)
                for s, gradient, go in zip(local, np.split(total, np.cumsum(sizes)[:-1]), going):
                    if go:
                        s.update(gradient / in_batch)
            # What is left is held out.
            units = []
            while waiting is not None:
                _, of, y, x = waiting
                found = np.stack([held_out_losses(spec, s.theta, x, y, memory) for spec, s in zip(own, local)], axis=1)
                for unit, a in zip(of, found):
                    add(units, unit, a, np.zeros(0))
                waiting = next(mine, None)
            val_loss, _ = exchange(units, 0)
            for k, spec in enumerate(own):
                if not going[k]:
                    continue
                train = float(train_loss[k] / n_train)
                val = float(val_loss[k] / n_val) if n_val else None
                losses_of += [(spec.name, "train_loss", epoch, train), (spec.name, "val_loss", epoch, val)]
                score = val if val is not None else train
                theta, at, least, since = best[k]
                best[k] = (local[k].theta.copy(), epoch, score, 0) if score < least else (theta, at, least, since + 1)
        if task:
            return
        rows = [r for r in settings["carried"] if r[0] in {s.name for s in own} or (r[0] == "" and group == 0)]
        rows += losses_of + ([("", "epoch", 0, float(last))] if group == 0 else [])
        for spec, s, (theta, *best_of) in zip(own, local, best):
            parts = {"theta": s.theta, "m": s.m, "v": s.v, "clock": [s.step, s.momentum_product], "best": theta, "best_of": best_of}
            rows += [(spec.name, part, i, float(v)) for part, values in parts.items() for i, v in enumerate(values)]
        types = (pa.string(), pa.string(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["model", "part", "i", "value"]
        )

    return run


def _leg(specs: list[NetSpec], work: dict[int, list[tuple]], settings: dict):
    """The task of a segment: a network's steps on its mini-batches, or held-out losses of its rows.

    ``work``: segment -> networks, as (number, theta, and for steps m, v, clock and train loss so far).  Returned are the
    state after the steps, or the losses by unit.
    """
    step_batch, held_out_losses, optimizer, stacks = nets.stacked_gradients, nets.stacked_losses, nets.Nadam, nets.stacks
    most_rows = STACK_ROWS
    precision, batch_size, n_train, rate = (settings[k] for k in ("precision", "batch_size", "n_train", "rate"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        segment = TaskContext.get().partitionId()
        mine = work.get(segment, [])
        steps = [(k, specs[k], optimizer(theta, *rest[:2], *rest[2], rate)) for k, theta, *rest in mine if rest]
        train_loss = {k: rest[3] for k, _, *rest in mine if rest}
        held_out = [(k, specs[k], theta, {}) for k, theta, *rest in mine if not rest]
        at = None  # the mini-batch whose units are being added up
        units: dict[int, list[list]] = {}

        def take_step() -> None:
            in_batch = min(batch_size, n_train - at * batch_size)
            for k, spec, state in steps:
                loss, total = 0.0, np.zeros(spec.size)
                for unit in sorted(units):
                    found = units[unit][[j for j, *_ in steps].index(k)]
                    loss += found[0]
                    total += found[1].astype(precision)
                train_loss[k] += loss
                state.update(total / in_batch)

        def blocks():
            for record in batches:
                for batch, unit, y, x in zip(*record.columns[:4]):
                    claims = np.frombuffer(y.as_buffer(), dtype=float)
                    yield batch.as_py(), unit.as_py(), claims, np.frombuffer(x.as_buffer(), dtype=precision).reshape(len(claims), -1)

        memory: dict = {}
        for batch, of, claims, rows in stacks(blocks(), most_rows):
            for _, spec, theta, losses in held_out:
                for unit, found in zip(of, held_out_losses(spec, theta, rows, claims, memory)):
                    losses[unit] = losses.get(unit, 0.0) + float(found)
            if not steps:
                continue
            if batch != at:
                if units:
                    take_step()
                at, units = batch, {}
            stacked = [step_batch(spec, state.theta, rows, claims, memory) for _, spec, state in steps]
            for j, unit in enumerate(of):
                found = [(a[j], g[j]) for a, g in stacked]
                if unit in units:
                    found = [(a + b, g + h) for (a, g), (b, h) in zip(units[unit], found)]
                units[unit] = found
        if units:
            take_step()
        out = [
            (k, b"", np.concatenate([s.theta, s.m, s.v, [s.step, s.momentum_product, train_loss[k]]]).tobytes())
            for k, _, s in steps
        ]
        out += [(k, np.array([losses[u] for u in sorted(losses)]).tobytes(), b"") for k, _, _, losses in held_out]
        if out:
            net, losses, state = zip(*out)
            columns = [
                pa.array(net, pa.int32()),
                pa.array([segment] * len(net), pa.int32()),
                pa.array(losses, pa.binary()),
                pa.array(state, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["net", "segment", "losses", "state"])

    return run


def _relay(
    blocks: DataFrame, specs: list[NetSpec], state: dict, first: int, last: int, settings: dict
) -> list[tuple]:
    """Rows of the state after epochs ``first`` to ``last``, the networks going round the segments.

    In a leg a segment has one network, and a network one segment; the one that is furthest goes first.  A network's held-out
    losses are taken while it goes on; only if it may end by ``patience``, it waits for them.
    """
    n_train, n_val, patience = settings["n_train"], settings["n_val"], settings["patience"]
    n_steps, n_held = settings["segments"]
    segment = F.col("segment")
    now = [[state[s.name][p] for p in ("theta", "m", "v")] + [tuple(state[s.name]["clock"])] for s in specs]
    best = [(state[s.name]["best"], *state[s.name]["best_of"]) for s in specs]
    place = [(first, 0) for _ in specs]  # epoch and segment that come next
    train_loss = [0.0 for _ in specs]
    waiting: list[tuple[int, int, np.ndarray, float]] = []  # epochs to be judged: network, epoch, weights, train loss
    losses_of: list[tuple] = []

    def judge(k: int, epoch: int, theta: np.ndarray, train: float, val: float | None) -> None:
        losses_of.extend([(specs[k].name, "train_loss", epoch, train), (specs[k].name, "val_loss", epoch, val)])
        score = val if val is not None else train
        before, at, least, since = best[k]
        best[k] = (theta, epoch, score, 0) if score < least else (before, at, least, since + 1)

    while True:
        work: dict[int, list[tuple]] = {}
        busy = {k for k, *_ in waiting} if patience is not None else set()
        going: dict[int, int] = {}
        for k in sorted(range(len(specs)), key=lambda k: (-place[k][0], -place[k][1], k)):
            epoch, at = place[k]
            over = epoch > last or (patience is not None and best[k][3] >= patience)
            if not over and k not in busy and at not in work:
                work[at] = [(k, *now[k], train_loss[k])]
                going[k] = at
        judged = waiting if n_held else []
        for j, (_, _, theta, _) in enumerate(judged):
            for part in range(n_steps, n_steps + n_held):
                work.setdefault(part, []).append((judged[j][0], theta))
        if not work:
            break
        with _blocks_in_small_batches(blocks.sparkSession):
            found = blocks.filter(segment.isin(*work)).mapInArrow(_leg(specs, work, settings), LEG_SCHEMA).collect()
        held_losses: dict[int, list[tuple[int, np.ndarray]]] = {}
        waiting = []
        for row in found:
            k = row["net"]
            if not row["state"]:
                held_losses.setdefault(k, []).append((row["segment"], np.frombuffer(row["losses"])))
                continue
            size, numbers = specs[k].size, np.frombuffer(row["state"])
            now[k] = [*np.split(numbers[: 3 * size], 3), (numbers[-3], numbers[-2])]
            train_loss[k] = float(numbers[-1])
            epoch, at = place[k]
            place[k] = (epoch, at + 1)
            if at + 1 == n_steps:
                place[k] = (epoch + 1, 0)
                waiting.append((k, epoch, now[k][0], train_loss[k] / n_train))
                train_loss[k] = 0.0
        for k, epoch, theta, train in judged:
            total = 0.0
            for _, losses in sorted(held_losses[k], key=lambda h: h[0]):
                for loss in losses:
                    total += loss
            judge(k, epoch, theta, train, float(total / n_val))
        if not n_held:
            for k, epoch, theta, train in waiting:
                judge(k, epoch, theta, train, None)
            waiting = []
        if set(going) - {row["net"] for row in found if row["state"]}:
            raise RuntimeError("a segment without rows")
    rows = settings["carried"] + losses_of + [("", "epoch", 0, float(last))]
    for k, spec in enumerate(specs):
        theta, m, v, clock = now[k]
        kept, *best_of = best[k]
        parts = {"theta": theta, "m": m, "v": v, "clock": clock, "best": kept, "best_of": best_of}
        rows += [(spec.name, part, i, float(x)) for part, values in parts.items() for i, x in enumerate(values)]
    return rows


def _loaded(table: DataFrame) -> dict:
    """The state of a fit from its table (some thousand numbers)."""
    rows = table.limit(MOST_ROWS).collect()
    parts: dict[tuple[str, str], dict[int, float]] = {}
    for r in rows:
        parts.setdefault((r["model"], r["part"]), {})[r["i"]] = r["value"]
    state: dict = {"": {}}
    for (model, part), values in parts.items():
        if part in ("train_loss", "val_loss") or model == "":
            state.setdefault(model, {})[part] = values
        else:
            state.setdefault(model, {})[part] = np.array([values[i] for i in range(len(values))])
    return state


def _models(specs: Sequence[NetSpec], state: dict, left_out: int) -> list[NetModel]:
    models = []
    for spec in specs:
        found = state[spec.name]
        losses = found.get("train_loss", {})
        history = [(e, losses[e], found["val_loss"][e]) for e in sorted(losses)]
        models.append(NetModel(spec, found["best"].copy(), history, int(found["best_of"][0]), left_out))
    return models


def best_so_far(spark: SparkSession, folder: str, specs: Sequence[NetSpec]) -> list[NetModel]:
    """Best weights and history in the last whole checkpoint of a fit, which may still be running."""
    kept = Checkpoints(spark, folder)
    at = kept.last()
    if at is None:
        raise ValueError("no whole checkpoint")
    state = _loaded(kept.read(at))
    return _models(specs, state, int(state[""]["left_out"][0]))


def fit_minibatch(
    learn: DataFrame,
    specs: Sequence[NetSpec],
    mean_claim: float,
    features: Sequence[str] = MODEL_FEATURES,
    claim: str = "Claim",
    epochs: int = EPOCHS,
    batch_size: int = BATCH_SIZE,
    validation_split: float = VALIDATION_SPLIT,
    rate: float = 0.001,
    patience: int | None = None,
    tasks: int | None = None,
    epochs_per_job: int = EPOCHS_PER_JOB,
    checkpoint: str | None = None,
    seed: int = SEED,
    warm_start: Sequence[np.ndarray] | None = None,
    id_col: str = "Id",
    precision: type = np.float32,
    held_rows: int | None = None,
) -> list[NetModel]:
    """Fit every network by steps over global mini-batches and keep its best epoch.

    Mini-batches are cut from the learn rows before the validation tail, in shuffle order (ties by
    id).  Rows that cannot be fitted on are left out, as in ``fit_nets``.  A network ends early if its validation loss
    has not improved for ``patience`` epochs.  The result does not depend on ``tasks`` (by default as many as
    a mini-batch is worth, at most ``UNITS``), ``held_rows`` (the most rows a task keeps, by default ``HELD_BYTES`` of them, or ``SEGMENT_ROWS`` where tasks share
    mini-batches; for a network with ``tasks=1`` more rows are cut into segments), ``epochs_per_job`` or the partitioning of the input.

    With a ``checkpoint`` folder the state after every job is kept there, and a call with the
    same settings goes on from the last whole one; a call with other settings is an error.
    ``epochs`` may be raised to train on.
    """
    specs = list(specs)
    if len({s.name for s in specs}) < len(specs):
        raise ValueError("networks need names of their own")
    spark = learn.sparkSession
    columns = {f"f{k}": f for k, f in enumerate(features)}
    narrow = with_validation(learn, validation_split, id_col=id_col).select(
        "is_validation",
        F.col(claim).cast("double").alias("_y"),
        *[F.col(f).cast("double" if precision is np.float64 else "float").alias(name) for name, f in columns.items()],
        "shuffle_key",
        F.col(id_col).alias("_id"),
    )
    flagged = stage(narrow.withColumn("fits", _can_fit(list(columns))), "minibatch-rows")
    counts = flagged.groupBy("fits", "is_validation").count().collect()
    n_train = sum(r["count"] for r in counts if r["fits"] and not r["is_validation"])
    n_val = sum(r["count"] for r in counts if r["fits"] and r["is_validation"])
    left_out = sum(r["count"] for r in counts if not r["fits"])
    if n_train == 0:
        raise ValueError("no learn rows to fit on")
    order = [F.col("is_validation"), F.col("shuffle_key"), F.col("_id")]
    numbered = dense_ids(flagged.filter("fits").drop("fits"), order, "_rank", "minibatch-order")
    n_batches = -(-n_train // batch_size)
    unit_rows = -(-batch_size // UNITS)
    # Held-out rows are the batch after the last; their units are as large as those of a batch.
    batch = F.expr(f"CASE WHEN is_validation THEN {n_batches}L ELSE (_rank - 1) div {batch_size} END")
    unit = F.expr(
        f"CAST(CASE WHEN is_validation THEN (_rank - 1 - {n_train}) div {unit_rows} "
        f"ELSE (_rank - 1) % {batch_size} div {unit_rows} END AS int)"
    )
    slots = spark.sparkContext.defaultParallelism
    n_tasks = max(1, min(tasks or min(-(-batch_size // ROWS_PER_TASK), slots), UNITS))
    n_groups = max(1, min(len(specs), slots // n_tasks))
    if held_rows is None:
        held_rows = HELD_BYTES // (8 + np.dtype(precision).itemsize * len(columns)) if n_tasks == 1 else SEGMENT_ROWS
    rows = numbered.withColumns({"batch": batch, "unit": unit})
    relayed = n_tasks == 1 and n_train + n_val > held_rows
    n_segments = None
    if n_tasks == 1:
        # Segments of whole mini-batches, then those of held-out units.  Relayed, at least one for each network; otherwise
        # they are only packed apart.
        most, least = (min(held_rows, SEGMENT_ROWS), len(specs)) if relayed else (ROWS_PER_RANGE, 1)
        per_step = -(-n_batches // max(-(-n_train // most), least))
        per_held = max(1, most // unit_rows)
        n_segments = (-(-n_batches // per_step), -(-(-(-n_val // unit_rows)) // per_held))
        task = F.expr(
            f"CAST(CASE WHEN is_validation THEN {n_segments[0]} + unit div {per_held} ELSE batch div {per_step} END AS int)"
        )
        n_parts = sum(n_segments)
    else:
        rows = rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
        task = (F.col("group") * n_tasks + F.col("unit") % n_tasks).cast("int")
        n_parts = n_groups * n_tasks
    blocks = (
        rows.withColumn("task", task)
        .repartitionById(n_parts, F.col("task"))
        .sortWithinPartitions("batch", "unit", "_rank")
        .select("batch", "unit", "_y", *columns)
        .mapInArrow(_pack(precision), BLOCK_SCHEMA)
    )
    if relayed:
        blocks = blocks.withColumn("segment", F.spark_partition_id())
    elif n_tasks == 1:
        # Every group's task gets all blocks, which are fewer and quicker to sort than their rows.
        blocks = (
            blocks.withColumn("place", F.monotonically_increasing_id())
            .withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
            .repartitionById(n_groups, F.col("group"))
            .sortWithinPartitions("place")
        )
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    settings = {
        "batch_size": batch_size,
        "n_train": n_train,
        "n_val": n_val,
        "left_out": left_out,
        "rate": rate,
        "patience": patience,
        "units": UNITS,
        "n_batches": n_batches,
    }
    kept = Checkpoints(spark, checkpoint or stage_path(spark, "minibatch-states"))
    known = [("", key, 0, float(value)) for key, value in settings.items() if key != "patience"]
    settings |= {"n_tasks": n_tasks, "n_groups": n_groups, "segments": n_segments}
    at = kept.last()
    if at is None:
        starts = warm_start or [s.start(mean_claim, seed + k) for k, s in enumerate(specs)]
        state: dict = {}
        for spec, theta in zip(specs, starts):
            theta = np.asarray(theta, dtype=float)
            none = np.zeros(spec.size)
            state[spec.name] = {"theta": theta, "m": none, "v": none, "clock": (0.0, 1.0), "best": theta, "best_of": (0.0, math.inf, 0.0)}
        at = 0
    else:
        state = _loaded(kept.read(at))
        if {s.name: s.size for s in specs} != {m: len(p["theta"]) for m, p in state.items() if m}:
            raise ValueError("the checkpoint is of other networks")
        for _, key, _, value in known:
            if state[""].get(key, {}).get(0) != value:
                raise ValueError(f"the checkpoint was made with another {key}")
        at = int(state[""]["epoch"][0])
    per_job = epochs_per_job if relayed or (n_train + n_val) / n_tasks <= held_rows else 1
    try:
        while at < epochs and (patience is None or any(state[s.name]["best_of"][2] < patience for s in specs)):
            last = min(epochs, at + per_job)
            losses = [
                (s.name, part, epoch, value)
                for s in specs
                for part in ("train_loss", "val_loss")
                for epoch, value in state[s.name].get(part, {}).items()
            ]
            told = {**settings, "precision": precision, "carried": known + losses}
            if relayed:
                numbers = spark.createDataFrame(_relay(blocks, specs, state, at + 1, last, told), STATE_SCHEMA)
            else:
                # Nothing but the barrier stage may be in this plan: all its tasks must run at once.
                run = _job(specs, state, at + 1, last, told)
                numbers = blocks.select("batch", "unit", "y", "x").mapInArrow(run, STATE_SCHEMA, barrier=n_tasks > 1)
            with _blocks_in_small_batches(spark):
                written = kept.write(last, numbers)
            state = _loaded(written)
            at = int(state[""]["epoch"][0])
    finally:
        blocks.unpersist()
        unstage(numbered)
        unstage(flagged)
    models = _models(specs, state, left_out)
    lost = [m.spec.name for m in models if m.history and not m.best_epoch]
    if lost:
        raise ValueError(f"no epoch with a finite loss: {', '.join(lost)}")
    return models
