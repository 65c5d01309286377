"""Sharding by histogram sort: exact counts below probes, splitters refined, one exchange."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimlens.sources.storage import stage

# Probes put between the known neighbours of a splitter in each pass.
FAN_OUT = 7

# A splitter is good enough when it is this near to its target, as a share of one shard.
TOLERANCE = 0.0005

LOWEST = -(2**63)

Probe = tuple[int, int]


@dataclass
class Bracket:
    """What is known of one splitter: keys below and above, with the bytes below each."""

    target: int
    low: Probe
    low_bytes: int
    high: Probe
    high_bytes: int
    done: Probe | None = None
    probes: list[Probe] = field(default_factory=list)


def between(low: Probe, high: Probe, n: int, rows: tuple[int, int]) -> list[Probe]:
    """Up to ``n`` evenly spaced probes strictly between two (key, row) pairs.

    The key is narrowed first; when the pairs are on one key or on neighbouring keys, the
    row number is, in the range ``rows`` of all row numbers.
    """
    if high[0] - low[0] > 1:
        width = high[0] - low[0]
        keys = {low[0] + max(1, width * (i + 1) // (n + 1)) for i in range(n)}
        return sorted({(k, LOWEST) for k in keys} - {low, high})
    first = max(low[1], rows[0])
    width = (high[1] if high[0] == low[0] else rows[1]) - first
    found = {(low[0], first + max(1, width * (i + 1) // (n + 1))) for i in range(n)}
    if high[0] != low[0]:
        found.add((high[0], LOWEST))
    return sorted(p for p in found if low < p < high)


def place_expression(probes: list[Probe], key: str = "key", row: str = "row") -> str:
    """SQL text: how many of the sorted probes are at or below the row's (key, row).

    A binary decision tree, so a row is compared with log2 of the probes.
    """

    def literal(v: int) -> str:
        return "(-9223372036854775807L - 1L)" if v == LOWEST else f"{v}L"

    def node(first: int, last: int) -> str:
        if first == last:
            return str(first)
        mid = (first + last) // 2
        k, r = probes[mid]
        below = f"{key} < {literal(k)}"
        if r != LOWEST:
            below += f" OR ({key} = {literal(k)} AND {row} < {literal(r)})"
        return f"IF({below}, {node(first, mid)}, {node(mid + 1, last)})"

    return node(0, len(probes))


def find_splitters(rows: DataFrame, n_shards: int, tolerance: float = TOLERANCE) -> list[Probe]:
    """The ``n_shards - 1`` splitters on ``(key, row)`` that even out ``size``.

    Each pass counts the bytes between neighbouring probes with one partially aggregated
    job; at most ``(n_shards - 1) * (FAN_OUT + 1)`` sums come back.  A splitter is final
    when it is within the tolerance, or when no row lies between its neighbours.
    """
    total, low, high, row_low, row_high = rows.agg(
        F.sum("size"), F.min("key"), F.max("key"), F.min("row"), F.max("row")
    ).first()
    if not total:
        return []
    start, end = (low, row_low), (high, row_high + 1)
    target = total / n_shards
    brackets = [Bracket(round(target * (i + 1)), start, 0, end, total) for i in range(n_shards - 1)]
    while True:
        for b in brackets:
            if b.done is None:
                b.probes = between(b.low, b.high, FAN_OUT, (row_low, row_high + 1))
                if not b.probes:
                    b.done = min((b.low_bytes, b.low), (b.high_bytes, b.high), key=lambda x: abs(x[0] - b.target))[1]
        probes = sorted({p for b in brackets if b.done is None for p in b.probes})
        if not probes:
            break
        sums = dict(rows.groupBy(F.expr(place_expression(probes)).alias("place")).agg(F.sum("size")).collect())
        below, running = {}, 0
        for i, p in enumerate(probes):
            running += sums.get(i, 0)
            below[p] = running
        for b in brackets:
            if b.done is not None:
                continue
            for p in probes:
                if b.low < p < b.high:
                    if below[p] <= b.target:
                        b.low, b.low_bytes = p, below[p]
                    else:
                        b.high, b.high_bytes = p, below[p]
                        break
            best = min((abs(b.low_bytes - b.target), b.low), (abs(b.high_bytes - b.target), b.high))
            if best[0] <= tolerance * target or b.low_bytes == b.high_bytes:
                b.done = best[1]
    return sorted(b.done for b in brackets)


def shard_rows(
    rows: DataFrame,
    n_shards: int,
    key_column: str,
    size_column: str,
    tolerance: float = TOLERANCE,
    partitions: int | None = None,
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: shards of near equal size, in key order.

    The rows are written once, which gives each a fixed number; that number breaks ties, so
    a key with any share of the rows can be cut.  Splitters come from ``find_splitters``,
    rows take their shard from them without moving, and one range exchange on
    (shard, key, number) sorts them.  The place inside the written, sorted partition less
    what precedes it gives ``slot``, 0, 1, ... in each shard.  ``shard`` and ``slot``
    columns of the input are replaced.

    Null keys come first, null sizes count as zero, repeated rows are placed one by one, an
    empty table gives an empty table.
    """
    spark = rows.sparkSession
    named = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    packed = stage(
        rows.select(
            F.struct(*(F.col(f"`{c}`") for c in named)).alias("kept"),
            F.coalesce(F.col(f"`{key_column}`").cast("bigint"), F.lit(LOWEST)).alias("key"),
            F.coalesce(F.col(f"`{size_column}`").cast("bigint"), F.lit(0)).alias("size"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "unsorted",
    )
    splitters = find_splitters(packed, n_shards, tolerance)
    n = partitions or max(n_shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = packed.withColumn("shard", F.expr(place_expression(splitters)).cast("int"))
    sorted_rows = stage(
        placed.repartitionByRange(n, "shard", "key", "row")
        .sortWithinPartitions("shard", "key", "row")
        .select("kept", "shard", F.monotonically_increasing_id().alias("place")),
        "sorted",
    )
    part = F.shiftright("place", 33)
    counts = sorted_rows.groupBy("shard", part.alias("part")).agg(
        F.min("place").alias("first"), F.count("*").alias("rows")
    )
    # One row per shard and partition that meet, at most n + n_shards: small enough to send.
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("part")) - F.col("rows")
    starts = counts.select("shard", "part", (before - F.col("first")).alias("shift"))
    return (
        sorted_rows.withColumn("part", part)
        .join(F.broadcast(starts), ["shard", "part"])
        .select("kept.*", "shard", (F.col("place") + F.col("shift")).alias("slot"))
    )
