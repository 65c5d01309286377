"""Exact search for the greatest inner products over a pivot-distance index.

Vectors get one more number, sqrt(M^2 - |x|^2) with M the greatest norm, queries a zero.  Then the
greatest product is the smallest distance: |q - x|^2 = |q|^2 + M^2 - 2 q.x.  Every vector is keyed by
its nearest pivot and its distance to it, and the index is sorted by that key.  A stretch of it with
one pivot is an annulus.  By the triangle inequality nothing in it is nearer to a query than the gap
between the query's distance to the pivot and the annulus, nor than half of what the pivot is
farther away than the query's nearest one, so no product in it exceeds a bound.  Annuli are
opened in order of that bound until it falls below the k-th best product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import type_of
from claimlens.sources.storage import stage

# Vectors of a shard, the annuli it is opened by, and the queries searched together.  There are at
# most MOST_SHARDS shards (larger ones beyond), so the table of their ranges stays below 4 MB.
SHARD_ROWS = 16_384
MOST_SHARDS = 50_000
ANNULUS = 512
QUERY_ROWS = 1024

# A shard that more queries want is searched by several tasks.
TASK_QUERIES = 20_000

# Pivots are the centres of a sample of at most so many numbers, 16 vectors a pivot.
MOST_PIVOTS = 512
SAMPLE_NUMBERS = 4_000_000
SAMPLE_A_PIVOT = 16

LOWEST = np.iinfo(np.int64).min


class Space:
    """Pivots, greatest norm and number type of the vectors of one dimension."""

    def __init__(self, pivots: np.ndarray, top: float, dim: int, largest: int):
        self.pivots, self.top, self.dim, self.largest = pivots, top, dim, largest
        self.squares = (pivots**2).sum(axis=1)
        self.kind = np.dtype("<i2" if largest < 2**15 else "<i8")

    def matrix(self, column: pa.Array) -> np.ndarray:
        parts = column.to_pylist()
        return np.frombuffer(b"".join(parts), dtype=self.kind).reshape(len(parts), self.dim)

    def lifted(self, points: np.ndarray) -> np.ndarray:
        points = points.astype(np.float64)
        rest = self.top - (points**2).sum(axis=1)
        return np.hstack([points, np.sqrt(np.maximum(rest, 0))[:, None]])

    def gaps(self, points: np.ndarray) -> np.ndarray:
        """Distances of lifted points to all pivots."""
        square = (points**2).sum(axis=1)[:, None] - 2 * (points @ self.pivots.T) + self.squares
        return np.sqrt(np.maximum(square, 0))

    def products(self, queries: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Exact integer products; beyond 64 bits the least or greatest such number."""
        size = float(self.largest) ** 2 * max(1, self.dim)
        if size < 2**53:
            return (queries.astype(np.float64) @ points.astype(np.float64).T).astype(np.int64)
        if size < 2**62:
            return queries.astype(np.int64) @ points.astype(np.int64).T
        exact = queries.astype(object) @ points.astype(object).T
        return np.clip(exact, LOWEST, np.iinfo(np.int64).max).astype(np.int64)

    def bounds(
        self, queries: np.ndarray, pivot: np.ndarray, low: np.ndarray, high: np.ndarray, norm: np.ndarray
    ) -> np.ndarray:
        """No product of a query and a vector of an annulus is larger, rounding included."""
        points = np.hstack([queries.astype(np.float64), np.zeros((len(queries), 1))])
        away = self.gaps(points)
        own = (points**2).sum(axis=1)[:, None]
        to = away[:, pivot]
        gap = np.maximum(np.maximum(to - high, low - to), (to - away.min(axis=1)[:, None]) / 2)
        scale = own + self.top
        by_gap = (scale - np.maximum(gap, 0) ** 2) / 2
        return np.minimum(by_gap, np.sqrt(own) * norm) + 1e-6 * (scale + self.squares.max()) + 1


def centres(sample: np.ndarray, pivots: int, rounds: int = 8) -> np.ndarray:
    """Pivots by Lloyd's iteration, from evenly chosen rows; a centre without rows stays."""
    chosen = sample[np.linspace(0, len(sample) - 1, min(pivots, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        away = (chosen**2).sum(axis=1) - 2 * (sample @ chosen.T)
        nearest = away.argmin(axis=1)
        for p in np.unique(nearest):
            chosen[p] = sample[nearest == p].mean(axis=0)
    return chosen


def best_of(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of flat (row, id, score) the k greatest scores of each row, ties to the smaller id."""
    order = np.lexsort((ids, ~scores, rows))  # ~ turns the order round and cannot overflow
    rows, ids, scores = rows[order], ids[order], scores[order]
    first = np.searchsorted(rows, rows, side="left")
    top = np.arange(len(rows)) - first < k
    return rows[top], ids[top], scores[top]


def search_shard(
    space: Space,
    data: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray],
    query_ids: np.ndarray,
    queries: np.ndarray,
    bound: np.ndarray,
    k: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, score) of each query's k best in the shard that reach its bound.

    ``data`` has pivot, distance, id and vector of the shard's rows, in the order of the index.
    """
    pivot, away, ids, points = data
    edges = np.flatnonzero(np.concatenate(([True], pivot[1:] != pivot[:-1])))
    starts = np.concatenate([np.arange(a, b, ANNULUS) for a, b in zip(edges, [*edges[1:], len(pivot)], strict=True)])
    ends = np.concatenate([starts[1:], [len(pivot)]])
    norm = np.sqrt(np.maximum.reduceat((points.astype(np.float64) ** 2).sum(axis=1), starts))
    most = space.bounds(queries, pivot[starts], away[starts], away[ends - 1], norm)
    order = np.argsort(-most, axis=1)
    kth = bound.copy()
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    asking = np.arange(len(queries))
    for step in range(len(starts)):
        at = order[asking, step]
        # A k-th best of the least number there is rules nothing out.
        live = (most[asking, at] >= kth[asking]) | (kth[asking] == LOWEST)
        asking, at = asking[live], at[live]
        if not len(asking):
            break
        fresh = [found]
        for a in np.unique(at):
            rows = asking[at == a]
            part = slice(starts[a], ends[a])
            scores = space.products(queries[rows], points[part])
            other = query_ids[rows][:, None] != ids[part][None]
            least = kth[rows]
            if scores.shape[1] > k:
                ranked = np.where(other, scores, LOWEST)
                least = np.maximum(least, np.partition(ranked, -k, axis=1)[:, -k])
            q, p = np.nonzero((scores >= least[:, None]) & other)
            fresh.append((rows[q], ids[part][p], scores[q, p]))
        found = best_of(*(np.concatenate(c) for c in zip(*fresh, strict=True)), k)
        full, counts = np.unique(found[0], return_counts=True)
        ends_of = np.cumsum(counts) - 1
        done = counts == k
        kth[full[done]] = np.maximum(kth[full[done]], found[2][ends_of[done]])
    return found


def usable(column: str) -> Column:
    """Not null, without null or non-finite components."""
    return F.expr(
        f"`{column}` IS NOT NULL AND forall(`{column}`, x -> x IS NOT NULL AND NOT isnan(x) "
        f"AND abs(x) < double('infinity'))"
    )


def _search(pairs: DataFrame, index: DataFrame, space: Space, k: int, out: str) -> DataFrame:
    """Rows of ``out`` from searching each of ``pairs`` (shard and query) in its shard.

    The rows of a shard and then its queries stream through one task; shards that many
    queries want go to several.
    """
    wanted = pairs.groupBy("shard").agg(F.ceil(F.count("*") / TASK_QUERIES).cast("int").alias("tasks"))
    # At most a row a shard, of which there is a bounded number.
    data = index.join(F.broadcast(wanted), "shard").select(
        "shard",
        F.explode(F.expr("sequence(0, tasks - 1)")).alias("task"),
        F.lit(0).alias("kind"),
        "pivot",
        "away",
        "id",
        "v",
        *(F.lit(None).cast("bigint").alias(c) for c in ("row", "bound")),
    )
    asks = pairs.join(F.broadcast(wanted), "shard").select(
        "shard",
        F.expr("CAST(pmod(xxhash64(row), tasks) AS int)").alias("task"),
        F.lit(1).alias("kind"),
        F.lit(0).alias("pivot"),
        F.lit(0.0).alias("away"),
        "id",
        "v",
        "row",
        "bound",
    )
    both = data.union(asks).repartition("shard", "task").sortWithinPartitions("shard", "task", "kind", "pivot", "away", "id", "row")
    with_home = "home" in out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        data = None
        of = None
        for batch in batches:
            shard, task, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            change = (shard[1:] != shard[:-1]) | (task[1:] != task[:-1]) | (kind[1:] != kind[:-1])
            cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if of != (shard[a], task[a]):
                    of, held, data = (shard[a], task[a]), [], None
                if kind[a] == 0:
                    columns = (part.column(c).to_numpy(zero_copy_only=False) for c in (3, 4, 5))
                    held.append((*columns, space.matrix(part.column(6))))
                    continue
                if data is None:
                    data = tuple(np.concatenate(c) for c in zip(*held, strict=True))
                for at in range(0, part.num_rows, QUERY_ROWS):
                    some = part.slice(at, QUERY_ROWS)
                    ids, rows = (some.column(c).to_numpy(zero_copy_only=False) for c in (5, 7))
                    bound = some.column(8).fill_null(LOWEST).to_numpy(zero_copy_only=False)
                    q, near, scores = search_shard(space, data, ids, space.matrix(some.column(6)), bound, k)
                    if with_home:
                        offsets = np.searchsorted(q, np.arange(some.num_rows + 1))
                        lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(c)) for c in (near, scores)]
                        home = pa.array(np.full(some.num_rows, of[0], dtype=np.int32))
                        columns = [some.column(7), some.column(5), some.column(6), home, *lists]
                        names = ["row", "query_id", "v", "home", "ids", "scores"]
                    else:
                        columns = [pa.array(rows[q]), pa.array(ids[q]), pa.array(near), pa.array(scores)]
                        names = ["row", "query_id", "id", "score"]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return both.mapInArrow(run, out)


def top_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256,
    shard_rows: int = SHARD_ROWS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, <id>, score``: the k rows with the greatest inner product with each query row.

    Components are scaled and rounded down to whole numbers; products are exact.  Ties go to the smaller
    id.  First each query is searched in the shard with the greatest bound; its k-th best
    product then decides which other shards it is sent to.  Nothing is lost by that.

    Vectors that are null or hold null or non-finite components take no part, nor do rows without an id;
    a query is compared with vectors of its own dimension (zero vectors and empty ones count).  Rows with
    the query's id are no candidates; other repeated rows each count, and a repeated query is
    answered as often.  A query with fewer candidates gets all of them.  Components and products beyond
    64 bits become the least or greatest such number.  An empty table gives an empty table.
    """
    whole = F.expr(f"transform(`{vector_column}`, x -> floor({float(scale)}D * double(x)))")
    rows = stage(
        vectors.filter(usable(vector_column) & F.col(f"`{id_column}`").isNotNull()).select(
            F.col(f"`{id_column}`").cast("bigint").alias("id"),
            whole.alias("v"),
            is_query.alias("asks"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "whole-vectors",
    )
    square = F.expr("aggregate(v, 0D, (a, x) -> a + double(x) * double(x))")
    largest = F.expr("array_max(transform(v, x -> abs(double(x))))")
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(
        F.count("*").alias("n"), F.count_if("asks").alias("q"), F.max(square).alias("top"), F.max(largest).alias("largest")
    )
    found = None
    for dim, n, asking, top, most in sizes.collect():  # as many as there are dimensions
        if asking:
            answer = _of_one_dimension(rows.filter(F.size("v") == dim), dim, n, top, int(most or 0), k, shard_rows)
            found = answer if found is None else found.union(answer)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "row bigint, query_id bigint, id bigint, score bigint")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(
        F.col("query_id").cast(type_of(vectors, id_column)),
        F.col("rank").cast("int"),
        F.col("id").cast(type_of(vectors, id_column)).alias(id_column),
        "score",
    )


def _of_one_dimension(rows: DataFrame, dim: int, n: int, top: float, largest: int, k: int, shard_rows: int) -> DataFrame:
    spark = rows.sparkSession
    pivots = int(max(1, min(MOST_PIVOTS, n**0.5 / 4, SAMPLE_NUMBERS // (SAMPLE_A_PIVOT * (dim + 1)))))
    sample = rows.orderBy(F.xxhash64("id", "row"), "row").limit(SAMPLE_A_PIVOT * pivots).select("v").toArrow()
    flat = sample.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    plain = Space(np.zeros((1, dim + 1)), top, dim, largest)
    space = Space(centres(plain.lifted(flat.reshape(sample.num_rows, dim)), pivots), top, dim, largest)
    shared = spark.sparkContext.broadcast(space)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = shared.value
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, space.dim)
            away = space.gaps(space.lifted(flat))
            nearest = away.argmin(axis=1)
            packed = [r.tobytes() for r in np.ascontiguousarray(flat.astype(space.kind))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(packed, pa.binary()),
                    batch.column(2),
                    batch.column(3),
                    pa.array(nearest, pa.int32()),
                    pa.array(away[np.arange(len(away)), nearest]),
                    pa.array(np.sqrt((flat.astype(np.float64) ** 2).sum(axis=1))),
                ],
                names=["id", "v", "asks", "row", "pivot", "away", "norm"],
            )

    keyed = stage(
        rows.select("id", "v", "asks", "row").mapInArrow(
            key, "id bigint, v binary, asks boolean, row bigint, pivot int, away double, norm double"
        ),
        "keyed-vectors",
    )
    shards = -(-n // max(shard_rows, n // MOST_SHARDS))
    order = ("pivot", "away", "id", "row")
    index = stage(
        keyed.repartitionByRange(shards, *order).sortWithinPartitions(*order).withColumn("shard", F.spark_partition_id()),
        "pivot-index",
    )
    ranges = index.groupBy("shard", "pivot").agg(F.min("away"), F.max("away"), F.max("norm")).orderBy("shard", "pivot").toArrow()
    shard, pivot, low, high, norm = (c.to_numpy() for c in ranges.columns)
    directory = spark.sparkContext.broadcast((shard, pivot, low, high, norm))

    def shard_bounds(queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shard, pivot, low, high, norm = directory.value
        starts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
        bounds = shared.value.bounds(queries, pivot, low, high, norm)
        return shard[starts], np.maximum.reduceat(bounds, starts, axis=1)

    # Queries whose bounds are held at a time.
    slice_rows = max(1, 4_000_000 // len(shard))
    pair_type = "shard int, id bigint, v binary, row bigint, bound bigint"
    names = ["shard", "id", "v", "row", "bound"]

    def to_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                shards, bounds = shard_bounds(shared.value.matrix(part.column(1)))
                home = pa.array(shards[bounds.argmax(axis=1)], pa.int32())
                none = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([home, *part.columns, none], names=names)

    def to_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                home, kth = (part.column(c).to_numpy(zero_copy_only=False) for c in (3, 4))
                shards, bounds = shard_bounds(shared.value.matrix(part.column(1)))
                wanted = ((bounds >= kth[:, None]) | (kth[:, None] == LOWEST)) & (shards[None] != home[:, None])
                q, s = np.nonzero(wanted)
                for a in range(0, len(q), 10_000):
                    some = pa.array(q[a : a + 10_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shards[s[a : a + 10_000]], pa.int32()), *(part.column(c).take(some) for c in (0, 1, 2, 4))],
                        names=names,
                    )

    at_home = stage(keyed.filter("asks").select("id", "v", "row").mapInArrow(to_home, pair_type), "home-pairs")
    first = stage(
        _search(at_home, index, space, k, "row bigint, query_id bigint, v binary, home int, ids array<bigint>, scores array<bigint>"),
        "home-found",
    )
    kth = F.when(F.size("scores") == k, F.element_at("scores", -1)).otherwise(F.lit(LOWEST))
    away = first.select(F.col("query_id").alias("id"), "v", "row", "home", kth.alias("bound")).mapInArrow(to_others, pair_type)
    second = _search(stage(away, "away-pairs"), index, space, k, "row bigint, query_id bigint, id bigint, score bigint")
    flat_first = first.select("row", "query_id", F.explode(F.arrays_zip("ids", "scores")).alias("f")).select(
        "row", "query_id", F.col("f.ids").alias("id"), F.col("f.scores").alias("score")
    )
    return flat_first.union(second)
