"""Nearest neighbours with one vantage-point tree per shard of the vectors.

Shards are ranges of the vectors sorted by nearest pivot and distance to it.  A query is searched
in the shard it may be nearest to, then, by shuffle, in those shards that its distances to
the pivots do not rule out.

A node keeps, for both halves of its points, the range of their distances to its vantage
point.  By the triangle inequality no point of a half is nearer to a query than the gap
between the query's own distance and that range.  A half is passed over when the gap times
``factor`` exceeds the distance of the query's k-th best so far: factor 1 never loses a
neighbour, larger ones search less.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import type_of
from claimlens.llm.topk import centres
from claimlens.sources.storage import stage

# Vectors per tree (fewer where they are long, more beyond MOST_SHARDS trees), points per leaf,
# and queries that a task searches a tree for.
SHARD_ROWS = 16_384
TREE_NUMBERS = 4_000_000
MOST_SHARDS = 50_000
LEAF = 128
QUERY_BLOCK = 20_000

# Pivots are the centres of a sample of at most so many numbers, 16 vectors a pivot.
MOST_PIVOTS = 256
SAMPLE_NUMBERS = 2_000_000
SAMPLE_A_PIVOT = 16

# At one nothing is lost.  On the test tables larger factors save no time (see README).
FACTOR = 1.0

# The id of a missing neighbour, which also has an infinite distance.
NONE = np.iinfo(np.int64).max


@dataclass
class Tree:
    """Points in leaf order, and per node: range of points, vantage point, halves, gaps."""

    ids: np.ndarray
    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    vantage: np.ndarray
    halves: np.ndarray
    near: np.ndarray
    far: np.ndarray


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances of all queries to all points, from the differences, in blocks.

    Where squares overflow or vanish, the differences are scaled by the largest first; only a
    distance beyond the largest double is infinite.
    """
    out = np.empty((len(queries), len(points)))
    rows = max(1, 2_000_000 // max(1, points.size))
    for i in range(0, len(queries), rows):
        with np.errstate(over="ignore", under="ignore"):
            gap = queries[i : i + rows, None, :] - points[None, :, :]
            squares = np.einsum("qpd,qpd->qp", gap, gap)
            d = np.sqrt(squares)
            odd = ~((squares > 1e-280) & np.isfinite(squares))
            if odd.any():
                gap = np.abs(gap[odd])
                top = gap.max(axis=1)
                exact = top.copy()
                fine = (top > 0) & np.isfinite(top)
                exact[fine] *= np.sqrt(((gap[fine] / top[fine, None]) ** 2).sum(axis=1))
                d[odd] = exact
        out[i : i + rows] = d
    return out


def build_tree(ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Halves each range of points at the median distance to a point of it.

    The halves are equal in number even when distances tie, so equal vectors split as well.
    """
    rng = np.random.default_rng(len(ids))
    order = np.arange(len(ids))
    nodes: list[list] = []

    def add(start: int, end: int) -> int:
        nodes.append([start, end, 0, (-1, -1), (0.0, 0.0), (0.0, 0.0)])
        return len(nodes) - 1

    waiting = [add(0, len(ids))]
    while waiting:
        at = waiting.pop()
        start, end = nodes[at][:2]
        if end - start <= leaf:
            continue
        members = order[start:end]
        vantage = int(members[rng.integers(len(members))])
        d = distances(points[vantage : vantage + 1], points[members])[0]
        rank = np.argsort(d, kind="stable")
        order[start:end], d = members[rank], d[rank]
        mid = (end - start) // 2
        halves = add(start, start + mid), add(start + mid, end)
        nodes[at][2:] = [vantage, halves, (d[0], d[mid]), (d[mid - 1], d[-1])]
        waiting += halves
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    columns = list(zip(*nodes, strict=True))
    return Tree(
        ids[order],
        points[order],
        np.array(columns[0]),
        np.array(columns[1]),
        place[np.array(columns[2])],
        np.array(columns[3]),
        np.array(columns[4]),
        np.array(columns[5]),
    )


def search_tree(
    tree: Tree, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float, bound: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of each query's k nearest, ties to the smaller id.

    Where there are fewer, the id is ``NONE`` and the distance infinite.  Points beyond a
    query's ``bound`` may be missing.

    Points with the query's own id are passed over.  All queries walk the tree together,
    each first to its own leaf, for a first bound, then through what cannot be ruled out.
    """
    best_d = np.full((len(queries), k), np.inf)
    best_i = np.full((len(queries), k), NONE)

    def look(node: int, active: np.ndarray) -> None:
        a, b = tree.start[node], tree.end[node]
        d = distances(queries[active], tree.points[a:b])
        own_id = query_ids[active, None] == tree.ids[None, a:b]
        d[own_id] = np.inf
        all_d = np.concatenate([best_d[active], d], axis=1)
        all_i = np.concatenate([best_i[active], np.where(own_id, NONE, tree.ids[None, a:b])], axis=1)
        first = np.lexsort((all_i, all_d), axis=-1)[:, :k]
        best_d[active] = np.take_along_axis(all_d, first, axis=1)
        best_i[active] = np.take_along_axis(all_i, first, axis=1)

    def gaps(node: int, active: np.ndarray) -> np.ndarray:
        d = distances(queries[active], tree.points[tree.vantage[node]][None])[:, 0]
        # An infinite distance is at least the largest double, and rules nothing out from above.
        most = np.finfo(np.float64).max
        known = np.minimum(d, most)
        starts = np.minimum([tree.near[node, 0], tree.far[node, 0]], most)
        low = np.where(np.isinf(d), 0, starts[:, None] - known)
        high = np.stack([known - tree.near[node, 1], known - tree.far[node, 1]])
        # Less what rounding can add.
        gap = np.maximum(np.maximum(low, high), 0)
        return np.maximum(gap - 1e-9 * gap - 1e-9 * (1 + known), 0)

    own = np.zeros(len(queries), dtype=np.int64)
    inner = tree.halves[own, 0] >= 0
    while inner.any():
        for node in np.unique(own[inner]):
            active = np.flatnonzero(own == node)
            g = gaps(node, active)
            own[active] = tree.halves[node][(g[1] < g[0]).astype(int)]
        inner = tree.halves[own, 0] >= 0
    for node in np.unique(own):
        look(node, np.flatnonzero(own == node))
    waiting = [(0, np.arange(len(queries)))]
    while waiting:
        node, active = waiting.pop()
        if tree.halves[node, 0] < 0:
            active = active[own[active] != node]
            if len(active):
                look(node, active)
            continue
        g = gaps(node, active)
        for half in range(2):
            most = best_d[active, -1] if bound is None else np.minimum(best_d[active, -1], bound[active])
            into = active[g[half] * factor <= most]
            if len(into):
                waiting.append((int(tree.halves[node, half]), into))
    return best_i, best_d


def usable(column: str) -> Column:
    """Not null, without null or non-finite components, not zero."""
    return F.expr(
        f"`{column}` IS NOT NULL AND forall(`{column}`, x -> x IS NOT NULL AND NOT isnan(x) "
        f"AND abs(x) < double('infinity')) AND exists(`{column}`, x -> x <> 0)"
    )


def shard_gaps(away: np.ndarray, pivot: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """No vector of a piece of a shard is nearer to a query, rounding included.

    ``away`` holds the queries' distances to all pivots; a piece is what a shard holds of one
    pivot's vectors, which lie ``low`` to ``high`` from it.
    """
    most = np.finfo(np.float64).max
    to = away[:, pivot]
    known = np.minimum(to, most)
    below = np.where(np.isinf(to), 0, np.minimum(low, most) - known)
    gap = np.maximum(np.maximum(below, known - high), 0)
    return np.maximum(gap - 1e-9 * gap - 1e-9 * (1 + known), 0)


def matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
    query_block: int = QUERY_BLOCK,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``query_id, rank, <id>, score``: the k nearest rows of each query row, nearest first.

    Every usable row is in one shard's tree.  A query's k-th distance in its first shard decides which
    others it is sent to; with factor 1 nothing is lost by that.  Ties go to the smaller id.
    Vectors that are null, zero or
    hold null or non-finite components take no part, nor do rows without an id; a query
    is compared with the vectors of its own dimension.  Rows with the query's id are no
    candidates; other repeated rows each count, and a repeated query is answered as often.
    A query with fewer candidates gets all of them, one without any no row.  An empty table
    gives an empty table.
    """
    rows = stage(
        vectors.filter(usable(vector_column) & F.col(f"`{id_column}`").isNotNull()).select(
            F.col(f"`{id_column}`").cast("bigint").alias("id"),
            F.col(f"`{vector_column}`").cast("array<double>").alias("v"),
            is_query.alias("asks"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "vectors",
    )
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).collect()
    found = None
    for dim, n, asking in sizes:  # as many as there are dimensions
        if asking:
            answer = _of_one_dimension(rows.filter(F.size("v") == dim), dim, n, k, factor, shard_rows, query_block)
            found = answer if found is None else found.union(answer)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "row bigint, query_id bigint, id bigint, score double")
    best = Window.partitionBy("row").orderBy("score", "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select(
        F.col("query_id").cast(type_of(vectors, id_column)),
        F.col("rank").cast("int"),
        F.col("id").cast(type_of(vectors, id_column)).alias(id_column),
        "score",
    )


def _of_one_dimension(rows: DataFrame, dim: int, n: int, k: int, factor: float, shard_rows: int, query_block: int) -> DataFrame:
    """``row, query_id, id, score`` of what may be among each query's k nearest."""
    context = rows.sparkSession.sparkContext
    pivots = int(max(1, min(MOST_PIVOTS, n**0.5 / 4, SAMPLE_NUMBERS // (SAMPLE_A_PIVOT * dim))))
    sample = rows.orderBy(F.xxhash64("id", "row"), "row").limit(SAMPLE_A_PIVOT * pivots).select("v").toArrow()
    points = matrix(sample.column("v").combine_chunks(), sample.num_rows)
    # Squares of very large numbers overflow; any vectors will do as pivots.
    shared = context.broadcast(centres(points, pivots) if np.abs(points).max() < 1e100 else points[:pivots])

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = distances(matrix(batch.column(1), batch.num_rows), shared.value)
                by = away.argmin(axis=1)
                keys = [pa.array(by, pa.int32()), pa.array(away[np.arange(len(by)), by])]
                yield pa.RecordBatch.from_arrays([*batch.columns, *keys], names=["id", "v", "row", "pivot", "away"])

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [
            (*(b.column(c).to_numpy(zero_copy_only=False) for c in (0, 2, 3)), matrix(b.column(1), b.num_rows))
            for b in batches
            if b.num_rows
        ]
        if not held:
            return
        ids, pivot, away, points = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        own = np.unique(pivot)
        ends = [[f(away[pivot == p]) for p in own] for f in (np.min, np.max)]
        columns = [pa.array([pickle.dumps(vars(build_tree(ids, points)))], pa.binary()), pa.array([own.tolist()], pa.list_(pa.int32()))]
        columns += [pa.array([e], pa.list_(pa.float64())) for e in ends]
        yield pa.RecordBatch.from_arrays(columns, names=["tree", "pivot", "low", "high"])

    size = max(1, min(shard_rows, TREE_NUMBERS // dim), n // MOST_SHARDS)
    keyed = stage(
        rows.select("id", "v", "row").mapInArrow(key, "id bigint, v array<double>, row bigint, pivot int, away double"), "keyed-vectors"
    )
    trees = stage(
        keyed.repartitionByRange(-(-n // size), "pivot", "away", "id", "row")
        .select("id", "v", "pivot", "away")
        .mapInArrow(grow, "tree binary, pivot array<int>, low array<double>, high array<double>")
        .withColumn("shard", F.spark_partition_id()),
        "trees",
    )
    # A row a shard and pivot of it: at most as many as shards and pivots together.
    pieces = trees.select("shard", F.explode(F.arrays_zip("pivot", "low", "high")).alias("p")).select("shard", "p.*")
    directory = context.broadcast(tuple(c.to_numpy() for c in pieces.orderBy("shard", "pivot").toArrow().columns))
    slice_rows = max(1, 4_000_000 // (-(-n // size) + pivots))

    def gaps_of(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """All shards, and the least distance each query can have to a vector in them."""
        shard, *piece = directory.value
        starts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
        away = distances(matrix(part.column(1), part.num_rows), shared.value)
        return shard[starts], np.minimum.reduceat(shard_gaps(away, *piece), starts, axis=1)

    pair_type = "shard int, id bigint, v array<double>, row bigint, bound double"
    names = ["shard", "id", "v", "row", "bound"]

    def to_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                shards, gaps = gaps_of(part)
                none = pa.array(np.full(part.num_rows, np.inf))
                yield pa.RecordBatch.from_arrays([pa.array(shards[gaps.argmin(axis=1)], pa.int32()), *part.columns, none], names=names)

    def to_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                part = batch.slice(at, slice_rows)
                shards, gaps = gaps_of(part)
                home, bound = (part.column(c).to_numpy(zero_copy_only=False) for c in (3, 4))
                q, s = np.nonzero((gaps * factor <= bound[:, None]) & (shards[None] != home[:, None]))
                for a in range(0, len(q), 10_000):
                    some = pa.array(q[a : a + 10_000])
                    columns = (part.column(c).take(some) for c in (0, 1, 2, 4))
                    yield pa.RecordBatch.from_arrays([pa.array(shards[s[a : a + 10_000]], pa.int32()), *columns], names=names)

    def search(asks: pa.Table, grown: pa.Table) -> pa.Table:
        tree = Tree(**pickle.loads(grown.column("tree")[0].as_py()))
        ids, bound = (asks.column(c).to_numpy() for c in ("id", "bound"))
        near, d = search_tree(tree, ids, matrix(asks.column("v").combine_chunks(), len(ids)), k, factor, bound)
        good = (near != NONE) & (d <= bound[:, None])
        offsets = pa.array(np.concatenate(([0], np.cumsum(good.sum(axis=1)))), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(c[good])) for c in (near, d)]
        kept = [asks.column(c) for c in ("row", "id", "v", "shard")]
        return pa.table([*kept, *lists], names=["row", "query_id", "v", "home", "ids", "scores"])

    def searched(pairs: DataFrame) -> DataFrame:
        """A shard's queries meet its tree; the tree goes to several tasks if many queries want it."""
        wanted = pairs.groupBy("shard").agg(F.ceil(F.count("*") / query_block).cast("int").alias("tasks"))
        asks = pairs.join(F.broadcast(wanted), "shard").withColumn("task", F.expr("CAST(pmod(xxhash64(row), tasks) AS int)"))
        grown = trees.join(F.broadcast(wanted), "shard").select("shard", F.expr("explode(sequence(0, tasks - 1))").alias("task"), "tree")
        both = asks.groupBy("shard", "task").cogroup(grown.groupBy("shard", "task"))
        return both.applyInArrow(search, "row bigint, query_id bigint, v array<double>, home int, ids array<bigint>, scores array<double>")

    at_home = stage(rows.filter("asks").select("id", "v", "row").mapInArrow(to_home, pair_type), "home-pairs")
    first = stage(searched(at_home), "home-found")
    kth = F.when(F.size("scores") == k, F.element_at("scores", -1)).otherwise(F.lit(float("inf")))
    away = first.select(F.col("query_id").alias("id"), "v", "row", "home", kth.alias("bound")).mapInArrow(to_others, pair_type)
    second = searched(stage(away, "away-pairs"))
    columns = "row", "query_id", "ids", "scores"
    return (
        first.select(*columns)
        .union(second.select(*columns))
        .select("row", "query_id", F.explode(F.arrays_zip("ids", "scores")).alias("f"))
        .select("row", "query_id", F.col("f.ids").alias("id"), F.col("f.scores").alias("score"))
    )
