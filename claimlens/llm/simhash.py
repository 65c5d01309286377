"""SimHash near-duplicates: fingerprints joined with themselves by walking a binary trie.

Two fingerprints within ``max_bits`` bits agree in at least one of ``max_bits + 1`` blocks of
bits.  So the trie is kept in as many rotations, each with another block first.  Its first
levels, the leading block, are walked by the shuffle, on equal bits only; below, a task
walks pairs of nodes together, adds up the bits in which they differ and leaves a pair as
soon as it exceeds the budget.  No link is lost.  Nodes with very many fingerprints are
walked further by the shuffle, as pairs of nodes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import few_rows, type_of, utf8
from claimlens.llm.components import connected
from claimlens.sources.storage import stage

SHINGLE = 3
MAX_BITS = 3

# Fingerprints of a trie node that one task may walk; larger nodes are split by STEP bits.
NODE_BOUND = 500_000
STEP = 8

# Shingle hashes held at a time, node pairs walked at a time, rows gathered before a walk.
HASHES_AT_A_TIME = 500_000
PAIRS_AT_A_TIME = 32_000
ROWS_AT_A_TIME = 200_000


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, lowest first.

    Eight bits are added at once, one per byte of a word, in blocks of 255 so that no byte
    overflows.
    """
    starts = np.arange(0, len(hashes), 255)
    counts = np.empty((8, 8), dtype=np.int64)
    for k in range(8):
        lanes = (hashes >> np.uint64(k)) & np.uint64(0x0101010101010101)
        sums = np.add.reduceat(lanes, starts)
        counts[:, k] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.reshape(64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the hashes of the word shingles; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, dtype=np.int64)
    for first in range(0, n, HASHES_AT_A_TIME):
        part = words[first : first + min(HASHES_AT_A_TIME, n - first) + shingle - 1]
        shifted = [part[k:] for k in range(shingle)] if len(words) >= shingle else [[b" ".join(part)]]
        hashes = [xxh64_intdigest(b" ".join(t), 42) for t in zip(*shifted)]
        counts += bit_counts(np.array(hashes, dtype=np.uint64))
    bits = counts * 2 > n
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Id and ``fingerprint`` (the 64 bits as a signed number) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            values = [fingerprint(t, shingle) for t in batch.column(1).to_pylist()]
            signed = np.array(values, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(signed)], names=["id", "fingerprint"]
            )

    narrow = docs.select(F.col(f"`{id_column}`").alias("id"), utf8(text_column).alias("text"))
    out = narrow.mapInArrow(run, f"id {type_of(narrow, 'id')}, fingerprint bigint")
    return out.withColumnRenamed("id", id_column)


def merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the sets of each pair; ``parent`` leads from every place straight to its root."""
    while True:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def walk(values: np.ndarray, starts: list[tuple[int, int, int, int, int, int]], budget: int) -> np.ndarray:
    """Sets of linked places among sorted distinct ``values``, as each place's root.

    ``starts`` are node pairs (depth, from, to, from, to, bits so far); a node is the range of
    places that share its first ``depth`` bits, and a pair of a node with itself stands for the
    pairs within it.
    """
    parent = np.arange(len(values), dtype=np.int32)
    ones: dict[int, np.ndarray] = {}

    def ones_before(depth: int) -> np.ndarray:
        if depth not in ones:
            bits = (values >> np.uint64(63 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate(([0], np.cumsum(bits, dtype=np.int32)))
        return ones[depth]

    stack = []
    by_depth: dict[int, list] = {}
    for depth, *pair in starts:
        by_depth.setdefault(depth, []).append(pair)
    for depth, pairs in by_depth.items():
        stack.append((depth, np.array(pairs, dtype=np.int32)))
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > PAIRS_AT_A_TIME:
            stack.append((depth, pairs[PAIRS_AT_A_TIME:]))
            pairs = pairs[:PAIRS_AT_A_TIME]
        lo1, hi1, lo2, hi2, bits = pairs.T
        single = (hi1 - lo1 == 1) & (hi2 - lo2 == 1)
        if single.any():
            i, j = lo1[single], lo2[single]
            near = (np.bitwise_count(values[i] ^ values[j]) <= budget) & (i != j)
            merge(parent, i[near], j[near])
            lo1, hi1, lo2, hi2, bits = pairs[~single].T
        if depth == 64 or not len(lo1):
            continue
        before = ones_before(depth)
        s1, s2 = hi1 - (before[hi1] - before[lo1]), hi2 - (before[hi2] - before[lo2])
        other = lo1 != lo2
        children = np.concatenate(
            [
                np.stack([lo1, s1, lo2, s2, bits], axis=1),
                np.stack([s1, hi1, s2, hi2, bits], axis=1),
                np.stack([lo1, s1, s2, hi2, bits + 1], axis=1),
                np.stack([s1, hi1, lo2, s2, bits + 1], axis=1)[other],
            ]
        )
        lo1, hi1, lo2, hi2, bits = children.T
        alone = (lo1 == lo2) & (hi1 - lo1 == 1)
        children = children[(hi1 > lo1) & (hi2 > lo2) & (bits <= budget) & ~alone]
        if len(children):
            stack.append((depth + 1, children))
    return parent


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, node_bound: int = NODE_BOUND) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints that span the linked ones.

    ``prints`` has one row per distinct ``fingerprint``.  Of the pairs within ``max_bits`` bits
    only as many come out as hold the linked fingerprints together.
    """
    blocks = max_bits + 1
    width = 64 // blocks
    turned = prints.select(F.explode(F.array(*(F.lit(width * k) for k in range(blocks)))).alias("turn"), "fingerprint")
    turned = turned.select(
        "turn",
        F.expr("shiftleft(fingerprint, turn) | IF(turn = 0, 0L, shiftrightunsigned(fingerprint, 64 - turn))").alias("bits"),
    )
    top = F.expr(f"shiftrightunsigned(bits, {64 - width})")
    nodes = turned.select("turn", F.lit(width).alias("depth"), top.alias("p"), top.alias("q"), "bits")
    keys = ["turn", "depth", "p", "q"]
    done = None
    masks = [m for m in range(1 << STEP) if m.bit_count() <= max_bits]
    depth = width
    while True:
        large = nodes.groupBy(*keys).count().filter(F.col("count") > node_bound).drop("count")
        if depth + STEP >= 64 or large.isEmpty():
            done = nodes if done is None else done.union(nodes)
            break
        large = stage(large, "large-nodes")
        small = nodes.join(large, keys, "left_anti")
        done = small if done is None else done.union(small)
        depth += STEP
        own = f"shiftrightunsigned(bits, {64 - depth})"
        nodes = stage(
            nodes.join(large, keys, "left_semi")
            .withColumn("own", F.expr(own))
            .withColumn("mask", F.explode(F.array(*(F.lit(m) for m in masks))))
            .withColumn(
                "other",
                F.expr(f"(shiftleft(IF(shiftright(own, {STEP}) = p, q, p), {STEP}) | (own & {(1 << STEP) - 1}L)) ^ CAST(mask AS BIGINT)"),
            )
            .filter(f"bit_count(own ^ other) <= {max_bits}")
            .select("turn", F.lit(depth).alias("depth"), F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "bits"),
            "split-nodes",
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            waiting.append(np.stack(columns, axis=1))
            if sum(map(len, waiting)) >= ROWS_AT_A_TIME:
                rows = np.concatenate(waiting)
                new = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
                if len(new):
                    yield links(rows[: new[-1]])
                    rows = rows[new[-1] :]
                waiting = [rows]
        if waiting and sum(map(len, waiting)):
            yield links(np.concatenate(waiting))

    def links(rows: np.ndarray) -> pa.RecordBatch:
        values = np.ascontiguousarray(rows[:, 4]).view(np.uint64)
        first = np.concatenate(([0], np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1))
        after = np.concatenate((first[1:], [len(rows)]))
        starts = []
        for lo, hi, (turn, depth, p, q) in zip(first.tolist(), after.tolist(), rows[first, :4].tolist(), strict=True):
            if hi - lo < 2:
                continue
            if p == q:
                starts.append((depth, lo, hi, lo, hi, 0))
                continue
            mid = lo + int(np.count_nonzero((values[lo:hi] >> np.uint64(64 - depth)) == np.uint64(p)))
            if lo < mid < hi:
                starts.append((depth, lo, mid, mid, hi, (p ^ q).bit_count()))
        parent = walk(values, starts, max_bits)
        turn = rows[:, 0].astype(np.uint64)
        back = (np.uint64(64) - turn) % np.uint64(64)
        whole = ((values >> turn) | np.where(turn == 0, np.uint64(0), values << back)).view(np.int64)
        lowest = whole.copy()
        np.minimum.at(lowest, parent, whole)
        centre = lowest[parent]
        tied = centre != whole
        return pa.RecordBatch.from_arrays([pa.array(whole[tied]), pa.array(centre[tied])], names=["a", "b"])

    # Unsigned order of the bits, as the walk needs it.
    in_order = done.withColumn("order", F.expr("bits ^ (-9223372036854775807L - 1L)"))
    dealt = in_order.repartition(*keys).sortWithinPartitions(*keys, "order").select(*keys, "bits")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def simhash_clusters(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    id_column: str = "doc_id",
    text_column: str = "text",
    node_bound: int = NODE_BOUND,
) -> DataFrame:
    """Id, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    Words are what lies between ASCII white space after lower-casing A-Z; a shingle is
    ``shingle`` consecutive words, or all words if there are fewer.  Fingerprints with at most
    ``max_bits`` different bits are linked; ``component_id`` is the smallest id reachable over
    links, the row's own included.

    A null or empty text, and one without words, has fingerprint 0, linked like any other.
    Null ids are not counted as smallest; a component without any other id gets null.
    Repeated rows each come out, other columns are not read, an empty table gives an empty
    table.
    """
    prints = stage(
        fingerprints(docs, shingle, id_column, text_column).withColumnRenamed(id_column, "id"), "fingerprints"
    )
    distinct = stage(
        prints.groupBy("fingerprint").agg(F.min("id").alias("first"), F.count("*").alias("copies")), "distinct"
    )
    roots = connected(near_links(distinct.select("fingerprint"), max_bits, node_bound))
    # A root is tied to itself, so that its members find the smallest id of all.
    tied = roots.union(roots.select("root", "root").distinct())
    several = distinct.join(tied, F.col("fingerprint") == F.col("node"), "left").filter("copies > 1 OR root IS NOT NULL")
    several = several.select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    several = stage(several, "several")
    smallest = stage(several.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    found = several.join(smallest, "root").select("fingerprint", "component_id")
    return (
        prints.join(found, "fingerprint", "left")
        .select(
            F.col("id").alias(id_column),
            F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
    )
