"""Periodic runs of words, found as maximal pairs in the LCP-interval tree of each text.

A maximal pair is two places that share L words, with different words before and after.
If the places are d words apart and L is at least (exponent - 1) * d, the L + d words from the
first place on have period d and no neighbouring word carries it on: they are a run, with
nothing left to extend.  So each run is read off one pair of a node of depth L.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import few_rows, kept_and, utf8

MIN_LENGTH = 24
MIN_EXPONENT = 3

# Texts are searched together up to so many bytes; a longer text is searched alone.
GROUP_BYTES = 4_000_000

# From so many left words on a node also keeps its places in one list.
MANY_CLASSES = 16

Run = tuple[int, int, int]


class Places:
    """A node's places: sorted lists by the word on their left, if many words also all in one."""

    __slots__ = ("by_left", "everywhere", "size")

    def __init__(self, left: int, place: int):
        self.by_left = {left: [place]}
        self.everywhere: list[int] | None = None
        self.size = 1

    def near(self, place: int, left: int, reach: int) -> Iterator[int]:
        """Places at most ``reach`` away whose left word is another."""
        if self.everywhere is not None:
            a = bisect_left(self.everywhere, place - reach)
            b = bisect_right(self.everywhere, place + reach, a)
            if b - a < len(self.by_left):
                for k in range(a, b):
                    other = self.everywhere[k]
                    own = self.by_left.get(left, ())
                    at = bisect_left(own, other)
                    if at == len(own) or own[at] != other:
                        yield other
                return
        for word, found in self.by_left.items():
            if word != left:
                k = bisect_left(found, place - reach)
                while k < len(found) and found[k] <= place + reach:
                    yield found[k]
                    k += 1

    def take(self, other: Places) -> None:
        """Add the places of a node that is not larger."""
        if self.everywhere is not None:
            for found in other.by_left.values():
                for place in found:
                    insort(self.everywhere, place)
        for word, found in other.by_left.items():
            own = self.by_left.get(word)
            if own is None:
                self.by_left[word] = found
            elif len(found) == 1:
                insort(own, found[0])
            else:
                own += found
                own.sort()
        self.size += other.size
        if self.everywhere is None and len(self.by_left) > MANY_CLASSES:
            self.everywhere = sorted(p for found in self.by_left.values() for p in found)


def repeated_places(words: np.ndarray, least: int) -> np.ndarray:
    """Places whose next 2^k words, the most with 2^k <= least, stand elsewhere too."""
    rank = words.copy()
    places = np.flatnonzero(np.bincount(words)[words] > 1)
    keep = np.zeros(len(words), dtype=bool)
    keep[places] = True
    size = 1
    while 2 * size <= least and len(places):
        places = places[keep[places + size]]
        keys = rank[places] * len(words) + rank[places + size]
        order = np.argsort(keys)
        keys = keys[order]
        new = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=bool)
        group = np.cumsum(new) - 1
        often = np.bincount(group, minlength=1)[group] > 1 if len(group) else new
        keep[:] = False
        places, group = places[order][often], group[often]
        rank[places] = group
        keep[places] = True
        size *= 2
    return places


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in the order of what follows them, and each one's rank in it.

    Prefixes are doubled; a place is sorted again only while others share its prefix.  The
    numbers that end the texts occur once, so no comparison crosses a text's end.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    first = np.concatenate(([True], words[order][1:] != words[order][:-1]))
    start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = start
    open_places = order[np.bincount(start, minlength=n)[start] > 1]
    size = 1
    while len(open_places):
        keys = rank[open_places] * n + rank[open_places + size]
        by_key = np.argsort(keys)
        open_places, keys = open_places[by_key], keys[by_key]
        old = rank[open_places]
        at = np.arange(len(keys))
        new_old = np.concatenate(([True], old[1:] != old[:-1]))
        new_key = np.concatenate(([True], keys[1:] != keys[:-1]))
        from_old = np.maximum.accumulate(np.where(new_old, at, 0))
        from_key = np.maximum.accumulate(np.where(new_key, at, 0))
        rank[open_places] = old + from_key - from_old
        group = np.cumsum(new_key) - 1
        open_places = open_places[np.bincount(group)[group] > 1]
        size *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order, rank


def common_words(words: list[int], order: list[int], rank: list[int]) -> list[int]:
    """Per place in the order, how many words it shares with the one before it."""
    shared = [0] * len(words)
    h = 0
    for i, r in enumerate(rank):
        if r:
            j = order[r - 1]
            while words[i + h] == words[j + h]:
                h += 1
            shared[r] = h
            if h:
                h -= 1
        else:
            h = 0
    return shared


def maximal_pairs(
    words: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> dict[tuple[int, int], int]:
    """(start, length) to the least period of every run; ``words`` ends each text with a number of its own.

    The tree is walked bottom-up on a stack.  When a child joins its parent of depth L, each place of
    the smaller of both is paired with those of the other that have another left word
    and are near enough: at most L / (exponent - 1) away.
    """
    order, rank = suffix_order(words)
    order, words = order.tolist(), words.tolist()
    shared = common_words(words, order, rank.tolist())
    least = -(-min_length * (min_exponent - 1) // min_exponent)
    runs: dict[tuple[int, int], int] = {}

    def join(one: Places, other: Places, depth: int) -> Places:
        large, small = (one, other) if one.size >= other.size else (other, one)
        reach, nearest = depth // (min_exponent - 1), max(1, min_length - depth)
        if len(large.by_left) > 1 or large.by_left.keys() != small.by_left.keys():
            for left, places in small.by_left.items():
                for place in places:
                    for found in large.near(place, left, reach):
                        period = abs(found - place)
                        if period >= nearest:
                            key = min(found, place), depth + period
                            if period < runs.get(key, period + 1):
                                runs[key] = period
        large.take(small)
        return large

    stack: list[list] = []
    last: Places | None = None
    for place, depth in zip(order, [*shared[1:], 0], strict=True):
        if last is None and depth < least:
            continue
        node = Places(words[place - 1], place)
        while stack and stack[-1][0] > depth:
            at, above = stack.pop()
            node = join(above, node, at)
        if depth < least:
            last = None
        else:
            if stack and stack[-1][0] == depth:
                stack[-1][1] = join(stack[-1][1], node, depth)
            else:
                stack.append([depth, node])
            last = node
    return runs


def runs_of_texts(
    texts: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> list[list[Run]]:
    """(start, length, period) of the runs of each text, by start, then period."""
    numbers: list[int] = []
    starts = [0]
    base = 0
    for words in texts:
        distinct = dict.fromkeys(words)
        number = dict(zip(distinct, range(base, base + len(distinct)), strict=True))
        numbers += map(number.__getitem__, words)
        base += len(distinct)
        numbers.append(base)
        base += 1
        starts.append(len(numbers))
    found: list[list[Run]] = [[] for _ in texts]
    if not texts:
        return found
    flat = np.array(numbers, dtype=np.int64)
    begin = np.array(starts)
    least = -(-min_length * (min_exponent - 1) // min_exponent)
    # No pair of the wanted depth lies in a text where so many words never repeat.
    places = repeated_places(flat, least)
    some = np.unique(np.searchsorted(begin, places, side="right") - 1)
    if not len(some):
        return found
    parts = [flat[begin[i] : begin[i + 1]] for i in some]
    at = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    for (start, length), period in maximal_pairs(np.concatenate(parts), min_length, min_exponent).items():
        k = int(np.searchsorted(at, start, side="right")) - 1
        found[some[k]].append((start - int(at[k]), length, period))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by single spaces, without those of a run after its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), dtype=bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def find_runs(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``runs``, an array of (start, length, period), and ``collapsed``, the text without them.

    Words are what stands between ASCII white space, numbered from 0.  A run is a stretch of at least
    ``min_length`` words that repeats its smallest period at least ``min_exponent`` (2 or more)
    times and that no neighbouring word carries on.  Runs are ordered by start, then period.
    ``collapsed`` has the remaining words joined by single spaces.

    Null and empty texts, and those of white space, have no runs and an empty ``collapsed``.  Whole texts are
    searched, whatever their length, in space and nearly in time proportional to their
    words.  Each row is searched for itself, so repeated rows get equal results; other columns
    pass through, but for those named ``runs`` or ``collapsed``, which are replaced.  An
    empty table gives an empty table.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has at least two words and repeats its period at least twice")
    others = [c for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    slim = docs.select(F.struct(F.lit(0), *(F.col(f"`{c}`") for c in others)).alias("kept"), utf8(text_column).alias("text"))
    run_type = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                done = sizes[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(sizes, done + GROUP_BYTES, side="right")))
                part = batch.slice(at, to - at)
                words = [(t or b"").split() for t in part.column(1).to_pylist()]
                found = runs_of_texts(words, min_length, min_exponent)
                left = [collapse(w, r) for w, r in zip(words, found, strict=True)]
                flat = [dict(zip(("start", "length", "period"), r, strict=True)) for runs in found for r in runs]
                offsets = np.concatenate(([0], np.cumsum([len(r) for r in found])))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, run_type)),
                        pa.array(left, pa.binary()).cast(pa.string()),
                    ],
                    names=["kept", "runs", "collapsed"],
                )
                at = to

    added = "runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    done = slim.mapInArrow(search, kept_and(slim, added))
    return done.select(*(F.col(f"kept.`{c}`").alias(c) for c in others), "runs", "collapsed")
