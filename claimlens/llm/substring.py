"""Substring dedup: hashes of sliding runs of sentences, joined over the whole corpus."""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import few_rows, kept_and, type_of, utf8
from claimlens.sources.storage import stage, unstage

MIN_SENTENCES = 3
MIN_WORDS = 25

# Sentences of so many words are cut after , ; : after a repeated word and after words whose
# checksum is divisible by CUT_EVERY.  Each GAP words on end without such a cut are cut after
# the one with the least checksum.  So equal stretches are cut alike wherever their sentences
# begin, and any LONG_SENTENCE - 1 + MIN_WORDS - 2 + 2 * GAP words (50) that two texts share
# hold a run that both have, if their sentences end alike within.
LONG_SENTENCE = 12
CUT_EVERY = 4
GAP = 8

# Texts are cut together up to so many bytes.
GROUP_BYTES = 2_000_000

# Where a sentence ends: after . ! or ? before white space, or at a line end.  White space goes
# with what it follows.
_END = re.compile(rb"[.!?](?=[ \t\r\n])[ \t\r\n]*|\n[ \t\r\n]*")
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_IS_MARK = np.isin(np.arange(256), list(b",;:"))
# White space beyond ASCII, as UTF-8.
_WIDE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def plain(text: bytes) -> bytes:
    """The text with as many spaces as bytes for white space beyond ASCII."""
    return text if text.isascii() else _WIDE.sub(lambda m: b" " * len(m[0]), text)


def grouped(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of few rows and few bytes of text; a longer text is a slice of its own."""
    for part in few_rows([batch]):
        sizes = np.cumsum(pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < part.num_rows:
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + GROUP_BYTES, side="right")))
            yield part.slice(at, to - at)
            at = to


@dataclass
class Parts:
    """Sentences and parts of long ones of several texts, as arrays over all of them."""

    ends: np.ndarray  # where each ends, in bytes of the texts joined by a space
    owner: np.ndarray  # its text
    starts: np.ndarray  # where each text begins
    words: list[bytes]
    before: np.ndarray  # how many words stand before each end

    def of(self, text: int) -> np.ndarray:
        """Ends of a text's parts, in its own bytes."""
        a, b = np.searchsorted(self.owner, (text, text + 1))
        return self.ends[a:b] - self.starts[text]


def cut_texts(texts: list[bytes]) -> Parts:
    """Cut the texts; words, marks and checksums are arrays, so that no Python code runs per word.

    The white space after a part goes with it.
    """
    texts = [plain(t) for t in texts]
    flat = b" ".join(texts)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts], dtype=np.int64)[:-1]
    found = [[m.end() for m in _END.finditer(t)] + [len(t)] for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(f) for f in found])
    ends = np.fromiter(itertools.chain.from_iterable(found), np.int64, len(owner)) + begin[owner]
    previous = np.concatenate(([-1], ends[:-1]))
    keep = ends > np.maximum(previous, begin[owner])
    ends, owner = ends[keep], owner[keep]
    raw = np.frombuffer(flat, dtype=np.uint8)
    space = _IS_SPACE[raw]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    words = flat.split()
    n = len(words)
    before = np.searchsorted(starts, ends)
    counts = np.diff(before, prepend=0)
    if not (counts >= LONG_SENTENCE).any():
        return Parts(ends, owner, begin, words, before)
    of = np.repeat(np.arange(len(ends)), counts)
    long = (counts >= LONG_SENTENCE)[of]
    checks = np.fromiter(map(zlib.crc32, words), np.uint32, n)
    final = raw[np.flatnonzero(~space & np.concatenate((space[1:], [True])))]
    flag = (checks % CUT_EVERY == 0) | _IS_MARK[final]
    twice = np.flatnonzero((checks[1:] == checks[:-1]) & (of[1:] == of[:-1])) + 1
    flag[[k for k in twice.tolist() if words[k] == words[k - 1]]] = True
    flag &= long
    if n >= GAP:
        marks = np.concatenate(([0], np.cumsum(flag)))
        bare = (marks[GAP:] == marks[:-GAP]) & (of[GAP - 1 :] == of[: n - GAP + 1]) & long[: n - GAP + 1]
        at = np.flatnonzero(bare)
        flag[at + checks[at[:, None] + np.arange(GAP)].argmin(axis=1)] = True
    last = np.flatnonzero(flag[:-1] & (of[1:] == of[:-1]))  # a sentence's last word ends it anyway
    ends, owner = np.concatenate((ends, starts[last + 1])), np.concatenate((owner, owner[of[last]]))
    order = np.argsort(ends)
    return Parts(ends[order], owner[order], begin, words, np.searchsorted(starts, ends[order]))


def sentences(text: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the sentences and parts of long ones, with the white space after each."""
    ends = cut_texts([text]).ends.tolist()
    return list(zip([0, *ends], ends, strict=False))


def run_hashes(
    texts: list[bytes], min_sentences: int, min_words: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every run its text, the number of its first sentence, its 64-bit hash, and how many sentences it has.

    A run starts with any sentence and takes as many as hold both minima; the last sentences
    of a text start none.  It is hashed as its words joined by single spaces, so
    equal runs are equal whatever white space parts them.
    """
    from xxhash import xxh64_intdigest

    parts = cut_texts(texts)
    ends = np.concatenate(([0], parts.before))
    first = np.arange(len(parts.ends))
    last = np.maximum(first + min_sentences, np.searchsorted(ends, ends[:-1] + min_words))
    of_text = np.searchsorted(parts.owner, np.arange(len(texts) + 1))
    inside = last <= of_text[parts.owner + 1]
    first, last, owner = first[inside], last[inside], parts.owner[inside]
    flat = b" ".join(parts.words)
    places = np.zeros(len(parts.words) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, parts.words), np.int64, len(parts.words)) + 1, out=places[1:])
    hashes = np.fromiter(
        (
            xxh64_intdigest(flat[a:b])
            for a, b in zip(places[ends[first]].tolist(), (places[ends[last]] - 1).tolist(), strict=True)
        ),
        np.uint64,
        len(first),
    )
    return owner, first - of_text[owner], hashes, last - first


def remove_repeats(
    docs: DataFrame,
    min_sentences: int = MIN_SENTENCES,
    min_words: int = MIN_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with repeated passages cut from the text, and ``n_removed``, the sentences cut.

    A span is a run of at least ``min_sentences`` sentences with at least ``min_words`` words;
    the parts of a long sentence count as sentences, so that a passage is found even if
    other words join it to its neighbours.
    Of equal spans anywhere in the corpus the first, by (id, hash of the text, place), stays;
    every sentence that another of them covers is removed, with the white space after it.
    Text that is not removed is kept byte for byte, at the end less white space left over.

    Null and empty texts, and those of fewer sentences or words, are left alone; other
    columns pass through (but for ``n_removed``).  Null ids come last in
    the order.  Rows that repeat both id and text are one document and get one
    result each.  An empty table gives an empty table.
    """
    named = [c for c in docs.columns if c.lower() != "n_removed"]
    text = F.col(f"`{text_column}`").cast("string")
    others = [c for c in named if c != text_column]
    keyed = docs.select(
        F.struct(F.lit(0), *(F.col(f"`{c}`") for c in others)).alias("kept"),
        F.col(f"`{id_column}`").alias("id"),
        F.xxhash64(text).alias("body"),  # tells rows apart that share an id; 32 bits would collide
        utf8(text_column).alias("text"),
    )
    id_type = type_of(keyed, "id")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in grouped(batch, 2):
                texts = part.column(2).to_pylist()
                some = [i for i, t in enumerate(texts) if t]
                if not some:
                    continue
                owner, place, hashes, size = run_hashes([texts[i] for i in some], min_sentences, min_words)
                row = pa.array(np.array(some)[owner])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(row),
                        part.column(1).take(row),
                        pa.array(hashes.view(np.int64)),
                        pa.array(place.astype(np.int32)),
                        pa.array(size.astype(np.int32)),
                    ],
                    names=["id", "body", "hash", "place", "size"],
                )

    spans = stage(
        keyed.select("id", "body", "text").mapInArrow(
            runs, f"id {id_type}, body bigint, hash bigint, place int, size int"
        ),
        "spans",
    )
    # Most spans occur once; only the others are sorted out by place.  What is joined with the
    # spans is written first: a join of two plain exchanges can be split at a hot hash.
    repeated = stage(spans.groupBy("hash").count().filter("count > 1").select("hash"), "repeated")
    shared = stage(spans.join(repeated, "hash"), "shared-spans")
    unstage(spans)
    unstage(repeated)
    # Null ids sort after all others.
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("body"), F.col("place"))
    first = stage(shared.groupBy("hash").agg(F.min(order).alias("first")), "first-spans")
    later = shared.join(first, "hash").filter(order != F.col("first")).select("id", "body", "place", "size")
    covered = later.groupBy("id", "body").agg(F.collect_set(F.struct("place", "size")).alias("covered"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in grouped(batch, 1):
                texts, marks = part.column(1).to_pylist(), part.column(2)
                removed = np.zeros(len(texts), dtype=np.int64)
                some = np.flatnonzero(pc.fill_null(pc.list_value_length(marks), 0).to_numpy(zero_copy_only=False)).tolist()
                parts = cut_texts([texts[i] for i in some]) if some else None
                for k, i in enumerate(some):
                    ends, t = parts.of(k), texts[i]
                    places, sizes = (marks[i].values.field(c).to_numpy() for c in ("place", "size"))
                    change = np.zeros(len(ends) + 1, dtype=np.int64)
                    np.add.at(change, places, 1)
                    np.add.at(change, places + sizes, -1)
                    gone = np.cumsum(change[:-1]) > 0
                    removed[i] = gone.sum()
                    # What stays, in stretches of neighbouring parts.
                    edges = np.flatnonzero(np.diff(gone, prepend=True, append=True))
                    bounds = np.concatenate(([0], ends))[edges].tolist()
                    left = b"".join([t[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True)])
                    texts[i] = left.rstrip(b" \t\r\n") if gone[-1] else left
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(removed)],
                    names=["kept", "text", "n_removed"],
                )

    marked = keyed.alias("d").join(
        covered.alias("c"),
        F.col("d.id").eqNullSafe(F.col("c.id")) & (F.col("d.body") == F.col("c.body")),
        "left",
    )
    slim = marked.select("d.kept", "d.text", "c.covered")
    done = slim.mapInArrow(cut, kept_and(slim, "text string, n_removed bigint"))
    back = [
        F.col("text").alias(c) if c == text_column else F.col(f"kept.`{c}`").alias(c)
        for c in named
    ]
    return done.select(*back, "n_removed")
