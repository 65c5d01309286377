"""Quality classifier: attention-based multiple-instance learning over a text's passages.

A text is a bag of passages.  Each passage is encoded, a gated attention network weighs the
passages, and the weighted mean of the encodings is scored.  All weights are learned
together, from labels of whole documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import few_rows, kept_and, texts_in, type_of, utf8

PASSAGE_WORDS = 100

# Fitting takes at most so many labelled documents, of any length, and at most so many passages of
# each; scoring reads all passages of all documents.
SAMPLE_DOCS = 3000
SAMPLE_PASSAGES = 100

# Bytes to classes; each place in the list is a class, what is left out shares the last two.
_GROUPS = [b" ", b"\t\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".", b",", b"!", b"?", b"|", b"#", b"*", b"%$&@", b"-_/+:;"]
N_CLASSES = len(_GROUPS) + 2
_CLASS = np.full(256, N_CLASSES - 1, dtype=np.uint16)
_CLASS[:128] = N_CLASSES - 2
for _i, _group in enumerate(_GROUPS):
    _CLASS[list(_group)] = _i

N_FEATURES = N_CLASSES * N_CLASSES + 4


def passages(text: bytes | None, words_each: int = PASSAGE_WORDS) -> list[list[bytes]]:
    """The text's words in groups; a text without words is one passage without words."""
    words = text.split() if text else []
    return [words[i : i + words_each] for i in range(0, len(words), words_each)] or [[]]


def sample(groups: list[list[bytes]], most: int) -> list[list[bytes]]:
    """At most so many passages from all over the text, in order: those whose words have the smallest checksums."""
    if len(groups) <= most:
        return groups
    least = sorted(range(len(groups)), key=lambda i: (crc32(b" ".join(groups[i])), i))[:most]
    return [groups[i] for i in sorted(least)]


def describe(groups: list[list[bytes]]) -> np.ndarray:
    """One row per passage: shares of neighbouring byte classes, and word repetition."""
    joined = [b" ".join(g) for g in groups]
    flat = _CLASS[np.frombuffer(b"\n".join(joined) + b"\n", dtype=np.uint8)]
    sizes = np.array([len(j) + 1 for j in joined])
    inside = np.ones(len(flat), dtype=bool)
    inside[np.cumsum(sizes) - 1] = False  # no pair reaches into the next passage
    at = np.flatnonzero(inside)
    pairs = flat[at] * np.uint16(N_CLASSES) + flat[at + 1]
    owner = np.repeat(np.arange(len(joined)), sizes - 1)
    width = N_CLASSES * N_CLASSES
    counts = np.bincount(owner * width + pairs, minlength=len(joined) * width).reshape(-1, width)
    out = np.empty((len(groups), N_FEATURES), dtype=np.float32)
    out[:, :width] = counts / np.maximum(sizes - 1, 1)[:, None]
    for i, (g, j) in enumerate(zip(groups, joined, strict=True)):
        n = len(g)
        out[i, width:] = (
            (len(set(g)) / n, sum(map(eq, g, g[1:])) / n, len(j) / n / 10, np.log1p(n) / 5) if n else (1, 0, 0, 0)
        )
    return out


class AttentionModel:
    """Encoder, gated attention and score; parameters are plain arrays by name."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @staticmethod
    def fresh(mean: np.ndarray, spread: np.ndarray, encoded: int = 32, hidden: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

        return AttentionModel(
            {
                "mean": mean,
                "spread": spread,
                "W": normal(len(mean), encoded),
                "b": np.zeros(encoded),
                "V": normal(encoded, hidden),
                "U": normal(encoded, hidden),
                "a": normal(hidden),
                "c": normal(encoded),
                "c0": np.zeros(1),
            }
        )

    def forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """``x`` has passages of documents one after the other; ``starts`` is where each begins."""
        w = self.w
        sizes = np.diff(np.append(starts, len(x)))
        x = np.clip((x - w["mean"]) / w["spread"], -8, 8)
        h = np.tanh(x @ w["W"] + w["b"])
        t = np.tanh(h @ w["V"])
        s = 1 / (1 + np.exp(-(h @ w["U"])))
        e = (t * s) @ w["a"]
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        attention = e / np.repeat(np.add.reduceat(e, starts), sizes)
        z = np.add.reduceat(attention[:, None] * h, starts, axis=0)
        p = 1 / (1 + np.exp(-np.clip(z @ w["c"] + w["c0"], -30, 30)))
        return {"x": x, "h": h, "t": t, "s": s, "attention": attention, "z": z, "p": p, "sizes": sizes}

    def gradient(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss, by the chain rule from the score back to the encoder."""
        w, f = self.w, self.forward(x, starts)
        h, t, s, att, sizes = f["h"], f["t"], f["s"], f["attention"], f["sizes"]
        d_score = (f["p"] - y) / len(y)
        d_z = np.repeat(d_score[:, None] * w["c"], sizes, axis=0)
        d_att = (d_z * h).sum(axis=1)
        d_e = att * (d_att - np.repeat(np.add.reduceat(att * d_att, starts), sizes))
        d_gate = d_e[:, None] * w["a"]
        d_t, d_s = d_gate * s * (1 - t * t), d_gate * t * s * (1 - s)
        d_h = att[:, None] * d_z + d_t @ w["V"].T + d_s @ w["U"].T
        d_pre = d_h * (1 - h * h)
        return {
            "W": f["x"].T @ d_pre,
            "b": d_pre.sum(axis=0),
            "V": h.T @ d_t,
            "U": h.T @ d_s,
            "a": (t * s).T @ d_e,
            "c": f["z"].T @ d_score,
            "c0": d_score.sum(keepdims=True),
        }


def train(x: np.ndarray, starts: np.ndarray, y: np.ndarray, epochs: int = 40, batch: int = 128, seed: int = 7) -> AttentionModel:
    """Adam on mini-batches of documents, with a small weight decay."""
    model = AttentionModel.fresh(
        x.mean(axis=0, dtype=np.float64), np.maximum(x.std(axis=0, dtype=np.float64), 1e-3)
    )
    ends = np.append(starts[1:], len(x))
    rng = np.random.default_rng(seed)
    first = {k: 0.0 for k in ("W", "b", "V", "U", "a", "c", "c0")}
    second = dict(first)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), batch):
            docs = order[at : at + batch]
            sizes = ends[docs] - starts[docs]
            begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            rows = np.arange(sizes.sum()) + np.repeat(starts[docs] - begins, sizes)
            step += 1
            for k, g in model.gradient(x[rows].astype(np.float64), begins, y[docs]).items():
                g = g + (1e-4 * model.w[k] if k in "WVU" else 0)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model.w[k] = model.w[k] - 0.005 * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                )
    return model


def held_out(id_column: str):
    """Whether a document's label is kept from fitting: crc32 of its id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
    sample_docs: int = SAMPLE_DOCS,
    sample_passages: int = SAMPLE_PASSAGES,
) -> dict[str, np.ndarray] | float:
    """Weights fitted to at most ``sample_docs`` labelled documents, whatever their length.

    The documents with the smallest hashes of their ids are taken, of those not held out; of rows
    that share an id, the one whose text has the smallest hash.  Of a text with more than ``sample_passages``
    passages, those count whose words have the smallest checksums, wherever they stand.
    Tasks turn their texts into passage features, which then come to the driver: about a kilobyte
    a passage, so at most ``sample_docs * sample_passages`` kilobytes (300 MB).  Null labels and ids are passed
    over; an id with several labels counts with their mean.  A null or empty text is one passage without words;
    other columns are not read.  Without both labels in the sample (also if a table is empty) the
    result is one score for all, (ones + 1) / (labels + 2).
    """
    spark = docs.sparkSession
    chosen = (
        labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").cast("double").alias("y"))
        .filter("id IS NOT NULL AND y IS NOT NULL")
        .filter(~held_out("id"))
        .groupBy("id")
        .agg(F.avg("y").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample_docs)
    )
    known = {r["id"]: r["y"] for r in chosen.collect()}  # bounded by the sample size
    if not known:
        return 0.5
    # The sample has a fixed bound, so it may be sent to all tasks.
    ids = spark.createDataFrame([(k,) for k in known], f"id {type_of(docs, id_column)}")
    texts = (
        docs.select(F.col(f"`{id_column}`").alias("id"), utf8(text_column).alias("text"))
        .join(F.broadcast(ids), "id", "left_semi")
        .groupBy("id")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
        .select("id", "least.text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            rows = [describe(sample(passages(t), sample_passages)).astype("<f4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["id", "x"])

    rows = texts.mapInArrow(run, f"id {type_of(docs, id_column)}, x binary").collect()
    bags = sorted((r["id"], bytes(r["x"])) for r in rows)
    y = np.array([known[i] for i, _ in bags])
    if not len(y) or (y > 0.5).all() or (y <= 0.5).all():
        return float(((y > 0.5).sum() + 1) / (len(y) + 2))
    x = [np.frombuffer(b, dtype="<f4").reshape(-1, N_FEATURES) for _, b in bags]
    starts = np.concatenate(([0], np.cumsum([len(b) for b in x])[:-1]))
    return train(np.concatenate(x), starts, y).w


def scores_of(texts: list[bytes | None], model: dict[str, np.ndarray] | float) -> np.ndarray:
    """Scores of whole texts, some passages at a time; a long text counts as one bag."""
    if isinstance(model, float):
        return np.full(len(texts), model)
    out = np.empty(len(texts))
    at = 0
    while at < len(texts):
        groups, starts, first = [], [], at
        while at < len(texts) and len(groups) < 1000:
            starts.append(len(groups))
            groups += passages(texts[at])
            at += 1
        x = np.concatenate([describe(groups[i : i + 1000]) for i in range(0, len(groups), 1000)])
        out[first:at] = AttentionModel(model).forward(x, np.array(starts))["p"]
    return out


def score_quality(
    docs: DataFrame,
    model: dict[str, np.ndarray] | float,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Id, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from 0.5) of every row.

    Only the text decides; null and empty texts are scored as one passage without words.
    Repeated rows are scored one by one, other columns are not read, an empty table gives
    an empty table.  Rows with a null id are not held out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            scores = scores_of(batch.column(2).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=["id", "held_out", "score", "predicted"],
            )

    narrow = docs.select(
        F.col(f"`{id_column}`").alias("id"), held_out(id_column).alias("held_out"), utf8(text_column).alias("text")
    )
    out = narrow.mapInArrow(run, f"id {type_of(narrow, 'id')}, held_out boolean, score double, predicted int")
    return out.withColumnRenamed("id", id_column)


def keep_good(docs: DataFrame, model: dict[str, np.ndarray] | float, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores at least 0.5, all columns as they are.

    Null and empty texts are judged as one passage without words, texts of any length whole; repeated rows
    alike, each by itself.  An empty table stays empty; other columns are not looked at, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            texts = texts_in(batch.column(0), text_column)
            yield batch.filter(pa.array(scores_of(texts, model) >= 0.5))

    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("kept"))
    kept = packed.mapInArrow(run, kept_and(packed))
    return kept.select("kept.*")
