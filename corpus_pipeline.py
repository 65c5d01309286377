"""The corpus pipeline: five stages from raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm.common import table
from claimlens.llm.decontaminate import drop_contaminated
from claimlens.llm.quality import fit_quality, keep_good
from claimlens.llm.queries import packed_documents
from claimlens.llm.simhash import simhash_clusters
from claimlens.llm.substring import remove_repeats
from claimlens.sources.storage import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.5).

    The classifier is fitted to the labels of these documents that are not held out.  Rows
    are judged by their text alone: null and empty texts like any other, long ones whole, repeated rows
    alike.  Extra columns go along untouched; an empty table stays empty.
    """
    return keep_good(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints: the one with the smallest id.

    Rows that repeat a doc_id are one document and stay or go together.  Rows without a
    doc_id stay only in groups where no document has one, and one of them a group.  Texts without words
    (null, empty) are one group.  Extra columns, of any name, go along; an empty table stays empty.
    """
    nameless = docs.filter("doc_id IS NULL")
    if nameless.isEmpty():
        kept = simhash_clusters(docs).filter(F.col("doc_id") == F.col("component_id"))
        kept = kept.select(F.col("doc_id").alias("kept_id")).distinct()
        return docs.join(kept, docs["doc_id"] == kept["kept_id"], "left_semi")
    # Rows without an id are told apart by written numbers, and sort after all others.
    key = "document key"
    while key in map(str.lower, docs.columns):
        key += "+"
    named = docs.filter("doc_id IS NOT NULL").withColumn(key, F.expr("struct(false AS none, doc_id AS id, 0L AS row)"))
    nameless = nameless.withColumn(key, F.expr("struct(true AS none, doc_id AS id, monotonically_increasing_id() AS row)"))
    keyed = named.union(stage(nameless, "nameless"))
    kept = simhash_clusters(keyed, id_column=key).filter(F.col(f"`{key}`") == F.col("component_id"))
    return keyed.join(kept.select(key).distinct(), key, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that stand earlier in the corpus; ``n_chars`` follows the text.

    A document that consisted of such passages alone keeps its row with an empty text, and
    ``n_chars`` stays as it was where nothing was removed.  Null texts stay null; rows that repeat
    a document are that document.  Extra columns go along; an empty table stays empty.
    """
    names = docs.columns
    apart = {c: f"input {c}" for c in names if c.lower() == "n_removed"}
    done = remove_repeats(docs.withColumnsRenamed(apart))
    if "n_chars" in names:
        chars = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        done = done.withColumn("n_chars", F.coalesce(chars, "n_chars"))
    return done.select(*(F.col(f"`{apart.get(c, c)}`").alias(c) for c in names))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark items.

    Null and empty texts have no words, so they stay; repeated rows stay or go together.  An empty benchmark
    lets everything stay.  Extra columns go along; an empty table stays empty.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece's place in windows of 4096 tokens, each token of each row in exactly one piece.

    A null or empty text is its end mark alone; long texts are cut, repeated rows packed one by one.
    Columns other than id and text are left behind, whatever their names; an empty table packs to none.
    """
    return packed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

# The classifier is learned, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what a stage returns is written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
