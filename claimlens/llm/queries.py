"""The registered queries of the operators, one per operator."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm.ann import nearest
from claimlens.llm.common import table, type_of
from claimlens.llm.conversations import repair_conversations
from claimlens.llm.decontaminate import find_contamination
from claimlens.llm.html_extract import extract_pages
from claimlens.llm.packing import pack_pieces, tokenize_pieces
from claimlens.llm.quality import fit_quality, score_quality
from claimlens.llm.runs import find_runs
from claimlens.llm.sharding import shard_rows
from claimlens.llm.simhash import simhash_clusters
from claimlens.llm.substring import remove_repeats
from claimlens.llm.token_count import count_tokens
from claimlens.llm.topk import top_products
from claimlens.llm.url_filter import judge_urls

# The rules of the URL query: verdict, host, path.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]

SHARDS = 24
TOKEN_LIMIT = 2048


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def packed_documents(docs: DataFrame) -> DataFrame:
    """Every piece's place; the ids are reduced to their checksum before anything moves."""
    pieces = tokenize_pieces(docs, tokenizer_file())
    digests = pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return pack_pieces(digests)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash_clusters(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens."""
    return packed_documents(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document; the listed items are hashed."""
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_join(F.transform("item_ids", lambda i: i.cast("string")), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(names, 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes, in order of doc_id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 8).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shard_rows(docs, SHARDS, "doc_id", "size").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(table(spark, sf_dir, "pages"))


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    counted = count_tokens(table(spark, sf_dir, "documents"), tokenizer_file())
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op7_vp_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth vector, by id, among all others."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, by a model fitted to the labels not held out."""
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every document without passages that stand earlier in the corpus."""
    done = remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_removed", "text")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with a fifth of the rows damaged, by the checksum of ``conv_id:turn``.

    Of 20 remainders 0 drops the row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 sets
    the role user.  Nulls count as one space; a null turn stays null.
    """
    part = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    key = F.concat(part["conv_id"], F.lit(":"), part["turn"]).cast("binary")
    act = F.crc32(key) % 20
    text = F.when(act == 1, "").when(act == 2, F.regexp_replace(part["text"], "[.!?]", "")).otherwise(part["text"])
    rows = conversations.filter(act != 0).select(
        "conv_id",
        "turn",
        F.when(act == 4, "user").otherwise(part["role"]).alias("role"),
        text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(act == 3, 2).otherwise(1))).alias("copy"),
    )
    return rows.drop("copy")


def turn_digests(turns: DataFrame) -> DataFrame:
    """Per conversation the hash of its ``role:text`` lines, read row by row and never held whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = digest = id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            ids, digests = [], []
            for i, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if digest is None or i != of:
                    if digest is not None:
                        ids.append(of)
                        digests.append(digest.hexdigest())
                    of, digest = i, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(digests, pa.string())], names=["id", "digest"])
        if digest is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([of], id_type), pa.array([digest.hexdigest()], pa.string())], names=["id", "digest"]
            )

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "role", "text")
    return ordered.mapInArrow(run, f"id {type_of(turns, 'conv_id')}, digest string")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of the repaired turns of every conversation, after damage."""
    rows = table(spark, sf_dir, "conversations")
    report, turns = repair_conversations(damaged(rows))
    digests = turn_digests(turns)
    every = rows.select(F.col("conv_id").alias("every")).distinct()
    joined = every.join(report, F.col("every").eqNullSafe(F.col("conv_id")), "left").join(
        digests, F.col("every").eqNullSafe(F.col("id")), "left"
    )
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        F.col("every").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"),
    )


def op12_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five greatest integer products of every fiftieth vector, by id, with all others."""
    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` where a tenth of the texts repeat a stretch of their words up to the end.

    h is the checksum of the written doc_id, g = floor(h / 10).  If h % 10 = 0, each of the n words from
    a = g % n on becomes word a + (i - a) % p, with p = 1 + floor((n - a) / (3 + g % 8)).  Rows without a
    doc_id stay as they are.
    """
    named = docs.select("*", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h of row"))
    chosen = F.col("h of row") % 10 == 0
    words = F.when(chosen, F.expr(r"filter(split(text, '[ \t-\r]+'), w -> w <> '')"))
    split = named.withColumn("words of row", words)
    n = F.size("words of row")
    a = F.expr("CAST((`h of row` div 10) % size(`words of row`) AS int)")
    placed = split.withColumn("a of row", F.when(n > 0, a))
    period = F.expr("CAST(1 + (size(`words of row`) - `a of row`) div (3 + (`h of row` div 10) % 8) AS int)")
    placed = placed.withColumn("p of row", F.when(n > 0, period))
    text = F.expr(
        "array_join(concat(slice(`words of row`, 1, `a of row`), slice(flatten(array_repeat("
        "slice(`words of row`, `a of row` + 1, `p of row`), "
        "CAST(ceil((size(`words of row`) - `a of row`) / `p of row`) AS int))), 1, size(`words of row`) - `a of row`)), ' ')"
    )
    return placed.withColumn("text", F.when(n > 0, text).otherwise(F.col("text"))).select(*docs.columns)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of runs, strongest run, and digests of all runs and of the collapsed text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_runs(with_planted_runs(docs))
    best = F.expr(
        "aggregate(runs, runs[0], (b, r) -> CASE WHEN r.length * b.period > b.length * r.period OR "
        "(r.length * b.period = b.length * r.period AND (r.start < b.start OR "
        "(r.start = b.start AND r.period < b.period))) THEN r ELSE b END)"
    )
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.select("doc_id", "runs", "collapsed", F.when(F.size("runs") > 0, best).alias("best")).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_packing": op2_packing,
    "op3_decontaminate": op3_decontaminate,
    "op4_histogram_sort": op4_histogram_sort,
    "op5_html_text": op5_html_text,
    "op6_token_count": op6_token_count,
    "op7_vp_trees": op7_vp_trees,
    "op8_quality": op8_quality,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_pivot_topk": op12_pivot_topk,
    "op13_runs": op13_runs,
}
