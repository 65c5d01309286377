from __future__ import annotations

import pytest

# Columns named like what operators add or use inside.
CLASHING = "kept string, id string, score string, shard string, slot string, fingerprint string, component_id string, n_removed int, length string, rank string, hash string, part string, `a column` string"

PASSAGE = (
    "The first sentence of the passage says little. The second one goes on for some more words than that. "
    "A third one ends it all with nine words more."
)


def edge_rows():
    long_text = " ".join(f"word{i % 977} runs on. Then line {i}.\n" for i in range(40_000))
    texts = [
        (1, f"Opening words that are mine. {PASSAGE}"),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (None, f"No id here, still a text. {PASSAGE}"),
        (5, long_text),
        (6, "one"),
        (7, "Two words"),
        (8, f"Opening words that are mine. {PASSAGE}"),
        (9, f"Quite another start stands here. {PASSAGE} And an end."),
        (9, f"Quite another start stands here. {PASSAGE} And an end."),
        (None, None),
    ]
    return [(i, t, None, "src", None, *["x"] * 7, 1, *["y"] * 5) for i, t in texts]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + CLASHING


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small_docs(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")
