from __future__ import annotations

from collections import defaultdict
import random

import pytest
from pyspark.sql import functions as F

from claimlens.llm.queries import op9_substring_dedup
from claimlens.llm.substring import remove_repeats, sentences
from llm.conftest import PASSAGE


def brute(docs: dict[int, str]) -> dict[int, tuple[str, int]]:
    """Text left and sentences removed, from a table of all runs by their words."""
    parts = {i: [t.encode()[a:b].decode() for a, b in sentences(t.encode())] for i, t in docs.items()}
    runs = defaultdict(list)
    for i in sorted(parts):
        own = parts[i]
        for k in range(len(own)):
            m = n = 0
            while k + m < len(own) and (m < 3 or n < 25):
                n += len(own[k + m].encode().split())
                m += 1
            if m >= 3 and n >= 25:
                runs[b" ".join("".join(own[k : k + m]).encode().split())].append((i, k, k + m))
    gone = defaultdict(set)
    for places in runs.values():
        for i, a, b in sorted(places)[1:]:
            gone[i].update(range(a, b))
    out = {}
    for i, own in parts.items():
        left = "".join(s for k, s in enumerate(own) if k not in gone[i])
        if gone[i] and len(own) - 1 in gone[i]:
            left = left.rstrip(" \t\r\n")
        out[i] = (left, len(gone[i]))
    return out


def test_sentences_cover_the_text():
    text = "A b. C d!\n\n e.f g\nH? “i” j\r\n".encode()
    spans = sentences(text)
    assert [text[a:b].decode() for a, b in spans] == ["A b. ", "C d!\n\n ", "e.f g\n", "H? ", "“i” j\r\n"]


def test_a_long_sentence_is_cut_at_the_same_places_wherever_it_begins():
    words = [f"w{i}" for i in range(60)]
    whole = " ".join(words).encode()
    cuts = {whole[:b].split()[-1] for _, b in sentences(whole)}
    assert len(cuts) > 3
    for start in range(0, 40, 7):
        text = b"Another start, " + b" ".join(whole.split()[start:])
        spans = sentences(text)
        assert b"".join(text[a:b] for a, b in spans) == text
        assert {text[:b].split()[-1] for _, b in spans if text[:b].split()[-1].startswith(b"w")} == {
            c for c in cuts if int(c[1:]) >= start
        }
    repeated = b"the " * 30
    assert len(sentences(repeated)) == 29


def test_a_short_sentence_is_not_cut():
    assert len(sentences(b"One, two, three; four: five six seven eight nine ten eleven.")) == 1


def test_a_passage_joined_to_other_words_is_found(spark):
    middle = " ".join(f"word{i * 7 % 101}," if i % 5 == 0 else f"word{i * 7 % 101}" for i in range(60))
    docs = spark.createDataFrame([(1, f"First text with {middle} and on."), (2, f"Quite another beginning {middle} then more.")], "doc_id bigint, text string")
    left = {r["doc_id"]: r["text"].split() for r in remove_repeats(docs).collect()}
    assert len(left[1]) > 60 and len(left[2]) < 25


@pytest.mark.parametrize("space", [" ", "\t", "\x0b", "\u00a0"])
@pytest.mark.parametrize("marks", ["", ",", ".,;"])
def test_no_planted_passage_of_fifty_words_is_left(spark, space, marks):
    rng = random.Random(7)

    def some(n):
        return ["".join(rng.choices("abcdefgh", k=4)) + (rng.choice(marks) if marks and rng.random() < 0.15 else "") for _ in range(n)]

    def shingles(text):
        words = text.split()
        return {tuple(words[k : k + 50]) for k in range(len(words) - 49)}

    rows = []
    for k in range(150):
        passage = some(51 + k % 10)
        rows += [(2 * k + j, space.join(some(40) + passage + some(40))) for j in range(2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = {r["doc_id"]: r["text"] for r in remove_repeats(docs).collect()}
    assert [k for k in range(150) if shingles(left[2 * k]) & shingles(left[2 * k + 1])] == []
    assert all(left[2 * k] == rows[2 * k][1] for k in range(150))


def test_documents_against_brute_force(spark, small_dir, small_docs):
    want = brute({r["doc_id"]: r["text"] for r in small_docs.collect()})
    rows = op9_substring_dedup(spark, small_dir).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in rows} == want
    assert any(n for _, n in want.values())


def test_a_passage_stays_in_its_first_document_only(edge_docs, no_docs):
    done = remove_repeats(edge_docs)
    assert [c for c in done.columns if c != "n_removed"] == [
        c for c in edge_docs.columns if c != "n_removed"
    ]
    rows = done.collect()
    assert len(rows) == edge_docs.count()
    texts = defaultdict(list)
    for r in rows:
        texts[r["doc_id"]].append(r["text"])
    assert texts[1] == [f"Opening words that are mine. {PASSAGE}"]
    assert texts[8] == [""]
    assert texts[9] == ["Quite another start stands here. And an end."] * 2
    assert set(texts[None]) == {None, "No id here, still a text."}
    assert texts[2] == [None] and texts[3] == [""] and texts[4] == [" \n\t "] and texts[6] == ["one"]
    assert len(texts[5][0]) > 100_000
    assert remove_repeats(no_docs).collect() == []


def test_repeats_within_one_document(spark):
    docs = spark.createDataFrame([(1, f"{PASSAGE}\n{PASSAGE}\nThe end.")], "doc_id bigint, text string")
    assert remove_repeats(docs).first()["text"] == f"{PASSAGE}\nThe end."


def test_rows_of_one_id_with_equal_short_hashes_are_apart(spark):
    own = "Nothing here stands anywhere else. These words are this text's own and stay where they are. So do the last ones, which end it without any haste."
    repeats, clean = f"Note 4951 opens. {PASSAGE}", f"Note 266380 opens. {own}"
    rows = [(1, f"First. {PASSAGE}"), (None, repeats), (None, clean)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert docs.select(F.hash("text")).distinct().count() == 2
    left = {(r["doc_id"], r["text"], r["n_removed"]) for r in remove_repeats(docs).collect()}
    assert left == {(1, f"First. {PASSAGE}", 0), (None, "Note 4951 opens.", 3), (None, clean, 0)}
