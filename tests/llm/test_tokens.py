from __future__ import annotations

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimlens.llm.queries import op6_token_count, tokenizer_file
from claimlens.llm.token_count import count_merged, count_tokens, merge_ranks
from claimlens.llm.tokens import PretokenResults

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LIBRARY = Tokenizer.from_file(tokenizer_file())
RANKS, END = merge_ranks(tokenizer_file())
COUNTS = PretokenResults(tokenizer_file(), lambda w: count_merged(w, RANKS, END), lambda _: 1, sum)
IDS = PretokenResults(
    tokenizer_file(),
    lambda w: [t.id for t in LIBRARY.model.tokenize(w)],
    lambda i: [i],
    lambda parts: [i for p in parts for i in p],
)


def same(text: str) -> None:
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert COUNTS.of_text(text) == len(want)
    assert IDS.of_text(text) == want


@pytest.mark.parametrize(
    "text",
    [
        "",
        "   ",
        "don't it's I'LL we'Ve 'S",
        "<|endoftext|>x<|startoftext|> a<|endoftext|>",
        "<|endoftext| <|> <",
        "İstanbul ΣΑΣ ẞ ǅ ŉ",
        "été ﬁ \xa0x y 日本語 テスト 😀👍🏽 \x1c\x0b\t\r\n z \x00 \x7f a\xadb",
        "é x̧́ ² ½ Ⅷ ٣",
        "a" * 3000 + " " + "!" * 500,
        "x1y22z — ‘q’ …",
    ],
)
def test_odd_texts(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="abcdeTHE'st  \n.,!<|endoftext>é1²ß", max_size=80))
def test_any_text(text):
    same(text)


def test_a_full_cache_is_emptied(monkeypatch):
    import claimlens.llm.tokens as module

    monkeypatch.setattr(module, "CACHE_ENTRIES", 3)
    same("one two three four five one two six seven one")


def test_caches_keep_a_bounded_number_of_letters(monkeypatch):
    from claimlens.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_LETTERS", 600)
    counts = PretokenResults(tokenizer_file(), lambda w: count_merged(w, RANKS, END), lambda _: 1, sum)
    for k in range(300):
        text = f"{'abcdefghij'[k % 10] * (k % 90 + 1)} é{'語' * (k % 40)}"
        assert counts.of_text(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)
        for cache in (counts.plain, counts.lettered):
            assert all(len(key) <= tokens.LONGEST_KEPT for key in cache)
            assert sum(map(len, cache)) == cache.letters < 600 + tokens.LONGEST_KEPT


def test_documents(spark, small_dir, small_docs):
    texts = {r["doc_id"]: r["text"] or "" for r in small_docs.collect()}
    for r in op6_token_count(spark, small_dir).collect():
        text = texts[r["doc_id"]]
        want = len(LIBRARY.encode(text, add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (want, len(text.encode()), want > 2048)


def test_edges(edge_docs, no_docs):
    rows = count_tokens(edge_docs, tokenizer_file()).collect()
    counts = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in rows}
    assert len(rows) == edge_docs.count()
    assert counts[2] == counts[3] == (0, 0) and counts[4] == (4, 0) and counts[5][1] > 100_000
    assert count_tokens(no_docs, tokenizer_file()).collect() == []
