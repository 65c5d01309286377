from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimlens.llm.queries import URL_RULES
from claimlens.llm.url_filter import blocks_of, build_trie, judge_urls, match, split_url


@pytest.mark.parametrize(
    ("url", "host", "path"),
    [
        ("http://A.Example.NET/en/x?y#z", "a.example.net", "/en/x"),
        ("no scheme", "", ""),
        (None, "", ""),
        ("http://h", "h", ""),
        ("http://h?q=/a/", "h", ""),
        ("x://É.net#/en/", "É.net", ""),
        ("a://b://c", "b:", "//c"),
    ],
)
def test_split(url, host, path):
    assert split_url(url) == (host, path)


HOSTS = st.lists(st.sampled_from(["a", "b", "example", "net", "org", "com", ""]), min_size=1, max_size=4).map(".".join)
PATHS = st.lists(st.sampled_from(["en", "de", "e", "", "end"]), max_size=3).map(lambda p: "".join("/" + s for s in p))


@settings(max_examples=500, deadline=None)
@given(HOSTS, PATHS, st.lists(st.tuples(st.sampled_from(["allow", "block"]), HOSTS, PATHS), max_size=6))
def test_longest_rule_against_all_rules(host, path, rules):
    fits = [
        (len(h + p), h + p, v)
        for v, h, p in rules
        if (host == h or not h or host.endswith("." + h)) and path.startswith(p)
    ]
    found = match(build_trie(rules), host, path)
    if not fits:
        assert found is None
    else:
        longest = max(n for n, _, _ in fits)
        assert found in [(name, v) for n, name, v in fits if n == longest]


def test_edges(spark):
    schema = "page_id bigint, url string, host int, verdict int"
    rows = [
        (1, "https://www.example.net/en/", 1, 1),
        (2, "https://www.example.net/de/", 1, 1),
        (3, "http://example.com/de/a", 1, 1),
        (4, "http://notexample.com/de/a", 1, 1),
        (5, None, 1, 1),
        (None, "http://x.net", 1, 1),
        (6, "http://x.org/fr/", 1, 1),
        (6, "http://x.org/fr/", 1, 1),
    ]
    got = judge_urls(spark.createDataFrame(rows, schema), URL_RULES).collect()
    assert [(r["page_id"], r["rule"], r["verdict"]) for r in got] == [
        (1, "example.net/en/", "allow"),
        (2, "net/", "block"),
        (3, "example.com/de/", "block"),
        (4, None, "allow"),
        (5, None, "allow"),
        (None, None, "allow"),
        (6, "org/fr/", "allow"),
        (6, "org/fr/", "allow"),
    ]
    assert judge_urls(spark.createDataFrame([], schema), URL_RULES).collect() == []


RULES = [
    ("allow", "net", "/e"),
    ("block", "net", ""),
    ("block", "a.net", ""),
    ("allow", "example.net", "/en/"),
    ("block", "", "/en/x/y"),
    ("allow", "net", ""),
]


@pytest.mark.parametrize("chars", [1, 8, 10**6])
@pytest.mark.parametrize("rules", [RULES, RULES[::-1], []])
def test_rules_in_several_passes(spark, chars, rules):
    urls = ["http://a.net/e", "http://b.net/", "http://example.net/en/x/y", "http://x.org/en/x/y", "http://a.net/en/x/y", "none", None]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = judge_urls(frame, rules, block_chars=chars).collect()
    whole = build_trie(rules)
    assert [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == [
        (i, *split_url(u), *(match(whole, *split_url(u)) or (None, "allow"))) for i, u in enumerate(urls)
    ]


def test_blocks_hold_all_rules_in_order():
    blocks = blocks_of(RULES, 8)
    assert [r for b in blocks for r in b] == RULES
    assert all(len(b) == 1 or sum(len(h + p) for _, h, p in b) <= 8 for b in blocks) and len(blocks) > 2
