"""URL filter: a trie over reversed host labels and path segments, longest match wins."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import type_of

# Rules of so many characters are broadcast as one trie; more rules take further passes.
BLOCK_CHARS = 64_000_000

_LOWER = {i: i + 32 for i in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    start = at + 3
    ends = [p for c in "?#" if (p := url.find(c, start)) >= 0]
    end = min(ends, default=len(url))
    slash = url.find("/", start, end)
    if slash < 0:
        slash = end
    return url[start:slash].translate(_LOWER), url[slash:end]


def build_trie(rules: Iterable[tuple[str, str, str]]) -> dict:
    """Nested dictionaries for rules ``(verdict, host, path)``.

    Host labels from the last to the first lead to a node; below its ``"/"`` entry the
    path's whole segments lead on.  A node's ``""`` entry lists what may remain of a rule's
    path after its last whole segment, with the rule's length, name and verdict.  Among
    equal rules the first one counts.
    """
    root: dict = {"hosts": {}}
    for verdict, host, path in rules:
        node = root
        for label in reversed(host.translate(_LOWER).split(".")) if host else ():
            node = node["hosts"].setdefault(label, {"hosts": {}})
        *whole, rest = path.split("/")
        node = node.setdefault("paths", {"next": {}})
        for segment in whole:
            node = node["next"].setdefault(segment, {"next": {}})
        name = host + path
        node.setdefault("rules", []).append((rest, len(name), name, verdict))
    return root


def longest(trie: dict, host: str, path: str) -> tuple[int, int, str, str] | None:
    """Length, host labels, name and verdict of the longest rule that fits; of equally long
    ones that with the fewest host labels."""
    best: tuple[int, int, str, str] | None = None
    segments = path.split("/")
    node = trie
    labels = host.split(".")
    for depth in range(len(labels) + 1):
        place = node.get("paths")
        for i in range(len(segments)):
            if place is None:
                break
            for rest, size, name, verdict in place.get("rules", ()):
                if (best is None or size > best[0]) and "/".join(segments[i:]).startswith(rest):
                    best = (size, depth, name, verdict)
            place = place["next"].get(segments[i]) if i + 1 < len(segments) else None
        if depth == len(labels):
            break
        node = node["hosts"].get(labels[-1 - depth])
        if node is None:
            break
    return best


def match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """Name and verdict of the longest rule that fits."""
    best = longest(trie, host, path)
    return best and best[2:]


def blocks_of(rules: Iterable[tuple[str, str, str]], chars: int) -> list[list[tuple[str, str, str]]]:
    """The rules in order, in lists of at most ``chars`` characters (a longer rule is alone)."""
    blocks: list[list[tuple[str, str, str]]] = [[]]
    size = 0
    for verdict, host, path in rules:
        size += len(host) + len(path)
        if size > chars and blocks[-1]:
            blocks.append([])
            size = len(host) + len(path)
        blocks[-1].append((verdict, host, path))
    return blocks


def judge_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    default: str = "allow",
    id_column: str = "page_id",
    url_column: str = "url",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Id, host, path, rule and verdict of every row.

    A rule fits its host and all subdomains when the path starts with the rule's path;
    the longest rule decides, whichever its verdict, and ``default`` where none fits.  Rules
    are broadcast in tries of at most ``block_chars`` characters; where there are several, the rows
    pass through one after the other, and keep the longest rule so far.

    Null urls and urls without ``://`` have an empty host and path and get the default
    (unless a rule has an empty host).  Null ids pass through, repeated rows are judged one
    by one, other columns are not read, an empty table gives an empty table.
    """
    context = pages.sparkSession.sparkContext

    def judge(rows: DataFrame, shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trie = build_trie(shared.value)
            for batch in batches:
                found = []
                for url, *before in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                    host, path = split_url(url)
                    best = longest(trie, host, path)
                    size, depth = before[:2]
                    if best is None or (size is not None and (-best[0], best[1]) >= (-size, depth)):
                        best = before
                    found.append(best)
                columns = list(zip(*found, strict=True)) or [()] * 4
                kinds = pa.int32(), pa.int32(), pa.string(), pa.string()
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:2], *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=names
                )

        return rows.mapInArrow(run, rows.schema)

    none = {"size": "int", "depth": "int", "rule": "string", "verdict": "string"}
    names = ["id", "url", *none]
    rows = pages.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in none.items()),
    )
    for block in blocks_of(rules, block_chars):
        rows = judge(rows, context.broadcast(block))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = list(zip(*map(split_url, batch.column(1).to_pylist()), strict=True)) or [(), ()]
            parts = [pa.array(hosts, pa.string()), pa.array(paths, pa.string())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *parts, batch.column(4), batch.column(5).fill_null(default)],
                names=["id", "host", "path", "rule", "verdict"],
            )

    out = rows.mapInArrow(split, f"id {type_of(rows, 'id')}, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("id", id_column)
