"""Main text of web pages by tree scoring."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import few_rows, type_of

# Comments, elements whose content is no text, tags (also cut off by the page's end), declarations.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|iframe|svg|object)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

CONTAINERS = frozenset(
    "html body main article section div center td th table tbody tr ul ol dl blockquote figure "
    "details fieldset".split()
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre address figcaption summary caption".split())
LEFT_OUT = frozenset("head title nav header footer aside form menu dialog button select".split())
BLOCKS = CONTAINERS | PARAGRAPHS | LEFT_OUT | {"hr"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
EMPTY = frozenset(("hr", "br", "img", "input", "meta", "link", "wbr"))

# Words in a class, id or role that mark what is not the article.
LEFT_OUT_NAMES = frozenset(
    "ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer header hidden login masthead menu modal nav navbar navigation newsletter "
    "notice overlay pagination pager popup promo related reply replies search share sharing sidebar "
    "signup social sponsor sponsored subscribe toolbar widget".split()
)
# With one of those names, these speak of the element's form and not of what it is about.
FORM_NAMES = frozenset(
    "area bar block box button buttons container content count form group icon icons inner item items link links "
    "list panel row section slot unit wrap wrapper".split()
)
_NAME_PARTS = re.compile(r"[^a-z]+")
# Before such a name these words speak of the page's layout, as in "no-sidebar".
LAYOUT_NAMES = frozenset("no has with without".split())
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)

ARTICLE_BONUS = 25.0
# A part of the page is a list of links if they hold more than this share of its text.
LINK_SHARE = 1 / 3


class Node:
    __slots__ = ("tag", "parent", "out", "head", "article", "score", "chars", "link_chars", "kept")

    def __init__(self, tag: str, parent: Node | None, out: bool = False, head: bool = False):
        # ``head``: lies in the header of an article, of which only headings are text.
        self.tag, self.parent, self.out, self.head = tag, parent, out, head
        # The outermost article or main element that it is or lies in.
        self.article: Node | None = parent.article if parent is not None else None
        if self.article is None and tag in ("article", "main"):
            self.article = self
        self.score = 0.0
        self.chars = self.link_chars = 0
        self.kept = False


def attributes_of(rest: str) -> dict[str, str]:
    """Values by lower-case name; of a repeated attribute the first counts."""
    values: dict[str, str] = {}
    for found in _ATTRIBUTE.finditer(rest):
        values.setdefault(found[1].lower(), found[2] or found[3] or found[4] or "")
    return values


def named_out(values: dict[str, str], in_article: bool) -> bool:
    """Whether an element's attributes mark it as hidden or as no part of the article.

    Outside an article the first or last part of a class, id or role decides ("share-box",
    "left-sidebar").  Inside, where such words may be the subject ("share-price",
    "related-work"), all of its parts have to be such names or speak of form.
    """
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true":
        return True
    if _NO_DISPLAY.search(values.get("style", "")):
        return True
    for name in ("class", "id", "role"):
        for token in values.get(name, "").lower().split():
            parts = [p for p in _NAME_PARTS.split(token) if p]
            if not parts or not any(p in LEFT_OUT_NAMES for p in parts):
                continue
            if in_article:
                if all(p in LEFT_OUT_NAMES or p in FORM_NAMES for p in parts):
                    return True
            elif parts[0] in LEFT_OUT_NAMES or (parts[-1] in LEFT_OUT_NAMES and parts[-2] not in LAYOUT_NAMES):
                return True
    return False


def blocks_of(html: str) -> tuple[list[Node], list[tuple[Node, str, int]]]:
    """The page's elements, parents first, and its text blocks in page order: the element,
    the text, and how much of it is in links."""
    node = Node("html", None)
    nodes = [node]
    blocks: list[tuple[Node, str, int]] = []
    pieces: list[str] = []
    links: list[str] = []
    in_link = False
    # Open elements by tag, so that an end tag without a start does not search all of them.
    still_open: Counter[str] = Counter()

    def flush() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text and not node.out:
                linked = len(" ".join(unescape("".join(links)).split())) if links else 0
                blocks.append((node, text, min(linked, len(text))))
            pieces.clear()
            links.clear()

    def leave(inner: Node) -> Node:
        still_open[inner.tag] -= 1
        return inner.parent

    at = 0
    for found in _MARKUP.finditer(html):
        if found.start() > at:
            pieces.append(html[at : found.start()])
            if in_link:
                links.append(pieces[-1])
        at = found.end()
        tag = (found["tag"] or "").lower()
        if tag == "br":
            pieces.append(" ")
        elif tag == "a":
            in_link = not found["close"]
        if tag not in BLOCKS:
            continue
        flush()
        in_link = False
        if found["close"]:
            if still_open[tag]:
                while node.tag != tag:
                    node = leave(node)
                node = leave(node)
            continue
        if tag == "body":  # ends a head left open
            while node.parent is not None:
                node = leave(node)
        while node.tag in PARAGRAPHS and not (node.tag in ("li", "dd") and tag != node.tag):
            node = leave(node)
        if tag in EMPTY or tag == "html":
            continue
        rest = found["rest"]
        out, head = node.out and not node.head, node.head
        if not out and not head and tag == "header" and node.article is not None:
            head = True
        elif tag in LEFT_OUT:
            out = True
        if not out and rest and tag not in ("body", "main", "article"):
            out = named_out(attributes_of(rest), node.article is not None)
        if out:
            head = False
        elif head:
            out = tag not in HEADINGS
        node = Node(tag, node, out, head)
        nodes.append(node)
        still_open[tag] += 1
    if at < len(html):
        pieces.append(html[at:])
    flush()
    return nodes, blocks


def main_text(html: str | None) -> str:
    """The article's blocks, one per line.

    Every block has a point, one per comma and up to three for length, less its share of
    link text.  Its container gets them whole, the next ancestor half, the one above a
    quarter and so on.  The container with most points, less its own share of link text, is
    the best.  All blocks of it are kept, and those of the siblings of it and of its
    ancestors, up to the outermost article or main element around it, unless links fill
    them.  Other articles beside that one are kept too.  The work is in proportion to
    the page, however deep its elements are nested.
    """
    if not html:
        return ""
    nodes, blocks = blocks_of(html)
    if not blocks:
        return ""
    for node, text, linked in blocks:
        node.chars += len(text)
        node.link_chars += linked
        container = node.parent if node.tag in PARAGRAPHS and node.parent is not None else node
        container.score += (1 + text.count(",") + min(len(text) // 100, 3)) * (1 - linked / len(text))
    for node in reversed(nodes):  # children before parents
        if node.parent is not None:
            node.parent.score += node.score / 2
            node.parent.chars += node.chars
            node.parent.link_chars += node.link_chars

    def worth(n: Node) -> float:
        bonus = ARTICLE_BONUS if n.tag in ("article", "main") else 0.0
        return (n.score + bonus) * (1 - n.link_chars / n.chars)

    def few_links(chars: int, linked: int) -> bool:
        return linked <= LINK_SHARE * chars

    best = max((n for n in nodes if n.chars and n.tag not in PARAGRAPHS), key=worth)
    around: set[Node] = set()  # the ancestors whose other parts are siblings
    up = best
    while up is not best.article and up.parent is not None:
        up = up.parent
        around.add(up)
    beside = up.parent  # of an article or main element; None without one
    for node in nodes:
        parent = node.parent
        if node is best:
            node.kept = True
        elif node in around or parent is None:
            continue
        elif parent.kept:
            node.kept = True
        elif parent in around:
            node.kept = few_links(node.chars, node.link_chars) or (
                node.tag in PARAGRAPHS and node.article is not None
            )
        elif parent is beside:
            node.kept = node.tag in ("article", "main") and few_links(node.chars, node.link_chars)
    return "\n".join(
        text for node, text, linked in blocks if node.kept or (node in around and few_links(len(text), linked))
    )


def extract_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Id, url, ``text`` and ``n_chars`` (code points) of every page.

    Kept is the article with its headings, lists and tables; menus, headers, footers,
    sidebars, notices, adverts, forms, scripts, styles and reader comments are left out, by
    element or by class, id and role.  Character references are decoded, white space in a
    block becomes one space, blocks are joined by a line feed.  Markup may be broken or
    cut off; pages are read whole, however long.

    Null and empty pages, and those without an article, give an empty text.  Null ids and
    urls pass through, repeated rows are read one by one, other columns are not read, an
    empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["id", "url", "text", "n_chars"],
            )

    narrow = pages.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").alias("url"), F.col(f"`{html_column}`").cast("string").alias("html")
    )
    out = narrow.mapInArrow(
        run, f"id {type_of(narrow, 'id')}, url {type_of(narrow, 'url')}, text string, n_chars bigint"
    )
    return out.withColumnsRenamed({"id": id_column, "url": url_column})
