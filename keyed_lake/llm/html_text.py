"""Main text of web pages by tag-path ratios.

A page becomes a list of text nodes, each with its path of tags from the root. For every path, the text length and the
punctuation of its nodes are summed and divided by their number. Both ratios are smoothed along the page and fused by
multiplication with a third feature of the path, its looks: every form and aside on it divides the product by `DOUBT`, every
element whose role, class or id speaks against it by `NAMED` (by `COMMENT` if it speaks of comments), while an `article`
or `main` that isn't among comments sets it back to one. Paths whose product reaches `SHARE` of the page's mean, weighted by length, are
content.

Content decides what stays: the smallest element that holds all content nodes is the article, widened to an enclosing
`article` or `main`, and an element that looks like something else is dropped from it unless it holds a content node. So
short headings and list items of the article stay, and a page or wrapper that is called `sidebar` stays too where
nothing better is there. Navigation, scripts and other elements that are never part of an article by their tag, and hidden
ones, are left out before.

A null or empty page, or one without text, gives an empty text. Unclosed tags end where HTML ends them or with the page.
A page is read in time and memory in proportion to its length and tags, whatever their depth; no text is too long.
Among equal ratios all nodes are content. Pages are independent of each other: there is no shuffle, and repeated rows are
separate results.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import col, fresh, map_arrow, plus

SHARE = 0.25
DOUBT, NAMED, COMMENT = 50, 1_000, 20_000

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
BLOCK = set(
    "html head body address article aside blockquote caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
NEVER = set(
    "head nav footer script style textarea title noscript template iframe svg math button select option "
    "dialog menu object canvas audio video datalist search xmp noembed noframes".split()
)
DOUBTFUL = set("aside form fieldset".split())
ROLES = set("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar".split())
WORDS = set(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices notification popup "
    "modal overlay newsletter subscribe subscription share sharing social related recommended recommendations comment "
    "comments disqus replies login signup signin widget toolbar pagination pager skip hidden".split()
)
ONE_WORD = set("topbar adbox adsense adslot commentlist cookiebar sitemap siteheader sitefooter sideblock".split())
COMMENTS = set("comment comments disqus replies commentlist".split())
#: Words that turn a name into one of the layout: `no-sidebar`, `with-comments`, `sidebar-layout`.
LAYOUT = set("no not non without with has layout template".split())
#: An opening tag of the first kind ends an open element of the second kinds, up to the nearest of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^<>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^<>\"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：¿¡]")
ATTRIBUTES = ("class", "id", "role", "aria-hidden", "style", "hidden")


class Node:
    """An element. `path` numbers its tag path, `doubt` is the innermost element at or above it that looks like something else."""

    __slots__ = ("tag", "parent", "out", "path", "looks", "inside", "doubt", "comments")

    def __init__(self, tag: str, parent: Node | None, attributes: str, paths: dict[tuple[int, str, float], int]):
        article = tag in ("article", "main")
        names = looks(attributes)
        marked = (bool(names) or tag in DOUBTFUL) and not article and tag not in ("html", "body")
        self.tag, self.parent = tag, parent
        self.inside = article or bool(parent and parent.inside)
        self.out = bool(parent and (parent.out or unwanted(tag, attributes, parent.inside)))
        self.comments = bool(names & COMMENTS) or bool(parent and parent.comments)
        self.looks = parent.looks if parent else 1.0
        if article and not names and not self.comments:
            self.looks = 1.0
        elif marked or (article and names):
            self.looks /= COMMENT if names & COMMENTS else NAMED if names else DOUBT
        self.doubt = self if marked else parent.doubt if parent else None
        # a path is its parent's number, a tag and the looks, so that deep pages don't spell out long paths
        self.path = paths.setdefault((parent.path if parent else -1, tag, self.looks), len(paths))


def unwanted(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element is never shown or never part of an article. A header within the article holds its heading."""
    if tag in NEVER or (tag == "header" and not inside):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    lower = attributes.lower()
    if not any(n in lower for n in ATTRIBUTES):
        return False
    if re.search(r"(?:^|\s)hidden(?:\s|/|$)", lower):
        return True
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


def looks(attributes: str) -> set[str]:
    """The words in an element's role, class and id that speak against it."""
    lower = attributes.lower()
    if not any(n in lower for n in ("class", "id", "role")):
        return set()
    found: set[str] = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "")
        if name == "role":
            found |= {value.lower().strip()} & ROLES
        if name in ("class", "id"):
            for one in value.split():
                words = {w.lower() for part in re.split(r"[^A-Za-z]+", one) for w in re.split(r"(?<=[a-z])(?=[A-Z])", part)}
                if not words & LAYOUT:
                    found |= words & WORDS | words & ONE_WORD
    return found


def parse(page: str) -> tuple[list[tuple[str, Node, int]], list[Node]]:
    """The text nodes in page order (text, element, and number of the block that it belongs to), and all elements, outer first."""
    found: list[tuple[str, Node, int]] = []
    paths: dict[tuple[int, str, float], int] = {}
    top = Node("", None, "", paths)
    stack, nodes, block, at, end = [top], [top], 0, 0, len(page)
    open_tags: Counter[str] = Counter()

    def text(raw: str) -> None:
        if raw:
            found.append((html.unescape(raw) if "&" in raw else raw, stack[-1], block))

    def close(k: int) -> None:
        open_tags.subtract(n.tag for n in stack[k:])
        del stack[k:]

    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:-3])
            continue
        closing, attributes = m[1] or m[4], m[3] if m[2] else m[6]
        if tag in BLOCK:
            block += 1
        if closing:
            if open_tags[tag] > 0:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        if tag in VOID:
            if tag == "br":
                found.append((" ", stack[-1], block))
            continue
        ends, border = ENDS.get(tag, ({"p"}, {"div", "td", "th", "li", "article", "section", "main", "body", "button"}))
        if tag in BLOCK and any(open_tags[t] > 0 for t in ends):
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in ends:
                    close(k)
                    break
                if stack[k].tag in border:
                    break
        if tag in RAW:
            last = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            at = last.end() if last else end
        elif not attributes.endswith("/") or tag in BLOCK:
            stack.append(Node(tag, stack[-1], attributes, paths))
            nodes.append(stack[-1])
            open_tags[tag] += 1
    return found, nodes


def content(found: list[tuple[str, Node, int]], share: float = SHARE) -> list[int]:
    """The text nodes whose path has fused ratios above the threshold; a share of 0 chooses all."""
    own = [i for i, (t, node, _) in enumerate(found) if t and not node.out and not t.isspace()]
    if not own:
        return []
    path = np.unique([found[i][1].path for i in own], return_inverse=True)[1]
    nodes = np.bincount(path)
    long = np.array([len(found[i][0]) for i in own], float)
    marks = np.array([len(PUNCTUATION.findall(found[i][0])) for i in own], float)
    length, marked = ((np.bincount(path, x) / nodes)[path] for x in (long, marks))
    fused = smooth(length) * (smooth(marked) + 1e-3) * np.array([found[i][1].looks for i in own])
    chosen = fused >= min(share * np.average(fused, weights=long), fused.max())
    return [i for i, c in zip(own, chosen) if c]


def smooth(x: np.ndarray) -> np.ndarray:
    """A Gaussian over the neighbours on both sides; the ends repeat."""
    weights = np.exp(-np.arange(-1, 2) ** 2 / 2)
    return np.convolve(np.pad(x, 1, mode="edge"), weights / weights.sum(), "valid")


def article(chosen: list[Node], held: dict[int, int]) -> Node:
    """The smallest element with all of the content, widened from a paragraph to what holds it."""
    node = chosen[0]
    while held[id(node)] < len(chosen):
        node = node.parent
    outer = node
    while outer is not None and outer.tag not in ("article", "main"):
        outer = outer.parent
    if outer is not None:
        return outer
    while node.parent is not None and node.tag not in ("div", "section", "td", "body", "html", ""):
        node = node.parent
    return node


def main_text(page: str | None, share: float = SHARE) -> str:
    found, nodes = parse(page or "")
    chosen = [found[i][1] for i in content(found, share)]
    if not chosen:
        return ""
    held = Counter(id(n) for n in chosen)  # content nodes at or below an element
    for node in reversed(nodes):
        if node.parent is not None and id(node) in held:
            held[id(node.parent)] += held[id(node)]
    root = article(chosen, held)
    kept: set[int] = set()
    for node in nodes:
        above = node is root or (node.parent is not None and id(node.parent) in kept)
        if above and not node.out and (node is root or node.doubt is not node or id(node) in held):
            kept.add(id(node))
    blocks: dict[int, list[str]] = {}
    for text, node, block in found:
        if id(node) in kept:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(x for x in lines if x)


def extract(df: DataFrame, page: str, text_name: str = "text", size_name: str = "n_chars") -> DataFrame:
    """All columns and the main text with its number of code points; underscores go in front of taken names."""
    schema = plus(df.schema, (fresh(text_name, df.columns), "string"), (fresh(size_name, df.columns), "long"))
    at = df.columns.index(page)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(at).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), sizes], schema.names)

    return map_arrow(df, rows, schema)


def extract_pages(df: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = df.select(col(key).alias("page_id"), col(url).alias("url"), col(page).cast("string").alias("_html"))
    return extract(rows, "_html").drop("_html")
