"""Main text of web pages by scoring the tree.

Every paragraph with enough text passes points to its ancestors: one, one for each
comma, one for each hundred characters (three at most); the parent gets all, the
grandparent half, further ones less. A container's points are discounted by the
share of its text inside links. The best container is the article; of its
siblings those are kept that score well beside it or are running text.

Scripts, styles, forms, navigation, headers and footers of the page, asides,
notices, adverts and reader comments are taken out before scoring, by element and by the
words of class, id and role. Markup may be unclosed: a block start closes an open
paragraph, an unknown end is ignored, the end of the page closes the rest.

Edge cases: a null or empty page, or one without text, gives ''; rows with null or
repeated ids are extracted one by one; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

#: Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
UNSEEN = frozenset("head script style noscript template textarea title iframe svg math nav footer aside form button select input object embed dialog menu".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd figcaption h1 h2 h3 h4 h5 h6".split())
#: What closes when an element of the name starts.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table html body article section div td".split())
#: Words of class, id and role that mark what isn't the article.
ASIDE = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus "
    "footer header masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related "
    "respond reply replies share sharing shares sidebar social sponsor sponsored subscribe subscription toolbar widget widgets complementary contentinfo "
    "search alert".split())
KEEP = frozenset("article main body html".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_MARK = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|[\s"'/])hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORD = re.compile(r"[A-Za-z]+")
COMMAS = ",\u060c\u3001\uff0c"
#: A block with fewer characters passes no points; shares of the points by distance.
LEAST_CHARS, SHARES = 25, (1.0, 0.5, 1 / 6, 1 / 9, 1 / 12)
#: A sibling needs so many points, and so much of the best one's.
LEAST_SIBLING, SIBLING_SHARE = 10.0, 0.2


class Node:
    """An element; ``block`` is the nearest block at or above it, ``linked`` whether it lies in a link."""

    __slots__ = ("name", "parent", "children", "out", "block", "linked", "chars", "link_chars", "own", "own_links", "commas", "points", "article")

    def __init__(self, name: str, parent: Node | None, out: bool = False):
        self.name, self.parent, self.children, self.out = name, parent, [], out
        self.block = self if name in BLOCKS or parent is None else parent.block
        self.linked = name == "a" or (parent is not None and parent.linked)
        self.article = name in ("article", "main") or (parent is not None and parent.article)
        self.chars = self.link_chars = self.own = self.own_links = self.commas = 0
        self.points = 0.0


def _is_aside(node: Node, name: str, attributes: str) -> bool:
    """Whether an element isn't part of an article, by its name and marks."""
    if name in UNSEEN or (name == "header" and not node.article):
        return True
    if not attributes or name in KEEP:
        return False
    words = {w.lower() for m in _MARK.finditer(attributes) for w in _WORD.findall(m[2] or m[3] or m[4] or "")}
    if node.article:
        words.discard("header")
    return bool(words & ASIDE) or bool(_HIDDEN.search(attributes))


def tree(html: str) -> list[Node]:
    """Elements of a page in page order, the root first; what is no article holds no text."""
    node = Node("html", None)
    nodes = [node]
    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        text = html[at : m.start() if m else size]
        if text and not node.out:
            _add(node, unescape(text))
        if not m:
            break
        at, name = m.end(), (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            node = _closed(node, name)
            continue
        if name in BLOCKS:
            node = _before_block(node, name)
        if name in VOID:
            if name == "br" and not node.out:
                node.children.append(" ")
            continue
        child = Node(name, node, node.out or _is_aside(node, name, m[3]))
        nodes.append(child)
        node.children.append(child)
        if name in RAW:
            end = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = end.end() if end else size
        elif not (m[3].endswith("/") and name not in BLOCKS):
            node = child
    return nodes


def _add(node: Node, text: str) -> None:
    """Put a text into an element and count it for its block."""
    node.children.append(text)
    n, block = len(" ".join(text.split())), node.block
    node.chars += n
    block.own += n
    block.commas += sum(text.count(c) for c in COMMAS)
    if node.linked:
        node.link_chars += n
        block.own_links += n


def _before_block(node: Node, name: str) -> Node:
    """Where a block begins: an open paragraph ends, as do siblings that can't hold it."""
    if node.block.name == "p":
        node = node.block.parent or node
    ends, up = CLOSES.get(name), node
    while ends and up.parent is not None and (up.name in ends or up.name not in SCOPES):
        if up.name in ends:
            return up.parent
        up = up.parent
    return node


def _closed(node: Node, name: str) -> Node:
    """Where an end leads; one that fits nothing open, or would leave the block around it, is ignored."""
    up = node
    while up.parent is not None:
        if up.name == name:
            return up.parent
        if name not in BLOCKS and up is up.block or name == "p" and up.name != "p" and up is up.block:
            return node
        up = up.parent
    return node


def _scored(nodes: list[Node]) -> None:
    """Sum text lengths over subtrees and pass the points of every paragraph to its ancestors."""
    for n in reversed(nodes):
        if n.parent is not None:
            n.parent.chars += n.chars
            n.parent.link_chars += n.link_chars
    for n in nodes:
        if n is n.block and n.own >= LEAST_CHARS:
            points = (1 + n.commas + min(3, n.own // 100)) * (1 - n.own_links / n.own)
            up = n.parent.block if n.name in PARAGRAPHS and n.parent is not None else n
            for share in SHARES:
                if up is None:
                    break
                up.points += points * share
                up = up.parent.block if up.parent is not None else None


def _final(node: Node) -> float:
    return node.points * (1 - node.link_chars / node.chars) if node.chars else 0.0


def _chosen(nodes: list[Node]) -> list[Node]:
    """The best container, or the article around it, and the siblings that go with it."""
    best = max((n for n in nodes if n is n.block and n.name not in PARAGRAPHS), key=_final)
    if not _final(best):
        return nodes[:1]
    up, around = best, None
    while up is not None:
        if up.name in ("article", "main"):
            around = up if around is None or up.name == "article" else around
        up = up.parent
    if around is not None and 2 * _final(around) >= _final(best) * SHARES[1]:
        return [around]
    if best.parent is None:
        return [best]
    least = max(LEAST_SIBLING, SIBLING_SHARE * _final(best))

    def goes_along(n: Node) -> bool:
        if n.name in PARAGRAPHS:
            return n.own > 0 and (n.name[0] == "h" or n.own_links < 0.25 * n.own)
        return _final(n) >= least

    return [n for n in best.parent.children if isinstance(n, Node) and (n is best or goes_along(n))]


def _blocks(node: Node) -> list[str]:
    """Texts of a subtree in page order, one string a block."""
    out: list[list[str]] = [[]]
    stack: list[Node | str | None] = [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            out[-1].append(n)
        elif n is None:
            out.append([])
        elif not n.out:
            if n is n.block:
                out.append([])
                stack.append(None)
            stack += reversed(n.children)
    return ["".join(b) for b in out]


def main_text(html: str | None) -> str:
    """The article of a page: blocks in page order, joined by one space."""
    if not html:
        return ""
    nodes = tree(html)
    _scored(nodes)
    texts = (" ".join(t.split()) for n in _chosen(nodes) for t in _blocks(n))
    return " ".join(t for t in texts if t)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page; no shuffle."""
    return pages.select("page_id", "url", "html").mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
