"""Main text of web pages by tree scoring.

A page is read into a small tree of elements. Scripts, styles, forms, menus, headers,
footers, sidebars, adverts, notices and comments go first, by tag, role, class or id. Each
paragraph then earns points for its length and its commas and passes them to its ancestors,
less the farther up; a container's points are discounted by the share of its text that lies
in links. The best container stays, with those siblings that score well or read like prose.

Pages are independent, so Spark deals them out in Arrow batches and one page at a time is in
memory as a tree. Defined results: null, empty or text-free html gives an empty text;
repeated rows are extracted each for itself; an empty table gives an empty result; a page
without any markup is one block; other columns are ignored; nothing is cut.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertalk.llm.common import with_fields

# HTML's own lists.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p "
    "pre section summary table tbody td tfoot th thead tr ul".split()
)
# A start tag of the first kind ends an open element of the second, within the third.
ENDS_P = BLOCKS - frozenset("body caption html li tbody td tfoot th thead tr dd dt".split())
P_WITHIN = frozenset("td th li button table div article section main blockquote".split())
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# What never belongs to an article.
DROPPED = frozenset(
    "script style template noscript iframe object embed applet svg math canvas audio video map "
    "form button select textarea input option datalist nav aside footer menu head title dialog "
    "xmp noembed noframes".split()
)
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "form toolbar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner billboard breadcrumb "
    "breadcrumbs comment comments commentlist consent cookie cookies cookiebar disclaimer disqus "
    "footer footnav gdpr header login masthead menu menubar modal nav navbar navigation newsletter "
    "notice notices notification outbrain overlay pager pagination paywall popup promo promoted "
    "promotion recommended related replies reply respond rss search share sharing sidebar sidebars "
    "signup skip skyscraper social sponsor sponsored subscribe subscription taboola toolbar "
    "widget widgets".split()
)
# Names that a paragraph or a heading of an article may bear as well.
AMBIGUOUS = frozenset("header login notice related replies reply rss search share skip social".split())
# A class with one of these words tells a state of the page, not what the element is.
STATES = frozenset("closed disabled enabled fixed has is layout no not off on open sticky with without".split())
KEPT_NAMES = frozenset("article content entry main post story text body page".split())
TAG_POINTS = {"article": 30, "main": 20, "section": 5, "div": 3, "td": 3, "blockquote": 3, "pre": 3}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = frozenset("p pre blockquote td li dd".split())

# Points of a paragraph: 1, one a comma, one a hundred characters up to 3.
CHARS_A_POINT, MOST_LENGTH_POINTS = 100, 3
SIBLING_SHARE, LEAST_SIBLING = 0.2, 10
LONG_PARAGRAPH, FEW_LINKS = 80, 0.25

MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)"
    r"(?P<attrs>(?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+')*+)>"
    r"|</?[a-zA-Z!?][^>]*>|<[!?/][^>]*>",
    re.S,
)
ATTRIBUTE = re.compile(
    r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I
)
NEVER_DROPPED = frozenset("html body article main".split())
NAME_PARTS = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "parent", "children", "points", "chars", "link_chars", "named", "dropped")

    def __init__(self, tag: str, parent: Node | None, attrs: str = ""):
        self.tag, self.parent = tag, parent
        self.children: list[Node | str] = []
        self.points = 0.0
        self.chars = self.link_chars = 0
        self.dropped = tag in DROPPED
        self.named = False
        if attrs and not self.dropped:
            self._look_at(attrs)

    def _look_at(self, attrs: str) -> None:
        for name, a, b, c in ATTRIBUTE.findall(attrs):
            name, value = name.lower(), (a or b or c).lower()
            if name in ("class", "id"):
                for one in value.split():
                    parts = NAME_PARTS.findall(one)
                    self.named |= not KEPT_NAMES.isdisjoint(parts)
                    if STATES.isdisjoint(parts) and self.tag not in NEVER_DROPPED:
                        unwanted = DROPPED_NAMES.intersection(parts)
                        if self.tag in HEADINGS or self.tag == "p":
                            unwanted -= AMBIGUOUS
                        # "article-header" or "post-comments" is no article.
                        self.dropped |= bool(unwanted)
            elif name == "role":
                self.dropped |= not DROPPED_ROLES.isdisjoint(value.split())
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                self.dropped = True
            elif name == "style" and HIDDEN.search(value):
                self.dropped = True


class Open:
    """The open element of a page that is read, with the number of open ones of each tag, so
    that an end tag without an open one costs nothing."""

    def __init__(self, root: Node):
        self.root = self.node = root
        self.tags: Counter[str] = Counter()

    def enter(self, child: Node) -> None:
        self.tags[child.tag] += 1
        self.node = child

    def leave_to(self, outer: Node) -> None:
        while self.node is not outer:
            self.tags[self.node.tag] -= 1
            self.node = self.node.parent

    def close(self, tag: str) -> None:
        """Leave the nearest open element with this tag; no such one: no change."""
        seek = self.node
        while self.tags[tag] and seek.parent is not None:
            if seek.tag == tag:
                self.leave_to(seek.parent)
                return
            # An inline end tag does not close the block around it.
            if tag not in BLOCKS and seek.tag in BLOCKS:
                return
            seek = seek.parent

    def close_all(self, closing: set[str], within: set[str]) -> None:
        """Close open elements out to the outermost of ``closing`` found inside ``within``."""
        if not any(self.tags[tag] for tag in closing):
            return
        seek = out = self.node
        while seek.parent is not None and seek.tag not in within:
            if seek.tag in closing:
                out = seek.parent
            seek = seek.parent
        self.leave_to(out)


def parse(page: str) -> Node:
    """Tree of a page; end tags that HTML lets authors leave out are put in."""
    root = Node("html", None)
    here = Open(root)
    at = 0
    # Behind the last ">" there is no markup; a "<" there need not look for one.
    last = page.rfind(">")
    unclosed: set[str] = set()
    while at < len(page):
        found = MARKUP.search(page, at) if at <= last else None
        if found is None:
            here.node.children.append(page[at:])
            break
        if found.start() > at:
            here.node.children.append(page[at : found.start()])
        at = found.end()
        name = found["name"]
        if not name:
            continue
        tag = name.lower()
        if found["end"]:
            here.close(tag)
            continue
        if tag in ("html", "body"):
            if tag == "body":
                # A body seen first or late takes over what an unclosed head left open.
                while here.node.parent is not None and here.node.tag in DROPPED:
                    here.leave_to(here.node.parent)
            continue
        if tag in ENDS_P:
            here.close_all({"p"}, P_WITHIN)
        if tag in SIBLINGS:
            here.close_all(*SIBLINGS[tag])
        if tag in HEADINGS and here.node.tag in HEADINGS:
            here.leave_to(here.node.parent or root)
        child = Node(tag, here.node, found["attrs"])
        here.node.children.append(child)
        if tag in VOID or found["attrs"].endswith("/") and tag in ("path", "svg", "circle"):
            continue
        if tag in RAW:
            end = None
            if tag not in unclosed:
                end = re.compile(f"</{tag}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            if end is None:
                # Unclosed: a script hides the rest, a title only itself.
                unclosed.add(tag)
                at = len(page) if tag != "title" else at
                continue
            at = end.end()
            continue
        here.enter(child)
    return root


def _drop(root: Node) -> None:
    """Remove what never belongs to the text. Inside an article, a header that holds a
    heading is the article's own; any other header is the page's. A form that holds most of
    the page's prose, as some servers put round every page, is no form of the article's."""
    prose: dict[int, int] = {}
    headed: set[int] = set()
    for node in reversed(_preorder(root)):
        size = 0 if node.tag in DROPPED - {"form"} or node.tag == "a" else 1
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        inner = [c for c in node.children if isinstance(c, Node)]
        prose[id(node)] = size * (own + sum(prose[id(c)] for c in inner))
        if any(c.tag in HEADINGS or id(c) in headed for c in inner):
            headed.add(id(node))
    most = prose[id(root)] / 2
    stack: list[tuple[Node, bool]] = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside |= node.tag in ("article", "main")
        kept: list[Node | str] = []
        for child in node.children:
            if isinstance(child, Node):
                if child.dropped and not (child.tag == "form" and prose[id(child)] > most):
                    continue
                if child.tag == "header" and not (inside and id(child) in headed):
                    continue
                stack.append((child, inside))
            kept.append(child)
        node.children = kept


def _preorder(root: Node) -> list[Node]:
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return order


def _score(order: list[Node]) -> None:
    """Text sizes from the leaves up, then points of paragraphs passed to their ancestors."""
    commas: dict[int, int] = {}
    for node in reversed(order):
        own = 0
        for child in node.children:
            if isinstance(child, str):
                node.chars += len(" ".join(child.split()))
                own += child.count(",")
            else:
                node.chars += child.chars
                node.link_chars += child.link_chars
                own += commas[id(child)] if child.tag not in BLOCKS else 0
        commas[id(node)] = own
        if node.tag == "a":
            node.link_chars = node.chars
    for node in order:
        node.points += TAG_POINTS.get(node.tag, 0) + (10 if node.named else 0)
    for node in order:
        direct = any(isinstance(c, str) and c.strip() for c in node.children)
        if node.chars == 0 or not (
            node.tag in PARAGRAPHS and not _holds_blocks(node)
            or node.tag in BLOCKS and node.tag not in HEADINGS and direct
        ):
            continue
        points = 1 + commas[id(node)] + min(node.chars / CHARS_A_POINT, MOST_LENGTH_POINTS)
        points *= 1 - node.link_chars / node.chars
        above, level = node if node.tag not in PARAGRAPHS else node.parent, 0
        while above is not None and level < 5:
            above.points += points / (1 if level == 0 else 2 if level == 1 else level * 3)
            above, level = above.parent, level + 1


def _holds_blocks(node: Node) -> bool:
    return any(isinstance(c, Node) and c.tag in BLOCKS for c in node.children)


def _final(node: Node) -> float:
    return node.points * (1 - node.link_chars / node.chars) if node.chars else 0.0


def _chosen(root: Node, order: list[Node]) -> list[Node]:
    """The best container and the siblings that belong to it, in page order."""
    containers = [n for n in order if n.tag in BLOCKS and n.chars and n.tag not in HEADINGS | {"p", "li"}]
    if not containers:
        return [root]
    best = max(containers, key=_final)
    # The whole article, if the best container is only a part of one.
    above = best
    while above is not None:
        if above.tag in ("article", "main"):
            best = above
        above = above.parent
    if best.parent is None:
        return [best]
    least = max(LEAST_SIBLING, SIBLING_SHARE * _final(best))
    kept = []
    seen = False
    for sibling in best.parent.children:
        if not isinstance(sibling, Node) or not sibling.chars:
            continue
        links = sibling.link_chars / sibling.chars
        prose = sibling.tag == "p" and (
            sibling.chars > LONG_PARAGRAPH and links < FEW_LINKS
            or links == 0 and _ends_sentence(sibling)
        )
        scored = sibling.tag in BLOCKS and sibling.tag != "p" and _final(sibling) >= least
        # A title stands before the text.
        title = sibling.tag == "h1" or sibling.tag == "h2" and not seen and links < FEW_LINKS
        seen |= sibling is best
        if sibling is best or prose or scored or title:
            kept.append(sibling)
    return kept


def _ends_sentence(node: Node) -> bool:
    """Whether the last text in an element ends with a stop."""
    stack: list[Node | str] = [node]
    while stack:
        item = stack.pop()
        if isinstance(item, Node):
            stack.extend(item.children)
        elif item.strip():
            return item.rstrip()[-1] in ".!?…。"
    return False


def _blocks(nodes: list[Node]) -> list[str]:
    """Texts of blocks in page order; two line breaks in a row also part blocks."""
    found: list[str] = []
    pieces: list[str] = []

    def finish() -> None:
        text = " ".join("".join(pieces).split())
        if text:
            found.append(text)
        pieces.clear()

    for top in nodes:
        stack: list[Node | str | None] = [top]
        breaks = 0
        while stack:
            item = stack.pop()
            if item is None:
                finish()
                continue
            if isinstance(item, str):
                pieces.append(html.unescape(item))
                breaks = 0 if item.strip() else breaks
                continue
            if item.tag == "br":
                breaks += 1
                finish() if breaks == 2 else pieces.append(" ")
                continue
            if item.tag in BLOCKS:
                finish()
                breaks = 0
                stack.append(None)
            stack.extend(reversed(item.children))
        finish()
    return found


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    _drop(root)
    order = _preorder(root)
    _score(order)
    return "\n\n".join(_blocks(_chosen(root, order)))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``page_id, url, html``."""
    schema = with_fields(pages.select("page_id", "url").schema, "text string")

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["page_id", "url"]].copy()
            out["text"] = [main_text(x) for x in batch["html"]]
            yield out

    found = pages.select("page_id", "url", "html").mapInPandas(texts, schema)
    return found.withColumn("n_chars", F.length("text").cast("long"))
