"""Main text of a page by composite text density.

The page becomes a tree. Every node has characters C, tags T, link characters
LC and link tags LT of its subtree and the composite density

    C/T * log(C * T / (LC * LT)) with base ln(C / nonlink * LC + body link share * C + e)

so that text in few tags is dense and text in links is not. A node's density
sum is the sum of its children's densities. The node with the largest sum gives
the threshold: the smallest density on its path from the body. The text kept is
that of the subtree with the largest sum, plus other subtrees that reach the
threshold and hold the largest sum among those below them.

Scripts, navigation elements and hidden parts are taken out of the tree first.
A name is a weaker sign. A part named as nothing but something else (side bar,
form, advert, notice, comments) goes unless it holds the article, most of the
page's text, or is a heading or paragraph of the article. So does one whose
name has other words beside those for comments, adverts, side bars and consent
(``user-comments``, ``ad-box``, ``cookie-text``), unless it says that there is none
or some elsewhere (``ad-free``, ``has-sidebar``). One with other doubtful words
(``section-header``, ``share-price``) goes only if links are most of it;
otherwise its density decides.

Markup is read as browsers do: a quote opens a value right after an equals
sign only, and a closing slash closes nothing. Open elements are counted by
name, so that deeply nested pages take time in proportion to their length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import e, log

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|$)"
    r"|<[!?][^>]*(?:>|$)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$)|[^\s>\"'][^\s>]*+)?+)*+)(?:>|$)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

# The HTML standard's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCKS - frozenset("body html legend option optgroup td th tr tbody thead tfoot".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

# What is not the article, by element, role and word of class or id.
NOT_TEXT = frozenset(
    "head script style noscript template iframe object embed svg canvas audio video map nav footer aside"
    " button select datalist textarea dialog menu noframes noembed title".split()
)
NOT_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar alert alertdialog dialog toolbar tablist".split())
NOT_NAME = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner breadcrumb breadcrumbs comment comments"
    " commentlist disqus cookie cookies consent gdpr footer header masthead menu nav navbar navigation navigate notice notices"
    " notification alert newsletter subscribe subscription signup login pager pagination popup modal overlay promo promotion"
    " promoted related recommended recommendations replies reply respond share sharing shares sidebar sidenav social sponsor"
    " sponsored tags toolbar topbar widget widgets discussion reactions skip outbrain taboola".split()
)
SURE_NAME = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot comment comments commentlist disqus cookie cookies"
    " consent gdpr sidebar sidenav newsletter sponsor sponsored replies reply respond discussion outbrain taboola".split()
)
NOT_SURE = frozenset("has have with no non without free".split())
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
SPACE = re.compile(r"\s+")
HINTED, MIXED, NAMED, HIDDEN = 1, 2, 3, 4
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OF_TEXT = HEADINGS | {"p", "blockquote", "pre"}


class Node:
    __slots__ = ("name", "parent", "children", "dropped", "suspect", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, name: str, parent: Node | None, dropped: bool) -> None:
        self.name, self.parent, self.dropped = name, parent, dropped
        self.suspect = 0
        self.children: list[Node | str] = []


def _suspect(name: str, attrs: str, in_section: bool) -> int:
    """How surely an element says that it is not part of the article: ``HIDDEN``, ``NAMED``, ``MIXED``, ``HINTED`` or 0."""
    found = 0
    if name == "form":
        found = NAMED
    if name == "header" and not in_section:
        found = NAMED
    if not attrs or name in ("html", "body", "main", "article", "header"):
        return found
    for key, *values in ATTRIBUTE.findall(attrs):
        key, value = key.lower(), "".join(values)
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return HIDDEN
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return HIDDEN
        if key == "role" and value.lower() in NOT_ROLE:
            found = NAMED
        if key in ("class", "id"):
            for token in value.split():
                words = [x.lower() for x in NAME_PART.findall(token) if not x.isdigit()]
                if words and NOT_NAME.issuperset(words):
                    found = NAMED
                elif not SURE_NAME.isdisjoint(words) and NOT_SURE.isdisjoint(words):
                    found = max(found, MIXED)
                elif not NOT_NAME.isdisjoint(words):
                    found = max(found, HINTED)
    return found


def _up(node: Node | None) -> Iterator[Node]:
    while node is not None:
        yield node
        node = node.parent


def _cut(stack: list[Node], opened: Counter[str], at: int) -> None:
    """Close the elements from ``at`` on."""
    opened.subtract(n.name for n in stack[at:])
    del stack[at:]


def _close(stack: list[Node], opened: Counter[str], names: tuple[str, ...], scope: tuple[str, ...]) -> None:
    if not any(opened[n] for n in names):
        return
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].name in names:
            _cut(stack, opened, i)
            return
        if stack[i].name in scope:
            return


def parse(html: str) -> Node:
    """The element tree. Unclosed and stray tags are repaired the simple way; elements left out are empty and dropped."""
    root = Node("html", None, False)
    stack, at = [root], 0
    opened: Counter[str] = Counter()
    size = len(html)
    while at < size:
        match = TOKEN.search(html, at)
        text = html[at : match.start() if match else size]
        if text and not stack[-1].dropped:
            stack[-1].children.append(unescape(text) if "&" in text else text)
        if not match:
            break
        at = match.end()
        if match["cdata"] is not None and not stack[-1].dropped:
            stack[-1].children.append(match["cdata"])
        name = match["name"]
        if name is None:
            continue
        name = name.lower()
        if match["close"]:
            if name in VOID or not opened[name]:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == name:
                    _cut(stack, opened, i)
                    break
                if name not in BLOCKS and stack[i].name in BLOCKS:
                    break  # a stray end of an inline element stays inside its block
            continue
        if name in ("html", "body") and (name == "html" or opened["body"]):
            continue
        if opened["head"] and (name == "body" or name in BLOCKS):
            _close(stack, opened, ("head",), ())
        if name in ENDS_P:
            _close(stack, opened, ("p",), ("table", "td", "th", "div", "article", "section", "li", "blockquote", "body"))
        if name in SAME:
            _close(stack, opened, SAME[name], SCOPE[name])
        if name in HEADINGS and stack[-1].name in HEADINGS:
            _cut(stack, opened, len(stack) - 1)
        above = stack[-1]
        node = Node(name, above, above.dropped or name in NOT_TEXT)
        node.suspect = 0 if node.dropped else _suspect(name, match["attrs"], opened["article"] + opened["main"] + opened["section"] > 0)
        if not above.dropped:
            above.children.append(node)
        if name in RAW:
            end = RAW_END[name].search(html, at)
            at = end.end() if end else size
        elif name not in VOID:
            stack.append(node)
            opened[name] += 1
    _settle(root)
    return root


def _settle(root: Node) -> None:
    """Drop hidden elements, and suspect ones that links fill or whose text is neither the article's nor most of the page's.

    A frame around the article stays: one with an article or main, or a title and paragraphs.
    """
    nodes = _order(root)
    holds = {id(n): [n.name in ("article", "main"), n.name == "h1", int(n.name == "p")] for n in nodes}
    for n in reversed(nodes):
        frame, title, paragraphs = own = holds[id(n)]
        if n.suspect == HIDDEN and not frame and not (title and paragraphs > 1):
            n.dropped = True
        elif n.parent is not None:
            above = holds[id(n.parent)]
            above[:] = above[0] or own[0], above[1] or own[1], above[2] + own[2]
    nodes = _order(root)
    if not any(n.suspect for n in nodes):
        return
    measure(nodes)
    text = {id(n): n.chars - n.link_chars for n in nodes}
    whole = next((n for n in nodes if n.name == "body"), root)
    has_article = any(n.name in ("article", "main") and text[id(n)] for n in nodes)
    of_article: set[int] = set()
    headed: set[int] = set()
    for n in nodes:
        if n.name in ("article", "main") or n.parent is not None and id(n.parent) in of_article:
            of_article.add(id(n))
    for n in reversed(nodes):
        if n.parent is not None and (n.name in HEADINGS or id(n) in headed):
            headed.add(id(n.parent))
    kept = lambda n: n.chars and n.link_chars < 0.5 * n.chars
    for n in nodes:
        frame, title, paragraphs = holds[id(n)]
        if not n.suspect or frame or title and paragraphs > 1:
            continue
        inside = id(n) in of_article
        paragraph = inside and n.name in OF_TEXT and n.suspect == NAMED
        most = 2 * text[id(n)] > text[id(whole)] and (inside or not has_article)
        if most or kept(n) and (n.suspect == HINTED or paragraph):
            continue
        if kept(n) and inside and n.name in ("header", "div", "section", "hgroup") and id(n) in headed and not _other_text(n):
            continue  # around headings only
        n.dropped = True


def _other_text(node: Node) -> bool:
    """Whether an element has text outside of headings."""
    todo = [node]
    while todo:
        for c in todo.pop().children:
            if isinstance(c, str):
                if c.strip():
                    return True
            elif not c.dropped and c.name not in HEADINGS:
                todo.append(c)
    return False


def _order(root: Node) -> list[Node]:
    """Nodes that stay, parents first."""
    found, todo = [], [root]
    while todo:
        node = todo.pop()
        found.append(node)
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped)
    return found


def _measure(n: Node) -> None:
    """Characters and tags of a node whose children have theirs."""
    kids = [c for c in n.children if isinstance(c, Node) and not c.dropped]
    own = sum(len(SPACE.sub("", c)) for c in n.children if isinstance(c, str))
    n.chars = own + sum(k.chars for k in kids)
    n.tags = len(kids) + sum(k.tags for k in kids)
    link = n.name == "a"
    n.link_chars = n.chars if link else sum(k.link_chars for k in kids)
    n.link_tags = (1 if link else 0) + sum(k.link_tags for k in kids)


def _density(n: Node, share: float) -> float:
    if not n.chars:
        return 0.0
    base = log(n.chars / max(1, n.chars - n.link_chars) * n.link_chars + share * n.chars + e)
    ratio = n.chars / max(1, n.link_chars) * max(1, n.tags) / max(1, n.link_tags)
    return n.chars / max(1, n.tags) * log(max(ratio, 1.0)) / base if base > 0 else 0.0


def _share(nodes: list[Node]) -> float:
    """Share of links in the body's text."""
    body = next((n for n in nodes if n.name == "body"), nodes[0])
    return body.link_chars / max(1, body.chars)


def measure(nodes: list[Node]) -> None:
    """Density and density sum of each node; ``nodes`` has parents first."""
    for n in reversed(nodes):
        _measure(n)
    share = _share(nodes)
    for n in reversed(nodes):
        n.density = _density(n, share)
        # Text of its own counts like a child without tags.
        own = sum(len(SPACE.sub("", c)) for c in n.children if isinstance(c, str))
        n.total = own + sum(c.density for c in n.children if isinstance(c, Node) and not c.dropped)


def _runs(node: Node, above_best: set[int]) -> Iterator[list[int]]:
    """Places of children that make a run of text, with a string of its own, between blocks."""
    run: list[int] = []
    for i, c in enumerate([*node.children, None]):
        if isinstance(c, str) or c is not None and not c.dropped and c.name not in BLOCKS and id(c) not in above_best and not _holds_block(c):
            run.append(i)
        elif c is None or not c.dropped:
            if any(isinstance(node.children[j], str) and node.children[j].strip() for j in run):
                yield run
            run = []


def _holds_block(node: Node) -> bool:
    todo = [node]
    while todo:
        for c in todo.pop().children:
            if isinstance(c, Node) and not c.dropped:
                if c.name in BLOCKS:
                    return True
                todo.append(c)
    return False


def select(nodes: list[Node]) -> set[int | tuple[int, int]]:
    """What is kept whole: the subtree of the largest density sum, and others above the threshold.

    Nodes are given by id. Runs of text directly in an ancestor of that subtree
    count like its children; strings are given by their parent's id and place.
    """
    best = max(nodes, key=lambda n: n.total)
    threshold = min(n.density for n in _up(best) if n.name not in ("html",) or n is best)
    share = _share(nodes)
    kept: set[int | tuple[int, int]] = set()
    todo = [nodes[0]]
    above_best = {id(n) for n in _up(best)}
    # An inline or heading winner stands for the block container around it.
    top = best
    while top.parent is not None and (top.name not in BLOCKS or top.name in ("p", "h1", "h2", "h3", "li", "td", "blockquote", "pre")):
        siblings = [c for c in top.parent.children if isinstance(c, Node) and not c.dropped]
        if top.name in BLOCKS and len(siblings) == 1 and top.parent.name in ("body", "html"):
            break
        top = top.parent
        if top.name == "body":
            break
    while todo:
        node = todo.pop()
        if node is top and node.name in ("body", "html"):
            # The whole page: no more than its parts are known to belong together, so parts that links fill go.
            for i, c in enumerate(node.children):
                if isinstance(c, str):
                    kept.add((id(node), i))
                elif not c.dropped and (c.name not in BLOCKS or c.link_chars < 0.5 * c.chars):
                    kept.add(id(c))
        elif node is top:
            kept.add(id(node))
        elif id(node) in above_best:
            for run in _runs(node, above_best):
                part = Node("span", None, False)
                part.children = [node.children[i] for i in run]
                _measure(part)
                part.density = _density(part, share)
                if part.density >= threshold and part.link_chars < 0.5 * part.chars:
                    kept.update((id(node), i) if isinstance(node.children[i], str) else id(node.children[i]) for i in run)
            todo.extend(c for c in node.children if isinstance(c, Node) and not c.dropped)
        elif node.density >= threshold and node.chars and node.link_chars < 0.5 * node.chars:
            kept.add(id(node))
    return kept


def blocks(root: Node, kept: set[int | tuple[int, int]]) -> list[str]:
    """Texts of the blocks below kept nodes, in page order, white space made single blanks."""
    found: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = SPACE.sub(" ", "".join(run)).strip()
        if text:
            found.append(text)
        run.clear()

    todo: list[tuple[Node | str | None, bool]] = [(root, id(root) in kept)]
    while todo:
        item, inside = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if inside:
                run.append(item)
        elif not item.dropped:
            inside = inside or id(item) in kept
            block = item.name in BLOCKS
            if block:
                flush()
                todo.append((None, inside))
            elif item.name in ("br", "wbr") and inside:
                run.append(" " if item.name == "br" else "")
            for i in range(len(item.children) - 1, -1, -1):
                todo.append((item.children[i], inside or (id(item), i) in kept))
    flush()
    return found


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by an empty line; null, empty or textless pages give ''."""
    if not html:
        return ""
    root = parse(html)
    nodes = _order(root)
    measure(nodes)
    if not nodes[0].chars:
        return ""
    return "\n\n".join(blocks(root, select(nodes)))


def extracted(html: Column) -> Column:
    """Main text of a column of pages."""

    @F.pandas_udf("string")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h) for h in batch], dtype=object)

    return extract(html)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    A null or empty page has an empty text of 0 characters. Pages of any length
    and depth are read whole; of equal density sums the first element in page
    order wins. Repeated rows are kept; other columns, whatever their names, are
    ignored; an empty table gives no rows.
    """
    texts = pages.select("page_id", "url", extracted(F.col("html")).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))
