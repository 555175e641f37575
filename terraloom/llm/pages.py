"""Main text of web pages by composite text density.

A page is read into a tree of block elements; inline elements count as tags of their block. What
can never be main text goes first: scripts, styles, forms, menus, headers and footers of the page,
asides, and elements whose class, id or role names an advert, a notice, a sidebar or comments. A
class name says so surely only as a whole (``sidebar``, ``cookie-notice``); where it begins or ends with
such a word (``ad-slot``, ``market-share``), and for a form, what the element holds decides: one that
holds all articles, all first headings or most of the page's text is a container and stays, and of a
form only the controls go; a name that merely ends so drops nothing inside an article. For
every node the composite density is computed, characters per tag weighted by how much of the
node's text lies in links, relative to the body. A node's sum is the density of its own text and
of its children. The node with the largest sum is the core; the threshold is the least density on
the path from the body to it. The core grows to the article or main element around it, or else to
ancestors as dense as itself. Beside it every other node that reaches the threshold is kept whole, and
a node's own text where that alone reaches it; the core's ancestors count by their own text only.

A null or empty page, and one without any text, give the empty text. Unclosed and misplaced tags
are read as browsers do as far as text is concerned; a page cut off in the middle gives what is
there. Ties go to the outer node, then the first. Pages of any length and depth are read whole.
"""

from __future__ import annotations

import math
import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terraloom.llm.common import map_arrow, quoted

# Element names of the HTML standard.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noembed noframes".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split())
_ENDS_P = frozenset(
    "address article aside blockquote body center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul dt dd".split())
_SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"),
             "th": ("td", "th"), "thead": ("tbody", "thead"), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
_WITHIN = frozenset("ul ol dl table select body html".split())  # an implied end never reaches past these
_DROPPED = frozenset(
    "script style noscript template iframe object svg math canvas audio video button select textarea input nav aside footer head title "
    "menu dialog xmp noembed noframes".split())
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar sidenav menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead topbar cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations comment comments disqus respond complementary contentinfo".split())
_SURE = frozenset("advert adverts advertisement advertising adsense comments disqus".split())  # in any place of a name
_READERS = frozenset("comment comments disqus respond".split())
_STATES = frozenset("has with without no is hide show".split())  # "has-sidebar" is no sidebar
_MAIN = frozenset(("article", "main"))
_ENDS, _BEGINS, _NAMED, _GONE = 1, 2, 3, 4  # how surely a name tells that an element is not main text

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'<]++|\"[^\"<]*+\"|'[^'<]*+')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)", re.S)
_HINTED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORDS = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("name", "parent", "parts", "children", "chars", "tags", "link_chars", "link_tags", "own", "own_density", "dropped", "main", "density", "sum",
                 "hint", "inside", "held", "mains", "heads")

    def __init__(self, name: str, parent: Node | None, dropped: bool):
        self.name, self.parent, self.dropped = name, parent, dropped
        self.parts: list = []  # text and child nodes in page order
        self.children: list[Node] = []
        self.chars = self.link_chars = self.link_tags = self.own = 0
        self.tags = 1
        self.main = name in _MAIN
        self.hint = self.held = self.mains = self.heads = 0
        self.inside = self.main or parent is not None and parent.inside


def parse(html: str) -> Node:
    """The tree of block elements; dropped elements are marked, their text is not kept."""
    root = Node("html", None, False)
    stack: list[tuple[str, Node]] = [("html", root)]  # open elements, each with the block it lies in
    links = 0  # open links

    def text(s: str) -> None:
        block = stack[-1][1]
        if block.dropped or not s:
            return
        s = unescape(s) if "&" in s else s
        n = len(s) - s.count(" ") if not s.isspace() else 0
        block.parts.append(s)
        block.own += n
        if links:
            block.link_chars += n

    def close(depth: int) -> None:
        nonlocal links
        while len(stack) > depth:
            links -= stack.pop()[0] == "a"

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        if not m:
            text(html[at:])
            break
        text(html[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        name = name.lower()
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    close(k)
                    break
                if name in _INLINE and stack[k][0] not in _INLINE:
                    break  # an inline element ends with its block
            continue
        block = stack[-1][1]
        if name in _INLINE:
            block.tags += 1
            if name == "br":
                text(" ")
            elif name not in _VOID:
                if name == "a":
                    block.link_tags += 1
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == "a":  # links do not nest
                            close(k)
                        if stack[k - 1][0] not in _INLINE:
                            break
                    links += 1
                stack.append((name, block))
            continue
        if name in ("html", "body"):
            if name == "body":
                for k, (open_name, _) in enumerate(stack):
                    if open_name == "head":
                        close(k)
                        break
            continue
        if name in _ENDS_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] not in _INLINE:
                    break
        if name in _SIBLINGS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in _SIBLINGS[name]:
                    close(k)
                    if stack[k - 1][0] in _SIBLINGS[name]:
                        continue
                    break
                if stack[k][0] in _WITHIN:
                    break
        block = stack[-1][1]
        hint = _hint(name, m[3] or m[6] or "", block)
        node = Node(name, block, block.dropped or name in _DROPPED or hint == _GONE)
        node.hint = hint
        if node.dropped:
            block.parts.append(None)  # what stood there still separates blocks
        else:
            block.parts.append(node)
            block.children.append(node)
        if name in _VOID:
            continue
        if name in _RAW:
            stop = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, at)
            if not stop:
                break
            closing = html.find(">", stop.end())
            at = closing + 1 if closing >= 0 else end
            continue
        stack.append((name, node))
    return root


def _hint(name: str, attributes: str, block: Node) -> int:
    """How surely the element's name or attributes tell that it is not main text; 0: they do not."""
    if name == "header":
        while block and block.name not in _MAIN:
            block = block.parent
        if not block:
            return _GONE  # of the page, not of an article
    hint = _BEGINS if name == "form" else 0
    if name in ("main", "table", "tbody", "tr", "td", "h1") or "=" not in attributes:
        return hint
    for m in _HINTED.finditer(attributes):
        for token in (m[1] or m[2] or m[3] or "").lower().split():
            words = _WORDS.findall(token)
            if _HINTS.isdisjoint(words) or words[0] in _STATES:
                continue
            if _HINTS.issuperset(words):
                return _GONE if not _READERS.isdisjoint(words) else _NAMED
            hint = max(hint, _NAMED if not _SURE.isdisjoint(words) else _BEGINS if words[0] in _HINTS else _ENDS)
    return hint


def _weigh(nodes: list[Node]) -> None:
    """Per kept node: characters, articles and first headings that it holds."""
    for node in nodes:
        node.held, node.mains, node.heads = node.own, int(node.main), int(node.name == "h1")
    for node in reversed(nodes):
        if node.parent and not node.dropped:
            p = node.parent
            p.held += node.held
            p.mains += node.mains
            p.heads += node.heads


def _prune(root: Node) -> None:
    """Drop elements by their names, but for those that hold what the page is about.

    A whole name drops its element unless all articles of the page lie in it. A name in parts, or
    a form, counts less than holding all articles, or where there is none all first headings, or
    more than half of the text that whole names leave.
    """
    nodes = _nodes(root)
    if not any(node.hint for node in nodes):
        return
    _weigh(nodes)
    for node in nodes:
        node.dropped = node.hint == _NAMED and not (node.mains and node.mains == root.mains)
    _weigh(nodes)
    for node in nodes:
        if node.hint in (_BEGINS, _ENDS) and not (node.hint == _ENDS and node.parent.inside):
            if root.mains:
                holds = node.mains == root.mains
            else:
                holds = root.heads and node.heads == root.heads or 2 * node.held > root.held
            node.dropped = node.dropped or not holds
    for node in nodes:
        if any(child.dropped for child in node.children):
            node.children = [child for child in node.children if not child.dropped]
            node.parts = [None if isinstance(part, Node) and part.dropped else part for part in node.parts]


def _nodes(root: Node) -> list[Node]:
    """All kept nodes, parents before children, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(reversed(node.children))
    return out


def content(root: Node) -> tuple[Node, set[int], float]:
    """The core, the ids of the nodes on the path from it to the root, and the threshold."""
    nodes = _nodes(root)
    for node in nodes:  # its own text counts as a child
        node.sum = node.own_density = _composite(node.own, node.tags, node.link_chars, node.link_tags, 0.0)
    for node in reversed(nodes):
        node.chars += node.own
        if node.parent:
            p = node.parent
            p.chars += node.chars
            p.tags += node.tags
            p.link_chars += node.link_chars
            p.link_tags += node.link_tags
    links = root.link_chars / max(1, root.chars)
    for node in nodes:
        node.density = _composite(node.chars, node.tags, node.link_chars, node.link_tags, links)
        if node.parent:
            node.parent.sum += node.density
    best = max(nodes, key=lambda n: n.sum)  # max keeps the first, hence the outer node
    path = [best]
    while path[-1].parent:
        path.append(path[-1].parent)
    threshold = min(n.density for n in path)
    around = [n for n in path if n.main]
    if around:
        best = around[-1]
    else:
        for n in path[1:]:
            if n.density < best.density:
                break
            best = n
    return best, {id(n) for n in path}, threshold


def _composite(chars: int, tags: int, link_chars: int, link_tags: int, body_links: float) -> float:
    """Characters per tag, scaled logarithmically down as links take up the text."""
    if not chars:
        return 0.0
    base = math.log(chars * link_chars / max(1, chars - link_chars) + body_links * chars + math.e)
    weight = chars / max(1, link_chars) * tags / max(1, link_tags)
    return chars / tags * math.log1p(weight) / math.log1p(base)


def text_of_content(root: Node) -> str:
    """Text of what is kept: one line a block, white space inside a block turned into single blanks."""
    best, path, threshold = content(root)

    def opened(node: Node, within: bool) -> tuple:
        whole = within or node is best or id(node) not in path and node.density > 0 and node.density >= threshold
        return iter(node.parts), whole, whole or node.own_density > 0 and node.own_density >= threshold

    lines, run = [], []
    stack: list = [opened(root, False)]
    while stack:
        parts, whole, own = stack[-1]
        for part in parts:
            if isinstance(part, str):
                if own:
                    run.append(part)
                continue
            lines.append("".join(run))
            run = []
            if part is not None:
                stack.append(opened(part, whole))
                break
        else:
            stack.pop()
            lines.append("".join(run))
            run = []
    return "\n".join(s for s in (" ".join(line.split()) for line in lines) if s)


def main_text(html: str | None) -> str:
    if not html:
        return ""
    root = parse(html)
    _prune(root)
    return text_of_content(root)


def extract(pages: DataFrame, id_column: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """One row per page: ``page_id, url, text``."""
    rows = pages.select(F.col(quoted(id_column)).cast("long").alias("page_id"), F.col(quoted(url)).cast("string").alias("url"),
                        F.coalesce(F.col(quoted(html)).cast("string"), F.lit("")).alias("html"))

    def run(batches):
        for batch in batches:
            for i, u, h in zip(*(batch.column(k).to_pylist() for k in range(3))):
                yield i, u, main_text(h)

    return map_arrow(rows, run, "page_id long, url string, text string", page_id=pa.int64(), url=pa.string(), text=pa.string())
