"""Main text of web pages by tree scoring.

A page becomes a tree of elements whose leaves are blocks of text. Each block that is long enough
gives points (one, one a comma, one a hundred characters up to three) to its parent, half of them
to its grandparent, and a sixth, a ninth, ... to the next of LEVELS ancestors; a container's points are
multiplied by one less its link density. The best container, or the whole article or else main that it lies
in, is kept with those siblings that score a fifth of the best or are long paragraphs with few links.

Menus, footers, sidebars and the like that an element or role states never count nor stay, nor do buttons, labels and
other controls within a text. A class or id drops an element only if all its words say so (cookie-notice, but not
no-sidebar or social-science) and most of the text lies elsewhere: of the page, where no article or main does, or of the article or
main that it lies in; so with headers of the page and forms. Reader comments go even where they are most of a page, or of an
article, that has another text, and so do articles that are named as comments. Inside articles and mains headings never go by name, an
id of one word tells of the article's own sections (section#related), as some classes do (TITLES), an element named
header goes only if it holds no heading, and lists of two items or more go if they are links. Other names with such
words (has-sidebar) drop an element only if it mostly links or holds a form.

Cases: null or empty html, and pages without text, give an empty text; unclosed or misplaced tags,
broken references and unclosed scripts are read as browsers do, roughly; repeated pages are
extracted each; texts are never cut; time is linear in a page's length, however deep its elements.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

#: Shortest block, in characters, that gives points, and the ancestors that get them.
SHORTEST, LEVELS = 25, 6

_RAW = "script|style|noscript|template|svg|iframe|select|textarea|object|canvas"
#: Comments, declarations, raw elements whole, and tags; a tag's attributes hold no "<" that could begin another tag, so
#: one that is never closed is given up at the next. The last form is for tags of uneven quotes.
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?:{_RAW})\b[^>]*+(?:(?<=/)>|>.*?(?:</(?:{_RAW})\s*+>|\Z)|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^"'<>]|"[^"]*"|'[^']*'|<(?![a-zA-Z/!?]))*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)(?:>|\Z)""",
    re.S | re.I,
)
_BLOCK = set("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul head".split())
_VOID = {"hr"}
_OUT = set("aside dialog footer head menu nav title".split())
#: Controls that stand within a text; what they hold is no part of it.
_MUTE = set("button datalist label meter output progress".split())
#: What an opening element ends if it is open: paragraphs end at any block.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr"}, "th": {"tr"}}
_ROLE = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
_WORD = set(
    "ad ads adv advert advertisement advertising aside banner breadcrumb breadcrumbs comment comments consent cookie cookies discussion disqus footer "
    "header login masthead menu menus modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted promotion "
    "recommended related replies reply respond responses search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that an article's own parts may have as names, and words that tell nothing beside others.
_DOUBT = set("advertising comment consent cookie cookies discussion footer header login menu menus navigation notice notices notification notifications pagination promotion recommended related replies reply respond responses search share sharing social".split())
_PLAIN = set("area bar block box container inner list section slot unit wrap wrapper".split())
#: Beside them inside articles; and words that there name sections of the article too.
_INNER = set("article body button buttons content entry group heading icons item items link links panel post posts row text title".split())
_TITLES = set("advertising discussion menu menus navigation search".split())
#: Beside them, words of place; and words of what readers write.
_PLACE = set("bottom left main page right site top".split())
_READERS = set("comment comments discussion disqus replies reply respond responses".split())
_NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_HEADING = re.compile("h[1-6]")
_PARTS = re.compile(r"[a-z]+")
_PRIOR = {"article": 25.0, "main": 15.0, "section": 5.0, "div": 5.0, "blockquote": 3.0, "td": 3.0, "pre": 3.0, "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "form": -3.0, "th": -5.0}


class _Node:
    __slots__ = ("article", "chars", "depth", "doubt", "form", "gone", "head", "heading", "inside", "items", "links", "out", "parent", "points", "readers", "scope", "sure", "tag", "top")

    def __init__(self, tag: str, parent: _Node | None, out: bool):
        self.tag, self.parent, self.out, self.gone = tag, parent, out, out
        self.depth = parent.depth + 1 if parent is not None else 0
        self.inside = tag in ("article", "main") or (parent is not None and parent.inside)
        self.points, self.chars, self.links, self.article, self.top = None, 0, 0, 0, None
        self.doubt = self.form = self.sure = self.readers = self.head = False
        self.heading, self.items = bool(_HEADING.fullmatch(tag)), 0
        # the article or main that it lies in
        self.scope = None if parent is None else parent if parent.tag in ("article", "main") else parent.scope

    def density(self) -> float:
        return self.links / self.chars if self.chars else 0.0

    def score(self) -> float:
        return (self.points or 0.0) * (1 - self.density())


def _names(node: _Node, attributes: str) -> None:
    """What an element's attributes and name say of it; ``inside`` an article, where a header belongs to the article."""
    tag, inside = node.tag, node.parent.inside
    node.sure = tag == "form" or (tag == "header" and not inside)
    if not attributes or tag in ("html", "body", "main"):
        return
    node.out = node.out or bool(_HIDDEN.search(attributes))
    for m in _NAMES.finditer(attributes):
        kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if kind == "role":
            node.out = node.out or bool(tag != "article" and _ROLE & set(value.split()))
        elif not (inside and node.heading):
            for name in value.split():
                words = set(_PARTS.findall(name))
                if words & _WORD:
                    _named(node, words, kind, inside)


def _named(node: _Node, words: set[str], kind: str, inside: bool) -> None:
    """What one name, of words that tell something, says of an element."""
    own = words & _WORD
    if node.tag == "article":  # only what readers write
        if own <= _READERS and words <= _WORD | _PLAIN | _INNER:
            node.sure = node.readers = True
        return
    plain = words <= (_WORD | _PLAIN | _INNER if inside else _WORD | _PLAIN | _PLACE)
    clear = bool(own - _DOUBT) or not (own <= _TITLES or (kind == "id" and len(words) == 1))
    if plain and (clear or not inside):
        if inside and own == {"header"}:
            node.head = True
        else:
            node.sure, node.readers = True, node.readers or bool(own & _READERS)
    elif not node.heading and not own <= {"header"}:
        node.doubt = True


def blocks(page: str) -> tuple[list[tuple[str, _Node]], list[_Node]]:
    """The page's blocks of text in order, each with its element, and all elements, parents first."""
    root = _Node("html", None, False)
    nodes, stack, out, held, link = [root], [root], [], [], 0
    places: dict[str, list[int]] = {}  # of open elements in the stack, by tag
    chars = 0
    mute: tuple[str, int] | None = None  # the outermost open control, and how deep it lies

    def flush() -> None:
        nonlocal chars
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            node = stack[-1]
            out.append((text, node))
            if not node.out:
                node.chars += len(text)
                node.links += min(chars, len(text))
        chars = 0

    def pop(k: int) -> None:
        nonlocal link, mute
        flush()
        for node in stack[k:]:
            places[node.tag].pop()
        del stack[k:]
        if mute and mute[1] > k:
            mute = None
        link = 0

    def take(raw: str) -> None:
        nonlocal chars
        if mute:
            return
        text = unescape(raw) if "&" in raw else raw
        held.append(text)
        if link:
            chars += len(text.strip())

    def last(tags) -> int:
        return max((places[t][-1] for t in tags if places.get(t)), default=0)

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            take(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = m[1] or m[4]
        if tag == "br":
            held.append("\n")
        elif tag == "a":
            link = 0 if closing else 1
        elif tag in _MUTE:
            if closing:
                mute = mute if mute and mute[0] != tag else None
            else:
                mute = mute or (tag, len(stack))
        elif tag in _BLOCK:
            if closing:
                k = last((tag,))
                if k:
                    pop(k)
                else:
                    flush()
                continue
            flush()
            if tag in ("html", "body") and len(stack) > 1 and stack[-1].tag != "head":
                continue
            if stack[-1].tag == "p":
                pop(len(stack) - 1)
            if tag in _ENDS and (k := last(_ENDS[tag])) > last(_HOLDS[tag]):
                pop(k)
            if tag == "body" and stack[-1].tag == "head":
                pop(len(stack) - 1)
            if tag in _VOID:
                continue
            if tag != "div":  # a control that was never closed
                mute = None
            above = stack[-1]
            node = _Node(tag, above, above.out or tag in _OUT)
            _names(node, m[3] or m[6] or "")
            node.form = tag == "form"
            above.items += tag == "li"
            places.setdefault(tag, []).append(len(stack))
            stack.append(node)
            nodes.append(node)
    if at < len(page):
        take(page[at:])
    flush()
    return out, nodes


def _judge(nodes: list[_Node]) -> None:
    """Sums of texts, links, forms and headings over what an element holds; then which elements go."""
    for node in reversed(nodes):
        if node.tag in ("article", "main"):
            node.article = node.chars
        if node.parent is not None:
            node.parent.article += node.article
            node.parent.chars += node.chars
            node.parent.links += node.links
            node.parent.form = node.parent.form or node.form
            node.parent.heading = node.parent.heading or node.heading
    root = nodes[0]
    for node in nodes:
        up = node.parent is not None and node.parent.gone
        whole = (node.scope or root).chars
        minor = 2 * node.chars <= whole or (node.readers and node.chars < whole) or (not node.inside and node.article < root.article)
        named = node.sure or (node.head and not node.heading) or (node.doubt and (node.form or 2 * node.links > node.chars))
        listed = node.scope is not None and node.tag in ("ul", "ol") and node.items > 1 and 10 * node.links >= 9 * node.chars
        node.gone = up or node.out or ((named or listed) and minor)


def extract(page: str | None) -> str:
    """The main text: its blocks in page order, one space between them."""
    found, nodes = blocks(page or "")
    _judge(nodes)
    found = [(t, n) for t, n in found if not n.gone]
    if not found:
        return ""
    for text, node in found:
        if len(text) < SHORTEST:
            continue
        points = (1 + text.count(",") + min(len(text) // 100, 3)) * (1 - node.density())
        up = node.parent if node.tag in ("p", "pre", "td", "blockquote") or _HEADING.fullmatch(node.tag) else node
        for level in range(LEVELS):
            if up is None:
                break
            if up.points is None:
                up.points = _PRIOR.get(up.tag, 0.0)
            up.points += points if level == 0 else points / (2 if level == 1 else level * 3)
            up = up.parent
    scored = [n for n in nodes if n.points is not None]
    if scored:
        best = max(scored, key=lambda n: (n.score(), n.depth))
    else:  # nothing long enough
        best = next((x for _, n in found if n.inside for x in _above(n) if x.tag in ("article", "main")), None)
        if best is None:
            return " ".join(t for t, _ in found)
    least = best.score() / 5
    best = _whole(best)
    least = max(10.0, least, best.score() / 5)
    for node in nodes:  # top: the element beside the best, or the best itself, that a node lies in
        if node is best or (best.parent is not None and node.parent is best.parent):
            node.top = node
        elif node.parent is not None:
            node.top = node.parent.top

    def kept(top: _Node | None) -> bool:
        return top is not None and (top is best or top.score() >= least or (top.tag == "p" and top.chars > 80 and top.density() < 0.25))

    return " ".join(text for text, node in found if kept(node.top))


def _whole(node: _Node) -> _Node:
    """The outermost article that has the node, else the outermost main, else the node."""
    for tag in ("article", "main"):
        if around := [x for x in _above(node) if x.tag == tag]:
            return around[-1]
    return node


def _above(node: _Node | None):
    while node is not None:
        yield node
        node = node.parent


def main_text(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each page."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(x.as_py()) for x in batch.column(2)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    ids = pages.schema[id_col].dataType.simpleString()
    urls = pages.schema[url].dataType.simpleString()
    return c.map_batches(pages.select(F.col(id_col).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")), run, f"page_id {ids}, url {urls}, text string, n_chars long")
