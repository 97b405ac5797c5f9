"""Main text of web pages by composite text density.

Every node of the page's tree has a density: the characters below it per tag below it, lowered by the share of link
characters. A node's score is the sum of its children's densities. The content is the subtree with the largest sum, or an
`<article>` or `<main>` within a tenth of it, widened to its parent while the rest of the parent is as dense by half. The
smallest density on the path from the body to it is the threshold of boxes that are mostly links; other blocks of the
subtree stay whatever their density. Menus, notices, comments and the like are taken out before densities are computed; a
box that only its class name, or being a form or header, speaks against stays if it holds the longest article or, on a page
without one, most of the plain text.

Pages are parsed in the task that reads them, one row in, one row out; nothing is shuffled.

* A null or empty page, and one without text, has the empty text. Unclosed and stray tags are accepted as browsers do.
* Repeated rows are read one by one. Long pages are parsed whole, without recursion.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# Elements of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead title tr ul".split())
UNWANTED = frozenset(
    "head nav footer aside form button input select option script style noscript iframe textarea template svg canvas "
    "object embed audio video dialog menu search title noembed noframes xmp label fieldset".split())
ENDS_PARAGRAPH = BLOCK - {"br", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "legend"}
# A tag of the first kind closes an open one of the second, inside the nearest of the third.
IMPLIED = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))), "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr", "td", "th")), frozenset(("table",))),
    "td": (frozenset(("td", "th")), frozenset(("table", "tr"))), "th": (frozenset(("td", "th")), frozenset(("table", "tr"))),
    "option": (frozenset(("option",)), frozenset(("select",))),
}
SCOPES = frozenset("table td th caption button object template html body article section main aside nav header footer".split())
# Parts of class names, ids and roles of what surrounds an article.
SURROUND = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adslot|advertisement|banner\w*|sponsor\w*|promo\w*|breadcrumbs?|comments?|"
    r"commentlist|respond|reply|replies|disqus\w*|discussion|cookies?|consent|gdpr|notice|notices|notification|alert|"
    r"footer|foot|copyright|menu|navbar|nav|navigation|toolbar|sidebar|sidebars|side|aside|widget\w*|rail|masthead|topbar|"
    r"header|share|sharing|social|newsletter|subscribe|subscription|signup|login|search|searchbox|related|recommend\w*|"
    r"trending|popular|popup|modal|overlay|paywall|pagination|pager|contentinfo|complementary|dialog|skip|"
    r"tags|tagcloud|toc|hidden|sr-only|visually-hidden|feedback|rating|ratings|outbrain|taboola)(?=$|[\s_-])", re.IGNORECASE)
# Parts of class names that tell the state or the layout of what is around them, not what it is.
STATE = re.compile(r"(?:^|[_-])(?:with|without|no|not|has|is|open|opened|closed|layout|wrapper|wrap|container|page|active)(?=$|[_-])", re.IGNORECASE)
COMMENTS = re.compile(r"comment|respond|repl(?:y|ies)|disqus|discussion", re.IGNORECASE)
SHARE = 0.5  # a named box with more of the plain text of a page without articles is a part of the layout
NEAR_TIE = 0.9  # of the largest sum of densities: here the element's name decides
WANTED = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body|text|page)(?=$|[\s_-])", re.IGNORECASE)

TAG = re.compile(r"<(?:(!--)|(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([!?/])|)")
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
SPACES = re.compile(r"\s+")


@dataclass
class Node:
    tag: str
    parent: Node | None
    unwanted: bool = False
    named: bool = False  # unwanted by a name only, which the text inside can overrule
    link: bool = False
    children: list = field(default_factory=list)  # nodes and strings, in page order
    chars: int = 0
    link_chars: int = 0
    tags: int = 0
    link_tags: int = 0
    density: float = 0.0
    total: float = 0.0


def _unwanted(tag: str, attributes: str, parent: Node) -> tuple[bool, bool]:
    """Whether an element surrounds the article, and whether only its name, or its being a form or header, says so."""
    if tag == "form":
        return True, True
    if tag in UNWANTED:
        return True, False
    if tag == "header":  # the heading of an article belongs to it
        up = parent
        while up and up.tag not in ("article", "main"):
            up = up.parent
        if up is None:
            return True, True
    if not attributes or tag in ("body", "html", "article", "main"):
        return False, False
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true":
        return True, False
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", values.get("style", ""), re.IGNORECASE):
        return True, False
    name = " ".join(t for k in ("class", "id", "role", "itemtype") for t in values.get(k, "").split() if not STATE.search(t))
    if tag in ("p", "span", "b", "i", "em", "strong", "a", "h1", "h2", "h3", "td", "li") and not SURROUND.fullmatch(name.strip()):
        return False, False
    if SURROUND.search(name) and not (WANTED.search(name) and not re.search(r"comment|sidebar|foot|menu", name, re.I)):
        return True, not COMMENTS.search(name)
    return False, False


def parse(page: str) -> Node:
    """The tree below the page's root."""
    root = Node("", None)
    node, at, end = root, 0, len(page)
    while at < end:
        open_ = page.find("<", at)
        if open_ < 0:
            open_ = end
        if open_ > at:
            node.children.append(html.unescape(page[at:open_]))
        if open_ == end:
            break
        m = TAG.match(page, open_)
        if m[1]:  # comment
            close = page.find("-->", open_ + 4)
            at = end if close < 0 else close + 3
            continue
        if m[5]:  # declaration, processing instruction, stray end
            close = page.find(">", open_)
            at = end if close < 0 else close + 1
            continue
        if not m[3]:
            rest = page.find(">", open_)
            if re.match(r"</?[A-Za-z]", page[open_:open_ + 3]):  # a tag that never ends
                at = end if rest < 0 else rest + 1
            else:
                node.children.append("<")
                at = open_ + 1
            continue
        tag, at = m[3].lower(), m.end()
        if m[2]:
            up = node
            while up is not root and up.tag != tag:
                up = up.parent if up.tag not in ("table", "td", "th") or tag not in ("p", "li", "b", "i", "a") else root
            if up is not root:
                node = up.parent
            elif tag == "p":
                node.children.append(Node("p", node))
            continue
        if tag in ENDS_PARAGRAPH:
            up = node
            while up is not root and up.tag != "p" and up.tag not in SCOPES:
                up = up.parent
            if up.tag == "p":
                node = up.parent
        if tag in IMPLIED:
            closes, inside = IMPLIED[tag]
            up, closed = node, None
            while up is not root and up.tag not in inside:
                if up.tag in closes:
                    closed = up
                up = up.parent
            if closed:
                node = closed.parent
        unwanted, named = _unwanted(tag, m[4], node)
        new = Node(tag, node, unwanted, named, link=tag == "a")
        node.children.append(new)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            stop = close.start() if close else end
            if tag == "pre" or not new.unwanted:
                new.children.append(page[at:stop])
            at = end if close is None else max(page.find(">", stop) + 1, stop + 1)
        elif tag not in VOID:
            node = new
    return root


def _overrule(root: Node) -> None:
    """Keep boxes that only a name speaks against if they hold the longest article or, on a page without one, most of the
    plain text."""
    order, stack = [], [(root, False)]
    while stack:
        node, link = stack.pop()
        order.append((node, link))
        stack += [(c, link or c.link) for c in node.children if isinstance(c, Node) and (c.named or not c.unwanted)]
    plain: dict[int, int] = {}
    longest = 0, None
    for node, link in reversed(order):
        own = 0 if link else sum(len(SPACES.sub("", c)) for c in node.children if isinstance(c, str))
        plain[id(node)] = own + sum(plain.get(id(c), 0) for c in node.children if isinstance(c, Node))
        if node.tag in ("article", "main") and plain[id(node)] >= longest[0]:
            longest = plain[id(node)], node
    above, up = set(), longest[1]
    while up is not None:
        above.add(id(up))
        up = up.parent
    for node, _ in order:
        most = longest[1] is None and plain[id(node)] > SHARE * plain[id(root)]
        if node.named and (id(node) in above or most):
            node.unwanted = False


def _measure(root: Node) -> None:
    """Characters, link characters, tags and link tags below every node; then densities; without what is unwanted."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node) and not c.unwanted]
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                n = len(SPACES.sub("", child))
                node.chars += n
                node.link_chars += n if node.link else 0
            elif not child.unwanted:
                node.chars += child.chars
                node.link_chars += child.chars if child.link else child.link_chars
                node.tags += child.tags + (child.tag not in VOID)
                node.link_tags += child.link_tags + child.link
    for node in order:
        node.density = _density(node.chars, node.link_chars, node.tags)
        own = sum(len(SPACES.sub("", c)) for c in node.children if isinstance(c, str))
        node.total = own * (1.0 - node.link)
    for node in order:
        node.total += sum(c.density for c in node.children if isinstance(c, Node) and not c.unwanted)


def _density(chars: int, link_chars: int, tags: int) -> float:
    """Characters per tag times the share of those outside links."""
    return max(chars - link_chars, 0) / max(tags, 1)


def _densest(root: Node) -> Node:
    """The node with the largest sum of densities; of those nearly as large an article or main element, if there is one."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node) and not c.unwanted]
    best = max(order, key=lambda n: n.total)
    near = [n for n in order if n.tag in ("article", "main") and n.total >= NEAR_TIE * best.total]
    return max(near, key=lambda n: n.total) if near else best


def _content(root: Node) -> tuple[Node, float]:
    """The subtree to keep and the density threshold of its path: the densest node, widened while what its parent has
    besides it is text of comparable density, or a heading of it."""
    best = _densest(root)
    while best.parent is not None and best.tag != "body":
        up = best.parent
        rest = up.chars - best.chars, up.link_chars - best.link_chars, up.tags - best.tags - 1
        if best.tag in BLOCK and not (best.tag not in ("article", "main") and _heading_before(up, best)):
            if rest[0] - rest[1] < 0.05 * max(up.chars, 1) or _density(*rest) < 0.5 * best.density:
                break
        best = up
    path, node = [], best
    while node is not None and node.tag not in ("html", ""):
        path.append(node.density)
        node = node.parent
    return best, min(path, default=0.0)


def _heading_before(up: Node, best: Node) -> bool:
    for child in up.children:
        if child is best:
            return False
        if isinstance(child, Node) and child.tag in ("h1", "h2"):
            return True
    return False


def _blocks(content: Node, threshold: float) -> list[str]:
    """The texts of the blocks below a node in page order; lists and boxes of links under the threshold are left out."""
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = SPACES.sub(" ", "".join(parts)).strip()
        if text:
            blocks.append(text)
        parts.clear()

    stack: list = [iter((content,))]
    ends: list[bool] = [False]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
            if ends.pop():
                flush()
        elif isinstance(child, str):
            parts.append(child)
        elif not child.unwanted:
            block = child.tag in BLOCK
            mostly_links = child.link_chars * 2 > child.chars and child.link_tags > 1
            if child is not content and block and mostly_links and child.density < threshold:
                flush()
                continue
            if block:
                flush()
            stack.append(iter(child.children))
            ends.append(block)
    flush()
    return blocks


def main_text(page: str | None) -> str:
    root = parse(page or "")
    _overrule(root)
    _measure(root)
    return "\n".join(_blocks(*_content(root)))


def extract(pages: DataFrame, markup: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    small_batches(pages.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    columns = [F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"),
               F.col(f"`{markup}`").cast("string").alias("html")]
    return pages.select(*columns).mapInArrow(read, "page_id long, url string, text string, n_chars long")
