"""Main text of web pages by composite text density.

Every block element of the page's tree gets a link-adjusted density (characters
per tag, lowered by the share of characters and tags in links). The element whose
children's densities sum highest is the core of the article; the lowest density
on its path to the body is the threshold. Elements that by tag, role, class or id
are menus, headers, footers, sidebars, notices, adverts, forms, code or reader
comments are taken out first. What is left of the outermost ``article`` or
``main`` around the core is the article, whole; outside it, parts over the
threshold, other articles and first headings are kept. A page whose core has no
such element keeps all parts but those under the threshold that are mostly links.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.arrow_rows import table_batch

# fixed values: HTML element and naming conventions
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output progress q rp rt
ruby s samp small span strike strong sub sup time tt u var wbr""".split())
DROP = frozenset("""head script style noscript template nav footer aside form button select textarea iframe object embed svg canvas audio
video dialog menu title noembed noframes input applet map datalist fieldset""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion sidebar rail menu nav
navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments reply replies respond disqus cookie cookies
consent notice notices gdpr popup modal overlay newsletter subscribe subscription signup login search share sharing social related recommended
recommendations widget toolbar pagination pager skip copyright alert form""".split())
# fixed values: what may stand beside such a name in the name of a part inside an article
GLUE = frozenset("""area articles bar block box button buttons container content icons inner item items label link links list module panel posts row
section slot stories text thread title top unit wrapper""".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("tr", "td", "th", "thead"), "body": ("head",)}
SCOPES = {"li": ("ul", "ol", "menu"), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "thead": ("table",), "tbody": ("table",),
          "dt": ("dl",), "dd": ("dl",)}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTR = re.compile(r"""(class|id|role|style|hidden)(?=[\s=>/]|\Z)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)


def closed(attrs: str) -> bool:
    """Whether a tag with these attributes ends itself (a slash, but not one that
    belongs to an unquoted value)."""
    return attrs.endswith("/") and not re.search(r"=\s*[^\s\"']*/\Z", attrs)


class Node:
    __slots__ = ("tag", "parent", "items", "noise", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, noise: bool) -> None:
        self.tag, self.parent, self.noise = tag, parent, noise
        self.items: list = []  # child nodes, and text runs as [text, chars, link chars, tags, link tags]
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


def noisy(attrs: str, inside: bool = False) -> bool:
    """Whether the attributes mark a menu, advert, form and the like. Inside an
    article a name counts only if all of it says so ("share-buttons", but not
    "share-price" or "alert-levels")."""
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value) or name == "role" and value in ROLES:
            return True
        if name in ("class", "id"):
            for word in value.split():
                parts = [p for p in re.split(r"[^a-z]+", word) if p]
                if not parts or parts[0] in ("has", "with", "no") or NAMES.isdisjoint(parts):
                    continue
                if not inside or all(p in NAMES or p in GLUE for p in parts):
                    return True
    return False


class Open:
    """A stack of open tags that knows how many of each are open."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.count: dict[str, int] = {}

    def push(self, tag: str) -> None:
        self.tags.append(tag)
        self.count[tag] = self.count.get(tag, 0) + 1

    def pop(self) -> str:
        tag = self.tags.pop()
        self.count[tag] -= 1
        return tag

    def has(self, *tags: str) -> bool:
        return any(self.count.get(t) for t in tags)


def parse(page: str) -> Node:
    """The tree of block elements; inline elements belong to their block's text.
    Text in inline elements that are noise is left out."""
    root = at = Node("html", None, False)
    inline, muted = Open(), Open()  # open inline elements of the current block; those from the first noisy one on
    blocks, names = [root], Open()
    pos, end = 0, len(page)

    def text(raw: str) -> None:
        if raw and not muted.tags:
            run = at.items[-1] if at.items and isinstance(at.items[-1], list) else None
            if run is None:
                at.items.append(run := [[], 0, 0, 0, 0])
            words = html.unescape(raw) if "&" in raw else raw
            n = sum(map(len, words.split()))
            run[0].append(words)
            run[1] += n
            run[2] += n if inline.has("a") else 0

    def shut_block() -> None:
        blocks.pop()
        names.pop()

    while pos < end:
        m = TOKEN.search(page, pos)
        if m is None:
            text(page[pos:])
            break
        text(page[pos:m.start()])
        pos = m.end()
        closing, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag in INLINE:
                for stack in (muted, inline):
                    if stack.has(tag):
                        while stack.pop() != tag:
                            pass
                        break
                continue
            if names.has(tag):
                while blocks[-1].tag != tag:
                    shut_block()
                shut_block()
                at, inline, muted = blocks[-1], Open(), Open()
            continue
        if tag in INLINE:
            if tag == "br":
                text(" ")
            if muted.tags or attrs.strip() and noisy(attrs, inside=True):
                if tag not in VOID and not closed(attrs):
                    muted.push(tag)
                continue
            if not at.items or not isinstance(at.items[-1], list):
                at.items.append([[], 0, 0, 0, 0])
            at.items[-1][3] += 1
            at.items[-1][4] += tag == "a"
            if tag not in VOID and not closed(attrs):
                inline.push(tag)
            continue
        if tag == "html":
            continue
        shut, scope = CLOSES.get(tag, ()), SCOPES.get(tag, ())
        if blocks[-1].tag == "p" and len(blocks) > 1:
            shut_block()
        # elements that this one ends, up to the one that it belongs to
        while names.has(*shut) and blocks[-1].tag not in scope:
            last = next(i for i in range(len(blocks) - 1, -1, -1) if blocks[i].tag in shut or blocks[i].tag in scope)
            if blocks[last].tag in scope:
                break
            while len(blocks) > last:
                shut_block()
        node = Node(tag, blocks[-1], tag in DROP or noisy(attrs, names.has("article", "main")))
        blocks[-1].items.append(node)
        inline, muted = Open(), Open()
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(page, pos)
            pos = close.end() if close else end
        elif tag not in VOID and not closed(attrs):
            blocks.append(node)
            names.push(tag)
        at = blocks[-1]
    return root


def nodes_of(root: Node) -> list[Node]:
    """All nodes, parents before children."""
    out = [root]
    for n in out:
        out += [x for x in n.items if isinstance(x, Node)]
    return out


def measure(root: Node) -> list[Node]:
    order = nodes_of(root)
    for n in reversed(order):
        n.chars = n.tags = n.link_chars = n.link_tags = 0
        for x in n.items:
            if isinstance(x, Node):
                counts = (x.chars, x.link_chars, x.tags + 1, x.link_tags)
            else:
                counts = tuple(x[1:])
            n.chars += counts[0]
            n.link_chars += counts[1]
            n.tags += counts[2]
            n.link_tags += counts[3]
    return order


def without_noise(root: Node) -> None:
    """Take out noise, unless a name alone marks it and it holds the article or
    most of the page's plain text."""
    order = measure(root)
    plain = max(1, root.chars - root.link_chars)
    holds = set()
    for n in reversed(order):
        if (n.tag in ("article", "main", "body") and not n.noise or n in holds) and n.parent:
            holds.add(n.parent)
    inside: dict[Node, bool] = {}
    for n in order:  # parents first
        in_article = inside[n] = n.parent is not None and (n.parent.tag in ("article", "main") or inside[n.parent])
        keep = []
        for x in n.items:
            if isinstance(x, Node):
                if x.tag == "header":
                    if not in_article and n.tag not in ("article", "main") and x not in holds:
                        continue
                elif x.tag in DROP and not (x.tag == "form" and (x in holds or prose(x) > 0.6 * max(1, prose(root)))):
                    continue
                elif x.noise and x.tag not in ("body", "main") and x not in holds and not (
                        x.tag != "article" and not in_article and x.chars - x.link_chars > 0.6 * plain):
                    continue
            keep.append(x)
        n.items = keep


def prose(top: Node) -> int:
    """Characters outside links, fields and other noise by tag, if there is a
    paragraph or a heading."""
    n, todo, text = 0, [top], False
    for x in todo:
        text = text or x.tag in ("p", "h1", "h2", "h3")
        n += sum(r[1] - r[2] for r in x.items if isinstance(r, list))
        todo += [c for c in x.items if isinstance(c, Node) and (c.tag not in DROP or c.tag == "form")]
    return n if text else 0


def above(n: Node) -> Iterator[Node]:
    while n.parent:
        n = n.parent
        yield n


def weigh(order: list[Node], body_link_share: float) -> None:
    for n in order:
        c, t, lc, lt = n.chars, max(1, n.tags), max(1, n.link_chars), max(1, n.link_tags)
        n.density = c / t
        if c and body_link_share > 0:
            base = log(c / max(1, c - n.link_chars) * n.link_chars + body_link_share * c + e)
            n.density *= log(max(1.0, c / lc * t / lt)) / log(base)
    for n in order:
        children = [x for x in n.items if isinstance(x, Node)]
        own = sum(x[1] / max(1, x[3]) for x in n.items if isinstance(x, list))
        n.total = sum(x.density for x in children) + own if children else n.density


def blocks_of(n: Node, out: list[str]) -> None:
    todo = list(reversed(n.items))
    while todo:
        x = todo.pop()
        if isinstance(x, Node):
            todo += reversed(x.items)
        elif line := " ".join("".join(x[0]).split()):
            out.append(line)


def menu(n: Node) -> bool:
    """Two links or more and nothing else."""
    return n.tag not in ("p", "li", "h1", "h2", "h3", "body") and n.link_tags > 1 and n.chars == n.link_chars > 0


def main_text(page: str | None) -> str:
    """The article's blocks in page order, one per line."""
    if not page:
        return ""
    root = parse(page)
    order = measure(root)
    body = next((n for n in order if n.tag == "body"), root)
    share = body.link_chars / body.chars if body.chars else 0.0
    without_noise(root)
    measure(root)
    order = nodes_of(body)
    if 2 * body.link_chars < body.chars and not any(n.tag in ("article", "main") for n in order):
        for n in order:
            n.items = [x for x in n.items if not (isinstance(x, Node) and menu(x))]
        measure(root)
        order = nodes_of(body)
    weigh(order, share)
    if not body.chars:
        return ""
    core = max(order, key=lambda n: n.total)
    inside = set(order)
    threshold = min([core.density, *(n.density for n in above(core) if n in inside)])
    best: dict[Node, Node] = {}
    for n in reversed(order):
        under = [best[x] for x in n.items if isinstance(x, Node)]
        best[n] = max([n, *under], key=lambda x: x.total)
    marked = set()
    for n in order:
        if n.density >= threshold and n.chars:
            marked.add(best[n])
    holder = None  # outermost
    for n in (core, *above(core)):
        if n.tag in ("article", "main") and n in inside:
            holder = n
    full = set(marked)  # parts with such a part in them
    for n in reversed(order):
        if any(isinstance(x, Node) and x in full for x in n.items):
            full.add(n)
    out: list[str] = []
    todo: list = [body]
    while todo:
        n = todo.pop()
        if isinstance(n, list):
            if line := " ".join("".join(n[0]).split()):
                out.append(line)
            continue
        linked = n.density < threshold and 2 * n.link_chars > n.chars
        if n in marked or n is holder or holder and n.tag in ("article", "main", "h1") and not linked:
            blocks_of(n, out)
        elif holder or linked:
            todo += reversed([x for x in n.items if isinstance(x, Node) and (holder or x in full)])
        else:
            todo += reversed(n.items)
    return "\n".join(out)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``.

    Null or empty html, and pages without text, give an empty text. Whole pages
    are read; character references are decoded, white space inside a block is one
    space, blocks are joined by one line feed. Null ids and urls and repeated rows
    are passed through; an empty table gives an empty result; other columns are
    ignored.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            schema = pa.schema([b.schema.field(0), b.schema.field(1), ("text", pa.string())])
            yield table_batch(schema, [b.column(0), b.column(1), [main_text(h) for h in b.column(2).to_pylist()]])

    spec = f"page_id {rows.schema[0].dataType.simpleString()}, url {rows.schema[1].dataType.simpleString()}, text string"
    return rows.mapInArrow(run, spec).withColumn("n_chars", F.length("text").cast("long"))
