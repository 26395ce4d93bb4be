"""Main text of web pages, with the templates of their site removed.

A tolerant parse makes a tree of each page. The subtree of every block element is hashed, those
of menus, footers and boxes around the article included, and hashes are counted in Spark over
the different pages of each host; copies of one page count once. Subtrees that recur are
templates and go:

* Elements other than prose go where at least ``min_pages`` pages and a third of the square root
  of the host's pages have them, so the boxes of one section of a large host are found too.
* Prose (paragraphs, headings, list items and the like) goes only on pages without a main region,
  where at least ``share`` of the host's pages have it. Inside a main region it is never deleted:
  a sentence that many articles have is still part of each.

The main region of a page are its articles, else the main element, else named content, else the
body. What occurs on too few pages to be counted is told by its markup: scripts, styles, forms
and other elements that are never prose go by their tag, around the main region also what class,
id or role name as menus, adverts or comments. Inside it only names that leave no doubt count.

A hot host is no task's load: hashes are counted by (host, hash) after partial sums, and pages
are joined with the list of their host's templates, broadcast behind a check of its rows. That
list grows with the square root of a host's pages.

Defined results: null and empty pages, and pages without text, give empty text. A page without a
host counts under an empty host. Repeated rows give the same text each. Other columns go.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulon.llm.common import small_batches
from tabulon.session import BROADCAST_ROWS, stored

MIN_PAGES = 5
SHARE = 0.5
#: An element on this part of the square root of a host's pages is a template of a section.
SECTION = 3

# Fixed vocabulary of markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template".split())
DROPPED = RAW | frozenset(
    "head nav footer aside form button select option datalist label fieldset legend dialog menu "
    "svg math canvas audio video object map".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rb rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr caption figcaption address "
                  "hgroup header".split())
#: A start tag of the key's group ends an open element of the value's.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
          "tbody": {"thead", "tbody", "tr", "td", "th"},
          "tfoot": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = frozenset("ul ol dl table article section div body html main nav aside".split())
#: Words of class, id or role that mark what is not the article; a word may end in more letters.
MARKED = frozenset(
    "nav navbar navigation menu menubar sidebar footer masthead breadcrumb breadcrumbs cookie "
    "cookies consent gdpr banner notice notices notification alert alertdialog ad ads advert "
    "adverts advertisement advertising sponsor sponsored promo promotion comment comments "
    "respond replies responses disqus discussion share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup login search popup modal overlay "
    "pagination pager widget toolbar skip copyright disclaimer contentinfo complementary "
    "dialog form".split())
PREFIXES = ("comment", "advert", "adsby", "cookie", "breadcrumb", "newsletter", "sidebar", "disqus")
#: ``header`` marks a page header only when nothing else is said of it than these.
HEADER = frozenset("header site page top global wrapper container main".split())
CONTENT = frozenset("content main main-content maincontent article article-body article-content "
                    "post post-body post-content entry entry-content story story-body".split())

#: Names of class, id or role that mark what is not the article wherever they stand.
SURE = re.compile(
    r"(?:ads?|adverts?|advertisements?|advertising|adsbygoogle|sponsored|promo|banner|cookies?|gdpr|"
    r"breadcrumbs?|navigation|navbar|menubar|sidebar|footer|comments?|disqus|newsletter|"
    r"subscribe|related|social|share|sharing|pagination|contentinfo|complementary|dialog)"
    r"(?:[-_](?:slot|box|block|unit|list|area|form|links?|buttons?|bar|banner|container|wrapper|"
    r"section|posts?|articles?|notice|top|bottom|left|right|inline|label|thread|\d+))*")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(
    r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>]+)))?""", re.S)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


class Node:
    """An element: its tag, what is said of it, and its children (nodes and strings)."""

    __slots__ = ("tag", "names", "words", "hidden", "children", "parent", "has_main", "hash",
                 "linked", "letters")

    def __init__(self, tag: str, attributes: str, parent: Node | None) -> None:
        self.tag, self.parent = tag, parent
        self.children: list[Node | str] = []
        self.has_main = self.hidden = False
        self.hash = self.linked = self.letters = 0
        self.names: frozenset[str] = frozenset()
        self.words: frozenset[str] = frozenset()
        if attributes and not attributes.isspace():
            said = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in
                    _ATTRIBUTE.finditer(attributes)}
            names = html.unescape(" ".join(said.get(a, "") for a in ("class", "id", "role")))
            self.names = frozenset(names.lower().split())
            self.words = frozenset(w.lower() for w in _WORDS.findall(names))
            self.hidden = "hidden" in said or bool(
                re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", said.get("style", "")))

    @property
    def is_main(self) -> bool:
        return self.tag in ("article", "main") or "main" in self.names and self.tag != "header"

    def unwanted(self) -> bool:
        """Never part of an article. Around an article, only by what the element is for."""
        if self.tag in DROPPED:
            return not (self.tag in ("form", "label", "fieldset") and self.has_main)
        if self.tag in ("html", "body", "main"):
            return False
        if self.inside("article", "main"):
            return (any(map(SURE.fullmatch, self.names)) or self.hidden) and not self.has_main
        marked = (bool(self.words & MARKED)
                  or any(w.startswith(PREFIXES) for w in self.words)
                  or bool(self.words) and "header" in self.words and self.words <= HEADER)
        if self.tag == "header":
            marked = True
        return (marked or self.hidden) and not self.has_main

    def inside(self, *tags: str) -> bool:
        at = self.parent
        while at is not None:
            if at.tag in tags:
                return True
            at = at.parent
        return False


def parse(page: str) -> Node:
    """The tree of a page; what is not closed ends with its parent."""
    root = at = Node("#", "", None)
    lower = None
    end = 0
    size = len(page)
    while end < size:
        m = _TOKEN.match(page, end)
        if m is None:                                  # cannot be: the last branch takes any "<"
            break
        end = m.end()
        tag = m[2]
        if tag is None:
            token = m[0]
            if token[0] != "<" or token == "<":
                at.children.append(token)
            elif token.startswith("<![CDATA["):
                at.children.append(html.escape(token[9:].removesuffix("]]>"), quote=False))
            continue
        tag = tag.lower()
        if m[1]:
            top = at
            while top.parent is not None and top.tag != tag:
                top = top.parent
            if top.parent is not None:
                at = top.parent
            elif tag == "p":                           # a stray end is an empty paragraph
                at.children.append(Node("p", "", at))
            elif tag == "br":
                at.children.append(Node("br", "", at))
            continue
        if tag not in INLINE and tag not in VOID:
            at = _closed_for(tag, at)
        if tag in ("article", "main"):
            lower = page.lower() if lower is None else lower
            top = at
            while top is not None:                     # an element that swallowed the page
                if top.tag in DROPPED and lower.find(f"</{top.tag}", end) < 0:
                    at = top.parent
                top = top.parent
        node = Node(tag, m[3], at)
        at.children.append(node)
        if tag in ("article", "main") or node.is_main:
            up = node
            while up is not None and not up.has_main:
                up.has_main = True
                up = up.parent
        if tag in VOID or m[3].endswith("/") and tag not in RAW and tag in ("svg", "path"):
            continue
        if tag in RAW:
            lower = page.lower() if lower is None else lower
            close = lower.find(f"</{tag}", end)
            if close < 0:
                end = size
            else:
                gt = page.find(">", close)
                end = size if gt < 0 else gt + 1
            continue
        at = node
    return root


def _closed_for(tag: str, at: Node) -> Node:
    """Where an element starts, once it has ended the open ones that it may not be inside."""
    ends = CLOSES.get(tag, ())
    top = at
    out = at
    while top.parent is not None and top.tag not in SCOPES:
        if top.tag == "p" and tag not in ("li", "dt", "dd", "tr", "td", "th", "option"):
            out = top.parent
        if top.tag in ends:
            out = top.parent
        top = top.parent
    return out


def _finish(root: Node) -> None:
    """Hashes and text sizes of all subtrees, children before parents."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in node.children if isinstance(c, Node)]
    for node in reversed(order):
        h = xxhash.xxh3_64(node.tag.encode())
        for c in node.children:
            if isinstance(c, Node):
                if c.tag not in RAW:
                    h.update(c.hash.to_bytes(8, "little"))
                if c.tag not in DROPPED:
                    node.letters += c.letters
                    node.linked += c.letters if c.tag == "a" else c.linked
            else:
                text = " ".join(c.split())
                if text:
                    h.update(text.encode("utf-8", "replace"))
                    node.letters += len(text)
        node.hash = h.intdigest()


#: A block of the main text: (text, subtrees that hold it and go by the rule of elements, those
#: that go by the rule of prose).
Block = tuple[str, list[int], list[int]]


def page_blocks(page: str | None) -> list[Block]:
    """The blocks of the page's main regions."""
    return _page(page)[0]


def _page(page: str | None) -> tuple[list[Block], list[int]]:
    """Blocks, and the hashes of the elements around the main regions."""
    if not page:
        return [], []
    root = parse(page)
    _finish(root)
    blocks: list[Block] = []
    regions = _regions(root)
    for region, loose in regions:
        _cut(region, loose, blocks)
    inside = {id(r) for r, _ in regions}
    around, stack = [], [root]
    while stack:
        node = stack.pop()
        if id(node) in inside or node.tag in RAW:
            continue
        if node.tag not in INLINE and _eligible(node, root):
            around.append(node.hash)
        stack += [c for c in node.children if isinstance(c, Node)]
    return blocks, around


def _regions(root: Node) -> list[tuple[Node, bool]]:
    """Outermost wanted articles; else main elements; else named content; else all."""
    wanted: dict[str, list[Node]] = {"article": [], "main": [], "content": []}
    stack: list[tuple[Node, frozenset[str]]] = [(root, frozenset())]
    while stack:
        node, above = stack.pop()
        if node.unwanted():
            continue
        kinds = set()
        if node.tag == "article" and not (node.words & MARKED):
            kinds.add("article")
        if node.tag == "main" or node.is_main and node.tag != "article":
            kinds.add("main")
        if node.names & CONTENT and node.tag not in ("html", "body"):
            kinds.add("content")
        for k in kinds - above:
            wanted[k].append(node)
        below = above | kinds
        stack += [(c, below) for c in reversed(node.children) if isinstance(c, Node)]
    for kind in ("article", "main", "content"):
        if any(n.letters for n in wanted[kind]):
            return [(n, False) for n in wanted[kind]]
    return [(root, True)]


def _cut(region: Node, loose: bool, blocks: list[Block]) -> None:
    """Append the region's blocks. ``loose``: the region is the whole page, so prose may be
    template too, and lists of links are left out."""
    text: list[str] = []
    elements: list[int] = []
    prose: list[int] = []

    def chain(node: Node) -> list[int] | None:
        if node is region or not _eligible(node, region):
            return None
        if node.tag not in PROSE:
            return elements
        return prose if loose else None

    def flush() -> None:
        words = html.unescape("".join(text)).split()
        if words:
            blocks.append((" ".join(words), list(elements), list(prose)))
        text.clear()

    # A stack of steps: a node to enter, a string to add, or a node to leave.
    stack: list[tuple[int, Node | str]] = [(0, region)]
    while stack:
        step, item = stack.pop()
        if isinstance(item, str):
            text.append(item)
            continue
        inline = item.tag in INLINE
        if step == 1:
            if not inline:
                flush()
                if (held := chain(item)) is not None:
                    held.pop()
            continue
        if item is not region and (item.unwanted() or loose and _links_only(item)):
            if not inline:
                flush()
            continue
        if item.tag in ("br", "hr"):
            flush()
            continue
        if not inline:
            flush()
            if (held := chain(item)) is not None:
                held.append(item.hash)
        stack.append((1, item))
        stack += [(0, c) for c in reversed(item.children)]
    flush()


def _eligible(node: Node, region: Node) -> bool:
    """The node may be a template of its site as a whole."""
    return (node is not region and not node.has_main
            and node.tag not in ("#", "html", "head", "body", *VOID))


def _links_only(node: Node) -> bool:
    links = sum(isinstance(c, Node) for c in node.children)
    return node.tag in ("ul", "ol", "div", "p") and links > 1 and 0 < node.letters == node.linked


_LONGS = T.ArrayType(T.LongType())
_PARSED = T.StructType([
    T.StructField("signature", T.LongType()),
    T.StructField("around", _LONGS),
    T.StructField("blocks", T.ArrayType(T.StructType([
        T.StructField("text", T.StringType()),
        T.StructField("elements", _LONGS), T.StructField("prose", _LONGS)])))])


def _signed(h: int) -> int:
    return h - (1 << 64) if h >= 1 << 63 else h


def _parse_pages(pages: pa.Array) -> pa.Array:
    out = []
    for page in pages.to_pylist():
        blocks, around = _page(page)
        whole = xxhash.xxh3_64_intdigest(
            "\n".join(b[0] for b in blocks).encode("utf-8", "replace"))
        out.append({"signature": _signed(whole), "around": [_signed(h) for h in around],
                    "blocks": [{"text": t, "elements": [_signed(h) for h in e],
                                "prose": [_signed(h) for h in p]} for t, e, p in blocks]})
    longs = pa.list_(pa.int64())
    return pa.array(out, pa.struct([
        ("signature", pa.int64()), ("around", longs),
        ("blocks", pa.list_(pa.struct([("text", pa.string()), ("elements", longs),
                                       ("prose", longs)])))]))


def site_templates(elements: DataFrame, min_pages: int, share: float) -> DataFrame:
    """(host, subtree, most) of the subtrees that recur on a host's different pages.

    ``elements`` has (host, signature, subtree); a page without elements has a null subtree.
    ``most`` tells those on at least ``share`` of the pages.
    """
    different = elements.distinct()
    pages = (different.select("host", "signature").distinct()
             .groupBy("host").agg(F.count("*").alias("pages")))
    return (different.where("subtree is not null").groupBy("host", "subtree")
            .agg(F.count("*").alias("n")).where(f"n >= {min_pages}")
            .join(pages, "host").withColumn("most", F.expr(f"n >= {share} * pages"))
            .where(f"most or n >= sqrt(pages) / {SECTION}").select("host", "subtree", "most"))


def main_text(pages: DataFrame, html_column: str = "html", url: str = "url",
              id_column: str = "page_id", min_pages: int = MIN_PAGES, share: float = SHARE
              ) -> DataFrame:
    """Per page: id, url, ``text`` (blocks joined by one space), ``n_chars``, and ``n_removed``:
    how many blocks of the main text and elements around it were templates."""
    small_batches(pages.sparkSession)
    host = F.lower(F.coalesce(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1),
                              F.lit("")))
    parsed = stored(pages.select(
        F.col(id_column).alias("_id"), F.col(url).alias("_url"), host.alias("host"),
        F.arrow_udf(_parse_pages, _PARSED)(F.col(html_column)).alias("_p"))
        .select("_id", "_url", "host", "_p.*"), "parsed")
    every = F.array_distinct(F.concat(F.flatten(F.col("blocks.elements")),
                                      F.flatten(F.col("blocks.prose")), F.col("around")))
    elements = parsed.select("host", "signature", F.explode_outer(every).alias("subtree"))
    templates = stored(site_templates(elements, min_pages, share).groupBy("host")
                       .agg(F.collect_list("subtree").alias("gone"),
                            F.collect_list(F.when(F.col("most"), F.col("subtree"))).alias("most")),
                       "templates")
    if templates.count() <= BROADCAST_ROWS:
        templates = F.broadcast(templates)
    kept = F.filter("blocks", lambda b: ~F.coalesce(
        F.arrays_overlap(b["elements"], F.col("gone"))
        | F.arrays_overlap(b["prose"], F.col("most")), F.lit(False)))
    boxes = F.coalesce(F.size(F.array_intersect("around", "gone")), F.lit(0))
    return (parsed.join(templates, "host", "left").withColumn("kept", kept)
            .select(F.col("_id").alias(id_column), F.col("_url").alias(url),
                    F.array_join(F.col("kept.text"), " ").alias("text"),
                    (F.size("blocks") - F.size("kept") + boxes).cast("long").alias("n_removed"))
            .withColumn("n_chars", F.length("text").cast("long")))
