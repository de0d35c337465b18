"""Main-text extraction by composite text density.

A page becomes a tree of elements. Elements that are never an article's text (scripts, styles, menus,
page headers, footers, sidebars, notices, adverts, forms, reader comments, by tag, role, class or id) go
first; by class or id only what holds no main, less text of articles than stands outside, and, on pages
without an article, no more than half of the page's unlinked text (reader comments: unless nothing much is
outside). That is cleaning only: what is chosen is decided by densities.

For each node left, with C characters, T tags, LC characters and LT tags in links below it, the
composite text density is C / T times the logarithm of (C / LC) (T / LT) to the base
ln(C / (C - LC) LC + LCb / Cb C + e), where b is the body and each number of links counts as 1 at least.
Inline elements are part of the block that holds them; text between the blocks of an element is a node of
its own. The body or the block below it with the largest sum of its blocks' densities is chosen, the outermost of equal ones. The smallest
density on the path from the body to it is the threshold. Blocks beside the path that reach it are kept too,
and so are those that hold a tenth of the chosen block's characters, or are text between blocks, and reach
half of the path's smallest number of characters a tag, unless most of their characters are links; so is
what stands between two kept blocks of a parent, and a heading right before the first. Of other blocks the
parts that reach the threshold are kept. Blocks of links outside articles go.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one
space in page order. Null or empty pages have an empty text. Any markup is read without failing, in time
that grows with its length: unknown, unclosed and misnested tags, stray brackets, very long pages, deep trees. Other columns are
ignored; repeated rows are repeated in the result.
"""

from __future__ import annotations

import heapq
import html as entities
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motolake.llm.common import begin, small_batches

#: Markup declarations, comments and tags; quoted attribute values may hold brackets.
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<([a-zA-Z][^\s/>]*)([^>]*)>|</([a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
PIECES = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")

# Element names by their part in a page, and words that name parts of a page which aren't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe xmp noembed noframes textarea title svg math".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split())
DROPPED = frozenset("head nav footer aside form button select option datalist dialog menu object embed audio video canvas map fieldset".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements adsense adslot sponsor sponsored sponsors promo promos promotion promoted outbrain taboola nav navbar navigation menu menus breadcrumb breadcrumbs masthead topbar footer "
    "sidebar sidebars aside widget widgets related recommended recommendations trending cookie cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login social share sharing shares "
    "comment comments commentlist disqus discussion replies respond search toolbar pagination pager copyright disclaimer banner".split()
)
READERS = frozenset("comment comments commentlist disqus discussion replies respond".split())
SCOPE = frozenset("html body table td th caption object template button article main section".split())
#: An opening tag on the left closes an open element on the right, if nothing of the scope is between.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "tbody", "thead"), "tfoot": ("tr", "td", "th", "tbody", "thead"), "body": ("head",)}


class Node:
    __slots__ = ("block", "children", "chars", "density", "dropped", "end", "inside", "link", "link_chars", "link_tags", "parent", "start", "suspect", "tag", "tags")

    def __init__(self, tag: str, parent: Node | None, start: int, dropped: bool):
        self.tag, self.parent, self.start, self.end = tag, parent, start, start
        self.children: list[Node] = []
        self.dropped = dropped
        self.suspect = 0
        self.link = tag == "a" or (parent is not None and parent.link)
        self.inside = tag in ("article", "main") or (parent is not None and parent.inside)
        self.block = tag not in INLINE  # and an inline element that holds one
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = 0.0


def boilerplate(tag: str, attributes: str, parent: Node) -> bool:
    if tag in DROPPED:
        return True
    if tag == "header":
        return not parent.inside
    if not attributes or tag in ("html", "body", "main", "article"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" and not value or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value.lower() in ROLES:
            return True
    return False


def suspicion(tag: str, attributes: str) -> int:
    """1 if a word of class or id names a part of a page which isn't the article, 2 if it names readers' comments, else 0."""
    if not attributes or tag in ("html", "body", "main", "article"):
        return 0
    found = 0
    for name, value in ATTRIBUTE.findall(attributes):
        value = value.strip("\"'")
        if name.lower() in ("class", "id") and "article" not in value.lower():
            words = {w.lower() for w in PIECES.findall(value)}
            found = max(found, 2 if words & READERS else 1 if words & WORDS else 0)
    return found


def drop_suspects(root: Node) -> None:
    """Drop suspect subtrees but those that hold a main, more text of articles than is outside, or, without articles, most of the page's unlinked text."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.dropped:
            order.append(node)
            stack.extend(node.children)
    if not any(n.suspect for n in order):
        return
    plain: dict[int, int] = {}
    held: dict[int, int] = {}
    mains: dict[int, bool] = {}
    own = {}
    for node in reversed(order):
        k = id(node)
        mine = node.chars - node.link_chars
        own[k] = mine if node.inside else 0
        kept = [id(c) for c in node.children if not c.dropped]
        plain[k] = mine + sum(plain[c] for c in kept)
        held[k] = own[k] + sum(held[c] for c in kept)
        mains[k] = any(mains[c] for c in kept) or node.tag == "main" and plain[k] > 0
    free, waiting, stack = 0, [], [root]
    whole = plain[id(root)]
    while stack or waiting:
        while stack:
            node = stack.pop()
            free += own[id(node)]
            for c in node.children:
                if c.suspect and not c.dropped:
                    heapq.heappush(waiting, (c.suspect, -held[id(c)], -plain[id(c)], c.start, id(c), c))
                elif not c.dropped:
                    stack.append(c)
        if waiting:
            kind, inner, text, _, k, node = heapq.heappop(waiting)
            if mains[k] or (-inner > (free if kind == 1 else 0) and not (kind == 2 and free)) or not free and (-text * 2 > whole if kind == 1 else -text * 10 > whole * 9):
                stack.append(node)
            else:
                node.dropped = True


def blocks(node: Node) -> list[Node]:
    return [c for c in node.children if c.block and not c.dropped]


def loose(node: Node, texts: list[str | None]) -> None:
    """Give text and inline elements between a node's blocks nodes of their own."""
    if not blocks(node) and node.parent is not None and node.tag not in ("html", "body"):
        return
    out: list[Node] = []
    run: list[Node] = []
    start, chars, links, at = node.start, 0, 0, node.start

    def end(upto: int) -> None:
        nonlocal run, chars, links
        if chars or any(c.chars for c in run):
            box = Node("#text", node, start, False)
            box.end, box.children, box.chars, box.link_chars = upto, run, chars, links
            for c in run:
                c.parent = box
            node.chars -= chars
            node.link_chars -= links
            out.append(box)
        else:
            out.extend(run)
        run, chars, links = [], 0, 0

    for child in [*node.children, None]:
        upto = child.start if child else node.end
        own = sum(len("".join(x.split())) for x in texts[at:upto] if x)
        chars += own
        links += own if node.link else 0
        if child and not child.dropped and not child.block:
            run.append(child)
        else:
            end(upto)
            if child:
                out.append(child)
                start = child.end
        at = child.end if child else upto
    node.children = out


def parse(page: str) -> tuple[Node, list[str | None]]:
    """The tree, and the page's texts in order, None for a block boundary; nodes hold the bounds of their part."""
    root = Node("#root", None, 0, False)
    texts: list[str | None] = []
    stack = [root]
    open_: list[dict[str, int]] = [{}]  # how many elements of each name are open since the last one of the scope
    everywhere: dict[str, int] = {}
    at, n = 0, len(page)
    last = page.rfind(">")

    def close(upto: int) -> None:
        while len(stack) > upto:
            node = stack.pop()
            if node.tag in SCOPE:
                open_.pop()
            open_[-1][node.tag] -= 1
            everywhere[node.tag] -= 1
            if node.tag not in INLINE:
                texts.append(None)
            node.end = len(texts)
            parent = stack[-1]
            parent.block = parent.block or node.block

    def text(part: str) -> None:
        if part:
            texts.append(entities.unescape(part) if "&" in part else part)
            if not stack[-1].dropped:
                count = len("".join(texts[-1].split()))
                stack[-1].chars += count
                if stack[-1].link:
                    stack[-1].link_chars += count

    while at < n:
        if at > last:  # no tag ends any more, but a comment may be open
            opened = [i for i in (page.find("<!--", at), page.find("<![CDATA[", at)) if i >= 0]
            text(page[at : min(opened, default=n)])
            break
        found = TAG.search(page, at)
        if found is None:
            text(page[at:])
            break
        text(page[at : found.start()])
        at = found.end()
        name = found[1] or found[3]
        if name:
            name = name.lower()
            attributes = found[2] if found[1] else found[4]
            if name not in INLINE and name not in VOID:
                closes = CLOSES.get(name, ())
                if any(open_[-1].get(t) for t in ("p", *closes)):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag == "p" or stack[i].tag in closes:
                            close(i)
                            break
                        if stack[i].tag in SCOPE or (stack[i].tag in ("ul", "ol", "dl") and name in ("li", "dt", "dd")):
                            break
                if name in ("tr", "tbody", "tfoot"):
                    while len(stack) > 1 and stack[-1].tag in closes:
                        close(len(stack) - 1)
            if name in VOID:
                stack[-1].tags += 1
                if name in ("br", "hr"):
                    texts.append(None)
                continue
            parent = stack[-1]
            node = Node(name, parent, len(texts), parent.dropped or boilerplate(name, attributes, parent))
            node.suspect = suspicion(name, attributes)
            if name not in INLINE:
                texts.append(None)
            parent.children.append(node)
            if attributes.endswith("/") and name in ("svg", "math", "path"):
                continue
            stack.append(node)
            open_[-1][name] = open_[-1].get(name, 0) + 1
            everywhere[name] = everywhere.get(name, 0) + 1
            if name in SCOPE:
                open_.append({})
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
                close(len(stack) - 1)
        elif found[5]:
            name = found[5].lower()
            if not (open_[-1] if name in INLINE else everywhere).get(name):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    close(i)
                    break
                if name in INLINE and stack[i].tag not in INLINE:
                    break
    close(1)
    root.end = len(texts)
    drop_suspects(root)
    todo = [root]
    while todo:
        node = todo.pop()
        if node.dropped:
            continue
        if node.block:
            loose(node, texts)
        todo.extend(node.children)
    return root, texts


def measure(root: Node) -> list[Node]:
    """Sum counts up the tree and set densities; nodes in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.dropped:
            continue
        order.append(node)
        stack.extend(reversed(node.children))
    for node in reversed(order):
        for child in node.children:
            if not child.dropped:
                node.chars += child.chars
                node.tags += child.tags + 1
                node.link_chars += child.link_chars
                node.link_tags += child.link_tags + (child.tag == "a")
    body = next((x for x in order if x.tag == "body"), root)
    share = body.link_chars / max(body.chars, 1)
    for node in order:
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if c:
            base = math.log(c / max(c - node.link_chars, 1) * lc + share * c + math.e)
            node.density = c / t * math.log(c / lc * t / lt) / math.log(base)
    return order


HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup header".split())


def select(order: list[Node]) -> list[Node]:
    """Maximal subtrees that hold the main text, in page order."""
    if not order or not order[0].chars:
        return []
    body = next((x for x in order if x.tag == "body"), order[0])
    body = body if body.chars == order[0].chars else order[0]
    best, most = body, -1.0
    stack = [body]
    while stack:
        node = stack.pop()
        if node.block and node.chars and not node.dropped:
            total = sum(c.density for c in blocks(node))
            if total > most:
                best, most = node, total
        stack.extend(c for c in reversed(node.children) if not c.dropped)
    path = [best]
    while path[-1] is not body:
        path.append(path[-1].parent)
    threshold = min(x.density for x in path)
    plain = min(x.chars / max(x.tags, 1) for x in path)

    def unlinked(node: Node) -> bool:
        return node.chars > node.link_chars * 2 or not node.link_chars

    def alike(node: Node) -> bool:
        # a short block is out of the reach of a long one's density, as that grows with the logarithm of the length
        return 2 * node.chars >= plain * max(node.tags, 1) and (node.tag == "#text" or 10 * node.chars >= best.chars)

    chosen = [best]
    for below, node in zip(path, path[1:], strict=False):
        own = [c for c in node.children if not c.dropped and c.chars]
        kept = [c is below or unlinked(c) and (c.density >= threshold or alike(c)) for c in own]
        first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
        while first and own[first - 1].tag in HEADINGS:
            first -= 1
        for i, c in enumerate(own):
            if c is below:
                continue
            if first <= i <= last and (kept[i] or unlinked(c)):
                chosen.append(c)
                continue
            rest = list(c.children)
            while rest:
                part = rest.pop()
                if part.dropped or not part.chars or not part.block:
                    continue
                if part.density >= threshold and unlinked(part):
                    chosen.append(part)
                else:
                    rest.extend(part.children)
    return sorted(chosen, key=lambda x: x.start)


def linked(node: Node) -> bool:
    """Whether a block outside articles is a list of links: two or more, with most of its characters."""
    return node.tag not in INLINE and not node.link and not node.parent.inside and node.link_tags >= 2 and node.link_chars * 2 > node.chars


def extract(page: str | None) -> str:
    """Main text of a page."""
    if not page:
        return ""
    root, texts = parse(page)
    order = measure(root)
    chosen = select(order)
    holes: list[tuple[int, int]] = []
    stack = list(chosen)
    while stack:
        node = stack.pop()
        for child in node.children:
            if child.dropped or linked(child):
                holes.append((child.start, child.end))
            else:
                stack.append(child)
    skip = bytearray(len(texts))
    for a, b in holes:
        skip[a:b] = b"\1" * (b - a)
    blocks, block = [], []
    for node in chosen:
        for i in range(node.start, node.end):
            if texts[i] is None or skip[i]:
                blocks.append("".join(block))
                block = []
            else:
                block.append(texts[i])
        blocks.append("".join(block))
        block = []
    return " ".join(" ".join(blocks).split())


def extract_pages(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars."""
    small_batches(pages.sparkSession)

    def run(batches):
        import pyarrow as pa

        begin(__name__)
        for batch in batches:
            texts = [extract(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    source = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return source.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_html(spark, sf_dir: str) -> DataFrame:
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
