"""HTML extraction: site templates are subtrees that recur across many pages of a host.

1. Every page is parsed into a tree, and each block element's subtree is hashed (its tag
   and its text).
2. Spark counts on how many different pages of a host each hash occurs: the same number
   is enough on a host of any size. Pages are told apart by the longest blocks of the
   article beside the subtree, so an article that is published at many addresses, or with
   small changes, isn't a template. A short subtree counts at one place in the tree only.
   Inside of an article texts stay that many articles share: what the site puts there has
   one place, from the start or the end, on nearly all pages that have its text at all.
3. Every page meets its host's hashes; the subtrees with these are deleted. What a page
   marks as no part of its article (navigation, forms, adverts, comments, and so on) goes
   as well, and the blocks that remain are joined.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm.store import stored

#: A subtree outside of an article is a template from so many different pages of the host, and one inside of an article.
LEAST_PAGES, INNER_PAGES = 3, 10
#: The share of a subtree's pages that have it in one place, if it is a template inside of an article.
SAME_PLACE = 0.8
#: A subtree of fewer words counts by its place; so many of the longest blocks beside a subtree tell pages apart.
SHORT_WORDS, BESIDE = 8, 3

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that hold others apart: the end tag of something inside of them doesn't reach beyond.
FRAMES = BLOCKS - frozenset("p dd dt li h1 h2 h3 h4 h5 h6".split())
#: What closes an open paragraph is any block; what else closes an open element of these kinds.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are no text of an article wherever they are.
DROPPED = frozenset(
    "head title script style noscript template nav footer aside form button input select textarea option label iframe frame object applet "
    "embed svg canvas audio video map dialog menu datalist progress meter".split()
)
#: Words of a class, an id or a role that mark an element as no part of the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu submenu "
    "sidebar aside complementary footer contentinfo header masthead topbar toolbar breadcrumb breadcrumbs pagination pager comment comments "
    "commentlist reply replies respond disqus discussion cookie cookies consent gdpr notice notices notification alert popup modal overlay "
    "newsletter subscribe subscription signup login search share sharing social related recommended recommendations widget skip form hidden".split()
)
NEUTRAL = frozenset("site list box container wrapper wrap area block left right top bottom global bar".split())
#: The elements whose names count.
HOLDERS = frozenset("address article body center dd details div dl fieldset figure header li main ol section table td tr ul".split())
NAMED, HIDDEN = 1, 2
MAIN = frozenset(("article", "main"))
WHOLE = frozenset(("html", "body"))
_WORD = re.compile(r"[a-z0-9]+")


class Node:
    __slots__ = ("children", "main", "marked", "names", "tag")

    def __init__(self, tag: str, marked: int):
        self.tag, self.marked, self.main = tag, marked, False
        self.names = False  # of the root: whether names or forms are inside of an article
        self.children: list[Node | str] = []


def _marked(tag: str, attrs: list[tuple[str, str | None]]) -> int:
    """Whether an element is named as no part of the article, or hidden; names count on containers only, an id not on a section."""
    named = 0
    for name, value in attrs:
        if name in ("class", "role") or (name == "id" and tag not in ("section", "article", "main")):
            if tag in HOLDERS and any(_names(token) for token in (value or "").lower().split()):
                named = NAMED
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            return HIDDEN
        elif name == "style" and value and "display:none" in value.replace(" ", "").lower():
            return HIDDEN
    return named


def _names(token: str) -> bool:
    """A token that is a mark, or joined of marks and words that say nothing of what is inside."""
    words = _WORD.findall(token)
    return not MARKS.isdisjoint(words) and all(x in MARKS or x in NEUTRAL for x in words)


class Tree(HTMLParser):
    """The elements of a page, with the ends that pages leave out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html", 0)
        self.open = [self.root]
        self.count: Counter[str] = Counter()  # of the open elements

    def _close(self, tags: tuple[str, ...], within: frozenset[str]) -> None:
        if not any(self.count[t] for t in tags):
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                self.count.subtract(x.tag for x in self.open[k:])
                del self.open[k:]
                return
            if self.open[k].tag in within:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        if tag in BLOCKS:
            self._close(("p",), FRAMES)
        if tag in CLOSES:
            self._close(CLOSES[tag], frozenset(("ul", "ol", "dl", "table", "select", "menu")))
        if tag in HEADINGS:
            self._close(tuple(HEADINGS), FRAMES)
        if tag in MAIN:
            for node in reversed(self.open):
                if node.main:
                    break
                node.main = True
        node = Node(tag, _marked(tag, attrs) if attrs else 0)
        if (node.marked or tag == "form") and (self.count["article"] or self.count["main"]):
            self.root.names = True
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # a slash at the end means something in void elements only

    def handle_endtag(self, tag: str) -> None:
        if tag not in VOID and tag != "html":
            self._close((tag,), frozenset() if tag in FRAMES else FRAMES)

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def subtrees(root: Node) -> Iterator[tuple[Node, bool, int, int]]:
    """The block elements that hold text but not the article, whether each is inside of an article, their hashes, and those of the text alone.

    An element's hash is of its tag, its own text and the hashes of the blocks in it, so
    each text is read once however deep it is.
    """
    stack: list[list] = [[root, root.tag in MAIN, 0, []]]
    while stack:
        frame = stack[-1]
        node, inner, k, parts = frame
        if k < len(node.children):
            frame[2] += 1
            child = node.children[k]
            if isinstance(child, str):
                parts.append(child)
            elif child.tag not in DROPPED or child.tag == "form":
                own = child.tag in BLOCKS or child.tag in DROPPED
                stack.append([child, inner or child.tag in MAIN, 0, [] if own else parts])
            continue
        stack.pop()
        if node.tag in BLOCKS or node.tag in DROPPED:
            text = " ".join("".join(parts).split())
            if text:
                h = _digest(f"{node.tag} {text}")
                if stack:
                    stack[-1][3].append(f" \x00{h}\x00 ")
                if not (node.main or node.tag in WHOLE or node.tag in MAIN):
                    yield node, inner, h, _digest(text) if inner else h


def _longest(own: dict[int, list[str]], n: int) -> tuple[list[tuple], list[tuple]]:
    """The longest blocks before each of ``n`` nodes, and from each on."""
    leaf: list[tuple] = [()] * n
    for k, texts in own.items():
        if text := " ".join("".join(texts).split()):
            leaf[k] = ((-len(text), text),)
    before, after = [()], [()]
    for k in range(n):
        before.append(_with(before[-1], leaf[k]))
        after.append(_with(after[-1], leaf[n - 1 - k]))
    after.reverse()
    return before, after


def _with(best: tuple, other: tuple) -> tuple:
    """The longest blocks with another one; most change nothing."""
    if not other or (len(best) == BESIDE and other[0] >= best[-1]):
        return best
    return tuple(sorted({*best, *other})[:BESIDE])


def evidence(root: Node, mains: list[Node] | None) -> Iterator[tuple[Node, bool, int, int, int]]:
    """The subtrees, whether each is inside of an article, its hash, its keys, and a hash of what is beside each in ``mains``.

    A key is the hash alone, or the hash with the place from the start or from the end.
    A short subtree counts by its places, one inside of an article by places and, whatever
    its tag, alone.
    """
    nodes: list[Node] = []
    at: dict[int, int] = {}
    end: list[int] = []
    count: list[int] = []
    place: list[tuple[int, int]] = []
    up: list[int] = []
    held = {id(m) for m in mains or ()}
    inside: list[bool] = []
    own: dict[int, list[str]] = {}
    stack: list[tuple] = [(root, -1, -1, (0, 0))]
    while stack:
        x, parent, block, path = stack.pop()
        if isinstance(x, str):
            count[parent] += len(x.split())
            if inside[parent]:
                own.setdefault(block, []).append(x)
            continue
        k = len(nodes)
        at[id(x)] = k
        nodes.append(x)
        up.append(parent)
        end.append(k + 1)
        count.append(0)
        place.append(path)
        inside.append(id(x) in held or (parent >= 0 and inside[parent]))
        block = k if x.tag in BLOCKS or block < 0 else block
        front, back = (0, 0) if x.tag in MAIN else path
        kin = [c for c in x.children if isinstance(c, Node) and (c.tag not in DROPPED or c.tag == "form")]
        order = {id(c): n for n, c in enumerate(kin)}
        for c in reversed(x.children):
            if isinstance(c, str):
                stack.append((c, k, block, path))
            elif (n := order.get(id(c))) is not None:
                stack.append((c, k, block, (hash((front, n)), hash((back, len(kin) - n)))))
    for k in range(len(nodes) - 1, 0, -1):
        count[up[k]] += count[k]
        end[up[k]] = max(end[up[k]], end[k])
    before = after = [()] * (len(nodes) + 1)
    if own:
        before, after = _longest(own, len(nodes))
    digests: dict[tuple, int] = {}
    for node, inner, h, text in subtrees(root):
        k = at[id(node)]
        beside = _with(before[k], after[end[k]]) if own else ()
        if beside not in digests:
            digests[beside] = _digest("\n".join(text for _, text in beside))
        keys = (text,) if inner or count[k] >= SHORT_WORDS else ()
        if inner or not keys:
            keys += (hash((h, 1, place[k][0])), hash((h, 2, place[k][1])))
        for key in keys:
            yield node, inner, text, key, digests[beside]


def _holding(root: Node, page: bool) -> frozenset[int]:
    """The marked elements and forms that hold most of the text, or the main heading of an article; not lists of other articles."""
    nodes, stack = [], [root]
    while stack:
        node = stack.pop()
        nodes.append(node)
        stack.extend(x for x in node.children if isinstance(x, Node) and (x.tag not in DROPPED or x.tag == "form"))
    if not any(x.marked or x.tag == "form" for x in nodes):
        return frozenset()
    size: dict[int, tuple[int, int, int]] = {}
    for node in reversed(nodes):
        below = [size[id(x)] for x in node.children if not isinstance(x, str) and id(x) in size]
        own = sum(len(x.strip()) for x in node.children if isinstance(x, str))
        size[id(node)] = (own + sum(x[0] for x in below), sum(x[1] for x in below) + (node.tag == "article"), sum(x[2] for x in below) + (node.tag == "h1"))
    total = size[id(root)][0]
    may = (x for x in nodes if x.marked == NAMED or (x.tag == "form" and not x.marked))
    return frozenset(id(x) for x in may if size[id(x)][1] < 2 and (2 * size[id(x)][0] > total or (not page and size[id(x)][2])))


def _mains(root: Node) -> list[Node]:
    """The outermost articles, else main elements, else the page."""
    held = None
    for tag in ("article", "main"):
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if node.tag in DROPPED or (node.marked and node.tag not in WHOLE):
                if held is None and (node.main or node.tag == tag):
                    held = _holding(root, True)
                if id(node) not in (held or ()):
                    continue  # an article in here is another's teaser
            if node.tag == tag:
                found.append(node)
            else:
                stack.extend(x for x in reversed(node.children) if isinstance(x, Node))
        if found:
            return found
    return [root]


def main_text(root: Node, templates: frozenset[tuple[bool, int]] = frozenset()) -> str:
    """The blocks of the article, joined by line feeds, without subtrees that are templates."""
    mains = _mains(root)
    gone = {id(node) for node, inner, _, key, _ in evidence(root, None) if (inner, key) in templates} if templates else set()
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            blocks.append(text)

    for main in mains:
        held = _holding(main, main is root) if main is root or root.names else ()
        stack: list = [(main, False)]
        while stack:
            x, heads_only = stack.pop()
            if x is None:
                flush()
            elif isinstance(x, str):
                if not heads_only:
                    parts.append(x)
            elif id(x) in gone or (x is not main and id(x) not in held and (x.tag in DROPPED or (x.marked and x.tag not in WHOLE))):
                parts.append(" ")
            elif x.tag == "br":
                parts.append(" ")
            else:
                # Of a header inside of the article only headings are its text; another header is the site's.
                if x.tag == "header" and not x.main:
                    heads_only = True
                elif x.tag in HEADINGS and main is not root:
                    heads_only = False
                if x.tag in BLOCKS:
                    flush()
                    stack.append((None, False))
                stack.extend((c, heads_only) for c in reversed(x.children))
        flush()
    return "\n".join(blocks)


def _host(url: str | None) -> str:
    """The host of an address without user and port, in lower case; empty if there is none."""
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hosts, rows = [], []
        for url, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            root = parse(html or "")
            own = {x[1:] for x in evidence(root, _mains(root))}
            hosts += [_host(url)] * len(own)
            rows += own
        kinds = (pa.bool_(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *(pa.array([x[k] for x in rows], kinds[k]) for k in range(4))], ["host", "inner", "hash", "key", "content"])


def templates(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``host, outer, inner``: the keys that recur across the pages of each host, outside and inside of articles."""
    rows = pages.select(F.col(url), F.col(html)).mapInArrow(_subtrees, "host string, inner boolean, hash long, key long, content long").distinct()
    often = stored(rows.groupBy("host", "inner", "hash", "key").agg(F.count("*").alias("n")), "subtree-counts")
    outer = often.where(~F.col("inner") & (F.col("n") >= LEAST_PAGES))
    # Inside of articles a text of their own may recur; what a site puts there has one place, here and elsewhere.
    inner = often.where("inner")
    everywhere = inner.groupBy("hash", "key").agg(F.sum("n").alias("placed"))
    anywhere = everywhere.where("key = hash").select("hash", F.col("placed").alias("anywhere"))
    inner = inner.where((F.col("n") >= INNER_PAGES) & (F.col("key") != F.col("hash"))).join(everywhere, ["hash", "key"]).join(anywhere, "hash")
    inner = inner.where(F.col("placed") >= SAME_PLACE * F.col("anywhere"))
    often = outer.select("host", "inner", "key").unionByName(inner.select("host", "inner", "key"))
    lists = (F.collect_list(F.when(F.col("inner") == flag, F.col("key"))) for flag in (False, True))
    return often.groupBy("host").agg(*(x.alias(name) for x, name in zip(lists, ("outer", "inner"), strict=True)))


def extract(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` without ``html`` but with the main text in ``out``; a null or empty page has an empty text.

    A null address, or one without a host, belongs to the host of all such. Pages marked
    with ``article`` or ``main`` give what these hold, others all that remains. Depth and
    length are not limited. Other columns and repeated rows stay; ``out`` is replaced.
    """
    others = [c for c in pages.columns if c not in (html, out)]
    hosts = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    plain = pages.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(others)], F.col(html).alias("_html"), hosts.alias("_host"))
    # Written, the lists have a known size: Spark broadcasts them below its threshold, and pages then stay where
    # they are; beyond it, the hosts are shuffled and adaptive execution splits a host of many pages.
    joined = plain.join(stored(templates(pages, url, html), "templates"), F.col("_host") == F.col("host"), "left")
    schema = pages.select(*others).withColumn(out, F.lit("")).schema
    n = len(others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for page, outer, inner in zip(*(b.column(n + k).to_pylist() for k in range(3)), strict=True):
                gone = frozenset([(False, h) for h in outer or ()] + [(True, h) for h in inner or ()])
                texts.append(main_text(parse(page or ""), gone))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(texts, pa.string())], schema.names)

    return joined.select(*[f"_{i}" for i in range(n)], "_html", "outer", "inner").mapInArrow(run, schema)
