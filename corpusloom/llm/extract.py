"""Main text of web pages by wrapper induction.

Pages of one host come from one template, or a few.  For every host up to ``KINDS`` reference pages are chosen
(of its most frequent shapes, the page with the smallest hash), every other page goes with the reference most like
it, and its DOM tree is aligned with the reference tree by simple tree
matching: the largest set of node pairs that keeps ancestors and sibling order, found by dynamic programming
over the children of matched nodes.  A node of the reference whose own text comes back unchanged on at least
``CONSTANT`` of the other pages that go with it, and on at least ``MIN_PAGES`` of them, is template; a node whose text
varies, or that a page has beyond the reference, is a slot, and slots are content.  Pages equal to the
reference say nothing and are not counted.

What varies is content, inside of ``article`` and ``main`` and outside of them.  Markup is evidence beside it: regions
that it calls navigation, headers, footers, sidebars, notices, adverts, forms or comments of readers are left out also
where they vary, unless they hold the only article or, by a class or id word alone, the bulk of what varies; pages
without a template are cut to their ``main`` or ``article``.  And not every part that stays is template: where it
would be most of a page's article, the pages are copies.

Statistics cover all pages of all hosts and are added up before they are shuffled; a host that holds a third
of all pages is only ever a key of partial sums.  The reference pages and their constant nodes of each host
travel to the tasks: by broadcast while they are below ``BROADCAST_BYTES``, else by a join on the host in
which hot hosts are split.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.skew import skew_join
from corpusloom.llm.common import materialize, slices

CONSTANT = 0.9
MIN_PAGES = 5
BROADCAST_BYTES = 32 << 20
# Pages whose constant text is so many times the rest are copies; in a marked article, once is enough.
COPY_SHARE = 4
# Reference pages of a host at most, and pages of a host for each of them that its shape does not have itself.
KINDS, KIND_PAGES = 4, 50
# Cells of the table that aligns the children of two nodes; larger ones are halved first.
MAX_CELLS = 40_000

# Elements without an end tag, elements whose content is not markup, and elements that end an
# open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split()
)
ENDS_P = BLOCK - {"br", "body", "html", "legend", "td", "th", "tr", "tbody", "thead", "tfoot"}
# Elements that an element of the same group ends when it begins.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Elements that show no text of the page, elements that by themselves are not the article, and words in
# class, id or role that mark such regions.  Words, and a form, may also stand on a wrapper of the whole page.
HIDDEN = frozenset("head script style noscript template iframe object svg canvas button select input textarea".split())
NEVER = frozenset("nav header footer aside dialog menu".split())
WORD, SURE = 1, 2
MARK = re.compile(
    r"ads?|advert\w*|banner|promo\w*|sponsor\w*|nav\w*|menu\w*|breadcrumbs?|header|masthead|footer|sidebar|side|aside|related|recommend\w*|"
    r"share|sharing|social|cookies?|consent|gdpr|notices?|alert|popup|modal|newsletter|subscri\w*|signup|login|search|form|comments?|replies|"
    r"respond|disqus|discussion|toolbar|pagination|pager|copyright|legal|complementary|contentinfo|navigation"
)
# Words that only say where or what kind of box a region is; they may stand beside a marking word.
LAYOUT = frozenset(
    "area bar block bottom box buttons col column container content global group inner items left links list local main page "
    "panel post primary reader readers right row secondary section site slot top unit user users widget widgets wrap wrapper".split()
)


def marks(value: str) -> bool:
    """Whether a class, id or role marks a region: some whole name in it is made of marking words and layout words
    alone.  ``cookie-notice`` and ``site-header`` do, ``share-price`` and ``no-sidebar`` do not."""
    for name in value.split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if any(MARK.fullmatch(w) for w in words) and all(w in LAYOUT or MARK.fullmatch(w) for w in words):
            return True
    return False


# In a tag, quotes have a meaning only after an equals sign.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*>?|"
    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?)*)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_SPACE = re.compile(r"\s+")


class Node:
    """An element: its tag, whether it shows no text, how surely its markup says it is not the article (0, WORD or
    SURE), and its children and texts in order."""

    __slots__ = ("tag", "hidden", "mark", "parts", "label", "shape", "size")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.parts = tag, []
        self.hidden = tag in HIDDEN
        self.mark = SURE if tag in NEVER else WORD if tag == "form" else 0
        self.label = tag
        if attributes and ("=" in attributes or "hidden" in attributes):
            for name, *value in _ATTRIBUTE.findall(attributes):
                name, value = name.lower(), "".join(value).lower()
                if name == "hidden" or (name == "aria-hidden" and value == "true"):
                    self.hidden = True
                elif name in ("class", "id", "role"):
                    if name == "class":
                        self.label = f"{tag}.{value}"
                    if marks(value) and tag not in ("body", "html", "main", "article"):
                        self.mark = max(self.mark, SURE if name == "role" else WORD)

    def children(self) -> list[Node]:
        return [p for p in self.parts if isinstance(p, Node)]


def parse(page: str) -> Node:
    """A tolerant DOM: unknown ends are ignored, open elements end where their parent or a sibling demands."""
    root = Node("#root")
    stack = [root]
    at = 0
    n = len(page)
    while at < n:
        m = _MARKUP.search(page, at)
        if not m:
            stack[-1].parts.append(page[at:])
            break
        if m.start() > at:
            stack[-1].parts.append(page[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            if m[1]:
                stack[-1].parts.append(html.escape(m[1], quote=False))
            continue
        tag = tag.lower()
        if m[2]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                # A stray inline end never closes blocks around it.
                if stack[k].tag in BLOCK and tag not in BLOCK:
                    break
            continue
        if tag in ENDS_P:
            _close(stack, {"p"}, BLOCK - {"p"})
        if tag in SIBLINGS:
            _close(stack, SIBLINGS[tag], {"ul", "ol", "menu", "dl", "table", "select", "#root"})
        node = Node(tag, m[4])
        stack[-1].parts.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*[^>]*>", re.I).search(page, at)
            node.parts.append(page[at : end.start() if end else n])
            at = end.end() if end else n
        elif tag not in VOID and not m[4].rstrip().endswith("/"):
            stack.append(node)
    measure(root)
    return root


def _close(stack: list[Node], tags: set[str], stop: frozenset[str] | set[str]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in stop:
            return


def own_text(node: Node) -> str:
    """The texts that stand directly in a node, with single spaces."""
    return _SPACE.sub(" ", html.unescape(" ".join(p for p in node.parts if isinstance(p, str)))).strip()


def measure(root: Node) -> None:
    """Give every node its ``size`` (nodes of its subtree) and ``shape`` (equal for subtrees of equal labels)."""
    order = [root]
    for node in order:
        order += node.children()
    for node in reversed(order):
        inner = node.children()
        node.size = 1 + sum(c.size for c in inner)
        node.shape = hash((node.label, *(c.shape for c in inner)))


def _ends(left: list[Node], right: list[Node]) -> tuple[int, int]:
    """How many first and last subtrees of two lists have equal shapes; to pair these is always best."""
    most = min(len(left), len(right))
    lo = 0
    while lo < most and left[lo].shape == right[lo].shape:
        lo += 1
    hi = 0
    while hi < most - lo and left[-1 - hi].shape == right[-1 - hi].shape:
        hi += 1
    return lo, hi


class Matcher:
    """Simple tree matching: the largest number of node pairs of two trees that keep labels, ancestors and sibling
    order, for every two subtrees that are asked for; each pair of shapes is worked out once."""

    def __init__(self):
        self.known: dict[tuple[int, int], int] = {}

    def weight(self, a: Node, b: Node) -> int:
        """Pairs of the subtrees of two nodes, 0 where their labels differ.  Deep trees need no deep recursion."""
        if a.label != b.label:
            return 0
        value = self._at_hand(a, b)
        todo = [] if value is not None else [self._work(a, b)]
        while todo:
            try:
                pair = todo[-1].send(value)
                value = self._at_hand(*pair)
                if value is None:
                    todo.append(self._work(*pair))
            except StopIteration as done:
                todo.pop()
                value = done.value
        return value

    def _at_hand(self, a: Node, b: Node) -> int | None:
        if a.shape == b.shape:
            return a.size
        if a.size == 1 or b.size == 1:
            return 1
        return self.known.get((a.shape, b.shape))

    def _work(self, a: Node, b: Node):
        """Asks for the weights of pairs of children as it goes; two rows of the alignment's table are kept."""
        left, right = a.children(), b.children()
        lo, hi = _ends(left, right)
        total = 1 + sum(c.size for c in left[:lo]) + sum(c.size for c in left[len(left) - hi :])
        right = right[lo : len(right) - hi]
        row = [0] * (len(right) + 1)
        for p in left[lo : len(left) - hi]:
            new = [0]
            for j, q in enumerate(right):
                best = row[j + 1] if row[j + 1] > new[j] else new[j]
                if p.label == q.label:
                    w = self._at_hand(p, q)
                    if w is None:
                        w = yield p, q
                    best = max(best, row[j] + w)
                new.append(best)
            row = new
        self.known[a.shape, b.shape] = total + row[-1]
        return total + row[-1]

    def align(self, left: list[Node], right: list[Node]) -> list[tuple[Node, Node]]:
        """The pairs of children in a best alignment."""
        if not left or not right:
            return []
        if len(left) > 1 and len(left) * len(right) > MAX_CELLS:
            # The same best alignment in linear memory (Hirschberg): halves of one side meet where their sum is greatest.
            mid = len(left) // 2
            cut = int(np.argmax(self.scores(left[:mid], right) + self.scores(left[mid:][::-1], right[::-1])[::-1]))
            return self.align(left[:mid], right[:cut]) + self.align(left[mid:], right[cut:])
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        weight = {}
        for i, p in enumerate(left, 1):
            for j, q in enumerate(right, 1):
                up = max(best[i - 1][j], best[i][j - 1])
                if p.label == q.label:
                    w = weight[i, j] = self.weight(p, q)
                    up = max(up, best[i - 1][j - 1] + w)
                best[i][j] = up
        out, i, j = [], len(left), len(right)
        while i and j:
            if (i, j) in weight and best[i][j] == best[i - 1][j - 1] + weight[i, j]:
                out.append((left[i - 1], right[j - 1]))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return out[::-1]

    def scores(self, left: list[Node], right: list[Node]) -> np.ndarray:
        """The weight of the best alignment of ``left`` with every head of ``right``."""
        kinds: dict[int, int] = {}
        of = np.array([kinds.setdefault(q.shape, len(kinds)) for q in right], np.int64)
        some = {q.shape: q for q in right}
        best = np.zeros(len(right) + 1, np.int64)
        known: dict[int, np.ndarray] = {}
        for p in left:
            if p.shape not in known:
                if len(known) * len(kinds) > MAX_CELLS:
                    known.clear()
                known[p.shape] = np.array([self.weight(p, some[s]) for s in kinds], np.int64)
            best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + known[p.shape][of]))
        return best


def match(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """Simple tree matching: the pairs of nodes of a largest matching of two trees with equal roots, top down.

    Children are aligned in order so that the sum of the matchings of their subtrees is greatest.  First and last
    subtrees of equal shape are paired at once, which is never worse; both trees must have been measured.
    """
    matcher = Matcher()
    pairs = [(a, b)]
    for x, y in pairs:
        left, right = x.children(), y.children()
        if left and right:
            lo, hi = _ends(left, right)
            pairs += zip(left[:lo], right[:lo])
            pairs += matcher.align(left[lo : len(left) - hi], right[lo : len(right) - hi])
            pairs += zip(left[len(left) - hi :], right[len(right) - hi :])
    return pairs


def edges(root: Node) -> set[tuple[str, str]]:
    """The pairs of labels of a node and its parent."""
    out, todo = set(), [root]
    while todo:
        node = todo.pop()
        inner = node.children()
        out.update((node.label, c.label) for c in inner)
        todo += inner
    return out


class References:
    """Parsed reference pages of hosts."""

    def __init__(self):
        self.known: dict[tuple[str, int], tuple[Node, dict[int, int], set]] = {}

    def closest(self, host: str, pages: list[str], tree: Node) -> tuple[int, Node, dict[int, int]]:
        """Number, tree and node numbers of the host's reference whose edges are most like the tree's."""
        for k, page in enumerate(pages):
            if (host, k) not in self.known:
                root = parse(page)
                self.known[host, k] = root, numbered(root), edges(root)
        best = 0
        if len(pages) > 1:
            mine = edges(tree)
            like = [len(mine & e) / max(len(mine | e), 1) for e in (self.known[host, k][2] for k in range(len(pages)))]
            best = like.index(max(like))
        root, number, _ = self.known[host, best]
        return best, root, number


def numbered(root: Node) -> dict[int, int]:
    """The number of every node (by identity) in document order."""
    out: dict[int, int] = {}
    todo = [root]
    while todo:
        node = todo.pop()
        out[id(node)] = len(out)
        todo += reversed(node.children())
    return out


def content(root: Node, template: set[int]) -> str:
    """Texts of all nodes that are not template, block by block, in page order.

    ``template`` holds identities of nodes whose own text is constant on the host.  White space inside a block
    is one space; blocks are joined by one space.  With a template, what varies is content, wherever it stands,
    besides marked regions (see ``_removed``).  Without one, only the page's ``main`` or ``article`` is looked
    at where it holds a fair share of the text.  A template that is most of an article is a copy of it.
    """
    removed = _removed(root, template)
    if not template:
        return _flat(_regions(root, removed), template, removed)[0]
    text, dropped = _flat([root], template, removed)
    if dropped:
        regions = _regions(root, removed)
        inside, lost = _flat(regions, template, removed) if regions != [root] else ("", 0)
        if lost > len(inside) or dropped > len(text) * COPY_SHARE:
            return content(root, set())
    return text


def _flat(regions: list[Node], template: set[int], removed: set[int]) -> tuple[str, int]:
    kept, dropped = _texts(regions, template, removed)
    return _SPACE.sub(" ", kept).strip(), dropped


def _topmost(nodes: list[Node], wanted, removed: set[int]) -> list[Node]:
    """The outermost shown nodes below some, in page order, for which ``wanted`` holds."""
    out, todo = [], [c for n in reversed(nodes) for c in reversed(n.children())]
    while todo:
        node = todo.pop()
        if node.hidden or id(node) in removed:
            continue
        if wanted(node):
            out.append(node)
        else:
            todo += reversed(node.children())
    return out


def _regions(root: Node, removed: set[int]) -> list[Node]:
    """The page's main and in it the articles, each as far as it holds a fair share of the text around it."""
    scope = [root]
    for tag in ("main", "article"):
        inner = _topmost(scope, lambda n: n.tag == tag, removed)
        if inner and len(_flat(inner, set(), removed)[0]) * COPY_SHARE >= len(_flat(scope, set(), removed)[0]):
            scope = inner
    return scope


def _removed(root: Node, template: set[int]) -> set[int]:
    """Marked elements that are left out, whatever stands in them.

    What the markup says is not believed of an element that holds the page's only article or main and no less
    varying text than is left outside, nor, where only a word says it, of one that holds the bulk of the page's
    varying text: more than ``COPY_SHARE`` times the rest, or with a template and no article or main more than the rest.
    Marks inside of such an element are judged by themselves.
    """
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        if not node.hidden:
            order.append(node)
            todo += node.children()
    if not any(n.mark for n in order):
        return set()
    # Of each node: varying characters, those outside of marks, and if an article or main is in it, outside of marks.
    total: dict[int, int] = {}
    bare: dict[int, int] = {}
    holds: dict[int, bool] = {}
    shows: dict[int, bool] = {}
    for node in reversed(order):
        me = id(node)
        t = o = 0 if me in template else len(own_text(node))
        h = s = node.tag in ("article", "main")
        for c in node.children():
            if not c.hidden:
                t, h = t + total[id(c)], h or holds[id(c)]
                if not c.mark:
                    o, s = o + bare[id(c)], s or shows[id(c)]
        total[me], bare[me], holds[me], shows[me] = t, o, h, s
    outside, shown = bare[id(root)], shows[id(root)]
    share = 1 if template and not shown else COPY_SHARE
    out: set[int] = set()
    queue = _topmost([root], lambda n: n.mark, out)
    while queue:
        node = max(queue, key=lambda n: total[id(n)])
        queue.remove(node)
        t = total[id(node)]
        if t and (node.mark == WORD and t > share * outside or holds[id(node)] and not shown and t >= outside):
            outside, shown = outside + bare[id(node)], shown or shows[id(node)]
            queue += _topmost([node], lambda n: n.mark, out)
        else:
            out.add(id(node))
    return out


def _texts(regions: list[Node], template: set[int], removed: set[int]) -> tuple[str, int]:
    """The texts of regions without removed elements and template nodes, with a space where blocks begin and end, and how many
    characters of template there were."""
    words: list[str] = []
    dropped = 0
    todo: list[tuple[Node, int]] = [(r, 0) for r in reversed(regions)]
    while todo:
        node, k = todo.pop()
        if k == 0:
            if node.hidden or id(node) in removed:
                continue
            if node.tag in BLOCK:
                words.append(" ")
            if id(node) in template:
                dropped += len(own_text(node))
        own = id(node) not in template
        parts = node.parts
        while k < len(parts):
            part = parts[k]
            k += 1
            if isinstance(part, str):
                if own:
                    words.append(html.unescape(part) if "&" in part else part)
            else:
                todo.append((node, k))
                todo.append((part, 0))
                break
        else:
            if node.tag in BLOCK:
                words.append(" ")
    return "".join(words), dropped


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """On how many pages nodes of their reference have its own text; node -1 counts the pages that were compared."""
    pages: Counter = Counter()
    same: Counter = Counter()
    for piece in slices(batches, "html"):
        known = References()
        for host, page, refs in zip(*(piece.column(c).to_pylist() for c in ("host", "html", "refs"))):
            if page in refs:
                continue
            tree = parse(page)
            kind, root, number = known.closest(host, refs, tree)
            pages[host, kind, -1] += 1
            for a, b in match(root, tree):
                text = own_text(a)
                if text and text == own_text(b):
                    same[host, kind, number[id(a)]] += 1
    if pages:
        total = pages + same
        cols = [*zip(*total), list(total.values())]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["host", "kind", "node", "pages"])


def _extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, "html"):
        known = References()
        out = []
        for host, page, refs, constant in zip(*(piece.column(c).to_pylist() for c in ("host", "html", "refs", "constant"))):
            tree = parse(page or "")
            template: set[int] = set()
            if constant:
                kind, root, number = known.closest(host, refs, tree)
                fixed = {n for c in constant if c["kind"] == kind for n in c["nodes"]}
                if fixed:
                    template = {id(b) for a, b in match(root, tree) if number[id(a)] in fixed and own_text(a) == own_text(b)}
            out.append(content(tree, template))
        yield pa.RecordBatch.from_arrays([piece.column("page_id"), piece.column("url"), pa.array(out, pa.string())], names=["page_id", "url", "text"])


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def shape_of(page: Column) -> Column:
    """A hash of the tags and classes that a page has."""
    tags = F.regexp_extract_all(page, F.lit(r"<([A-Za-z][^\s/>]*)"), F.lit(1))
    classes = F.regexp_extract_all(page, F.lit(r"""\bclass\s*=\s*["']?([^"'>]*)"""), F.lit(1))
    return F.xxhash64(F.array_sort(F.array_distinct(tags)), F.array_sort(F.array_distinct(classes)))


def _by_host(pages: DataFrame, hosts: DataFrame, spread: list[str], how: str) -> DataFrame:
    """Give every page what ``hosts`` (host, n_pages, refs, ...) knows of its host."""
    size = F.aggregate("refs", F.lit(0).cast("long"), lambda a, r: a + F.octet_length(r))
    if (hosts.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES:
        return pages.join(F.broadcast(hosts), "host", how)
    return skew_join(pages, hosts, ["host"], "n_pages", spread, how=how)


def references(pages: DataFrame, min_pages: int) -> DataFrame:
    """(host, n_pages, refs): the reference pages of every host, the page of smallest hash of each of its most
    frequent shapes; besides the first, of shapes with more than ``min_pages`` pages or on hosts with many."""
    shapes = pages.groupBy("host", shape_of(F.col("html")).alias("shape")).agg(F.count(F.lit(1)).alias("n"), F.min(F.xxhash64("html")).alias("hash"))
    shapes = materialize(shapes, "shapes")
    sizes = shapes.groupBy("host").agg(F.sum("n").alias("n_pages"))
    # The rank is cut to KINDS before hosts are gathered.
    order = Window.partitionBy("host").orderBy(F.col("n").desc(), "shape")
    top = shapes.withColumn("kind", F.row_number().over(order)).where(F.col("kind") <= KINDS).join(sizes, "host")
    top = top.where((F.col("kind") == 1) | (F.col("n") > min_pages) | (F.col("n_pages") >= KIND_PAGES * F.col("kind")))
    top = materialize(top.select("host", "hash", "kind", "n_pages"), "kinds")
    found = pages.withColumn("hash", F.xxhash64("html")).join(top, ["host", "hash"])
    found = found.groupBy("host", "kind", "n_pages").agg(F.min("html").alias("html"))
    refs = F.transform(F.array_sort(F.collect_list(F.struct("kind", "html"))), lambda r: r["html"])
    return materialize(found.groupBy("host", "n_pages").agg(refs.alias("refs")), "hosts")


def wrappers(pages: DataFrame, constant: float = CONSTANT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, n_pages, refs, constant): for every host its reference pages and the numbers of their constant
    nodes, counted on the pages that are closest to each; pages without html neither count nor serve."""
    some = pages.where(F.length("html") > 0).select(host_of(F.col("url")).alias("host"), "html")
    hosts = references(some, min_pages)
    both = _by_host(some, hosts.where(F.col("n_pages") > min_pages), ["html"], "inner")
    sums = both.select("host", "html", "refs").mapInArrow(_sums, "host string, kind int, node int, pages long")
    sums = materialize(sums.groupBy("host", "kind", "node").agg(F.sum("pages").alias("pages")), "nodes")
    compared = sums.where("node = -1").select("host", "kind", F.col("pages").alias("compared"))
    fixed = sums.where("node >= 0").join(compared, ["host", "kind"]).where(
        (F.col("pages") >= min_pages) & (F.col("pages") >= constant * F.col("compared"))
    )
    nodes = fixed.groupBy("host", "kind").agg(F.collect_list("node").alias("nodes"))
    nodes = nodes.groupBy("host").agg(F.collect_list(F.struct("kind", "nodes")).alias("constant"))
    return materialize(hosts.join(nodes, "host", "left"), "wrappers")


def main_text(pages: DataFrame, constant: float = CONSTANT, min_pages: int = MIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    A null or empty html gives an empty text.  A host with fewer than ``min_pages`` pages, and a null or odd
    url (host ""), has only the marked regions removed, besides what repeats on its pages if they are enough.
    Rows that repeat are extracted alike; nothing is dropped or capped; extra columns are ignored.
    """
    known = wrappers(pages, constant, min_pages)
    keyed = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    # Hosts without any html have no wrapper but keep their pages.
    joined = _by_host(keyed, known, ["page_id", "url"], "left")
    out = joined.select("page_id", "url", "html", "host", "refs", "constant").mapInArrow(_extractor, "page_id long, url string, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
