"""HTML main-text extraction by wrapper induction.

Pages of a host come from few templates. The pages of a host that have the same frame (the kinds of elements that the
body, or the only box in it, is made of) share a seed, the page of the smallest content hash. Every page's DOM tree, of
block elements, is aligned with its seed by simple tree matching: nodes match if their tag and class agree, and children
align in order so that the number of matched nodes is greatest. Each seed node is a slot, and over all pages of the seed
it is counted how the texts of a slot repeat:

* template: one text on nearly all pages, or texts that recur between pages (a menu, notice or footer drawn from some);
* content: at least CONTENT_PAGES pages, and hardly a text that recurs;
* undecided: too few pages, or in between.

The most frequent text of a slot is not counted as recurring unless it is on nearly all pages, so many copies of one
article do not make an article a template. Extraction aligns a page again: template slots go, and content slots stay
inside and outside of the article or main elements, of which a page may have several. What is undecided stays only inside of
them; on pages that have none the box that holds nearly all text of the content slots stands for them. A page's own marks fill the gaps: elements that are no article by their tag (nav,
footer, aside, script, ...; header outside of an article) go, and forms, adverts, consent boxes and reader comments go whatever
their size and the wrapper's verdict, as their texts may be new on every page; other names of classes, ids and roles
(menu, sidebar, related, ...) count for undecided slots only. A name is telling as a whole: `cookie-notice` is, as all
its parts are, `header-note` and `social-science` are not. The body, an article and a form around all of a page's text are
frames and no such elements. Slots of the region are not taken for template where they would be half of it or more, as is so
on hosts of copies.

Learning sees all pages, each once; a partition sums its own repeats before the shuffle. Wrappers are broadcast while
the seeds are under a checked size, else joined by host and frame. Alignment is exact at any size: long child lists go
through numpy rows in linear space (Hirschberg). Parsing takes time linear in the page, and depth is not limited.

Defined cases: null or empty html gives an empty text; a null url or one without a host belongs to the host ''; repeated
pages count as often as they are; a page without tags is one block; broken, unclosed and nested tags are closed as
browsers would for the common cases, and what an unclosed tag, comment or script swallows is no text; an empty table
gives an empty result; an input column named like the output is replaced.
"""

from __future__ import annotations

import html as html_lib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractloom.llm.common import settle
from tractloom.llm.urls import host_of

MIN_PAGES = 5
CONTENT_PAGES = 12
CONSTANT_SHARE, RECURRING_SHARE, VARYING_SHARE = 0.9, 0.25, 0.08
MAX_BROADCAST_SEED_CHARS = 24_000_000
TABLE_CELLS = 4_000_000  # larger alignments are split in two (exactly) until they fit
TREES, PAIRS = 256, 100_000  # what a task remembers of parsed seeds and matched pairs
# Element kinds of HTML, and what marks an element as not part of the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
BARRIERS = frozenset("ul ol dl table select html body".split())
CROSSING = frozenset("article main section div nav aside footer header form".split())
NOT_ARTICLE = frozenset("nav header footer aside button select input label script style noscript template iframe svg textarea title head dialog menu".split())
ALWAYS_OUT_WORDS = frozenset("ad ads advert adverts advertisement sponsor sponsored promo comment comments disqus cookie cookies consent newsletter subscribe popup modal".split())
NOT_ARTICLE_WORDS = ALWAYS_OUT_WORDS | frozenset("banner sidebar nav navbar navigation menu breadcrumb breadcrumbs header masthead footer notice sharing social related widget toolbar".split())
FILLING_WORDS = frozenset("site global top bottom left right box bar list block area links section container wrapper form thread user reader".split())
NOT_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STOP = re.compile("[>\"']")
DIGITS = re.compile("[0-9]+")
ATTRIBUTE = re.compile(r"""(?:\A|[\s/"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW_END = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in RAW}
BOXES = frozenset("div section td center table tbody tr".split())
REGION_SHARE = 0.8
TEMPLATE, CONTENT = 1, 2
WEAK, STRONG = 1, 2  # marks that a content slot overrules, and marks that nothing does


@lru_cache(4096)
def named_mark(names: str) -> int:
    """What class names and ids say: a name counts if all its parts are known words and one is telling."""
    found = 0
    for name in names.split():
        parts = {p for p in re.split(r"[^a-z]+", name) if p}
        if not NOT_ARTICLE_WORDS.isdisjoint(parts) and parts <= NOT_ARTICLE_WORDS | FILLING_WORDS:
            found = max(found, WEAK if ALWAYS_OUT_WORDS.isdisjoint(parts) else STRONG)
    return found


class Node:
    """An element: `elements` are the block elements below it with no other between, `own` is the text of the rest."""

    __slots__ = ("block", "children", "elements", "key", "marked", "number", "own", "region", "sign", "size", "tag", "text_hash", "words")

    def __init__(self, tag: str, attributes: str) -> None:
        self.tag, self.children = tag, []
        found = {}
        if "=" in attributes:
            for m in ATTRIBUTE.finditer(attributes):
                found.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
        self.key = f"{tag}.{DIGITS.sub('0', found['class'])}" if "class" in found else tag
        mark = named_mark(f"{found.get('class', '')} {found.get('id', '')}") if found else 0
        self.region = tag in ("article", "main") or found.get("role") in ("main", "article")
        if self.region and mark == STRONG and tag != "main":  # an article element for each reader comment
            self.region = False
        self.marked = 0 if self.region or tag == "body" else STRONG if tag == "form" else max(mark, WEAK if found.get("role") in NOT_ARTICLE_ROLES else 0)
        self.block = tag in BLOCKS or self.marked > 0


class Stack:
    """The open elements, with the places of each tag, so that closing never searches."""

    def __init__(self, root: Node) -> None:
        self.open, self.at, self.barriers, self.blocks = [root], {"html": [0]}, [0], [0]

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.open))
        if node.tag in BARRIERS:
            self.barriers.append(len(self.open))
        if node.tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append(node)

    def cut(self, place: int) -> None:
        """Close everything from a place on; the root stays."""
        place = max(place, 1)
        while len(self.open) > place:
            node = self.open.pop()
            self.at[node.tag].pop()
            if node.tag in BARRIERS:
                self.barriers.pop()
            if node.tag in BLOCKS:
                self.blocks.pop()

    def last(self, tag: str) -> int:
        places = self.at.get(tag)
        return places[-1] if places else -1

    def close(self, tag: str) -> None:
        place = self.last(tag)
        if place > 0 and (tag in BARRIERS or tag in CROSSING or place > self.barriers[-1]):
            self.cut(place)

    def make_room(self, tag: str) -> None:
        """Close what the start of this tag closes."""
        if tag == "body":  # what an unclosed head left open ends here
            self.cut(1)
        if tag in BLOCKS:
            p = self.last("p")
            if p > 0 and p >= self.blocks[-1]:
                self.cut(p)
        if tag in CLOSES:
            wall, first = self.barriers[-1], len(self.open)
            for t in CLOSES[tag]:
                for place in reversed(self.at.get(t, ())):
                    if place <= wall:
                        break
                    first = min(first, place)
            self.cut(first)


def tag_end(text: str, at: int, never: dict[str, int]) -> int:
    """Where the tag's > is, quoted values skipped; -1 without one. `never` keeps from where on a mark is not found."""
    while True:
        m = STOP.search(text, at)
        if m is None:
            return -1
        if m[0] == ">":
            return m.start()
        at = m.end()
        if text[max(m.start() - 64, 0) : m.start()].rstrip().endswith("="):
            if never.get(m[0], len(text)) <= at:
                continue  # a quote that is never closed is no quote
            end = text.find(m[0], at)
            if end < 0:
                never[m[0]] = at
                continue
            at = end + 1


def parse(text: str) -> Node:
    """The DOM tree of a page, below a root of its own. Text stays undecoded; raw elements keep no text."""
    root = Node("html", "")
    stack = Stack(root)
    at, n, never = 0, len(text), {}
    while at < n:
        start = text.find("<", at)
        if start < 0:
            stack.open[-1].children.append(text[at:])
            break
        if start > at:
            stack.open[-1].children.append(text[at:start])
        mark = text[start + 1 : start + 2]
        if mark in ("!", "?"):
            comment = text.startswith("<!--", start)
            end = text.find("-->" if comment else ">", start + 2)
            at = n if end < 0 else end + (3 if comment else 1)
            continue
        closing = mark == "/"
        m = NAME.match(text, start + 1 + closing)
        if m is None:  # no tag: the mark itself is text
            stack.open[-1].children.append("<")
            at = start + 1
            continue
        end = tag_end(text, m.end(), never)
        if end < 0:
            break
        at, tag, attributes = end + 1, m[0].lower(), text[m.end() : end]
        if closing:
            if tag not in ("html", "body"):  # what comes after the body belongs to it
                stack.close(tag)
            continue
        if tag == "html":
            continue
        stack.make_room(tag)
        node = Node(tag, attributes)
        stack.open[-1].children.append(node)
        if tag in RAW:
            end = RAW_END[tag].search(text, at)
            at = n if end is None else text.find(">", end.end() - 1) + 1 or n
        elif tag not in VOID and not attributes.endswith("/"):
            stack.push(node)
    finish(root)
    return root


def finish(root: Node) -> None:
    """Block children, own text, signature, size and text hash of every node, from the leaves up."""
    order, stack = [], [root]
    while stack:  # every block element in document order, with its own text and block children
        node = stack.pop()
        node.number = len(order)
        order.append(node)
        node.elements, parts = [], []
        inner = list(reversed(node.children))
        while inner:
            c = inner.pop()
            if type(c) is str:
                parts.append(c)
            elif c.block:
                node.elements.append(c)
                parts.append(" ")
            elif c.tag == "br":
                parts.append(" ")
            elif c.tag not in NOT_ARTICLE:
                inner.extend(reversed(c.children))
        node.own = " ".join("".join(parts).split())
        stack.extend(reversed(node.elements))
    for node in reversed(order):
        node.size = 1 + sum(c.size for c in node.elements)
        node.words = len(node.own) + sum(c.words for c in node.elements)
        node.sign = node.key if not node.elements else xxhash.xxh64_intdigest("\0".join([node.key, *(str(c.sign) for c in node.elements)]))
        own = xxhash.xxh64_intdigest(node.own.encode("utf-8", "surrogatepass")) if node.own else 0
        node.text_hash = own if not node.elements else xxhash.xxh64_intdigest(repr([own, *(c.text_hash for c in node.elements if c.words)])) if node.words else 0


def preorder(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(reversed(node.elements))
    return out


def trimmed(xs: list[Node], ys: list[Node]) -> tuple[int, int, int]:
    """How many equal nodes both lists start with, and the ends of what is left of each before an equal tail."""
    a, x_end, y_end = 0, len(xs), len(ys)
    while a < x_end and a < y_end and xs[a].sign == ys[a].sign:
        a += 1
    while x_end > a and y_end > a and xs[x_end - 1].sign == ys[y_end - 1].sign:
        x_end, y_end = x_end - 1, y_end - 1
    return a, x_end, y_end


def missing_pairs(a: Node, b: Node, known: dict) -> list[tuple[Node, Node]]:
    """The pairs of children whose match sizes are needed for this pair and not known."""
    start, x_end, y_end = trimmed(a.elements, b.elements)
    xs = {x.sign: x for x in a.elements[start:x_end]}.values()
    by_key: dict[str, dict] = {}
    for y in b.elements[start:y_end]:
        by_key.setdefault(y.key, {})[y.sign] = y
    return [(x, y) for x in xs for y in by_key.get(x.key, {}).values() if x.sign != y.sign and (x.sign, y.sign) not in known]


def match_size(a: Node, b: Node, known: dict) -> int:
    """Nodes that simple tree matching pairs below and with a and b; from the leaves up, without recursion."""
    if a.key != b.key:
        return 0
    if a.sign == b.sign:
        return a.size
    stack = [(a, b, False)]
    while stack:
        x, y, ready = stack.pop()
        if (x.sign, y.sign) in known:
            continue
        if ready:
            known[x.sign, y.sign] = 1 + sum(size_of(p, q, known) for p, q in align(x.elements, y.elements, known))
        else:
            stack.append((x, y, True))
            stack.extend((p, q, False) for p, q in missing_pairs(x, y, known))
    return known[a.sign, b.sign]


def size_of(x: Node, y: Node, known: dict) -> int:
    return 0 if x.key != y.key else x.size if x.sign == y.sign else known[x.sign, y.sign]


def align(xs: list[Node], ys: list[Node], known: dict) -> list[tuple[Node, Node]]:
    """Pairs in order with the greatest total match; equal heads and tails are paired at once. Sizes must be known."""
    a, x_end, y_end = trimmed(xs, ys)
    middle_x, middle_y = xs[a:x_end], ys[a:y_end]
    pairs = list(zip(xs[:a], ys[:a], strict=True))
    if middle_x and middle_y:
        signs_x, signs_y = {x.sign: x for x in middle_x}, {y.sign: y for y in middle_y}
        weights = np.array([[size_of(x, y, known) for y in signs_y.values()] for x in signs_x.values()], dtype=np.int64)
        place_x, place_y = {s: i for i, s in enumerate(signs_x)}, {s: i for i, s in enumerate(signs_y)}
        found = best_pairs(np.array([place_x[x.sign] for x in middle_x]), np.array([place_y[y.sign] for y in middle_y]), weights)
        pairs += [(middle_x[i], middle_y[j]) for i, j in found]
    return pairs + list(zip(xs[x_end:], ys[y_end:], strict=True))


def scores(xs: np.ndarray, ys: np.ndarray, weights: np.ndarray, keep: bool = False) -> np.ndarray:
    """The last row (all rows if keep) of the table of best totals of beginnings of xs with beginnings of ys."""
    row = np.zeros(len(ys) + 1, dtype=np.int64)
    rows = [row] if keep else None
    for x in xs:
        w = weights[x][ys]
        new = np.maximum(row[1:], np.where(w > 0, w + row[:-1], 0))
        row = np.concatenate(([0], np.maximum.accumulate(new)))
        if keep:
            rows.append(row)
    return np.array(rows) if keep else row


def best_pairs(xs: np.ndarray, ys: np.ndarray, weights: np.ndarray) -> list[tuple[int, int]]:
    """Places (i, j) in order of the greatest total weight; lists too long for a table are halved exactly."""
    out, todo = [], [(0, len(xs), 0, len(ys))]
    while todo:
        a, b, c, d = todo.pop()
        if a == b or c == d:
            continue
        if b - a > 1 and (b - a) * (d - c) > TABLE_CELLS:
            half = (a + b) // 2
            ahead = scores(xs[a:half], ys[c:d], weights) + scores(xs[half:b][::-1], ys[c:d][::-1], weights)[::-1]
            cut = c + int(np.argmax(ahead))
            todo += [(half, b, cut, d), (a, half, c, cut)]
            continue
        table = scores(xs[a:b], ys[c:d], weights, keep=True)
        i, j, found = b - a, d - c, []
        while i and j:
            if table[i, j] == table[i - 1, j]:
                i -= 1
            elif table[i, j] == table[i, j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((a + i, c + j))
        out += reversed(found)
    return out


def matched(page: Node, seed: Node, known: dict) -> list[tuple[Node, Node]]:
    """All pairs (page node, seed node) of the simple tree matching of two trees."""
    if len(known) > PAIRS:
        known.clear()
    if page.sign != seed.sign:
        match_size(page, seed, known)
    out, stack = [], [(page, seed)]
    while stack:
        x, y = stack.pop()
        out.append((x, y))
        if x.elements and y.elements:
            stack.extend(zip(x.elements, y.elements, strict=True) if x.sign == y.sign else align_known(x, y, known))
    return out


def align_known(x: Node, y: Node, known: dict) -> list[tuple[Node, Node]]:
    """align() of the children, after what it needs was made sure of."""
    for p, q in missing_pairs(x, y, known):
        match_size(p, q, known)
    return align(x.elements, y.elements, known)


def body_of(root: Node) -> Node:
    return next((c for c in root.elements if c.tag == "body"), root)


def frame(root: Node) -> str:
    """The kinds of elements of the body, or of the only element that holds all its text, as one text."""
    node = body_of(root)
    while len(node.elements) == 1 and node.elements[0].words == node.words and node.elements[0].elements and not node.elements[0].region:
        node = node.elements[0]
    return " ".join(sorted({c.key for c in node.elements if c.words}))


def regions_of(root: Node) -> list[Node]:
    """The outermost article elements, in place of a main around them that main, none inside what its tag or a name calls no
    article; without any the body, else all."""
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag in NOT_ARTICLE or counts(node, root):
            continue
        if node.region:
            found.append(node)
            continue
        stack.extend(reversed(node.elements))
    out = []
    for f in found:
        inner = []
        if f.tag == "main":
            below = list(reversed(f.elements))
            while below:
                c = below.pop()
                if c.region and c.tag != "main":
                    inner.append(c)
                elif c.tag not in NOT_ARTICLE and not c.marked:
                    below.extend(reversed(c.elements))
        out += inner or [f]
    return out or [body_of(root)]


def counts(node: Node, root: Node) -> bool:
    """Whether a mark holds: a form around all text is the page's frame, and a weak name is not believed of most of a page."""
    if node.tag == "form" and node.words == root.words:
        return False
    return node.marked == STRONG or (node.marked == WEAK and 2 * node.words <= root.words)


def blocks(root: Node, verdicts: dict[int, int], found: Node | None = None) -> list[str]:
    """Texts of the blocks of a page in order, by the verdicts on its nodes (number: TEMPLATE or CONTENT) and its marks.

    found: what the wrapper takes for the article, on a page without article elements.
    """
    nodes = preorder(root)
    regions = regions_of(root) if found is None else [found]
    heads, inside = {x.number for x in regions}, {x.number for r in regions for x in preorder(r)}
    content = [verdicts.get(x.number) == CONTENT and not x.elements for x in nodes]
    out: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = " ".join(html_lib.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append(text)

    stack: list = [(root, False, 0)]  # a node or text, whether its text stays, the strongest mark about it
    while stack:
        x, keep, marked = stack.pop()
        if type(x) is str:
            if keep:
                parts.append(x)
            continue
        if x is None:
            flush()
            continue
        if x.tag == "br":
            parts.append(" ")
        own_header = x.tag == "header" and x.number in inside and x.number not in heads if x.block else False
        if (x.tag in NOT_ARTICLE and not own_header) or (x.block and verdicts.get(x.number) == TEMPLATE):
            if x.tag in BLOCKS:
                flush()
            continue
        if x.block:
            if x.tag in BLOCKS:
                flush()
                stack.append((None, False, 0))
            if x.number not in heads and counts(x, root):
                marked = max(marked, x.marked)
            keep = marked < STRONG and (content[x.number] or (not marked and x.number in inside))
        stack.extend((c, keep, marked) for c in reversed(x.children))
    flush()
    return out


class Wrapper:
    """A seed tree and the verdicts on its nodes."""

    def __init__(self, seed: str, template: list[int], content: list[int]) -> None:
        self.tree, self.known = parse(seed), {}
        fixed = set(template)
        for region in regions_of(self.tree):
            below, stack = 0, [region]
            while stack:  # the text of the region's template, each node's once
                x = stack.pop()
                if x.number in fixed:
                    below += x.words
                else:
                    stack.extend(x.elements)
            if 2 * below >= region.words:
                fixed -= {x.number for x in preorder(region)}
            fixed -= {x.number for x in preorder(self.tree) if x.number <= region.number < x.number + x.size}  # what holds the region
        self.verdicts = dict.fromkeys(content, CONTENT) | dict.fromkeys(fixed, TEMPLATE)
        self.region = self.container()

    def container(self) -> int | None:
        """The seed's number for the box that holds nearly all of its content slots' text, if it has no article element."""
        body = body_of(self.tree)
        if regions_of(self.tree) != [body]:
            return None
        held: dict[int, int] = {}
        for x in reversed(preorder(self.tree)):  # children before parents
            own = x.words if self.verdicts.get(x.number) == CONTENT and not x.elements else 0
            held[x.number] = own + sum(held[c.number] for c in x.elements)
        node = body
        while node.elements and held[node.number]:
            most = max(node.elements, key=lambda c: held[c.number])
            if most.tag not in BOXES or not most.elements or held[most.number] < REGION_SHARE * held[body.number]:
                break
            node = most
        return None if node is body else node.number

    def extract(self, tree: Node) -> str:
        verdicts, found = {}, None
        if self.verdicts:
            pairs = matched(tree, self.tree, self.known)
            verdicts = {x.number: self.verdicts[y.number] for x, y in pairs if y.number in self.verdicts}
            if self.region is not None and regions_of(tree) == [body_of(tree)]:
                found = next((x for x, y in pairs if y.number == self.region), None)
        return "\n".join(blocks(tree, verdicts, found))


def plain(tree: Node) -> str:
    """Extraction by the page's own marks alone."""
    return "\n".join(blocks(tree, {}))


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def cached(made: dict, key, make):
    if key not in made:
        if len(made) >= TREES:
            made.clear()
        made[key] = make()
    return made[key]


def kept(seeds: DataFrame):
    """Whether the seeds are small enough for a broadcast."""
    return (seeds.agg(F.sum(F.length("seed") + 100)).first()[0] or 0) <= MAX_BROADCAST_SEED_CHARS


def frame_column(html: Column) -> Column:
    @F.arrow_udf("string")
    def of(htmls: pa.Array) -> pa.Array:
        return pa.array([frame(parse(t.as_py() or "")) for t in htmls], type=pa.string())

    return of(html)


def induce_wrappers(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """host, frame, n_pages, seed, template and content (numbers of the seed's block elements in preorder)."""
    read = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html")).where("html <> ''")
    least = F.min_by("html", F.struct(F.xxhash64("html"), "html"))
    seeds = settle(read.withColumn("frame", frame_column(F.col("html"))).groupBy("host", "frame").agg(least.alias("seed"), F.count("*").alias("n_pages")).withColumn("slot", F.xxhash64("host", "frame")))
    small = kept(seeds)
    held = pages.sparkSession.sparkContext.broadcast({(r.host, r.frame): (r.slot, r.seed) for r in seeds.select("host", "frame", "slot", "seed").collect()}) if small else None
    source = read if small else read.withColumn("frame", frame_column(F.col("html"))).join(seeds.select("host", "frame", "slot", "seed"), ["host", "frame"]).select("host", "html", "slot", "seed")

    def rows(tally: dict):
        items = list(tally.items())
        for a in range(0, len(items), 50_000):
            part = items[a : a + 50_000]
            columns = [[k[0] for k, _ in part], [k[1] for k, _ in part], [k[2] for k, _ in part], [n for _, n in part]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["slot", "node", "text", "n"])

    def learn(batches):
        tally: dict[tuple, int] = {}
        trees: dict = {}
        for b in batches:
            for i in range(b.num_rows):
                tree = parse(b.column(1)[i].as_py())
                slot, seed = held.value[b.column(0)[i].as_py(), frame(tree)] if held is not None else (b.column(2)[i].as_py(), b.column(3)[i].as_py())
                seed_tree, known = cached(trees, slot, lambda s=seed: (parse(s), {}))
                for x, y in matched(tree, seed_tree, known):
                    if x.words:
                        k = (slot, y.number, x.text_hash >> 1)
                        tally[k] = tally.get(k, 0) + 1
                if len(tally) > 200_000:
                    yield from rows(tally)
                    tally.clear()
        yield from rows(tally)

    texts = source.mapInArrow(learn, "slot bigint, node int, text bigint, n bigint").groupBy("slot", "node", "text").agg(F.sum("n").alias("n"))
    seen = texts.groupBy("slot", "node").agg(F.sum("n").alias("n"), F.max("n").alias("top"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once"))
    rest, recurring = F.col("n") - F.col("top"), F.col("n") - F.greatest("once", F.lit(0)) - F.when(F.col("top") > 1, F.col("top")).otherwise(0)
    share = F.when(rest > 0, recurring / rest).otherwise(0.0)
    constant = (F.col("n") >= MIN_PAGES) & (F.col("top") >= CONSTANT_SHARE * F.col("n"))
    drawn = (recurring >= MIN_PAGES) & (share >= RECURRING_SHARE)
    varying = (rest >= CONTENT_PAGES) & (share <= VARYING_SHARE) & ~constant
    verdict = F.when(constant | drawn, TEMPLATE).when(varying, CONTENT)
    judged = seen.select("slot", "node", verdict.alias("v")).where("v is not null").groupBy("slot").agg(
        F.sort_array(F.collect_list(F.when(F.col("v") == TEMPLATE, F.col("node")))).alias("template"), F.sort_array(F.collect_list(F.when(F.col("v") == CONTENT, F.col("node")))).alias("content")
    )  # at most one entry for each element of the seed
    none = F.array().cast("array<int>")
    return settle(seeds.join(judged, "slot", "left").select("host", "frame", "n_pages", "seed", F.coalesce("template", none).alias("template"), F.coalesce("content", none).alias("content")))


def extract(pages: DataFrame, wrappers: DataFrame, *, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """pages with `out`, the main text of each."""
    if kept(wrappers):
        held = pages.sparkSession.sparkContext.broadcast({(r.host, r.frame): (r.seed, r.template, r.content) for r in wrappers.select("host", "frame", "seed", "template", "content").collect()})
        made: dict = {}

        @F.arrow_udf("string")
        def by_host(hosts: pa.Array, texts: pa.Array) -> pa.Array:
            result = []
            for h, t in zip(hosts.to_pylist(), texts, strict=True):
                tree = parse(t.as_py() or "")
                key = (h, frame(tree))
                result.append(cached(made, key, lambda k=key: Wrapper(*held.value[k])).extract(tree) if key in held.value else plain(tree))
            return pa.array(result, type=pa.string())

        return pages.withColumn(out, by_host(host_of(F.col(url)), F.col(html)))
    known: dict = {}

    @F.arrow_udf("string")
    def by_row(hosts: pa.Array, frames: pa.Array, texts: pa.Array, seeds: pa.Array, templates: pa.Array, contents: pa.Array) -> pa.Array:
        result = []
        for i, t in enumerate(texts):
            tree = parse(t.as_py() or "")
            if seeds[i].is_valid:
                wrapper = cached(known, (hosts[i].as_py(), frames[i].as_py()), lambda i=i: Wrapper(seeds[i].as_py(), templates[i].as_py(), contents[i].as_py()))
                result.append(wrapper.extract(tree))
            else:
                result.append(plain(tree))
        return pa.array(result, type=pa.string())

    w = wrappers.select(*[F.col(c).alias(f"__{c}") for c in ("host", "frame", "seed", "template", "content")])
    named = pages.withColumn("__h", host_of(F.col(url))).withColumn("__f", frame_column(F.col(html)))
    joined = named.join(w, (F.col("__h") == F.col("__host")) & (F.col("__f") == F.col("__frame")), "left")
    return joined.withColumn(out, by_row("__h", "__f", html, "__seed", "__template", "__content")).drop("__h", "__f", "__host", "__frame", "__seed", "__template", "__content")
