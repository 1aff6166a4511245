"""Main text of web pages by wrapper induction over aligned page trees.

Each page is parsed once into the tree of what can be its article; neighbouring leaves of
one label are one node. Pages of a host with equal trees form a layout. The layout most
pages have is the centre of its host, and every other layout is aligned with it by simple
tree matching: equal labels at the roots, then the order-preserving matching of children
with the most matched nodes, all the way down. A matched node takes the slot of its partner; one
without partner is told by its labels below the nearest matched ancestor. Nodes of one label path
are a second slot, which catches what lists repeat a varying number of times. Only layouts are
aligned, not pages, and each with the centre alone, so neither the order nor the partitioning of
the pages matters, and no host is gathered.

A text that nearly all pages with a slot carry there belongs to the template; a slot whose
text varies is content. Texts are counted exactly, a row per slot and a row per slot and
text, each once per page, summed per batch and then by `groupBy`, so a host with a third of
all pages is spread over all tasks by slot and text. Layouts, slots and texts are told apart
by 64-bit hashes. A page meets the constant texts of its own layout's slots only, which
are about as many as a page of that layout has leaves.

Which part is the article is told by structure: article or main elements if there are
any, without navigation, headers, footers, sidebars, notices, adverts, forms and
comments, which are recognised by element, role and class. Headings of an article stay
even if all pages have them: they name what follows.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import Batches, map_batches, map_slices, texts, work_table
from histlake.llm.url_reputation import host_of

CELLS = 1 << 20  # of a table of matchings held at once; larger ones are halved
MIN_PAGES, CONSTANT = 8, 0.95  # a text is template if so many pages carry it

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Element names of the HTML standard by their role here.
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg math canvas object video audio".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark meter nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
DROPPED = frozenset("nav aside form footer button select input fieldset menu dialog head datalist label option".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
CLOSES = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "option": ("option", ("select",)),
    "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
    "thead": ("tr td th", ("table",)), "tbody": ("thead tbody tr td th", ("table",)), "tfoot": ("tbody tr td th", ("table",)),
}
# Words of class and id names that mark what is not the article.
MARKS = frozenset(
    "nav navbar navigation menu sidebar aside ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup comment comments "
    "disqus respond reply replies footer breadcrumb breadcrumbs pagination pager share sharing social related recommended widget "
    "masthead login search toolbar skip".split()
)
PAGE_HEADERS = frozenset(("header", "masthead"))
# Words that may stand beside a mark in one class name, as in "site-footer" or "ad-slot";
# any other word makes it a name of its own, as in "share-prices" or "related-work".
PLAIN = frozenset(
    "site page main global local user reader top bottom left right inner outer upper lower first last box bar block body area "
    "section container wrapper wrap content list lists item items link links post posts article articles story stories button "
    "buttons icon icons media form panel slot unit row col column columns text label title heading toggle close wide small large "
    "primary secondary sticky fixed mobile desktop header policy message more x".split()
)
# Elements of the text itself: in an article their class names mark nothing.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr figure figcaption caption table".split())
# Elements that name what follows; in an article they stay, however many pages have them.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 dt th caption summary".split())


class Node:
    """Block element, or a run of text in one (label "#")."""

    __slots__ = ("label", "tag", "kids", "text", "holder", "dropped", "where")

    def __init__(self, tag: str, label: str, dropped: bool, where: int):
        self.tag, self.label, self.dropped, self.where = tag, label, dropped, where
        self.kids: list[Node] = []
        self.text, self.holder = "", ""  # of a run: its text and the element it is in


ARTICLE, MAIN = 2, 1
FOREIGN = frozenset("comment comments reply ad ads advert sponsored promo related".split())  # articles that aren't the page's


def marked(names: str, what: frozenset[str]) -> bool:
    """Whether a class name is one of the words or made of one and plain words only."""
    for name in names.split():
        words = [w.lower() for w in WORDS.findall(name)]
        if not what.isdisjoint(words) and all(w in what or w in MARKS or w in PLAIN for w in words):
            return True
    return False


def marks(tag: str, source: str, inside: int) -> tuple[str, bool, int]:
    """Label of an element, whether it is left out, and the region it opens."""
    label, dropped, where = tag, tag in DROPPED or tag == "header" and inside < ARTICLE, inside
    if tag == "article":
        where = ARTICLE
    elif tag == "main":
        where = max(inside, MAIN)
    if source and not source.isspace():
        found = {}
        for name, a, b, c in ATTRIBUTE.findall(source):
            found.setdefault(name.lower(), unescape(a or b or c))
        names = found.get("class", "") + " " + found.get("id", "")
        words = [w.lower() for w in WORDS.findall(names)]
        role = found.get("role", "").lower()
        if role == "main":
            where = max(where, MAIN)
        elif role == "article":
            where = ARTICLE
        hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
        dropped |= hidden or role in ROLES
        if inside == ARTICLE and tag in PROSE:
            pass
        elif tag not in ("html", "body", "article", "main"):
            dropped |= marked(names, MARKS) or inside < ARTICLE and marked(names, PAGE_HEADERS)
        elif tag == "article":
            dropped |= marked(names, FOREIGN)
        if words:
            label = f"{tag}.{'.'.join(sorted(set(words)))}"
    return label, dropped, where


def parse(html: str) -> Node:
    """Tree of block elements and text runs; what never is text is left out."""
    root = Node("", "", False, 0)
    stack = [root]  # open block elements
    inline: list[tuple[str, bool]] = []  # open inline elements: name, left out
    run: list[str] = []
    state = {"hidden": 0}

    def flush() -> None:
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                top = stack[-1]
                leaf = Node("#", "#", top.dropped, top.where)
                leaf.text, leaf.holder = text, top.tag
                top.kids.append(leaf)

    def add(piece: str) -> None:
        if piece and not state["hidden"]:
            run.append(unescape(piece) if "&" in piece else piece)

    def close(tag: str, barriers: tuple[str, ...] = ()) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == tag:
                flush()
                del stack[k:]
                return
            if stack[k].tag in barriers:
                return

    at, skip = 0, None
    for m in TOKEN.finditer(html):
        if skip:  # inside an element whose content is not markup
            if m[1] and m[2].lower() == skip:
                skip, at = None, m.end()
            continue
        if m.start() < at:
            continue
        add(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in INLINE:
                for k in range(len(inline) - 1, -1, -1):
                    if inline[k][0] == tag:
                        state["hidden"] -= inline[k][1]
                        del inline[k]
                        break
            elif tag == "p" and all(n.tag != "p" for n in stack):
                flush()
            else:
                close(tag)
            continue
        if tag in RAW:
            if not m[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
                at = html.find(">", end.start()) + 1 or len(html) if end else len(html)
            continue
        if tag in INLINE:
            if tag == "br":
                run.append(" ")
            elif tag not in VOID and not m[3].endswith("/"):
                hidden = bool(m[3]) and marks(tag, m[3], ARTICLE)[1]
                inline.append((tag, hidden))
                state["hidden"] += hidden
            continue
        flush()
        if tag == "hr" or tag in VOID:
            continue
        for n in CLOSES.get(tag, ("", ()))[0].split():
            close(n, CLOSES[tag][1])
        close("p", ("table", "article", "body"))
        if tag in ("article", "main", "footer", "nav", "aside", "header", "section", "div", "body"):
            # Inline elements left open don't reach beyond their block.
            inline.clear()
            state["hidden"] = 0
        top = stack[-1]
        label, dropped, where = marks(tag, m[3], top.where)
        node = Node(tag, label, dropped or top.dropped, where)
        top.kids.append(node)
        if not m[3].endswith("/") or tag not in ("p", "div"):
            stack.append(node)
    if at < len(html):
        add(html[at:])
    flush()
    return root


class Shape:
    """Node of a page tree as it is matched: neighbouring leaves of equal label are one."""

    __slots__ = ("label", "kids", "leaves")

    def __init__(self, label: str):
        self.label = label
        self.kids: list[Shape] = []
        self.leaves: list[Node] = []


def article(root: Node) -> tuple[int, list[tuple[Node, tuple]]]:
    """The region of a page that is its article, and its leaves in page order, each with the
    chain of elements it is in (innermost first: element, rest of the chain)."""
    found, todo = [], [(root, ())]
    while todo:
        node, chain = todo.pop()
        if node.tag == "#":
            if not node.dropped:
                found.append((node, chain))
            continue
        inner = (node, chain)
        todo += [(kid, inner) for kid in reversed(node.kids)]
    region = max((n.where for n, _ in found), default=0)
    return region, [x for x in found if x[0].where == region]


def shape_of(root: Node, found: list[tuple[Node, tuple]]) -> Shape:
    """Tree over the given leaves: elements without one of them are left out."""
    top = Shape(root.label)
    made, order = {id(root): top}, [top]
    for leaf, chain in found:
        missing = []
        while id(chain[0]) not in made:
            missing.append(chain[0])
            chain = chain[1]
        shape = made[id(chain[0])]
        for node in reversed(missing):
            part = made[id(node)] = Shape(node.label)
            shape.kids.append(part)
            order.append(part)
            shape = part
        part = Shape("#")
        part.leaves.append(leaf)
        shape.kids.append(part)
    for shape in reversed(order):  # children before parents
        if all(k.label == "#" for k in shape.kids):
            shape.leaves = [n for k in shape.kids for n in k.leaves]
            shape.kids = []
            continue
        merged: list[Shape] = []
        for kid in shape.kids:
            if merged and merged[-1].label == kid.label and not merged[-1].kids and not kid.kids:
                merged[-1].leaves += kid.leaves
            else:
                merged.append(kid)
        shape.kids = merged
    return top


def layout_of(top: Shape) -> tuple[str, list[Node], list[int]]:
    """Layout of a page as text (label and number of children of every node, parents first),
    its leaves in page order, and the number of the node that each is in."""
    parts, leaves, nodes, todo = [], [], [], [top]
    while todo:
        shape = todo.pop()
        leaves += shape.leaves
        nodes += [len(parts)] * len(shape.leaves)
        parts.append(f"{shape.label or '/'} {len(shape.kids)}")
        todo += reversed(shape.kids)
    return " ".join(parts), leaves, nodes


def digest(text: str, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed)


class Tree:
    """A layout: label, parent and children of every node. Equal subtrees have equal kinds."""

    def __init__(self, layout: str, kinds: dict):
        words = layout.split(" ")
        self.labels = words[::2]
        self.kids: list[list[int]] = [[] for _ in self.labels]
        self.parents = [-1] * len(self.labels)
        open_nodes: list[list[int]] = []  # node, children still to come
        for k, many in enumerate(map(int, words[1::2])):
            if open_nodes:
                self.parents[k] = open_nodes[-1][0]
                self.kids[self.parents[k]].append(k)
                open_nodes[-1][1] -= 1
            open_nodes.append([k, many])
            while open_nodes and not open_nodes[-1][1]:
                open_nodes.pop()
        self.kinds, self.sizes = [0] * len(self.labels), [1] * len(self.labels)
        for k in range(len(self.labels) - 1, -1, -1):
            kind = (self.labels[k], *(self.kinds[c] for c in self.kids[k]))
            self.kinds[k] = kinds.setdefault(kind, len(kinds))
            self.sizes[k] += sum(self.sizes[c] for c in self.kids[k])


def last_row(weights: np.ndarray) -> np.ndarray:
    """Most weight that all rows can match with the first n columns, n from 0 on."""
    best = np.zeros(weights.shape[1] + 1, np.int64)
    for row in weights:
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + row))
    return best


def matched(weights: np.ndarray) -> list[tuple[int, int]]:
    """Order-preserving pairs (row, column) of most weight."""
    rows, columns = weights.shape
    if rows > 1 and rows * columns > CELLS:
        # Halve the rows and cut the columns where both halves together weigh most.
        half = rows // 2
        cut = int((last_row(weights[:half]) + last_row(weights[half:][::-1, ::-1])[::-1]).argmax())
        below = matched(weights[half:, cut:])
        return matched(weights[:half, :cut]) + [(a + half, b + cut) for a, b in below]
    best = np.zeros((rows + 1, columns + 1), np.int64)
    for k in range(rows):
        best[k + 1, 1:] = np.maximum.accumulate(np.maximum(best[k, 1:], best[k, :-1] + weights[k]))
    out, a, b = [], rows, columns
    while a and b:
        if best[a, b] == best[a - 1, b]:
            a -= 1
        elif best[a, b] == best[a, b - 1]:
            b -= 1
        else:
            a, b = a - 1, b - 1
            out.append((a, b))
    return out[::-1]


class Matching:
    """Simple tree matching of two trees. The score of a pair of nodes is the number of
    pairs matched at and below them, and is found once per pair of kinds."""

    def __init__(self, one: Tree, other: Tree):
        self.one, self.other = one, other
        self.scores: dict[tuple[int, int], int] = {}

    def weights(self, left: list[int], right: list[int]) -> np.ndarray:
        """Scores of pairs of children; unlike labels have none."""
        one, other = self.one, self.other
        rows: dict[int, np.ndarray] = {}
        for a in left:
            if one.kinds[a] not in rows:
                pairs = ((one.kinds[a], other.kinds[b]) if one.labels[a] == other.labels[b] else None for b in right)
                rows[one.kinds[a]] = np.array([self.scores[x] if x else 0 for x in pairs], np.int64)
        return np.array([rows[one.kinds[a]] for a in left]).reshape(len(left), len(right))

    def ends(self, left: list[int], right: list[int]) -> tuple[int, int]:
        """How many children at the beginning and at the end are of equal kind: no matching
        weighs more than one that pairs these."""
        a, b = ([t.kinds[k] for k in kids] for t, kids in ((self.one, left), (self.other, right)))
        most, head = min(len(a), len(b)), 0
        while head < most and a[head] == b[head]:
            head += 1
        tail = 0
        while tail < most - head and a[-1 - tail] == b[-1 - tail]:
            tail += 1
        return head, tail

    def score(self, a: int, b: int) -> None:
        """Find the scores of a pair and of all that it depends on."""
        one, other, scores = self.one, self.other, self.scores
        todo = [(a, b)]
        while todo:
            a, b = todo[-1]
            pair = one.kinds[a], other.kinds[b]
            if pair in scores or pair[0] == pair[1]:
                scores[pair] = scores.get(pair, one.sizes[a])
                todo.pop()
                continue
            left, right = one.kids[a], other.kids[b]
            head, tail = self.ends(left, right)
            inner_left, inner_right = left[head : len(left) - tail], right[head : len(right) - tail]
            kinds_left = {one.kinds[x]: x for x in inner_left}
            kinds_right = {other.kinds[y]: y for y in inner_right}
            missing = [
                (x, y) for k, x in kinds_left.items() for m, y in kinds_right.items() if one.labels[x] == other.labels[y] and (k, m) not in scores
            ]
            if missing:
                todo += missing
                continue
            inner = last_row(self.weights(inner_left, inner_right))[-1] if inner_left and inner_right else 0
            scores[pair] = 1 + int(inner) + sum(one.sizes[x] for x in [*left[:head], *left[len(left) - tail :]])
            todo.pop()

    def partners(self) -> list[int]:
        """Node of the other tree that each node of the one is matched with, or -1."""
        one, other = self.one, self.other
        out = [-1] * len(one.labels)
        todo = [(0, 0)] if one.labels[0] == other.labels[0] else []
        for pair in todo:
            self.score(*pair)
        while todo:
            a, b = todo.pop()
            out[a] = b
            if one.kinds[a] == other.kinds[b]:
                out[a : a + one.sizes[a]] = range(b, b + one.sizes[a])
                continue
            left, right = one.kids[a], other.kids[b]
            head, tail = self.ends(left, right)
            todo += zip(left[:head], right[:head])
            todo += zip(left[len(left) - tail :], right[len(right) - tail :])
            left, right = left[head : len(left) - tail], right[head : len(right) - tail]
            if left and right:
                todo += [(left[x], right[y]) for x, y in matched(self.weights(left, right))]
        return out


def slots_of(layout: str, centre: str) -> list[int]:
    """Slots of a layout's nodes: first by matching with the centre, then by label path."""
    kinds: dict = {}
    tree = Tree(layout, kinds)
    partners = list(range(len(tree.labels))) if layout == centre else Matching(tree, Tree(centre, kinds)).partners()
    places, paths = [], []
    for label, parent, partner in zip(tree.labels, tree.parents, partners):
        paths.append(digest(label, paths[parent] if paths else 0))
        places.append(digest(str(partner), 1) if partner >= 0 else digest(label, places[parent] if places else 2))
    return places + paths


def blocks(texts: list[str], constant: list[bool], headings: list[bool], region: bool) -> list[str]:
    """Texts of an article's leaves without those of the template."""
    varying = [t for t, c, h in zip(texts, constant, headings) if not c or region and h]
    # A page most of whose article is the same everywhere is one of many copies.
    if 2 * sum(map(len, varying)) >= sum(map(len, texts)) or not region and varying:
        return varying
    return texts


def main_text(root: Node, constant: set[int]) -> str:
    """Blocks of the article in page order, joined by blank lines, without the leaves whose
    identities are given."""
    region, found = article(root)
    leaves = [n for n, _ in found]
    return "\n\n".join(blocks([n.text for n in leaves], [id(n) in constant for n in leaves], [n.holder in HEADINGS for n in leaves], region > 0))


def parsed(pages: DataFrame) -> DataFrame:
    """Every page as its layout and its article's leaves (columns id, url, key, html)."""

    def step():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for html in texts(batch.column(3)):
                root = parse(html)
                region, found = article(root)
                layout, leaves, nodes = layout_of(shape_of(root, found))
                rows.append((digest(layout), layout, region > 0, nodes, [digest(n.text) for n in leaves], [n.holder in HEADINGS for n in leaves], [n.text for n in leaves]))
            trees, layouts, regions, nodes, hashes, headings, found_texts = zip(*rows) if rows else [()] * 7
            return pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(np.array(trees, np.uint64).view(np.int64)),
                    pa.array(layouts, pa.string()),
                    pa.array(regions, pa.bool_()),
                    pa.array(nodes, pa.list_(pa.int32())),
                    pa.array(hashes, pa.list_(pa.uint64())).cast(pa.list_(pa.int64()), safe=False),
                    pa.array(headings, pa.list_(pa.bool_())),
                    pa.array(found_texts, pa.list_(pa.string())),
                ],
                ["id", "url", "key", "tree", "layout", "region", "nodes", "hashes", "headings", "texts"],
            )

        return work

    kind = pages.schema["id"].dataType.simpleString()
    schema = f"id {kind}, url string, key long, tree long, layout string, region boolean, nodes array<int>, hashes array<long>, headings array<boolean>, texts array<string>"
    return map_slices(pages, step, schema)


def aligned(pages: DataFrame) -> DataFrame:
    """(key, tree, slots): slots of the nodes of every layout, of hosts with enough pages."""
    layouts = work_table(pages.groupBy("key", "tree").agg(F.count(F.lit(1)).alias("pages"), F.first("layout").alias("layout")))
    centres = layouts.groupBy("key").agg(F.max_by("layout", F.struct("pages", "tree")).alias("centre"), F.sum("pages").alias("all_pages"))
    joined = layouts.join(centres.where(F.col("all_pages") >= MIN_PAGES), "key").select("key", "tree", "layout", "centre")

    def step():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            slots = [np.array(slots_of(a, b), np.uint64).view(np.int64) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            return pa.record_batch([batch.column(0), batch.column(1), pa.array(slots, pa.list_(pa.int64()))], ["key", "tree", "slots"])

        return work

    return work_table(map_slices(joined, step, "key long, tree long, slots array<long>"))


def first_of(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by the columns, and where in it a new combination begins."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[order[1:]] != c[order[:-1]] for c in columns], axis=0)
    return order, new


def templates(pages: DataFrame, slots: DataFrame) -> DataFrame:
    """(key, tree, template): constant texts of the nodes of every layout, as structs of
    node and text.

    A text is constant in a slot if at least `CONSTANT` of at least `MIN_PAGES` pages with the slot
    carry it there. Layouts without such a text have no row.
    """
    joined = pages.join(slots, ["key", "tree"]).select("key", "slots", "nodes", "hashes")

    def sums(key: np.ndarray, page: np.ndarray, slot: np.ndarray, text: np.ndarray | None) -> pa.RecordBatch:
        columns = [page, slot] if text is None else [page, slot, text]
        order, new = first_of(*columns)  # once per page
        once = order[new]
        columns = [key[once], *(c[once] for c in columns[1:])]
        order, new = first_of(*columns)
        starts = np.flatnonzero(new)
        found = [pa.array(c[order[starts]]) for c in columns]
        if text is None:
            found.append(pa.nulls(len(starts), pa.int64()))
        return pa.record_batch([*found, pa.array(np.diff(np.r_[starts, len(order)]))], ["key", "slot", "text", "n"])

    def count(batches: Batches) -> Batches:
        for batch in batches:
            lists = [batch.column(k) for k in (1, 2, 3)]
            offsets = [c.offsets.to_numpy() for c in lists]
            slot_values, nodes, hashes = (c.values.to_numpy(zero_copy_only=False) for c in lists)
            nodes, hashes = nodes[offsets[1][0] : offsets[1][-1]], hashes[offsets[2][0] : offsets[2][-1]]
            many = np.diff(offsets[1])
            page = np.repeat(np.arange(batch.num_rows), many)
            begin, half = offsets[0][:-1], np.diff(offsets[0]) // 2
            place = begin[page] + nodes
            slot = np.r_[slot_values[place], slot_values[place + half[page]]]
            page, text = np.r_[page, page], np.r_[hashes, hashes]
            key = batch.column(0).to_numpy()[page]
            yield sums(key, page, slot, None)
            yield sums(key, page, slot, text)

    counts = map_batches(joined, count, "key long, slot long, text long, n long")
    # Smaller sums can't be template: a slot needs MIN_PAGES pages, a text CONSTANT of them.
    summed = work_table(counts.groupBy("key", "slot", "text").agg(F.sum("n").alias("n")).where(F.col("n") >= CONSTANT * MIN_PAGES))
    used = summed.where(F.col("text").isNull() & (F.col("n") >= MIN_PAGES)).select("key", "slot", F.col("n").alias("pages"))
    constant = summed.where("text is not null").join(used, ["key", "slot"]).where(F.col("n") >= CONSTANT * F.col("pages")).select("key", "slot", "text")
    nodes = slots.select("key", "tree", (F.size("slots") / 2).cast("int").alias("half"), F.posexplode("slots").alias("at", "slot"))
    found = nodes.join(constant, ["key", "slot"]).select("key", "tree", F.struct((F.col("at") % F.col("half")).alias("node"), "text").alias("x"))
    return found.groupBy("key", "tree").agg(F.collect_set("x").alias("template"))


def extract(df: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every row.

    A null page is empty and has an empty text; pages without a host share one template.
    Repeated rows each count and stay. Of layouts that equally many pages have, the one
    with the greatest hash is the centre. Long and deeply nested pages are parsed whole.
    """
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    pages = work_table(parsed(pages.select("id", "url", F.xxhash64(host_of(F.col("url"))).alias("key"), "html")))
    found = work_table(templates(pages, aligned(pages)))
    joined = pages.join(found, ["key", "tree"], "left").select("id", "url", "region", "nodes", "hashes", "headings", "texts", "template")

    def step():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns[2:])):
                region, nodes, hashes, headings, leaves, template = row
                known = {(x["node"], x["text"]) for x in template or ()}
                out.append("\n\n".join(blocks(leaves, [x in known for x in zip(nodes, hashes)], headings, region) if known else leaves))
            return pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(map(len, out), pa.int64())], ["id", "url", "text", "n_chars"])

        return work

    kind = joined.schema["id"].dataType.simpleString()
    return map_slices(joined, step, f"id {kind}, url string, text string, n_chars long").withColumnRenamed("id", id_col)
