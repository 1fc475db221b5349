"""Main text of web pages by wrapper induction: pages of a host are aligned and what varies is content.

1. Every page is parsed into blocks and a skeleton, the tree of its block elements in which neighbouring siblings
   with equal trees are one node.
2. The different skeletons of a host are merged into one wrapper by simple tree matching: two trees with the same
   root label match, and their children are aligned in order so that most nodes match. Merging a group of skeletons
   and merging the merged is the same operation, so a host's skeletons are merged in rounds, a few in each group.
3. Each skeleton node is aligned with a wrapper node, its slot. A text that most of a host's different pages hold in
   one slot may be template; it is if it stands beside differing content. A page bears witness to that by the longest
   of its other texts, if these are most of what not nearly all pages of the host hold, and not little beside the
   rest; all pages without such content count as one. So copies of an article that differ in an advert lose nothing.
   Slots that hold mostly links, and those that their element or its class name marks as menu, header, footer, sidebar,
   notice, advert, form or comments, are template too. Names are read whole ("with-sidebar" marks nothing), and a name
   alone doesn't decide about an element that holds most of its host's different texts.
4. The text of a page is the blocks in the remaining slots; where the page itself has such blocks inside an article or
   a main element, only these.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from finmarts.llm.common import batches, written

TEMPLATE_SHARE, LEAST_PAGES, LINK_SHARE = 0.5, 5, 0.5
#: Texts on more than this share of a host's different pages say nothing about a page; other text than what may be
#: template has to be this share of that at least.
EVERYWHERE, LEAST_REST = 0.9, 0.2
#: Skeletons merged in one group of a round, about.
FAN_IN = 64

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<(?=[a-zA-Z/])[^>]*\Z",
    re.S,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[a-z]+|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg iframe object canvas select datalist math audio video map".split())
RAW = frozenset("script style textarea title xmp noscript template iframe svg".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Elements that are never part of an article.
APART = frozenset("nav footer aside form head title button menu dialog fieldset textarea input option".split()) | SILENT
#: Class names, ids and roles that mark such parts: one of these words, or a compound of them with `PLAIN` words.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices alert popup modal overlay sidebar side menu menubar nav navbar navigation breadcrumb breadcrumbs "
    "footer foot header masthead toolbar topbar comment comments commentlist respond reply replies disqus discussion "
    "share sharing social related recommended newsletter subscribe subscription signup login search widget pagination "
    "pager copyright complementary contentinfo skip".split()
)
PLAIN = frozenset(
    "site page main global primary secondary top bottom left right inner outer wp js box bar bars area wrap wrapper "
    "container section block blocks list item items group links link buttons button icons posts articles stories news "
    "form field text body content the my col column".split()
)
#: A part that a name marks stays if it holds more than this share of a host's different texts.
WHOLE_SHARE = 0.5
MAIN = frozenset(["article", "main"])
#: An opening tag of the key ends an open element of these.
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
#: Blocks that an open one of these holds back from closing.
HOLDERS = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)


class Node:
    __slots__ = ("tag", "label", "apart", "main", "marked", "above", "children", "number", "form", "shape")

    def __init__(self, tag: str, label: str, apart: bool, main: bool, marked: bool = False, above: Node | None = None):
        self.tag, self.label, self.apart, self.main = tag, label, apart, main
        self.marked, self.above = marked, above  # a name marks it; the next node above that a name marks
        self.children: list[Node] = []
        self.number, self.form, self.shape = 0, 0, ""


def _label(tag: str, attributes: str) -> tuple[str, bool]:
    """The node's label (element and its names' words, digits left out), and whether a name marks it as apart."""
    if "=" not in attributes:
        return tag, False
    names = [n for m in NAMES.finditer(attributes) for n in (m[1] or m[2] or m[3] or "").lower().split()]
    split = [[w for w in WORDS.findall(n) if not w.isdigit()] for n in names]
    marked = any(not MARKS.isdisjoint(words) and MARKS.union(PLAIN).issuperset(words) for words in split)
    return ".".join([tag, *[w for words in split for w in words]]), marked


def parse(page: str) -> tuple[Node, list[tuple[Node, str, int]]]:
    """The tree of a page's block elements and its blocks in order: node, text, characters inside links."""
    root = Node("#", "#", False, False)
    open_nodes: list[tuple[str, Node]] = [("#", root)]
    blocks: list[tuple[Node, str, int]] = []
    run: list[str] = []
    linked, links, silent = 0, 0, 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal run, linked
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                blocks.append((open_nodes[-1][1], text, linked))
        run, linked = [], 0

    def text(part: str) -> None:
        nonlocal linked
        if part:
            run.append(part)
            if links:
                linked += len(part)

    def close(to: int) -> None:
        nonlocal links
        while len(open_nodes) > to:
            tag, node = open_nodes[-1]
            if node is not open_nodes[-2][1]:
                flush()
            links -= tag == "a"
            open_nodes.pop()

    while at < end:
        m = TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        slash, attributes = m[1] or m[4], m[3] if m[2] else m[6]
        if slash:
            for i in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[i][0] == tag:
                    close(i)
                    break
            else:
                if tag in ("p", "br"):
                    text(" ")
            continue
        if tag in RAW and not attributes.rstrip().endswith("/"):
            stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            if tag not in ("svg", "noscript", "template"):
                at = stop.start() if stop else end
            if tag in SILENT:
                tail = page.find(">", stop.start()) if stop else -1
                at = tail + 1 if tail >= 0 else end
            if tag in SILENT or tag in ("title", "textarea"):
                continue
        if tag in VOID:
            if tag == "hr":
                flush()
            text(" ")
            continue
        if tag in ENDS_P:
            for i in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[i][0] == "p":
                    close(i)
                    break
                if open_nodes[i][0] in ("button", "td", "th", "table"):
                    break
        for i in range(len(open_nodes) - 1, 0, -1) if tag in CLOSED_BY else ():
            if open_nodes[i][0] in CLOSED_BY[tag]:
                close(i)
                if tag != "tr":
                    break
            elif open_nodes[i][0] in HOLDERS[tag]:
                break
        label, marked = _label(tag, attributes)
        parent = open_nodes[-1][1]
        if tag in INLINE and not marked:
            links += tag == "a"
            open_nodes.append((tag, parent))
            continue
        flush()
        apart = parent.apart or tag in APART or (tag == "header" and not parent.main)
        marked = marked and (tag not in ("html", "body", "article", "main") or (tag == "article" and parent.main))
        above = parent if parent.marked else parent.above
        node = Node(tag, label, apart, parent.main or tag in MAIN or label.endswith(".main"), marked, above)
        parent.children.append(node)
        links += tag == "a"
        open_nodes.append((tag, node))
    close(1)
    flush()
    return root, blocks


def _distinct(children: list[Node]) -> list[Node]:
    return [c for j, c in enumerate(children) if not j or c.form != children[j - 1].form]


def number(root: Node) -> list[Node]:
    """Collapse equal neighbouring siblings and number the tree in preorder; returns the nodes that stand for others.

    Pages nest as deep as they like, so that here and in the matching below nothing calls itself.
    """
    every, stack = [], [root]
    while stack:
        node = stack.pop()
        every.append(node)
        stack += node.children
    forms: dict[tuple, int] = {}
    for node in reversed(every):
        inner = tuple(c.form for c in _distinct(node.children))
        node.form = forms.setdefault((node.label, inner), len(forms))

    order: list[Node] = []
    pending: list[tuple[Node, Node | None]] = [(root, None)]
    while pending:
        node, twin = pending.pop()
        if twin is None:
            node.number = len(order)
            order.append(node)
        else:
            node.number = twin.number
        twins = _distinct(twin.children) if twin is not None else _distinct(node.children)
        i, below = -1, []
        for j, child in enumerate(node.children):
            i += not j or child.form != node.children[j - 1].form
            below.append((child, None if twins[i] is child else twins[i]))
        pending += reversed(below)

    written_out: list[str] = []
    todo: list[Node | str] = [root]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            written_out.append(part)
            continue
        written_out.append(part.label)
        if part.children:
            todo.append(")")
            inner = _distinct(part.children)
            for child in reversed(inner):
                todo += [child, " "]
            todo[-1] = "("
    root.shape = "".join(written_out)
    return order


def read_shape(shape: str) -> list:
    """A skeleton's text as nested lists [label, children]."""
    root: list = ["", []]
    stack = [root]
    for token in re.findall(r"[()]|[^\s()]+", shape):
        if token == "(":
            stack.append(stack[-1][1][-1])
        elif token == ")":
            stack.pop()
        else:
            stack[-1][1].append([token, []])
    return root[1][0]


def write_shape(tree: list) -> str:
    out: list[str] = []
    todo: list = [tree]
    while todo:
        part = todo.pop()
        if isinstance(part, str):
            out.append(part)
            continue
        out.append(part[0])
        if part[1]:
            todo.append(")")
            for child in reversed(part[1]):
                todo += [child, " "]
            todo[-1] = "("
    return "".join(out)


class Matching:
    """Simple tree matching between the subtrees of some trees; every pair of equal forms is solved once."""

    def __init__(self, *trees: list):
        every, stack = [], list(trees)
        while stack:
            node = stack.pop()
            every.append(node)
            stack += node[1]
        self.form: dict[int, int] = {}
        self.size: dict[int, int] = {}
        forms: dict[tuple, int] = {}
        for node in reversed(every):
            key = (node[0], tuple(self.form[id(c)] for c in node[1]))
            self.form[id(node)] = forms.setdefault(key, len(forms))
            self.size[id(node)] = 1 + sum(self.size[id(c)] for c in node[1])
        self.solved: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}

    def __call__(self, a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
        """Nodes that match, and the pairs of children that are aligned."""
        form, solved = self.form, self.solved
        stack = [(a, b)]
        while stack:
            x, y = stack[-1]
            key = (form[id(x)], form[id(y)])
            if key in solved:
                stack.pop()
            elif x[0] != y[0]:
                solved[key] = 0, []
            elif key[0] == key[1]:
                solved[key] = self.size[id(x)], [(i, i) for i in range(len(x[1]))]
            else:
                missing = [(i, j) for i in x[1] for j in y[1] if i[0] == j[0] and (form[id(i)], form[id(j)]) not in solved]
                if missing:
                    stack += missing
                else:
                    solved[key] = self._children(x[1], y[1])
        return solved[form[id(a)], form[id(b)]]

    def _children(self, x: list, y: list) -> tuple[int, list[tuple[int, int]]]:
        form, solved = self.form, self.solved
        weight = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        pair = [[solved[form[id(i)], form[id(j)]][0] if i[0] == j[0] else 0 for j in y] for i in x]
        for i in range(1, len(x) + 1):
            for j in range(1, len(y) + 1):
                both = weight[i - 1][j - 1] + pair[i - 1][j - 1]
                weight[i][j] = max(weight[i - 1][j], weight[i][j - 1], both)
        pairs, i, j = [], len(x), len(y)
        while i and j:
            if pair[i - 1][j - 1] and weight[i][j] == weight[i - 1][j - 1] + pair[i - 1][j - 1]:
                pairs.append((i - 1, j - 1))
                i, j = i - 1, j - 1
            elif weight[i][j] == weight[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return 1 + weight[-1][-1], pairs[::-1]


def matched(a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: nodes that match, and the pairs of children that are aligned."""
    return Matching(a, b)(a, b)


def merged(a: list, b: list) -> list:
    """The tree that holds both: aligned nodes once, the others in order between them."""
    match = Matching(a, b)
    whole: list = [a[0], []]
    todo = [(a, b, whole)]
    while todo:
        x, y, to = todo.pop()
        i, j = 0, 0
        for p, q in [*match(x, y)[1], (len(x[1]), len(y[1]))]:
            to[1] += x[1][i:p] + y[1][j:q]
            if p < len(x[1]) and q < len(y[1]):
                to[1].append([x[1][p][0], []])
                todo.append((x[1][p], y[1][q], to[1][-1]))
            i, j = p + 1, q + 1
    return whole


def aligned(tree: list, wrapper: list) -> list[int]:
    """For each node of a skeleton, in preorder, its slot: the number of its wrapper node, -1 if it has none."""
    match = Matching(tree, wrapper)
    slots: list[int] = []
    todo: list[tuple[list, list | None, int]] = [(tree, wrapper, 0)]
    while todo:
        node, to, at = todo.pop()
        slots.append(at)
        below: list[tuple[list, list | None, int]] = [(child, None, -1) for child in node[1]]
        if to is not None:
            before, starts = at + 1, []
            for child in to[1]:
                starts.append(before)
                before += match.size[id(child)]
            for i, j in match(node, to)[1]:
                below[i] = node[1][i], to[1][j], starts[j]
        todo += reversed(below)
    return slots


PARSED = (
    "page_id long, url string, host string, shape string, shape_hash long, page_hash long, "
    "blocks array<struct<node:int,marks:array<int>,apart:boolean,main:boolean,text:string,hash:bigint,chars:int,links:int>>"
)


def _marks(node: Node | None) -> list[int]:
    """Numbers of the nodes that a name marks, from this one up."""
    found = []
    while node is not None:
        if node.marked:
            found.append(node.number)
        node = node.above
    return found


def parsed(pages: DataFrame) -> DataFrame:
    """Each page's host, skeleton and blocks."""
    block = pa.struct([
        ("node", pa.int32()), ("marks", pa.list_(pa.int32())), ("apart", pa.bool_()), ("main", pa.bool_()), ("text", pa.string()), ("hash", pa.int64()),
        ("chars", pa.int32()), ("links", pa.int32()),
    ])
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("shape", pa.string()),
        ("shape_hash", pa.int64()), ("page_hash", pa.int64()), ("blocks", pa.list_(block)),
    ])

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        def hashed(text: str) -> int:
            return xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)

        for batch in rows:
            for part in (batch.slice(i, 200) for i in range(0, batch.num_rows, 200)):
                out: dict[str, list] = {n: part.column(n).to_pylist() for n in ("page_id", "url", "host")}
                out |= {n: [] for n in ("shape", "shape_hash", "page_hash", "blocks")}
                for page in part.column("html").to_pylist():
                    root, found = parse(page or "")
                    number(root)
                    out["shape"].append(root.shape)
                    out["shape_hash"].append(hashed(root.shape))
                    out["blocks"].append([
                        {"node": n.number, "marks": _marks(n), "apart": n.apart, "main": n.main, "text": t, "hash": hashed(t), "chars": len(t), "links": k}
                        for n, t, k in found
                    ])
                    out["page_hash"].append(hashed("\n".join(t for _, t, _ in found)))
                yield from batches(out, schema)

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\w+://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    chosen = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    ).withColumn("host", host)
    return chosen.mapInArrow(read, PARSED)


def _merge_all(shapes: pd.Series) -> str:
    trees = [read_shape(s) for s in sorted(shapes)]
    whole = trees[0]
    for tree in trees[1:]:
        whole = merged(whole, tree)
    return write_shape(whole)


def wrappers(shapes: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(host, wrapper) from (host, shape, shape_hash), each skeleton once.

    Each round merges about ``fan_in`` trees of a host in a group and is written, until every host has one tree.
    """

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": group.host.iloc[:1], "shape": [_merge_all(group["shape"])]})

    trees = shapes.select("host", "shape")
    while True:
        parts = trees.groupBy("host").agg(F.ceil(F.count(F.lit(1)) / fan_in).alias("parts"))
        most = parts.agg(F.max("parts")).first()[0] or 1
        dealt = trees.join(parts, "host").withColumn("part", F.pmod(F.xxhash64("shape"), "parts"))
        trees = written(dealt.groupBy("host", "part").applyInPandas(merge, "host string, shape string"), "merged-skeletons")
        if most == 1:
            return trees.withColumnRenamed("shape", "wrapper")
        trees = trees.distinct()


def slots(shapes: DataFrame) -> DataFrame:
    """(host, shape_hash, slots): for each skeleton, the wrapper node of each of its nodes."""
    schema = pa.schema([("host", pa.string()), ("shape_hash", pa.int64()), ("slots", pa.list_(pa.int32()))])

    def align(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [
                aligned(read_shape(s), read_shape(w))
                for s, w in zip(batch.column("shape").to_pylist(), batch.column("wrapper").to_pylist())
            ]
            same = {n: batch.column(n).to_pylist() for n in ("host", "shape_hash")}
            yield from batches(same | {"slots": found}, schema)

    both = shapes.join(wrappers(shapes), "host").select("host", "shape_hash", "shape", "wrapper")
    return both.mapInArrow(align, "host string, shape_hash long, slots array<int>")


def beside_differing(pages: DataFrame, among) -> DataFrame:
    """(host, slot, hash): the frequent texts that stand beside differing content on enough pages.

    Takes pages with their usable blocks; ``among(column, block)`` tells whether a set of places holds a block.
    """

    def chars(blocks):
        return F.aggregate(blocks, F.lit(0).cast("long"), lambda total, b: total + b["chars"])

    fixed = F.filter("usable", lambda b: among("often", b))
    rest = F.filter("usable", lambda b: ~among("often", b))
    part = F.filter("fixed", lambda b: ~among("everywhere", b))
    longest = F.array_max(F.transform("rest", lambda b: F.struct(b["chars"], b["hash"])))
    own = chars("rest")
    told = (own > 0) & (own >= chars(part)) & (own >= LEAST_REST * chars("fixed"))
    found = pages.withColumn("fixed", fixed).where(F.size("fixed") > 0).withColumn("rest", rest)
    places = F.array_distinct(F.transform("fixed", lambda b: F.struct(F.col("slots")[b["node"]].alias("slot"), b["hash"].alias("hash"))))
    found = found.select("host", F.when(told, longest).alias("witness"), F.explode(places).alias("place"))
    beside = F.count_distinct("witness") + F.max(F.col("witness").isNull().cast("int"))
    return found.groupBy("host", "place").agg(beside.alias("n")).where(F.col("n") >= LEAST_PAGES).select("host", "place.*")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page.

    A null or empty page has an empty text; a page without a host is one of the host "". Repeated pages count once
    when a template is sought and get a row each. Columns other than page_id, url and html are not read; an empty
    table gives no rows.
    """
    read = written(parsed(pages), "parsed-pages")
    shapes = read.select("host", "shape", "shape_hash").distinct()
    mapped = written(slots(shapes), "page-slots")
    sizes = read.groupBy("host").agg(F.count_distinct("page_hash").alias("pages"))
    block = read.select("host", "shape_hash", "page_hash", F.explode("blocks").alias("b")).where("not b.apart")
    slot = F.when(F.col("b.node") < F.size("slots"), F.col("slots")[F.col("b.node")])
    placed = block.join(mapped, ["host", "shape_hash"]).select(
        "host", slot.alias("slot"), F.col("b.hash").alias("hash"), "page_hash", F.col("b.chars").alias("chars"), F.col("b.links").alias("links"),
        F.transform("b.marks", lambda m: F.col("slots")[m]).alias("marks"),
    )
    texts = placed.groupBy("host", "slot", "hash").agg(
        F.count_distinct("page_hash").alias("n"), F.max("chars").alias("chars"), F.max("marks").alias("marks"),
        F.max("links").alias("links"), F.sum("chars").alias("all_chars"), F.sum("links").alias("all_links"),
    )
    texts = written(texts, "slot-texts")
    often = texts.where(F.col("n") >= LEAST_PAGES).join(sizes, "host").where(F.col("n") >= TEMPLATE_SHARE * F.col("pages"))
    place = F.struct("slot", "hash")
    often = often.groupBy("host").agg(
        F.collect_set(place).alias("often"),
        F.collect_set(F.when(F.col("n") > EVERYWHERE * F.col("pages"), place)).alias("everywhere"),
    )
    kinds = texts.groupBy("host", "slot").agg(F.sum("all_chars").alias("chars"), F.sum("all_links").alias("links"))
    varying = kinds.where(F.col("links") <= LINK_SHARE * F.col("chars")).groupBy("host").agg(F.collect_set("slot").alias("wanted"))
    # a name doesn't decide about what holds most of a host's different texts, unless these are links
    below = texts.select("host", F.explode(F.array_distinct("marks")).alias("mark"), "chars", "links").groupBy("host", "mark")
    below = below.agg(F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    whole = texts.groupBy("host").agg(F.sum("chars").alias("whole"))
    held = below.join(whole, "host").where((F.col("chars") > WHOLE_SHARE * F.col("whole")) & (F.col("links") <= LINK_SHARE * F.col("chars")))
    stays = held.where("mark >= 0").groupBy("host").agg(F.collect_set("mark").alias("stays"))
    hosts = varying.join(often, "host", "left").join(stays, "host", "left")

    def among(places: str, b):
        at = F.col("slots")[b["node"]]
        return F.coalesce(F.array_contains(places, F.struct(at.alias("slot"), b["hash"].alias("hash"))), F.lit(False))

    def usable(b):
        named = F.exists(b["marks"], lambda m: ~F.coalesce(F.array_contains("stays", F.col("slots")[m]), F.lit(False)))
        return ~b["apart"] & ~named & F.array_contains(F.col("wanted"), F.col("slots")[b["node"]])

    # written, so that its size is known before the pages move: they need no shuffle unless there are very many hosts
    judged = written(mapped.join(hosts, "host", "left"), "page-verdicts")
    pages_of = read.join(judged, ["host", "shape_hash"], "left").withColumn("usable", F.filter("blocks", usable))
    template = beside_differing(pages_of, among).groupBy("host").agg(F.collect_set(place).alias("template"))
    judged = written(judged.drop("often", "everywhere").join(template, "host", "left"), "page-templates")
    content = read.join(judged, ["host", "shape_hash"], "left").withColumn(
        "content", F.filter("blocks", lambda b: usable(b) & ~among("template", b))
    )
    inside = F.filter("content", lambda b: b["main"])
    texts = F.transform(F.when(F.size(inside) > 0, inside).otherwise(F.col("content")), lambda b: b["text"])
    return (
        content.withColumn("text", F.coalesce(F.array_join(texts, "\n"), F.lit("")))
        .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
    )
