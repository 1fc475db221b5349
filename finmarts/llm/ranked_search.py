"""Ranked lexical search with a K2-treap over the grid of terms and documents.

A block of documents is a grid: a row for each term that an item asks for, a column for each document, and in a cell
the impact of the term in the document. The grid is a quadtree whose empty quadrants are left out; every node holds the
largest impact in its square.

An item is a set of rows. Their paths descend the tree together: a state is a range of documents with, for each row,
the node that holds the row and the range. The sum of the nodes' maxima, weighted by term, bounds what any document of
the range can score; at a single document the nodes are the cells, so the bound is the score. Ranges are taken best
first, a batch at a time, until no bound reaches the score of the k-th best document found.

A tree is built, searched for all items and given up in the task that reads the block's documents, so texts are neither
shuffled nor stored. Every block gives its best documents for each item, and a rank over the blocks' lists gives the
answer. Before that, an item's k-th best score in a first block bounds its k-th best of all from below, which lets the
search of other blocks stop early without losing a document.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from finmarts.llm.common import written

TOP = 50
#: Documents and bytes of text that make a block, whichever comes first.
BLOCK_DOCS, BLOCK_BYTES = 1 << 12, 1 << 24
#: Items, with their terms, that a task is sent; more items take more passes over the documents.
ITEMS = 1 << 14
#: Ranges expanded together.
BATCH = 512
#: Documents searched beforehand, in one task, for a lower bound of the k-th best score.
PILOTS = 1 << 11
NO_ID = (1 << 63) - 1

#: Digits, letters (A-Z lowered) and all bytes of other characters stay; what is left becomes a space.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split() if text else []


# --- the tree of one block ---------------------------------------------------------


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers, with a zero between any two."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


class Treap:
    """``levels`` of the tree from the root on; nodes of all levels are numbered one after another.

    ``children`` has four bits a node, one for each quadrant that isn't empty (row half times two plus column half),
    and ``largest`` the largest impact in its square. Cells have no children. ``first``, the number of a node's first
    child, follows from the bits before it. One more node, found as -1, is empty and stands for no node.
    """

    def __init__(self, levels: int, children: np.ndarray, largest: np.ndarray) -> None:
        self.levels = levels
        self.children = np.append(children, np.uint8(0))
        self.largest = np.append(largest, np.uint32(0))
        counts = np.bitwise_count(self.children)
        self.first = (1 + np.cumsum(counts, dtype=np.int32) - counts).astype(np.int32)


#: For each set of children times four plus a quadrant, how many children come before it; -1 where it is empty.
BEFORE = np.array([(c & (1 << q) - 1).bit_count() if c >> q & 1 else -1 for c in range(16) for q in range(4)], np.int32)


def build(rows: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> Treap:
    """The tree over different cells (row, column) with their impacts."""
    side = int(max(rows.max(), columns.max())) + 1
    levels = max(1, (side - 1).bit_length())
    code = (_spread(rows) << np.uint64(1)) | _spread(columns)
    order = np.argsort(code)
    code, value = code[order], impacts[order].astype(np.uint32)
    kinds, maxima = [np.zeros(len(code), np.uint8)], [value]
    for _ in range(levels):
        parent = code >> np.uint64(2)
        start = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        quadrant = (code & np.uint64(3)).astype(np.uint8)
        kinds.append(np.add.reduceat(np.left_shift(np.uint8(1), quadrant), start).astype(np.uint8))
        value = np.maximum.reduceat(value, start)
        maxima.append(value)
        code = parent[start]
    kinds, maxima = kinds[::-1], maxima[::-1]
    return Treap(levels, np.concatenate(kinds), np.concatenate(maxima))


def _halves(tree: Treap, nodes: np.ndarray, row_bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The children of nodes in the left and the right half of their documents, in the row half given for each."""
    kids = tree.children[nodes] * np.int16(4) + 2 * row_bit
    first = tree.first[nodes]
    left, right = BEFORE[kids], BEFORE[kids + 1]
    return np.where(left >= 0, first + left, -1), np.where(right >= 0, first + right, -1)


def search(tree: Treap, rows: np.ndarray, weights: np.ndarray, top: int, least: int = 1, batch: int = BATCH) -> tuple[np.ndarray, np.ndarray]:
    """Columns and scores of the ``top`` best columns for some rows, best first, ties to the smaller column.

    Columns with a score below ``least`` are left out; ``least`` is 1 at least.
    """
    none = np.empty(0, np.int64)
    if not len(rows):
        return none, none
    nodes = np.zeros((1, len(rows)), np.int32)
    bound = np.array([int(tree.largest[0] * weights.sum())])
    low, level = np.zeros(1, np.int64), np.zeros(1, np.int64)
    found_columns, found_scores = none, none
    least = max(1, least)
    while len(bound):
        keep = bound >= least
        if len(found_scores) >= top:
            keep &= (bound > found_scores[top - 1]) | ((bound == found_scores[top - 1]) & (low < found_columns[top - 1]))
        bound, low, level, nodes = bound[keep], low[keep], level[keep], nodes[keep]
        if not len(bound):
            break
        if len(bound) > batch:
            best = np.argpartition(-bound, batch)[:batch]
            rest = np.ones(len(bound), bool)
            rest[best] = False
            taken = (bound[best], low[best], level[best], nodes[best])
            bound, low, level, nodes = bound[rest], low[rest], level[rest], nodes[rest]
        else:
            taken = (bound, low, level, nodes)
            bound, low, level, nodes = bound[:0], low[:0], level[:0], nodes[:0]
        t_bound, t_low, t_level, t_nodes = taken
        single = t_level == tree.levels
        if single.any():
            columns = np.concatenate([found_columns, t_low[single]])
            scores = np.concatenate([found_scores, t_bound[single]])
            order = np.lexsort((columns, -scores))[:top]
            found_columns, found_scores = columns[order], scores[order]
            t_low, t_level, t_nodes = t_low[~single], t_level[~single], t_nodes[~single]
        if not len(t_low):
            continue
        half = tree.levels - 1 - t_level
        row_bit = ((rows[None, :] >> half[:, None]) & 1).astype(np.int16)
        for column_bit, children in enumerate(_halves(tree, t_nodes, row_bit)):
            bounds = tree.largest[children] @ weights
            some = bounds >= least
            bound = np.concatenate([bound, bounds[some]])
            low = np.concatenate([low, t_low[some] + (column_bit << half[some])])
            level = np.concatenate([level, t_level[some] + 1])
            nodes = np.concatenate([nodes, children[some]])
    return found_columns, found_scores


# --- documents ---------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch], names: Sequence[str], most: int) -> Iterator[list[list]]:
    """Rows of a task as lists of columns, in blocks."""
    held: list[list] = [[] for _ in names]
    size = 0
    for batch in batches:
        for row in zip(*(batch.column(n) for n in names)):
            values = [v.as_py() for v in row]
            for column, v in zip(held, values):
                column.append(v)
            size += len(values[-1] or "")
            if len(held[0]) >= most or size >= BLOCK_BYTES:
                yield held
                held, size = [[] for _ in names], 0
    if held[0]:
        yield held


Query = tuple[int, list[bytes], list[int]]


def term_totals(docs: DataFrame, wanted: set[bytes]) -> tuple[int, int, dict[bytes, int]]:
    """How many documents hold a term, how many terms there are in all, and in how many documents each wanted term is.

    A task sends its sums, a row for each wanted term it has met and one for the totals.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding: Counter = Counter()
        n = total = 0
        for batch in batches:
            for text in batch.column(0):
                words = terms_of(text.as_py())
                n, total = n + bool(words), total + len(words)
                holding.update(wanted.intersection(words))
        terms = [None, *holding]
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.binary()), pa.array([n, *holding.values()], pa.int64()), pa.array([total] + [0] * len(holding), pa.int64())],
            names=["term", "n", "l"],
        )

    sums = docs.select(F.col("text").cast("string")).mapInArrow(count, "term binary, n long, l long")
    found = sums.groupBy("term").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).collect()  # at most the wanted terms
    totals = next(((r.n, r.l) for r in found if r.term is None), (0, 0))
    return *totals, {bytes(r.term): r.n for r in found if r.term is not None}


def _searched(
    docs: DataFrame, queries: list[Query], documents: int, terms: int, top: int, least: dict[int, int], block_docs: int
) -> DataFrame:
    """The best documents of every block for every query; ``documents`` and ``terms`` are totals of the whole table."""
    names = ["query", "doc_id", "score"]
    row_of: dict[bytes, int] = {}
    for _, wanted, _ in queries:
        for t in wanted:
            row_of.setdefault(t, len(row_of))
    asked = [(q, np.array([row_of[t] for t in wanted], np.int64), np.array(weights, np.int64)) for q, wanted, weights in queries]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _blocks(batches, ["doc_id", "text"], block_docs):
            # ascending ids, so that the smaller column is the smaller id; null ids come last
            order = sorted(range(len(ids)), key=lambda i: NO_ID if ids[i] is None else ids[i])
            sizes, cells = np.zeros(len(ids), np.int64), []
            for column, i in enumerate(order):
                words = terms_of(texts[i])
                sizes[column] = len(words)
                cells += [column << 32 | row_of[w] for w in words if w in row_of]
            if not cells:
                continue
            cells, tf = np.unique(np.array(cells, np.int64), return_counts=True)
            columns, rows = cells >> 32, cells & 0xFFFFFFFF
            m = 50 + 50 * sizes * documents // terms
            tree = build(rows, columns, 1_000_000_000 * tf // (1000 * tf + 20 * m[columns]))
            here = np.zeros(len(row_of), bool)
            here[rows] = True
            out: list[list] = [[], [], []]
            for query, wanted, weights in asked:
                some = here[wanted]
                found, scores = search(tree, wanted[some], weights[some], top, least.get(query, 1))
                out[0] += [query] * len(found)
                out[1] += [ids[order[c]] for c in found.tolist()]
                out[2] += scores.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out], names=names)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(find, ", ".join(f"{n} long" for n in names))


def best_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    items_at_once: int = ITEMS,
    pilots: int = PILOTS,
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` best documents of each item with a score above 0.

    Ties go to the smaller doc_id, null ids last; repeated rows of documents are ranked each, repeated rows of items
    are one item, and items with one id but different texts are ranked apart. Null and blank texts have no terms: such
    a document is never found, such an item finds none. Columns other than the ids and texts are not read; an empty
    table on either side gives no rows.
    """
    ids = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    ids = written(ids.withColumn("query", F.monotonically_increasing_id()), "search-items")
    # blocks of items, so that what a task is sent is bounded whatever the number of items
    blocks = max(1, -(-ids.count() // items_at_once))
    numbered = ids.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    found = []
    for block in range(blocks):
        some = numbered.where(F.col("block") == block).select("query", "text").collect()
        wanted = {r["query"]: list(dict.fromkeys(terms_of(r["text"]))) for r in some}
        documents, terms, holding = term_totals(docs, {t for w in wanted.values() for t in w})
        weight = {t: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for t, n in holding.items()}
        weight = {t: w for t, w in weight.items() if w > 0}
        queries = [(q, known, [weight[t] for t in known]) for q, w in wanted.items() if (known := [t for t in w if t in weight])]
        least: dict[int, int] = {}
        if pilots and queries:
            nth = _searched(docs.limit(pilots), queries, documents, terms, top, {}, pilots)
            nth = nth.groupBy("query").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).where(F.size("s") >= top)
            least = {r["query"]: r.s for r in nth.select("query", F.element_at("s", top).alias("s")).collect()}
        found.append(_searched(docs, queries, documents, terms, top, least, block_docs))
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(ids.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")
