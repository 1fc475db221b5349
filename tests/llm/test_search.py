"""Ranked search against brute force and SQL, and the tree by itself."""

import collections
import math
import os
import re

import numpy as np
import odd
import pytest
from finmarts.llm import ranked_search
from finmarts.llm.common import table
from finmarts.llm.ranked_search import best_documents, build, search

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [t.translate(odd.LOWER) for t in TERM.findall(text or "")]


def brute(documents, items, top=50):
    held = [(i, collections.Counter(terms(t))) for i, t in documents]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in set(items):
        scores = []
        for doc_id, c in held:
            m = 100 - 50 + 50 * sum(c.values()) * n // total
            s = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if s > 0:
                scores.append((-s, doc_id is None, doc_id))
        for rank, (s, _, doc_id) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top], 1):
            out.append((item_id, rank, doc_id, -s))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_tree_search_is_exact(seed):
    rng = np.random.default_rng(seed)
    side, columns = 200, 333
    grid = np.where(rng.random((side, columns)) < 0.1, rng.integers(1, 50, (side, columns)), 0)
    row, column = grid.nonzero()
    tree = build(row, column, grid[row, column])
    assert int(tree.largest[0]) == grid.max() and len(tree.children) == len(tree.largest) == len(tree.first)
    for _ in range(20):
        rows = rng.choice(side, rng.integers(1, 12), replace=False)
        weights = rng.integers(1, 9, len(rows))
        scores = (grid[rows] * weights[:, None]).sum(axis=0)
        order = np.lexsort((np.arange(columns), -scores))
        best = order[scores[order] > 0][:10]
        for batch in (1, 7, 512):
            got, of = search(tree, rows, weights, 10, batch=batch)
            assert got.tolist() == best.tolist() and of.tolist() == scores[best].tolist()
        least = int(scores[best[-1]])
        got, _ = search(tree, rows, weights, 10, least=least)
        assert got.tolist() == best.tolist()


def test_search_opens_few_ranges_when_the_best_stand_out(monkeypatch):
    rng = np.random.default_rng(5)
    column = np.arange(4096)
    impacts = rng.integers(1, 100, 4096)
    impacts[rng.choice(4096, 10, replace=False)] += 1000
    tree = build(np.zeros(4096, np.int64), column, impacts)
    opened = []
    whole = ranked_search._halves
    monkeypatch.setattr(ranked_search, "_halves", lambda t, nodes, bits: opened.append(len(nodes)) or whole(t, nodes, bits))
    got, _ = search(tree, np.array([0]), np.array([3]), 10, batch=4)
    assert sorted(got.tolist()) == sorted(np.flatnonzero(impacts > 1000).tolist())
    assert sum(opened) < 1000


@pytest.mark.parametrize("block_docs", [3, 4096])
def test_odd_documents_in_blocks(spark, block_docs):
    items = [(1, "word7 WORD14 passage3"), (1, "word7 WORD14 passage3"), (1, "one"), (2, None), (3, ""), (None, "words é"), (4, "unseen")]
    target = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, score string")
    out = best_documents(odd.documents(spark), target, top=4, block_docs=block_docs)
    assert found(out) == brute(odd.TEXTS, items, top=4)


def test_blocks_of_items_and_pilots(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert found(best_documents(docs, items, items_at_once=7, pilots=0)) == expected
    assert found(best_documents(docs.repartition(5), items)) == expected


def test_totals(spark):
    docs = odd.documents(spark).repartition(2)
    found = [terms(t) for _, t in odd.TEXTS]
    expected = (sum(map(bool, found)), sum(map(len, found)), {b"word7": sum("word7" in t for t in found)})
    assert ranked_search.term_totals(docs, {b"word7", b"unseen"}) == expected


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert best_documents(odd.documents(spark, []), items).count() == 0
    assert best_documents(odd.documents(spark), items.limit(0)).count() == 0
