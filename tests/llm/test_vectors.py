import math

import numpy as np
import pyarrow.parquet as pq
from finmarts.llm import ann
from finmarts.llm.queries import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def brute(rows, is_query, k=5):
    """(query, rank, id, score) with Python floats."""
    out = []
    for q, v in rows:
        if is_query(q):
            scored = [(-sum(a * b for a, b in zip(v, w)) / math.sqrt(sum(a * a for a in v) * sum(b * b for b in w)), i) for i, w in rows if i != q]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return out


def test_recall_on_given_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist()]
    expected = brute(rows, lambda i: i % 50 == 0)
    found = {(r.query_id, r.vec_id): r.score for r in QUERIES["op3_multi_index_hashing"](spark, SF).collect()}
    hits = [(q, i) for q, _, i, _ in expected if (q, i) in found]
    assert len(hits) >= 0.9 * len(expected) == 0.9 * len(found)
    assert all(abs(found[q, i] - s) < 1e-12 for q, _, i, s in expected if (q, i) in found)


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (300, 4)).astype(np.uint16)
    codes[200:] = codes[:100] ^ (1 << rng.integers(0, 16, (100, 4))).astype(np.uint16)
    index = ann.MultiIndex(codes)
    for query in codes[::17]:
        for radius in (0, 3, 4, 8, 27, 40):
            wanted = np.flatnonzero(ann.distances(codes, query) <= radius)
            assert index.within(query, radius).tolist() == wanted.tolist()


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string, v int, shard int, rank string")


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    good = [(50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [-1.0, 0.5]), (100, [1.0, 1.0]), (7, [1.0, 0.0]), (8, [5.0, 0.0])]
    bad = [(5, None), (6, [0.0, 0.0]), (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [None, 1.0]), (12, [1.0]), (13, []), (None, [1.0, 0.0])]
    rows = [(i, v, "s", 1, 1, "r") for i, v in good + bad]
    found = [tuple(r) for r in ann.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, shard_rows=3, query_rows=1).collect()]
    expected = brute(good, lambda i: i % 50 == 0)
    assert sorted((q, r, i) for q, r, i, _ in found) == sorted((q, r, i) for q, r, i, _ in expected)
    assert ann.nearest(frame(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    alone = ann.nearest(frame(spark, [(50, [1.0, 2.0], "s", 1, 1, "r")]), F.col("vec_id") % 50 == 0)
    assert alone.count() == 0


def test_repeated_vector_ties_go_to_smaller_ids(spark):
    rows = [(i, [0.3, 0.7, 0.1], "s", 1, 1, "r") for i in range(400)]
    found = ann.nearest(frame(spark, rows), F.col("vec_id") % 50 == 0, shard_rows=64).collect()
    for r in found:
        assert r.vec_id == [i for i in range(7) if i != r.query_id][r["rank"] - 1]
