"""Importance resampling against a brute-force version."""

import hashlib
import math
import os
import re
import zlib

import numpy as np
import odd
import pytest
from finmarts.llm.common import table
from finmarts.llm.queries import QUERIES
from finmarts.llm.regular_sampling import exact_ranks, segment_of
from finmarts.llm.resampling import WordNumbers, _shift_tables, feature_buckets, importance_ranks, resample

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(odd.LOWER))


def features(text):
    w = words(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def brute(documents, targets):
    def counts(texts):
        out = [0] * 10000
        for t in texts:
            for f in features(t):
                out[bucket(f)] += 1
        return out

    source, target = counts(t for _, t in documents), counts(targets)
    s, t = sum(source), sum(target)
    gain = [math.floor(1000 * math.log((b + 1) * (s + 10000) / ((a + 1) * (t + 10000)))) for a, b in zip(source, target)]
    rows = []
    for doc_id, text in documents:
        f = [gain[bucket(x)] for x in features(text)]
        weight = sum(f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(f), weight, score, None, len(words(text))])
    enough = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, r in enumerate(enough[: 25 * len(enough) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    expected = brute(docs, [r.text for r in table(spark, SF, "benchmark").collect()])
    assert found(QUERIES["op13_importance_resampling"](spark, SF)) == expected


@pytest.mark.parametrize("segment_rows", [3, 1 << 14])
def test_odd_documents(spark, segment_rows):
    target = spark.createDataFrame([("passage1 passage2 word7", "x"), (None, "y"), ("", "z")], "text string, weight string")
    expected = brute(odd.TEXTS, ["passage1 passage2 word7"])
    assert found(importance_ranks(odd.documents(spark), target, segment_rows=segment_rows)) == expected


def test_empty_tables(spark):
    target = spark.createDataFrame([("a b",)], "text string")
    assert importance_ranks(odd.documents(spark, []), target).count() == 0
    assert found(importance_ranks(odd.documents(spark), target.limit(0))) == brute(odd.TEXTS, [])


def test_checksums_of_long_and_odd_words():
    texts = [b"a", b"b" * 200, "é".encode() * 30, b"z" * 48, b"y" * 49]
    got, document = feature_buckets([texts, [], texts[:1], texts[1:3]], WordNumbers(), _shift_tables(), 1 << 31)
    expected = [w for t in (texts, texts[:1], texts[1:3]) for w in t]
    expected += [a + b" " + b for t in (texts, texts[1:3]) for a, b in zip(t, t[1:])]
    assert got.tolist() == [zlib.crc32(w) % (1 << 31) for w in expected]
    assert np.bincount(document).tolist() == [9, 0, 1, 3]


def test_ranks_are_exact_and_segments_even(spark):
    rows = [(int(x) // 40, i) for i, x in enumerate(np.random.default_rng(1).integers(0, 2000, 5000))]
    df = spark.createDataFrame(rows, "k long, i long").repartition(7)
    out = exact_ranks(df, ["k"], segment_rows=100).collect()
    assert sorted(r["rank"] for r in out) == list(range(1, 5001))
    assert [r.k for r in sorted(out, key=lambda r: r["rank"])] == sorted(k for k, _ in rows)


def test_one_key_in_all_rows_is_dealt_out(spark):
    keys = [np.zeros(1000, np.int64), np.arange(1000)]
    splitters = [np.zeros(9, np.int64), np.arange(100, 1000, 100)]
    assert np.bincount(segment_of(keys, splitters)).tolist() == [100] * 10
    out = exact_ranks(spark.createDataFrame([(5,)] * 3000, "k long").repartition(3), ["k"], segment_rows=300)
    assert sorted(r["rank"] for r in out.collect()) == list(range(1, 3001))
    assert segment_of([np.array([1, 2, 2])], [np.array([2])]).tolist() == [0, 1, 1]


def test_drawn_documents(spark):
    docs, target = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    out = resample(docs, target)
    ranks = importance_ranks(docs, target).where("rank is not null")
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == {r.doc_id for r in ranks.collect()}
