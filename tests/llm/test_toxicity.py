import zlib

import numpy as np
import odd
import pyarrow.parquet as pq
from finmarts.llm import toxicity as tx
from finmarts.llm.common import table

SF = "/root/testdata/sf0.01"


def auc(labels, scores):
    better = sum((p > n) + 0.5 * (p == n) for l, p in zip(labels, scores) if l for m, n in zip(labels, scores) if not m)
    return better / (sum(labels) * (len(labels) - sum(labels)))


def test_finds_toxic_texts_and_never_reads_held_out_labels(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    known = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    first = {r.doc_id: r for r in tx.toxicity(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in first.items())
    both = [i for i in first if i in known]
    assert auc([known[i] for i in both], [first[i].score for i in both]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in first.values())
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    second = {r.doc_id: r.score for r in tx.toxicity(docs, flipped).collect()}
    assert second == {i: r.score for i, r in first.items()}


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, text string, label double, found string")


def test_odd_documents_and_labels(spark):
    rows = [(1, 0, "x", 1.0, "f"), (1, 1, "x", 1.0, "f"), (None, 1, "x", 1.0, "f"), (2, None, "x", 1.0, "f"), (6, 0, "x", 0.0, "f"), (9, 0, "x", 0.0, "f"), (14, 0, "x", 0.0, "f")]
    scores = tx.toxicity(odd.documents(spark), labels(spark, rows)).collect()
    assert len(scores) == len(odd.TEXTS) and all(0 <= r.score <= 1 for r in scores)
    unlabelled = tx.toxicity(odd.documents(spark), labels(spark, [])).collect()
    assert {(r.score, r.predicted) for r in unlabelled} == {(0.5, 1)}
    assert tx.toxicity(odd.documents(spark, []), labels(spark, rows)).count() == 0


def test_label_model_learns_rates_and_correlations(spark):
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.3
    one, two = rng.random(4000) < np.where(y, 0.8, 0.05), rng.random(4000) < np.where(y, 0.6, 0.1)
    votes = np.stack([one, two, two], axis=1).astype(float)
    sums = np.zeros((2, 1 + 3 + 9))
    for label in (0, 1):
        w = (y == label).astype(float)
        sums[label] = np.concatenate([[w.sum()], w @ votes, ((votes * w[:, None]).T @ votes).ravel()])
    model = tx._model(sums, 3)
    assert np.allclose(model.rates[1], [0.8, 0.6, 0.6], atol=0.05) and np.allclose(model.rates[0], [0.05, 0.1, 0.1], atol=0.03)
    assert model.divisors[0] < 1.1 and np.allclose(model.divisors[1:], 2, atol=0.1)  # a copy of a voter halves both
    p = model.posterior(np.array([[1, 1, 1], [0, 0, 0]], float), np.array([np.nan, np.nan]))
    assert p[0] > 0.9 > 0.5 > p[1]


def test_classifier_separates():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(500, 2)), np.ones((500, 1))], axis=1)
    w = tx.fit_classifier(x, (x[:, 0] > 0.5).astype(float), 0.1)
    assert (((x @ w) > 0) == (x[:, 0] > 0.5)).mean() > 0.97
