"""Toxicity scores by weak supervision.

1. Lexicon: words and word beginnings are counted over all labelled training texts; those that stand in toxic texts
   far more often than in others make up the lexicon (the `LEXICON` best by z-score of the log ratio).
2. Voters: the `VOTERS` best entries each vote where a text holds them, patterns of writing (capitals, exclamation
   marks, symbols, digits, repetition) where a text exceeds a fixed level, and one voter where no entry is found.
3. Label model: a generative model of a hidden label and the votes, fitted by expectation maximisation over all texts
   with each voter's firing rates for either label as its accuracies; a voter that doesn't fire abstains. The label of a training row is one more vote,
   wrong in `LABEL_ERROR` of the cases. Voters that fire together more than the label explains are correlated; each
   one's weight is divided by one plus the sum of its correlations.
4. Classifier: ridge logistic regression on the posterior labels of a sample of at most `SAMPLE` labelled rows, over
   lexicon counts (as logarithm and by text length) and pattern levels.

Only rows in the training folds give labels. Text alone enters a score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from finmarts.llm.common import batches, held_out, written

LEXICON, VOTERS = 300, 48
PREFIXES = (4, 5, 6, 7)
LEAST_TOXIC, LEAST_RATIO = 3, 3.0
ROUNDS, LABEL_ERROR = 5, 0.02
SAMPLE, RIDGE = 20_000, 1.0
#: Labels of 12 bytes that are sent to every executor at most.
BROADCAST_LABELS = 1_000_000
#: Entries counted in a task before they are passed on.
HELD = 400_000

LETTERS = re.compile(r"[^\W\d_]+")
SYMBOLS = "#*$%&|<>"
#: Levels of the pattern voters, in the order of `patterns`.
LEVELS = np.array([0.3, 0.02, 0.02, 0.05, 0.2])


def entries(text: str) -> Counter:
    """Words of a text in lower case (as ``word``) and their beginnings (as ``begin*``), with counts."""
    found: Counter = Counter()
    for word, n in Counter(LETTERS.findall(text.lower())).items():
        found[word] += n
        for k in PREFIXES:
            if len(word) <= k:
                break
            found[word[:k] + "*"] += n
    return found


def patterns(text: str) -> list[float]:
    """Shares of capitals, exclamation marks, symbols and digits in the characters, and of the commonest word."""
    n = max(1, len(text))
    words = text.split()
    commonest = Counter(words).most_common(1)[0][1] / len(words) if words else 0.0
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    digits = sum(text.count(d) for d in "0123456789")
    return [capitals / n, text.count("!") / n, sum(map(text.count, SYMBOLS)) / n, digits / n, commonest]


def lexicon(labelled: DataFrame, size: int) -> list[str]:
    """The entries of the lexicon, best first, from (text, toxic) over all rows."""
    schema = pa.schema([("entry", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())

        def flush() -> Iterator[pa.RecordBatch]:
            keys = list(counts[0] | counts[1])
            yield from batches({"entry": keys, "toxic": [counts[1][k] for k in keys], "clean": [counts[0][k] for k in keys]}, schema, 20_000)
            counts[0].clear()
            counts[1].clear()

        for batch in rows:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                counts[toxic].update(entries(text).keys())
                if len(counts[0]) + len(counts[1]) > HELD:
                    yield from flush()
        yield from flush()

    totals = labelled.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1))).first()
    toxic, clean = totals[0], totals[1] - totals[0]
    found = labelled.mapInArrow(count, "entry string, toxic long, clean long").groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    p, q = F.col("toxic") + 0.5, F.col("clean") + 0.5
    ratio = (p / F.lit(toxic + 1)) / (q / F.lit(clean + 1))
    best = (
        found.where(F.col("toxic") >= LEAST_TOXIC)
        .withColumn("ratio", ratio)
        .where(F.col("ratio") > LEAST_RATIO)
        .withColumn("z", F.ln("ratio") / F.sqrt(1 / p + 1 / q))
        .orderBy(F.desc("z"), "entry")
        .limit(4 * size)
    )
    kept = {}
    for r in best.collect():  # a word and its beginnings that stand in the same texts are one entry
        kept.setdefault((r.entry[: min(PREFIXES)], r.toxic, r.clean), r.entry)
    return list(kept.values())[:size]


HITS = "doc_id long, train boolean, found array<int>, times array<int>, n_words int, levels array<double>"


def hits(docs: DataFrame, words: list[str]) -> DataFrame:
    """Each text's lexicon entries with counts, its words and its patterns."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("train", pa.bool_()), ("found", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())),
        ("n_words", pa.int32()), ("levels", pa.list_(pa.float64())),
    ])
    place = {w: i for i, w in enumerate(words)}
    whole = {w for w in words if not w.endswith("*")}
    begins = {k: {w[:-1] for w in words if w.endswith("*") and len(w) == k + 1} for k in PREFIXES}

    def look(text: str) -> dict[int, int]:
        out: dict[int, int] = {}
        found = Counter(LETTERS.findall(text.lower()))
        for w in found.keys() & whole:
            out[place[w]] = found[w]
        for k, known in begins.items():
            for w, n in found.items() if known else ():
                if len(w) > k and w[:k] in known:
                    i = place[w[:k] + "*"]
                    out[i] = out.get(i, 0) + n
        return out

    def search(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                texts = part.column("text").to_pylist()
                found = [look(t) for t in texts]
                yield from batches({
                    "doc_id": part.column("doc_id").to_pylist(), "train": part.column("train").to_pylist(),
                    "found": [list(f) for f in found], "times": [list(f.values()) for f in found],
                    "n_words": [len(t.split()) for t in texts], "levels": [patterns(t) for t in texts],
                }, schema)

    return docs.select("doc_id", "train", "text").mapInArrow(search, HITS)


def counts_of(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dense lexicon counts, words and patterns of a batch of `hits`."""
    found, times = batch.column("found"), batch.column("times")
    dense = np.zeros((batch.num_rows, size), np.float32)
    rows = np.repeat(np.arange(batch.num_rows), found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    dense[rows, found.flatten().to_numpy()] = times.flatten().to_numpy()
    levels = np.array(batch.column("levels").to_pylist(), dtype=np.float64).reshape(batch.num_rows, len(LEVELS))
    return dense, batch.column("n_words").to_numpy().astype(np.float64), levels


def votes_of(dense: np.ndarray, levels: np.ndarray, voters: int) -> np.ndarray:
    """Which voters fire: lexicon entries, patterns, and the one that finds none."""
    present = dense > 0
    return np.concatenate([present[:, :voters], levels > LEVELS, ~present.any(axis=1, keepdims=True)], axis=1).astype(np.float64)


@dataclass
class LabelModel:
    """Rates at which voters fire for either label, and the divisors of their weights for correlation."""

    prior: float
    rates: np.ndarray  # clean, toxic
    divisors: np.ndarray

    def posterior(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Probability of the toxic label; labels are 1, 0 or nan where there is none."""
        logit = np.log(self.prior / (1 - self.prior)) + votes @ (np.log(self.rates[1] / self.rates[0]) / self.divisors)
        trust = np.log((1 - LABEL_ERROR) / LABEL_ERROR)
        logit += np.where(np.isnan(labels), 0.0, np.where(labels > 0.5, trust, -trust))
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def _model(sums: np.ndarray, voters: int) -> LabelModel:
    """The model from summed statistics: for either label its weight, votes and pairs of votes."""
    weight, rates, pairs = [], [], []
    for label in (0, 1):
        s = sums[label]
        weight.append(s[0])
        rates.append((s[1 : voters + 1] + 0.5) / (s[0] + 1))
        pairs.append(s[voters + 1 :].reshape(voters, voters) / max(s[0], 1e-9))
    prior = (weight[1] + 1) / (sum(weight) + 2)
    correlated = np.zeros((voters, voters))
    for label, share in ((0, 1 - prior), (1, prior)):
        r = rates[label]
        spread = np.sqrt(np.outer(r * (1 - r), r * (1 - r)))
        correlated += share * np.clip((pairs[label] - np.outer(r, r)) / np.maximum(spread, 1e-9), 0, 1)
    np.fill_diagonal(correlated, 0)
    return LabelModel(prior, np.array(rates), 1 + np.where(correlated > 0.1, correlated, 0).sum(axis=1))


def fit_label_model(known: DataFrame, size: int, voters: int, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation over (found, times, n_words, levels, label): a job a round, sums alone return."""
    total = voters + len(LEVELS) + 1
    width = 1 + total + total * total
    schema = pa.schema([("sums", pa.list_(pa.float64()))])
    model: LabelModel | None = None
    for _ in range(rounds + 1):
        now = model

        def expect(rows: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((2, width))
            for batch in rows:
                dense, _, levels = counts_of(batch, size)
                votes = votes_of(dense, levels, voters)
                labels = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
                q = now.posterior(votes, labels) if now else labels
                for label, w in ((0, 1 - q), (1, q)):
                    w = np.where(np.isnan(w), 0.0, w)
                    sums[label] += np.concatenate([[w.sum()], w @ votes, ((votes * w[:, None]).T @ votes).ravel()])
            yield pa.RecordBatch.from_pylist([{"sums": sums.ravel().tolist()}], schema=schema)

        parts = known.mapInArrow(expect, "sums array<double>")
        summed = parts.select(F.posexplode("sums").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
        flat = np.zeros(2 * width)
        for r in summed.collect():
            flat[r.i] = r.x
        model = _model(flat.reshape(2, width), total)
    return model


def features(dense: np.ndarray, n_words: np.ndarray, levels: np.ndarray) -> np.ndarray:
    share = 100 * dense / np.maximum(n_words, 1)[:, None]
    bias = np.ones((len(dense), 1))
    return np.concatenate([np.log1p(dense), np.minimum(share, 10), np.minimum(10 * levels, 10), bias], axis=1)


def fit_classifier(x: np.ndarray, target: np.ndarray, ridge: float = RIDGE, steps: int = 12) -> np.ndarray:
    """Ridge logistic regression on soft labels by Newton steps; the bias isn't penalised."""
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        gradient, curve = penalty * weights, np.diag(penalty)
        for i in range(0, len(x), 2000):
            part = x[i : i + 2000].astype(np.float64)
            p = 1 / (1 + np.exp(-np.clip(part @ weights, -30, 30)))
            gradient += part.T @ (p - target[i : i + 2000])
            curve += (part * (p * (1 - p) + 1e-6)[:, None]).T @ part
        weights = weights - np.linalg.solve(curve, gradient)
    return weights


def toxicity(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, size: int = LEXICON, voters: int = VOTERS, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of ``docs``.

    Labels of rows whose crc32 of the id's text leaves ``remainder`` are never used. Null labels are left out; of
    several labels of an id the highest counts. Null and empty texts are scored like others; repeated rows get a score
    each. Without both labels among the training rows every score is 0.5. Columns other than doc_id and text, and
    doc_id and toxic, are not read; an empty table gives no rows.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (~held_out("doc_id", modulus, remainder)).alias("train"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    )
    if known.count() <= BROADCAST_LABELS:  # else the texts are shuffled to their labels
        known = F.broadcast(known)
    labelled = texts.where("train").join(known, "doc_id").select("doc_id", "text", "toxic")
    words = lexicon(labelled, size)
    found = written(hits(texts, words), "lexicon-hits")
    with_label = written(
        found.join(known, "doc_id", "left").withColumn("label", F.when(F.col("train"), F.col("toxic").cast("double"))).drop("toxic"),
        "labelled-hits",
    )
    kinds = with_label.where("label is not null").agg(F.min("label"), F.max("label")).first()
    schema = pa.schema([("doc_id", pa.int64()), ("train", pa.bool_()), ("score", pa.float64())])
    weights = None
    n, v = len(words), min(voters, len(words))
    if kinds[0] == 0 and kinds[1] == 1:
        model = fit_label_model(with_label, n, v)
        chosen = with_label.where("label is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        x, target = [], []
        for batch in chosen.toArrow().to_batches():
            dense, n_words, levels = counts_of(batch, n)
            x.append(features(dense, n_words, levels).astype(np.float32))
            target.append(model.posterior(votes_of(dense, levels, v), batch.column("label").to_numpy(zero_copy_only=False)))
        weights = fit_classifier(np.concatenate(x), np.concatenate(target))

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if weights is None:
                p = np.full(batch.num_rows, 0.5)
            else:
                p = 1 / (1 + np.exp(-np.clip(features(*counts_of(batch, n)) @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("train"), pa.array(p)], schema=schema)

    scores = found.mapInArrow(score, "doc_id long, train boolean, score double")
    return scores.select(
        "doc_id", (~F.col("train")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
