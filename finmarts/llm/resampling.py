"""Importance resampling of documents towards the word statistics of a target set.

1. Features are runs of one and two words, hashed into a fixed number of buckets. Both sides' bucket counts are summed
   over all texts; they make one array of gains, the log ratio of a bucket's share in the target and in the documents.
2. A document's weight is the mean gain of its features. With Gumbel noise that depends on its id alone, the highest
   scores are a draw without replacement in proportion to the exponential of the weights.
3. Exact ranks come from parallel sorting by regular sampling (`regular_sampling`), so the number drawn is exact and no
   task holds more than a segment.

The checksum of a run of two words is combined from those of the words, as a checksum is linear in its bits: a table
for each length of the second word moves the first one's on.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from finmarts.llm.common import written
from finmarts.llm.regular_sampling import SEGMENT_ROWS, exact_ranks

BUCKETS, SHARE_PERCENT, LEAST_WORDS, SEED = 10_000, 25, 20, 7
#: Words whose checksum a worker remembers, and words handled together.
REMEMBERED, TOGETHER = 1 << 20, 1 << 19
#: Second words up to this length are combined by table, longer ones one by one.
TABLED = 48
NO_ID = (1 << 63) - 1

#: Digits, letters (A-Z lowered) and all bytes of other characters stay; what is left becomes a space.
TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def _shift_tables() -> np.ndarray:
    """For each length and each byte of a checksum, that byte's checksum after so many zero bytes."""
    one = np.array([zlib.crc32(bytes([b])) for b in range(256)], np.uint32)
    zero_byte = one ^ one[0]  # the table of the polynomial, without the start value
    tables = np.empty((TABLED + 1, 4, 256), np.uint32)
    tables[0] = [[b << 8 * k for b in range(256)] for k in range(4)]
    for n in range(1, TABLED + 1):
        last = tables[n - 1]
        tables[n] = (last >> np.uint32(8)) ^ zero_byte[last & np.uint32(255)]
    return tables


class WordNumbers(dict):
    """Numbers words as they come, and keeps their checksums, alone and with a space behind, and lengths."""

    def __init__(self) -> None:
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number

    def figures(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        done = getattr(self, "_done", None)
        if done is None or len(done[0]) < len(self.words):
            new = self.words[len(done[0]) if done else 0 :]
            alone = np.array([zlib.crc32(w) for w in new], np.uint32)
            spaced = np.array([zlib.crc32(b" ", c) for c in alone.tolist()], np.uint32)
            sizes = np.array([len(w) for w in new], np.int64)
            self._done = done = tuple(np.concatenate([a, b]) for a, b in zip(done, (alone, spaced, sizes))) if done else (alone, spaced, sizes)
        return done


def feature_buckets(texts: list[list[bytes]], numbers: WordNumbers, shift: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket and the document of every feature of some documents, given as lists of words."""
    sizes = np.array([len(t) for t in texts], np.int64)
    total = int(sizes.sum())
    ids = np.fromiter((numbers[w] for t in texts for w in t), np.int64, total)
    document = np.repeat(np.arange(len(texts)), sizes)
    if not total:
        return ids, document
    alone, spaced, lengths = numbers.figures()
    pairs = np.flatnonzero(document[1:] == document[:-1])
    first, second = spaced[ids[pairs]], ids[pairs + 1]
    long_ = lengths[second]
    at = np.minimum(long_, TABLED)
    moved = np.zeros(len(pairs), np.uint32)
    for k in range(4):
        moved = moved ^ shift[at, k, (first >> np.uint32(8 * k)) & np.uint32(255)]
    both = moved ^ alone[second]
    for i in np.flatnonzero(long_ > TABLED).tolist():
        both[i] = zlib.crc32(numbers.words[second[i]], int(first[i]))
    crc = np.concatenate([alone[ids], both])
    return (crc % np.uint32(buckets)).astype(np.int64), np.concatenate([document, document[pairs]])


def _grouped(column: pa.Array) -> Iterator[tuple[int, list[list[bytes]]]]:
    """A column's texts as lists of words, in groups of about `TOGETHER` words, with the row each group starts at."""
    start, held, size = 0, [], 0
    for row in range(len(column)):
        text = column[row].as_py()
        held.append(text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split() if text else [])
        size += len(held[-1])
        if size >= TOGETHER:
            yield start, held
            start, held, size = row + 1, [], 0
    if held:
        yield start, held


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """How many features of all texts lie in each bucket; a task sends at most one row a bucket."""
    shift = _shift_tables()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, numbers = np.zeros(buckets, np.int64), WordNumbers()
        for batch in batches:
            for _, group in _grouped(batch.column(0)):
                found, _ = feature_buckets(group, numbers, shift, buckets)
                counts += np.bincount(found, minlength=buckets)
                if len(numbers) > REMEMBERED:
                    numbers = WordNumbers()
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])

    found = texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket long, n long")
    out = [0] * buckets
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[r.bucket] = r.n
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """A thousand times the log ratio of each bucket's smoothed share in the target and in the source, rounded down."""
    s, t, buckets = sum(source), sum(target), len(source)
    return [
        math.floor(1000 * math.log(float((b + 1) * (s + buckets)) / float((a + 1) * (t + buckets))))
        for a, b in zip(source, target)
    ]


def noise(doc_id: int | None, seed: int) -> int:
    """A thousand times a Gumbel draw that depends on the id, rounded down; a null id counts as the empty text."""
    h = int.from_bytes(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()[:4], "big")
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: list[int], seed: int = SEED) -> DataFrame:
    """doc_id, text_hash, n_words, n_features, weight and score of every row; a text without words weighs 0."""
    shift, table = _shift_tables(), np.array(gain, np.float64)
    names = ["doc_id", "text_hash", "n_words", "n_features", "weight", "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = WordNumbers()
        for batch in batches:
            words, features, weights = [], [], []
            for _, group in _grouped(batch.column("text")):
                found, document = feature_buckets(group, numbers, shift, len(table))
                n = np.bincount(document, minlength=len(group))
                sums = np.bincount(document, weights=table[found], minlength=len(group)).astype(np.int64)
                words += [len(t) for t in group]
                features += n.tolist()
                weights += (sums // np.maximum(n, 1)).tolist()
                if len(numbers) > REMEMBERED:
                    numbers = WordNumbers()
            ids = batch.column("doc_id").to_pylist()
            scores = [w + noise(i, seed) for w, i in zip(weights, ids)]
            columns = [batch.column("doc_id"), batch.column("text_hash"), *(pa.array(c, pa.int64()) for c in (words, features, weights, scores))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text")
    )
    return chosen.mapInArrow(score, ", ".join(f"{n} long" for n in names))


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    share_percent: int = SHARE_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """doc_id, text_hash, n_words, n_features, weight, score and rank of every row, the rank null if it isn't drawn.

    Of the rows with at least ``least_words`` words ``share_percent`` percent, rounded down, are drawn: those with the
    highest scores, ties to the smaller id, null ids last. Null and blank texts have no words; repeated rows are rows
    of their own and take ranks next to each other. Columns other than doc_id and text are not read; an empty table
    gives no rows, an empty target draws by document frequency alone.
    """
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = written(scored(docs, gain, seed), "importance-scores")
    keyed = rows.withColumns({"__down": -F.col("score"), "__id": F.coalesce("doc_id", F.lit(NO_ID)), "__features": F.col("n_features")})
    keys = ["__down", "__id", "__features", "weight", "text_hash"]
    enough = F.col("n_words") >= least_words
    drawn = rows.where(enough).count() * share_percent // 100
    ranked = exact_ranks(keyed.where(enough), keys, segment_rows).drop("__down", "__id", "__features")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents, in the columns of ``docs``; of repeated rows all stay if one is drawn. See `importance_ranks`."""
    drawn = importance_ranks(docs, target, **options).where("rank is not null")
    drawn = drawn.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(drawn, same, "left_semi")
