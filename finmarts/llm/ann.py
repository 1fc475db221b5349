"""Nearest neighbours by cosine: multi-index hashing over learned rotated binary codes, then exact scores.

A bounded sample of `SAMPLE` vectors gives the mean, several rotations (each from another random start, improved so
that rotated vectors lie near the corners of a cube) and the search radius. The signs of the rotated coordinates are a
code of about `BITS` bits. A code within the radius of a query's must be within ``radius // substrings`` of it in at
least one substring (pigeonhole), so the tables of 16-bit substrings find every code within the radius. Those are
checked over the whole code and reranked by their original vectors. Where a shard has fewer than k codes within the
radius, the radius grows there until it has k.

The radius is the `COVER` quantile of the code distances between sampled queries and their nearest neighbours in the
sample; in the whole table neighbours are nearer than in the sample.

Index rows are dealt out by hash in shards of about `SHARD` and queries in blocks of about `QUERIES`; a task meets one
shard and one block and returns k rows a query. A vector that is repeated any number of times is spread over the
shards like any other row.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from finmarts.llm.common import written

BITS, SUBSTRING, COVER = 256, 16, 0.99
SAMPLE, SAMPLE_QUERIES = 4096, 256
SHARD, QUERIES = 8192, 4096


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Codes:
    """Centre and rotations; `of` gives codes as rows of 16-bit substrings."""

    def __init__(self, sample: np.ndarray, bits: int = BITS, rounds: int = 15, seed: int = 11):
        x = unit(sample)
        self.mean = x.mean(axis=0)
        x = x - self.mean
        kept = min(x.shape[1], bits)
        self.axes = np.linalg.svd(x, full_matrices=True)[2][:kept].T
        y = x @ self.axes
        random = np.random.default_rng(seed)
        rotations = []
        for _ in range(math.ceil(bits / kept)):
            r = np.linalg.qr(random.standard_normal((kept, kept)))[0]
            for _ in range(rounds):
                u, _, v = np.linalg.svd(np.sign(y @ r).T @ y)
                r = (u @ v).T
            rotations.append(r)
        self.rotation = self.axes @ np.concatenate(rotations, axis=1)
        self.substrings = math.ceil(self.rotation.shape[1] / SUBSTRING)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        signs = (unit(vectors) - self.mean) @ self.rotation > 0
        padded = np.zeros((len(signs), self.substrings * SUBSTRING), bool)
        padded[:, : signs.shape[1]] = signs
        return np.packbits(padded, axis=1).view(np.uint16)


def distances(codes: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ query).sum(axis=1, dtype=np.int64)


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact in double precision, and the same for equal vectors wherever they stand."""
    norm = np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum())
    return (vectors * query).sum(axis=1) / norm


def search_radius(codes: Codes, sample: np.ndarray, k: int, cover: float = COVER) -> int:
    """The radius that covers this share of the sampled queries' nearest neighbours in the sample."""
    if len(sample) <= k + 1:
        return codes.rotation.shape[1]
    own = codes.of(sample)
    found = []
    for i in range(min(SAMPLE_QUERIES, len(sample))):
        scores = cosines(sample, sample[i])
        scores[i] = -np.inf
        near = np.argpartition(-scores, k)[:k]
        found.append(distances(own[near], own[i]))
    return int(np.quantile(np.concatenate(found), cover, method="higher"))


class MultiIndex:
    """Tables from substring values to the rows that hold them."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.tables = []
        for column in codes.T:
            order = np.argsort(column, kind="stable")
            values, first, place = np.unique(column[order], return_index=True, return_inverse=True)
            bucket = np.empty(len(column), np.int64)
            bucket[order] = place
            self.tables.append((values, np.append(first, len(column)), order, bucket))

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code is within the radius."""
        near = radius // len(self.tables)
        probes = sum(math.comb(SUBSTRING, i) for i in range(near + 1))
        marked = np.zeros(len(self.codes), bool)
        for (values, first, order, bucket), part in zip(self.tables, query):
            if probes < len(values):
                wanted = np.unique(part ^ flips(near))
                at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
                hit = at[values[at] == wanted]
            else:  # fewer buckets than probes: look at the buckets there are
                hit = np.flatnonzero(np.bitwise_count(values ^ part) <= near)
            if len(hit) > 8:
                inside = np.zeros(len(values), bool)
                inside[hit] = True
                marked |= inside[bucket]
            else:
                for b in hit.tolist():
                    marked[order[first[b] : first[b + 1]]] = True
        rows = np.flatnonzero(marked)
        return rows[distances(self.codes[rows], query) <= radius]


_flips: dict[int, np.ndarray] = {}


def flips(near: int) -> np.ndarray:
    """All 16-bit values with at most ``near`` bits set."""
    if near not in _flips:
        bits = [sum(1 << b for b in c) for i in range(near + 1) for c in itertools.combinations(range(SUBSTRING), i)]
        _flips[near] = np.array(bits, np.uint16)
    return _flips[near]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) as doubles; null, zero, empty and ragged vectors and those with null or non-finite parts are left out.

    Ragged are those whose length isn't the commonest one (the shorter of two as common).
    """
    v = F.col("embedding").cast("array<double>")
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & whole & some
    )
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (lengths.d if lengths else 0))


def nearest(vectors: DataFrame, is_query, k: int = 5, bits: int = BITS, shard_rows: int = SHARD, query_rows: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest other rows, nearest first, ties to smaller ids.

    ``is_query`` is a condition on vec_id. Fewer than k candidates give fewer rows. Rows that repeat a vec_id are
    candidates each, but never of a query with that id; a query id that is repeated is searched once. Columns other
    than vec_id and embedding are not read; an empty table gives no rows.
    """
    rows = written(usable(vectors), "vectors")
    sample = [r.v for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()]
    queries = rows.where(is_query).dropDuplicates(["vec_id"])
    n, q = rows.count(), queries.count()
    fitted = np.array(sample, dtype=np.float64).reshape(len(sample), len(sample[0]) if sample else 0)
    codes = Codes(fitted, bits) if sample else None
    radius = search_radius(codes, fitted, k) if sample else 0
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(q / query_rows))

    def every(count: int, name: str):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    hashed = F.xxhash64("vec_id", "v")
    index = rows.select("vec_id", "v", F.pmod(hashed, F.lit(shards)).cast("int").alias("shard"), every(blocks, "block"))
    asked = queries.select("vec_id", "v", F.pmod(hashed, F.lit(blocks)).cast("int").alias("block"), every(shards, "shard"))

    def search(here: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(here) and len(wanted):
            x, ids = np.stack(here.v.to_numpy()).astype(np.float64), here.vec_id.to_numpy()
            y = np.stack(wanted.v.to_numpy()).astype(np.float64)
            tables = MultiIndex(codes.of(x))
            for query_id, query, code in zip(wanted.vec_id.to_numpy(), y, codes.of(y)):
                found = tables.within(code, radius)
                found = found[ids[found] != query_id]
                if len(found) < k:
                    far = distances(tables.codes, code)
                    far[ids == query_id] = np.iinfo(np.int64).max
                    cut = np.partition(far, min(k, len(far)) - 1)[min(k, len(far)) - 1]
                    found = np.flatnonzero((far <= cut) & (ids != query_id))
                scores = cosines(x[found], query)
                best = np.lexsort((ids[found], -scores))[:k]
                out["query_id"] += [query_id] * len(best)
                out["vec_id"] += ids[found][best].tolist()
                out["score"] += scores[best].tolist()
        return pd.DataFrame(out)

    met = index.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
    local = met.applyInPandas(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
