"""Groups of near copies: texts that share `SIMILARITY` or more of their different five-word shingles (Jaccard).

1. A text is the set of the hashes of its shingles. Texts with equal words are one node.
2. Candidates come from MinHash: `HASHES` seeded minima of the set, of which `BANDS` keys of `ROWS` minima each deal the
   nodes into buckets. A pair of similarity s shares no bucket with probability (1 - s^4)^16: 0.0002 at 0.8, 10^-12 at 0.95.
3. A candidate counts only if its shingle sets, compared whole, are that similar. The sketch (a byte of each minimum)
   is looked at before texts move: pairs with fewer than `LEAST_EQUAL` equal bytes aren't compared. A pair of 0.8
   has that few with a probability of about 0.0003.
4. First every node is compared with the smallest node of each of its buckets, which settles large groups with a few
   pairs a node. Then, in buckets that still hold several groups, nodes whose sketches allow a link across groups are
   gathered. Up to `CROWD` that hang together by such links give their pairs. More are a crowd, which is handed on as
   its members, one row each, so that no row is made for a pair. Crowds with a node in common become one, and each is
   compared whole in one task (`settled`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from finmarts.llm.common import batches, lower_words_of, written
from finmarts.llm.components import connected_components

WIDTH, SIMILARITY = 5, 0.8
BANDS, ROWS, HASHES, LEAST_EQUAL = 16, 4, 128, 87
#: Buckets of more nodes are dealt out again by parts of the sketch before all pairs across groups are looked at. Two
#: sketches with `LEAST_EQUAL` equal bytes differ in fewer bytes than there are parts, so that one part at least is
#: equal and no such pair is lost.
HOT = 512
PARTS = HASHES - LEAST_EQUAL + 1
PART = HASHES // PARTS
#: Nodes of a bucket that hang together beyond this number are passed on as a crowd instead of as pairs.
CROWD = 8
SEED = 42
NO_ID = (1 << 63) - 1

_RANDOM = np.random.default_rng(SEED)
FLIPS = _RANDOM.integers(0, 1 << 64, HASHES, np.uint64)
FACTORS = _RANDOM.integers(0, 1 << 64, HASHES, np.uint64) | np.uint64(1)


def shingles(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """The different hashes of all shingles; fewer words make one shingle, none the shingle 0."""
    from xxhash import xxh64_intdigest

    if not words:
        return np.zeros(1, np.uint64)
    text = b" ".join(words)
    width = min(width, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    return np.unique(np.array([xxh64_intdigest(text[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())], np.uint64))


def minima(hashes: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, (1 << 64) - 1, np.uint64)
    for i in range(0, len(hashes), 4096):
        least = np.minimum(least, ((hashes[i : i + 4096, None] ^ FLIPS) * FACTORS).min(axis=0))
    return least


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def sketched(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_hash, node (a hash of the words), the bucket keys and the sketch of each row."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("node", pa.int64()), ("keys", pa.list_(pa.int64())), ("sketch", pa.binary()),
    ])

    def sketch(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in rows:
            out: dict[str, list] = {n: batch.column(n).to_pylist() for n in ("doc_id", "text_hash")}
            out |= {"node": [], "keys": [], "sketch": []}
            for text in batch.column("text").to_pylist():
                words = lower_words_of(text)
                least = minima(shingles(words, width))
                out["node"].append(xxh64_intdigest(b" ".join(words), SEED) - (1 << 63))
                parts = [least[i * ROWS : (i + 1) * ROWS].tobytes() for i in range(BANDS)]
                out["keys"].append([xxh64_intdigest(p, i) - (1 << 63) for i, p in enumerate(parts)])
                out["sketch"].append((least >> np.uint64(56) ^ least & np.uint64(255)).astype(np.uint8).tobytes())
            yield from batches(out, schema)

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text")
    )
    return chosen.mapInArrow(sketch, "doc_id long, text_hash long, node long, keys array<long>, sketch binary")


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
NEAR = pa.schema([*PAIRS, ("crowd", pa.bool_())])


def _pairs(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(a), 20_000):
        x, y = a[i : i + 20_000], b[i : i + 20_000]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], schema=PAIRS)


def to_smallest(entries: DataFrame) -> DataFrame:
    """Pairs of each node and the smallest node of each of its buckets, where their sketches allow."""

    def alike(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            if batch.num_rows:
                near = (_bytes(batch.column("sketch")) == _bytes(batch.column("other"))).sum(axis=1) >= LEAST_EQUAL
                yield from _pairs(batch.column("node").to_numpy()[near], batch.column("least").to_numpy()[near])

    least = entries.groupBy("key").agg(F.min_by(F.struct("node", "sketch"), "node").alias("s"), F.count(F.lit(1)).alias("n"))
    least = least.where("n > 1").select("key", F.col("s.node").alias("least"), F.col("s.sketch").alias("other"))
    both = entries.join(least, "key").where("node != least").select("node", "sketch", "least", "other").dropDuplicates(["node", "least"])
    return both.mapInArrow(alike, "a long, b long")


def hanging_together(root: np.ndarray, sketches: np.ndarray) -> Iterator[np.ndarray]:
    """The nodes of a bucket that are connected by sketches near enough across groups, set by set.

    Nodes that are near to none of another group are in no set. Holds numbers of nodes only, never pairs.
    """
    groups, counts = np.unique(root, return_counts=True)
    usual = root == groups[np.argmax(counts)]
    several, of = np.zeros(len(root), bool), np.arange(len(root))
    # members of the largest group are only met by those of others
    for i in np.flatnonzero(~usual).tolist():
        found = np.flatnonzero((root != root[i]) & (usual | (np.arange(len(root)) > i)))
        near = found[(sketches[found] == sketches[i]).sum(axis=1) >= LEAST_EQUAL]
        if len(near):
            several[near] = several[i] = True
            joined = np.unique(np.append(of[near], of[i]))
            if len(joined) > 1:
                of[np.isin(of, joined)] = joined[0]
    some = np.flatnonzero(several)
    some = some[np.argsort(of[some], kind="stable")]
    if len(some):
        yield from np.split(some, np.flatnonzero(np.diff(of[some])) + 1)


def across_groups(entries: DataFrame, groups: DataFrame, hot: int = HOT) -> DataFrame:
    """Pairs (a, b) of nodes of different groups in one bucket, where their sketches allow.

    Nodes that hang together by more than a few such pairs come as members of a crowd instead: ``crowd`` is true, b is
    the node and a the smallest node of the crowd.
    """

    def alike(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current = None
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def batch_of(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], schema=NEAR)

        def finish() -> None:
            nonlocal size
            whole = pa.Table.from_batches(held)
            node, root = whole.column("node").to_numpy(), whole.column("root").to_numpy()
            sketches = _bytes(whole.column("sketch"))
            for members in hanging_together(root, sketches):
                if len(members) > CROWD:
                    out.append((np.full(len(members), node[members].min()), node[members], np.ones(len(members), bool)))
                else:
                    i, j = np.triu_indices(len(members), 1)
                    i, j = members[i], members[j]
                    near = (root[i] != root[j]) & ((sketches[i] == sketches[j]).sum(axis=1) >= LEAST_EQUAL)
                    a, b = node[i[near]], node[j[near]]
                    out.append((np.minimum(a, b), np.maximum(a, b), np.zeros(len(a), bool)))
                size += len(out[-1][0])

        for batch in rows:
            key = batch.column("key").to_numpy()
            cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                if a == b:
                    continue
                if held and key[a] != current:
                    finish()
                    held = []
                current = key[a]
                held.append(batch.slice(a, b - a))
            if size > 20_000:
                yield batch_of(out)
                out, size = [], 0
        if held:
            finish()
        if out:
            yield batch_of(out)

    placed = entries.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def mixed(rows: DataFrame) -> DataFrame:
        kinds = rows.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count(F.lit(1)).alias("n"))
        return rows.join(kinds.where("x != y").select("key", "n"), "key")

    first = written(mixed(placed.select("key", "node", "root", "sketch")), "mixed-buckets")
    large = written(first.where(F.col("n") > hot).select("node", "root", "sketch").dropDuplicates(["node"]), "hot-nodes")
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
    again = large.select("node", "root", "sketch", parts.alias("j"))
    again = again.select(F.xxhash64("j", F.substring("sketch", F.col("j") * PART + 1, F.lit(PART))).alias("key"), "node", "root")
    again = mixed(again).join(large.select("node", "sketch"), "node")
    chosen = [p.select("key", "node", "root", "sketch") for p in (first.where(F.col("n") <= hot), again)]
    grouped = chosen[0].unionByName(chosen[1]).repartition("key").sortWithinPartitions("key")
    return grouped.mapInArrow(alike, "a long, b long, crowd boolean")


def links(sets: list[np.ndarray], group: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs of sets that are similar enough, as few as connect all groups that such a pair connects.

    Sets meet through the hashes they share. Those that have come to the group of the first pivot need not be one: a
    link between two of them tells nothing new. Holds the sets and one number for each, whatever the pairs.
    """
    sizes = np.array([len(s) for s in sets])
    hashes, which = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(len(sets)), sizes)[np.argsort(which, kind="stable")]
    counts = np.bincount(which, minlength=len(hashes))
    upto, ends = np.cumsum(counts), np.cumsum(sizes)
    group = np.unique(group, return_inverse=True)[1]
    # the set whose hashes the others have most often is the likeliest to be near to many
    first = int(np.argmax(np.add.reduceat(counts[which], ends - sizes) / sizes))
    found = []
    for i in [first, *(k for k in range(len(sets)) if k != first)]:
        if i != first and group[i] == group[first]:
            continue
        own = which[ends[i] - sizes[i] : ends[i]]
        both = np.zeros(len(sets), np.int64)
        for a, b in zip((upto[own] - counts[own]).tolist(), upto[own].tolist()):
            both[owners[a:b]] += 1  # a hash has an owner once
        near = np.flatnonzero((both / (sizes + sizes[i] - both) >= least) & (group != group[i]))
        for g, j in zip(*np.unique(group[near], return_index=True)):
            found.append((i, int(near[j])))
            group[group == g] = group[i]
    return found


def settled(
    members: DataFrame, groups: DataFrame, texts: DataFrame, width: int = WIDTH, least: float = SIMILARITY
) -> DataFrame:
    """Pairs of similar nodes that connect the groups of each crowd (a: its smallest node, b: a member).

    Crowds that share a node are one, so that each text travels once. A crowd is gathered in one task.
    """

    def settle(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: list[int] = []
        roots: list[int] = []
        sets: list[np.ndarray] = []
        current = None

        def finish() -> Iterator[pa.RecordBatch]:
            found = np.array(links(sets, np.array(roots), least), np.int64).reshape(-1, 2)
            node = np.array(nodes)
            yield from _pairs(node[found[:, 0]], node[found[:, 1]])

        for batch in rows:
            for crowd, node, root, text in zip(*(batch.column(n).to_pylist() for n in ("crowd", "node", "root", "text"))):
                if nodes and crowd != current:
                    yield from finish()
                    nodes, roots, sets = [], [], []
                current = crowd
                nodes.append(node)
                roots.append(root)
                sets.append(shingles(lower_words_of(text), width))
        if nodes:
            yield from finish()

    crowds = connected_components(members.select("a", "b")).withColumnRenamed("root", "crowd")
    crowds = crowds.unionByName(crowds.select(F.col("crowd").alias("node"), "crowd").distinct())
    whole = crowds.join(groups, "node", "left").join(texts, "node").withColumn("root", F.coalesce("root", "node"))
    grouped = whole.select("crowd", "node", "root", "text").repartition("crowd").sortWithinPartitions("crowd")
    return grouped.mapInArrow(settle, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, width: int = WIDTH, least: float = SIMILARITY) -> DataFrame:
    """The pairs whose shingle sets are similar enough."""

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, base = None, None
        for batch in rows:
            keep = []
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                if a != last:
                    last, base = a, shingles(lower_words_of(x), width)
                keep.append(similarity(base, shingles(lower_words_of(y), width)) >= least)
            yield from _pairs(*(batch.column(n).to_numpy()[np.array(keep, bool)] for n in ("a", "b")))

    pairs = written(pairs.distinct(), "candidate-pairs")
    right = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("y")), "b")
    both = right.join(texts.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def classes(docs: DataFrame, width: int = WIDTH, least: float = SIMILARITY, hot: int = HOT) -> DataFrame:
    """doc_id, text_hash, group (the same number for all rows of a group) and component_id, its smallest doc_id.

    Texts without words are alike. Null ids are no group's id unless all its ids are null. Repeated rows get the same
    answer each. Columns other than doc_id and text are not read; an empty table gives no rows.
    """
    hashed = written(sketched(docs, width), "sketches")
    nodes = hashed.groupBy("node").agg(
        F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("least"), F.min_by(F.struct("text_hash", "keys", "sketch"), "text_hash").alias("s")
    ).select("node", "least", "s.*")
    nodes = written(nodes, "nodes")
    every = nodes.select("node", "text_hash", "sketch", F.explode("keys").alias("key"))
    shared = every.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    entries = written(every.join(shared, "key", "left_semi"), "shared-buckets")
    wanted = entries.select("node", "text_hash").distinct()
    texts = docs.select(F.xxhash64("text").alias("text_hash"), F.col("text").cast("string").alias("text"))
    texts = written(texts.join(wanted, "text_hash").dropDuplicates(["node"]).select("node", "text"), "candidate-texts")
    sure = written(verified(to_smallest(entries), texts, width, least), "similar-pairs")
    roots = connected_components(sure)
    near = written(across_groups(entries, roots, hot), "near-nodes")
    pairs, members = near.where(~F.col("crowd")).select("a", "b"), near.where("crowd")
    more = verified(pairs, texts, width, least).unionByName(settled(members, roots, texts, width, least))
    roots = connected_components(sure.unionByName(more))
    placed = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("group"))
    ids = placed.groupBy("group").agg(F.min("least").alias("component_id"))
    named = placed.join(ids, "group").select("node", "group", F.nullif("component_id", F.lit(NO_ID)).alias("component_id"))
    return hashed.join(named, "node").select("doc_id", "text_hash", "group", "component_id")
