"""SimHash fingerprints and their links within a Hamming radius by covering locality-sensitive hashing.

Each of the 64 bit positions is given a non-zero vector of radius + 1 bits, all vectors about equally often. For each
non-zero vector v there is a table whose mask keeps the positions with an odd inner product with v, about half of
them. The at most ``radius`` positions in which a pair differs span less than the whole space, so some v is orthogonal
to all their vectors: in that table the masked fingerprints are equal. Every pair within the radius thus collides.

Equal fingerprints are merged first. A bucket of more than `HOT` distinct fingerprints is split again by a second
covering of the positions its mask leaves free, which again loses no pair. For the radii here a fingerprint then has
at most 18 free positions, which bounds a bucket whatever the input. A bucket gives a link for each member but one
of each of its connected groups, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from finmarts.llm.common import batches, lower_words_of, written
from finmarts.llm.components import connected_components

SHINGLE, RADIUS = 3, 3
HOT = 2048
SEED = 42
#: Stands for a null id, so that such a document comes last when the smallest id of a component is taken.
NO_ID = (1 << 63) - 1

#: For each byte value its eight bits, most significant first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(words: list[bytes], width: int = SHINGLE) -> int:
    """Majority of the bits of the hashes of all shingles; fewer words make one shingle, none the fingerprint 0."""
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    text = b" ".join(words)
    width = min(width, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    hashes = [xxh64_intdigest(text[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]
    octets = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    set_in = np.concatenate([np.bincount(octets[:, i], minlength=256) @ BITS for i in range(8)])
    return int.from_bytes(np.packbits(2 * set_in > len(hashes)).tobytes(), "big")


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over some bit positions such that any ``radius`` of the positions lie outside one of them."""
    vectors = (1 << radius + 1) - 1
    return [
        sum(1 << p for i, p in enumerate(positions) if (v & (i % vectors + 1)).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def local_links(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join each connected group of a bucket's distinct (unsigned) fingerprints: to the first found of it."""
    links = []
    rest = members
    while len(rest) > 1:
        first, rest = rest[0], rest[1:]
        frontier = [first]
        while frontier and len(rest):
            near = np.bitwise_count(rest ^ frontier.pop()) <= radius
            found = rest[near].tolist()
            if found:
                rest = rest[~near]
                frontier += map(np.uint64, found)
                links += [(int(first), other) for other in found]
    return links


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, a hash of the text, and the fingerprint as a signed 64-bit number.

    A null or blank text has fingerprint 0. Rows are kept as they are, repeated ones too.
    """
    schema = pa.schema([(n, pa.int64()) for n in ("doc_id", "text_hash", "fingerprint")])

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            prints = [signed(fingerprint(lower_words_of(t), width)) for t in batch.column("text").to_pylist()]
            same = {n: batch.column(n).to_pylist() for n in ("doc_id", "text_hash")}
            yield from batches(same | {"fingerprint": prints}, schema)

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    return chosen.mapInArrow(hashed, "doc_id long, text_hash long, fingerprint long")


def _tables(prints: DataFrame, radius: int, hot: int) -> DataFrame:
    """``bucket`` (table number), ``key`` (masked fingerprint) and fingerprint, buckets above ``hot`` split again."""
    masks = covering_masks(list(range(64)), radius)
    rows = [F.struct(F.lit(t).alias("bucket"), F.col("fingerprint").bitwiseAND(F.lit(signed(m))).alias("key")) for t, m in enumerate(masks)]
    first = prints.select("fingerprint", F.inline(F.array(*rows)))
    crowded = first.groupBy("bucket", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot)
    crowded = crowded.select("bucket", "key", F.lit(True).alias("crowded"))
    marked = first.join(crowded, ["bucket", "key"], "left")
    finer = []
    for mask in masks:
        inner = covering_masks([p for p in range(64) if not mask >> p & 1], radius)
        finer.append(F.array(*[F.lit(signed(mask | m)) for m in inner]))
    wide = len(masks) * (len(masks) + 1)
    inner_masks = F.element_at(F.array(*finer), F.col("bucket") + 1)
    again = marked.where("crowded").select("fingerprint", "bucket", F.posexplode(inner_masks).alias("inner", "mask"))
    again = again.select(
        "fingerprint",
        (F.lit(wide) + F.col("bucket") * len(masks) + F.col("inner")).alias("bucket"),
        F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"),
    )
    return marked.where("crowded is null").select("fingerprint", "bucket", "key").unionByName(again)


def links(prints: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that join all pairs within the radius, and no others."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def linked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        current = None

        def finish() -> list[tuple[int, int]]:
            members = np.concatenate(held).view(np.uint64)
            return local_links(members, radius) if len(members) > 1 else []

        for batch in rows:
            if not batch.num_rows:
                continue
            bucket, key, prints = (batch.column(n).to_numpy() for n in ("bucket", "key", "fingerprint"))
            cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (key[1:] != key[:-1])) + 1
            found = []
            if current is not None and current != (bucket[0], key[0]):
                found += finish()
                held = []
            starts, ends = [0, *cuts.tolist()], [*cuts.tolist(), len(key)]
            for a, b in zip(starts[:-1], ends[:-1]):
                if held or b - a > 1:
                    held.append(prints[a:b])
                    found += finish()
                    held = []
            held.append(prints[starts[-1] :])
            current = (bucket[-1], key[-1])
            if found:
                yield from batches({"a": [signed(x) for x, _ in found], "b": [signed(y) for _, y in found]}, schema)
        if held and (found := finish()):
            yield from batches({"a": [signed(x) for x, _ in found], "b": [signed(y) for _, y in found]}, schema)

    grouped = _tables(prints, radius, hot).repartition("bucket", "key").sortWithinPartitions("bucket", "key")
    return grouped.mapInArrow(linked, "a long, b long")


def components(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """doc_id, text_hash, fingerprint and component_id, the smallest doc_id that links lead to, for every row.

    Documents with equal fingerprints, empty ones too, are linked. Null ids are no component's id unless all its
    ids are null. Repeated rows get the same answer each. Columns other than doc_id and text are not read; an empty
    table gives no rows.
    """
    hashed = written(fingerprints(docs, width), "fingerprints")
    prints = hashed.groupBy("fingerprint").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("least"))
    prints = written(prints, "distinct-fingerprints")
    roots = connected_components(links(prints.select("fingerprint"), radius, hot))
    placed = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = placed.join(least, "root").select("fingerprint", F.nullif("component_id", F.lit(NO_ID)).alias("component_id"))
    return hashed.join(named, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The document with the smallest id of each component, one row of it; the columns of ``docs``.

    Of several texts with that id the one with the smallest hash stays. Of documents without an id one stays, if no
    document with an id is in their component.
    """
    found = components(docs, width, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = found.groupBy("doc_id").agg(F.min("text_hash").alias("__hash")).withColumnRenamed("doc_id", "__id")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(kept, same).dropDuplicates(["doc_id"]).select(*docs.columns)
