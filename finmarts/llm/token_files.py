"""Token files: ids packed in the fewest whole bits a vocabulary needs, with block offsets for random access.

A shard holds, in this order:

* blocks of `BLOCK` ids, each id in ``(vocabulary size - 1).bit_length()`` bits, most significant bit first, each
  block padded to a whole byte;
* block offsets, unsigned 64-bit, one more than there are blocks;
* document ids (signed 64-bit), a byte per document that is 1 where the id is null, and document starts
  (unsigned 64-bit ids, one more than there are documents);
* a JSON footer with the counts, its length as unsigned 32-bit, and `MAGIC`.

Any id is found from its number alone: block ``i // BLOCK``, bit ``(i % BLOCK) * bits``. The shards of a dataset
follow each other in document order; a manifest table names them with their first id.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from finmarts.llm.common import batches, fresh_path
from finmarts.llm.encoding import encoder

MAGIC = b"PKIDS001"
BLOCK = 1 << 16


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a bit string of ``bits`` each, padded to a whole byte."""
    wide = ids.astype(">u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return wide[:, 4 - bits // 8 :].tobytes()
    return np.packbits(np.unpackbits(wide, axis=1)[:, 32 - bits :].ravel()).tobytes()


def unpack(data: bytes, count: int, bits: int) -> np.ndarray:
    """``count`` ids from the bytes of `pack`, as little-endian unsigned 32-bit."""
    raw = np.frombuffer(data, np.uint8)
    wide = np.zeros((count, 4), np.uint8)
    if bits % 8 == 0:
        wide[:, 4 - bits // 8 :] = raw[: count * bits // 8].reshape(count, bits // 8)
    else:
        full = np.zeros((count, 32), np.uint8)
        full[:, 32 - bits :] = np.unpackbits(raw)[: count * bits].reshape(count, bits)
        wide = np.packbits(full, axis=1)
    return wide.reshape(-1).view(">u4").astype("<u4")


class ShardWriter:
    """Writes one shard; documents must come in the order in which they shall stand."""

    def __init__(self, stream, bits: int):
        self.stream, self.bits = stream, bits
        self.pending: list[np.ndarray] = []
        self.held, self.at = 0, 0
        self.offsets, self.docs, self.nulls, self.starts = [0], [], [], [0]

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.starts.append(self.starts[-1] + len(ids))
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= 16 * BLOCK:
            self._flush(all_of_it=False)

    def _flush(self, all_of_it: bool) -> None:
        ids = np.concatenate([np.empty(0, "<u4"), *self.pending])
        end = len(ids) if all_of_it else len(ids) - len(ids) % BLOCK
        for i in range(0, end, BLOCK):
            data = pack(ids[i : min(i + BLOCK, end)], self.bits)
            self.stream.write(data)
            self.at += len(data)
            self.offsets.append(self.at)
        self.pending, self.held = [ids[end:]], len(ids) - end

    def close(self) -> dict:
        self._flush(all_of_it=True)
        for values, kind in ((self.offsets, "<u8"), (self.docs, "<i8"), (self.nulls, "u1"), (self.starts, "<u8")):
            self.stream.write(np.array(values, kind).tobytes())
        counts = {"docs": len(self.docs), "ids": self.starts[-1], "blocks": len(self.offsets) - 1, "bits": self.bits}
        footer = json.dumps(counts | {"data": self.at, "block": BLOCK}).encode()
        self.stream.write(footer + np.array([len(footer)], "<u4").tobytes() + MAGIC)
        self.stream.close()
        return counts


class Shard:
    """Reads a shard by ranges of ids, never more than the blocks asked for."""

    def __init__(self, stream):
        self.stream = stream
        end = stream.size()
        tail = stream.read_at(12, end - 12)
        if tail[4:] != MAGIC:
            raise ValueError("not a token shard")
        length = int(np.frombuffer(tail[:4], "<u4")[0])
        self.meta = json.loads(stream.read_at(length, end - 12 - length))
        at, n, m = self.meta["data"], self.meta["docs"], self.meta["blocks"]
        parts = []
        for count, kind in ((m + 1, "<u8"), (n, "<i8"), (n, "u1"), (n + 1, "<u8")):
            size = count * np.dtype(kind).itemsize
            parts.append(np.frombuffer(stream.read_at(size, at), kind))
            at += size
        self.offsets, self.docs, self.nulls, self.starts = parts

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids number ``start`` to ``stop`` - 1 of the shard."""
        block, bits = self.meta["block"], self.meta["bits"]
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // block, (stop - 1) // block
        low, high = int(self.offsets[first]), int(self.offsets[last + 1])
        data = self.stream.read_at(high - low, low)
        found = []
        for b in range(first, last + 1):
            count = min(block, self.meta["ids"] - b * block)
            part = data[int(self.offsets[b]) - low : int(self.offsets[b + 1]) - low]
            found.append(unpack(part, count, bits))
        return np.concatenate(found)[start - first * block : stop - first * block]

    def documents(self, at_once: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start, ids) of each document, reading about ``at_once`` ids at a time."""
        first, n = 0, self.meta["docs"]
        while first < n:
            stop = max(first + 1, int(np.searchsorted(self.starts, self.starts[first] + at_once, "right")) - 1)
            base = int(self.starts[first])
            ids = self.ids(base, int(self.starts[stop]))
            for d in range(first, stop):
                a, b = int(self.starts[d]), int(self.starts[d + 1])
                yield (None if self.nulls[d] else int(self.docs[d])), a, ids[a - base : b - base]
            first = stop


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Encode ``text`` of all documents and write them as shards in ascending ``doc_id``; returns the manifest.

    A null text counts as empty. Null ids come first, rows of one id stand in the order of a hash of their text.
    Empty documents still hold the end id. Columns other than ``doc_id`` and ``text`` are not read, an empty table
    gives an empty manifest. A task that runs again writes a shard under another name; only shards named in the
    manifest belong to the dataset.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "token-files")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )
    shards = f"{folder}/shards"
    schema = pa.schema([(c, pa.int64()) for c in ("shard", "docs", "ids", "blocks", "bits")] + [("path", pa.string())])

    def write(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext
        from pyarrow import fs

        shard, out, enc = TaskContext.get().partitionId(), None, encoder(tokenizer)
        end = np.array([end_id], "<u4")
        for batch in rows:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                if out is None:
                    store, where = fs.FileSystem.from_uri(shards)
                    store.create_dir(where, recursive=True)
                    name = f"{shards}/{shard:06d}-{uuid.uuid4().hex}.ids"
                    out = ShardWriter(store.open_output_stream(f"{where}/{name.rpartition('/')[2]}"), bits_for(max(enc.size, end_id + 1)))
                encoded = enc.encode(part.column("text").to_pylist())
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoded):
                    out.add(doc_id, np.concatenate([np.frombuffer(ids, "<u4"), end]))
        if out is not None:
            yield pa.RecordBatch.from_pylist([out.close() | {"shard": shard, "path": name}], schema=schema)

    manifest = f"{folder}/manifest"
    ordered.mapInArrow(write, "shard long, docs long, ids long, blocks long, bits long, path string").write.parquet(manifest)
    return read_manifest(spark, folder, manifest)


def read_manifest(spark: SparkSession, folder: str, manifest: str | None = None) -> DataFrame:
    """One row per shard, with ``first``: the ids in all shards before it."""
    shards = spark.read.parquet(manifest or f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """The documents of a dataset: doc_id, start, n_tokens, the checksum of their ids and, if asked for, the ids.

    Ids are little-endian unsigned 32-bit numbers.
    """
    fields = [(n, pa.int64()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")]
    schema = pa.schema([*fields, *([("ids", pa.binary())] if with_ids else [])])

    def read(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in rows:
            for row in batch.to_pylist():
                store, where = fs.FileSystem.from_uri(row["path"])
                with store.open_input_file(where) as stream:
                    out, held = {n: [] for n in schema.names}, 0
                    for doc_id, start, ids in Shard(stream).documents():
                        data = ids.tobytes()
                        for n, v in zip(schema.names, (doc_id, row["first"] + start, len(ids), zlib.crc32(data), data)):
                            out[n].append(v)
                        held += len(ids)
                        if held > 1 << 20:
                            yield from batches(out, schema)
                            out, held = {n: [] for n in schema.names}, 0
                    yield from batches(out, schema)

    spread = manifest.select("path", "first").repartition(manifest.sparkSession.sparkContext.defaultParallelism, "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))


def token_range(manifest: DataFrame, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` - 1 of the dataset, read from the blocks that hold them."""
    from pyarrow import fs

    hits = manifest.where((F.col("first") < stop) & (F.col("first") + F.col("ids") > start)).orderBy("first")
    found = [np.empty(0, "<u4")]
    for row in hits.collect():
        store, where = fs.FileSystem.from_uri(row["path"])
        with store.open_input_file(where) as stream:
            shard = Shard(stream)
            found.append(shard.ids(max(0, start - row["first"]), min(row["ids"], stop - row["first"])))
    return np.concatenate(found)
