"""Packing of documents into training sequences, balanced by estimated attention cost.

The cost of a piece of n tokens is ``LINEAR * n + QUADRATIC * n * n``: the first
term stands for the layers that see each token alone, the second for attention
inside the piece. Within a task, documents are gathered until they fill
`GROUP` sequences. In descending size each goes to the sequence of lowest cost
that has room for it; what fits nowhere is cut over the sequences that still
have room, those of lowest cost first. The rest of a task that fills no whole
sequence is cut into sequences of a power of two, so that no padding is left.

Nothing is shuffled: a task packs the documents of its own input split, and the
sequence number is the task's number and a count, so a task that runs again
gives the same sequences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from finmarts.llm.common import batches
from finmarts.llm.encoding import encoder

CAPACITY = 4096
GROUP = 128
LINEAR, QUADRATIC = 1.0, 1.0 / 4096


def cost(n, linear: float = LINEAR, quadratic: float = QUADRATIC):
    return linear * n + quadratic * n * n


def pack_lengths(lengths: list[int], capacities: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that fill the sequences exactly.

    The lengths and the capacities must have the same sum.
    """
    room = np.array(capacities, dtype=np.int64)
    spent = np.zeros(len(room))
    used = np.zeros(len(room), dtype=np.int64)
    pieces = []

    def put(doc: int, start: int, n: int, seq: int) -> None:
        pieces.append((doc, start, n, seq, int(used[seq])))
        used[seq] += n
        room[seq] -= n
        spent[seq] += cost(n)

    homeless = []
    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        n, start = lengths[doc], 0
        seq = int(np.argmin(np.where(room >= n, spent, np.inf)))
        if room[seq] >= n:
            put(doc, start, n, seq)
        else:
            homeless.append(doc)
    free = iter(sorted(np.flatnonzero(room > 0).tolist(), key=lambda s: (spent[s], s)))
    seq = next(free, -1)
    for doc in homeless:
        start = 0
        while start < lengths[doc]:
            if room[seq] == 0:
                seq = next(free)
            n = int(min(room[seq], lengths[doc] - start))
            put(doc, start, n, seq)
            start += n
    return pieces


def rest_capacities(tokens: int, capacity: int) -> list[int]:
    """Whole sequences, then one for each power of two in what is left."""
    left = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids, doc_tokens, sequence_id, offset, sequence_tokens, cost.

    A null text counts as empty; an empty document still has its end id. Repeated rows and null ids are packed as
    documents of their own. A document of any length is cut where a sequence ends. Other columns are not read; an
    empty table gives no rows.
    """
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "cost"]
    kinds = {"ids": pa.binary(), "cost": pa.float64()}
    schema = pa.schema([(n, kinds.get(n, pa.int64())) for n in names])

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, numbered = encoder(tokenizer), TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4").tobytes()
        held: list[tuple[int | None, bytes, int, int]] = []  # id, ids still to pack, ids before them, ids in all
        tokens = 0

        def packed(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, tokens, numbered
            sizes = rest_capacities(tokens, capacity) if last else [capacity] * group
            taken, kept, room = [], [], sum(sizes)
            for doc_id, ids, before, total in held:
                n = min(len(ids) // 4, room)
                room -= n
                if n:
                    taken.append((doc_id, ids[: 4 * n], before, total))
                if 4 * n < len(ids):
                    kept.append((doc_id, ids[4 * n :], before + n, total))
            out: dict[str, list] = {n: [] for n in names}
            for d, start, n, seq, offset in pack_lengths([len(t[1]) // 4 for t in taken], sizes):
                doc_id, ids, before, total = taken[d]
                row = (doc_id, before + start, n, ids[4 * start : 4 * (start + n)], total, numbered + seq, offset, sizes[seq], cost(n))
                for name, value in zip(names, row):
                    out[name].append(value)
            numbered += len(sizes)
            held, tokens = kept, tokens - sum(sizes)
            yield from batches(out, schema)

        for batch in rows:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), enc.encode(texts)):
                    ids += end
                    held.append((doc_id, ids, 0, len(ids) // 4))
                    tokens += len(ids) // 4
                    while tokens >= capacity * group:
                        yield from packed(last=False)
        if tokens:
            yield from packed(last=True)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(
        pack,
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
        "sequence_tokens long, cost double",
    )
