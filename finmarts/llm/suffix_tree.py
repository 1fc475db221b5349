"""Language-model scores from a probabilistic suffix tree over the bytes of normalised texts.

A text is its words (A-Z in lower case), each with a space after it, then an end symbol. The tree holds contexts of up to
`DEPTH` bytes that training texts hold at least `LEAST_COUNT` times. The root and contexts of one byte are kept; a longer
one is kept if its next-symbol distribution diverges from that of its suffix (count times Kullback-Leibler divergence of
at least `DIVERGENCE` nats) or if it is a suffix of a kept one. Each distribution is smoothed with its suffix's, whose
weight is `ESCAPE` for each different symbol seen after the context (after Witten and Bell), the root's with a uniform one.
A symbol is scored by the longest kept suffix of what precedes it, a text by the product over its symbols.

Nothing of the tree is bounded by the corpus: it grows with what the training texts hold, and no task or the driver
sees it whole. Texts are dealt out in blocks of about `BLOCK_BYTES`. Each block's different words and grams (a context and
the symbol after it) travel to the corpus-wide counts and their answers back to the block, where its texts are scored.
Grams are kept by their context read backwards, so that all contexts with the same last two bytes, and with them all
levels of the tree from the second down, meet in one task; that task tests divergence and gives each gram its probability.
The levels above are at most 256 x 256 counts, which every task gets. Such a group holds the different grams of one pair
of bytes, a few hundredths of the different grams of the corpus.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from finmarts.llm.common import batches, held_out, lower_words_of, written

DEPTH, LEAST_COUNT, DIVERGENCE, ESCAPE = 5, 2, 3.0, 4
BLOCK_BYTES = 32 << 20
#: Grams or words handled at once in a task.
CHUNK = 1 << 20
END = b"\n"
SYMBOLS = 257


def symbols(texts: list[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each symbol of some texts its gram as one number, the context's last byte first and the symbol last; symbols
    per text."""
    before = b"\0" * depth
    parts = [before + b" ".join([*words, END]) for words in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.array([len(p) for p in parts], np.int64)
    keys = np.zeros(max(0, len(data) - depth), np.int64)
    for j in [*range(depth - 1, -1, -1), depth]:
        keys = (keys << 8) | data[j : len(data) - depth + j]
    starts = np.cumsum(sizes) - sizes
    within = np.arange(len(keys)) - np.repeat(starts, sizes)[: len(keys)]
    inside = within + depth < np.repeat(sizes, sizes)[: len(keys)]
    return keys[inside], sizes - depth


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in ascending order and the sums of their counts."""
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every, n = every[order], np.concatenate(counts)[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    return every[first], np.add.reduceat(n, first)


def upper_levels(pairs: np.ndarray) -> np.ndarray:
    """From counts[context byte, symbol]: the probability of each symbol after each byte, by the root and level 1."""
    below = np.full(256, 1 / SYMBOLS)
    for counts in (pairs.sum(0, keepdims=True), pairs):
        total, escape = counts.sum(1, keepdims=True), ESCAPE * (counts > 0).sum(1, keepdims=True)
        kept = total >= LEAST_COUNT
        below = np.where(kept, (counts + escape * below) / np.where(kept, total + escape, 1), below)
    return below


def probabilities(grams: np.ndarray, n: np.ndarray, pairs: np.ndarray, depth: int, divergence: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """The probability of each gram's symbol after its context, and for levels 2 to ``depth`` the kept contexts.

    Takes different grams with their counts in the training texts, all grams of a pair of last bytes or none;
    ``pairs`` counts the symbols after each byte.
    """
    grams = grams.view(np.uint64)
    symbol = grams & np.uint64(255)
    last = (grams >> np.uint64(8 * depth)).astype(np.int64)
    p = upper_levels(pairs)[last, symbol.astype(np.int64)]
    share = (pairs / np.maximum(1, pairs.sum(1, keepdims=True)))[last, symbol.astype(np.int64)]
    levels = []
    for k in range(2, depth + 1):
        code = ((grams >> np.uint64(8 * (depth + 1 - k))) << np.uint64(8)) | symbol
        each, row, place = np.unique(code, return_index=True, return_inverse=True)
        counts = np.bincount(place, n, len(each))
        contexts, start, own = np.unique(each >> np.uint64(8), return_index=True, return_inverse=True)
        total, escape = np.add.reduceat(counts, start), ESCAPE * np.add.reduceat(counts > 0, start, dtype=np.int64)
        usual, seen = share[row], counts > 0
        share = (counts / np.maximum(1, total)[own])[place]
        gain = np.bincount(own[seen], counts[seen] * np.log(counts[seen] / total[own][seen] / usual[seen]), len(contexts))
        levels.append([contexts, (gain >= divergence) & (total >= LEAST_COUNT), row, place, own, counts, total, escape])
    for short, long in zip(levels[-2::-1], levels[:0:-1]):
        suffixes = np.searchsorted(short[0], long[0][long[1]] >> np.uint64(8))
        short[1][suffixes] = True
    for _, kept, row, place, own, counts, total, escape in levels:
        before = p[row]
        smoothed = (counts + escape[own] * before) / np.maximum(1, total + escape)[own]
        p = np.where(kept[own], smoothed, before)[place]
    return p, [contexts[kept] for contexts, kept, *_ in levels]


def gram_scores(grams: DataFrame, pairs: np.ndarray, depth: int, divergence: float, chunk: int = CHUNK) -> DataFrame:
    """(gram, log): log10 of each gram's probability, from (gram, n) with each gram once."""
    schema = pa.schema([("gram", pa.int64()), ("log", pa.float64())])

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, limit = [], 0, chunk

        def finish(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            logs = np.log10(probabilities(keys, n, pairs, depth, divergence)[0])
            whole = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(logs)], schema=schema)
            yield from (whole.slice(i, 20_000) for i in range(0, whole.num_rows, 20_000))

        def joined() -> tuple[np.ndarray, np.ndarray]:
            return tuple(np.concatenate([part[i] for part in held]) for i in (0, 1))

        for batch in rows:
            held.append((batch.column("gram").to_numpy(), batch.column("n").to_numpy()))
            size += batch.num_rows
            if size >= limit:
                keys, n = joined()
                near = keys >> (8 * (depth - 1))
                cut = int(np.argmax(near == near[-1]))
                if cut:
                    yield from finish(keys[:cut], n[:cut])
                held, size = [(keys[cut:], n[cut:])], len(keys) - cut
                limit = max(chunk, 2 * size)
        if size:
            yield from finish(*joined())

    near = F.shiftright("gram", 8 * (depth - 1))
    dealt = grams.select("gram", "n").repartition(near).sortWithinPartitions("gram")
    return dealt.mapInArrow(score, "gram long, log double")


def block_counts(blocked: DataFrame, depth: int) -> DataFrame:
    """(block, word, gram, n): the different words and the different grams of each block, each row one of either, and
    how often the block's training texts hold it."""
    schema = pa.schema([("block", pa.int64()), ("word", pa.binary()), ("gram", pa.int64()), ("n", pa.int64())])

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, words, keys, counts, held = None, Counter(), [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            size = len(words)
            yield from batches({"block": [current] * size, "word": list(words), "gram": [None] * size, "n": list(words.values())}, schema, 20_000)
            grams, n = merged(keys, counts)
            for i in range(0, len(grams), 20_000):
                part = pa.array(grams[i : i + 20_000])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), current)), pa.nulls(len(part), pa.binary()), part, pa.array(n[i : i + 20_000])], schema=schema
                )

        def take(texts: list[list[bytes]], out: bool) -> None:
            nonlocal held
            for text in texts:
                words.update(dict.fromkeys(text, 0) if out else text)
            grams, n = np.unique(symbols(texts, depth)[0], return_counts=True)
            keys.append(grams)
            counts.append(n * (not out))
            held += len(grams)

        for batch in rows:
            block, out = batch.column("block").to_numpy(), batch.column("held_out").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (out[1:] != out[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
                if a < b and block[a] != current:
                    if current is not None:
                        yield from flush()
                    current, words, keys, counts, held = int(block[a]), Counter(), [], [], 0
                for i in range(a, b, 250):
                    take([lower_words_of(t) for t in batch.column("text").slice(i, min(250, b - i)).to_pylist()], bool(out[a]))
                    if held > 4 * CHUNK:
                        k, n = merged(keys, counts)
                        keys, counts, held = [k], [n], 0
        if current is not None:
            yield from flush()

    return blocked.mapInArrow(count, "block long, word binary, gram long, n long")


PACKED = "block long, words binary, counts binary, n long, known double, grams binary, logs binary"


def packed(rows: DataFrame, of_words: bool) -> DataFrame:
    """A task's words (block, word, count, n, share) or grams (block, gram, log) as few rows a block: words with spaces
    between them, numbers as arrays; for words also the sum of ``n`` and of the share of the known ones."""
    schema = pa.schema([
        ("block", pa.int64()), ("words", pa.binary()), ("counts", pa.binary()), ("n", pa.int64()), ("known", pa.float64()),
        ("grams", pa.binary()), ("logs", pa.binary()),
    ])

    def finish(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held)
        block = whole.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        block = block[order]
        starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])).tolist()
        column = {c: whole.column(c).to_numpy()[order] for c in whole.column_names if c not in ("block", "word")}
        words = whole.column("word").combine_chunks().take(pa.array(order)) if of_words else None
        for a, b in zip(starts, [*starts[1:], len(block)]):
            row = dict.fromkeys(schema.names) | {"block": int(block[a])}
            if words is not None:
                counts = column["count"][a:b]
                row["words"], row["counts"] = b" ".join(words.slice(a, b - a).to_pylist()), counts.tobytes()
                row["n"], row["known"] = int(column["n"][a:b].sum()), float(column["share"][a:b][counts > 0].sum())
            else:
                row["grams"], row["logs"] = column["gram"][a:b].tobytes(), column["log"][a:b].tobytes()
            yield pa.RecordBatch.from_pylist([row], schema=schema)

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in rows:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= CHUNK:
                yield from finish(held)
                held, size = [], 0
        if held:
            yield from finish(held)

    return rows.mapInArrow(pack, PACKED)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, score double"


def scored(texts: DataFrame, words: DataFrame, grams: DataFrame, depth: int, ends: int) -> DataFrame:
    """Per text: tokens, known tokens, the sum of log10(count + 1) of its tokens, and the model's score.

    A block's words and grams, packed, come before its texts.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("log_counts", pa.float64()), ("score", pa.float64()),
    ])
    columns = {
        "words": "binary", "counts": "binary", "grams": "binary", "logs": "binary", "doc_id": "long", "held_out": "boolean", "text": "string",
    }

    def of_kind(df: DataFrame, kind: int) -> DataFrame:
        return df.select("block", F.lit(kind).alias("kind"), *(F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()))

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, counts, parts, known, logs = None, {}, [], pd.Index([]), np.empty(0)

        def finish(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = [lower_words_of(t) for t in part.column("text").to_pylist()]
            seen = np.fromiter((n for w in texts for n in (*map(counts.__getitem__, w), ends)), np.float64)
            sizes = np.array([len(w) + 1 for w in texts])
            starts = np.cumsum(sizes) - sizes
            keys, lengths = symbols(texts, depth)
            spelled = logs[known.get_indexer(keys)]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("held_out"), pa.array(sizes),
                pa.array(np.add.reduceat((seen > 0).astype(np.int64), starts)),
                pa.array(np.add.reduceat(np.log10(seen + 1), starts)),
                pa.array(np.add.reduceat(spelled, np.cumsum(lengths) - lengths)),
            ], schema=schema)

        for batch in rows:
            block, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            cuts = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
                if a == b:
                    continue
                if block[a] != current:
                    current, counts, parts = block[a], {}, []
                part = batch.slice(a, b - a)
                if kind[a] == 0:
                    for some, n, grams, values in zip(*(part.column(c).to_pylist() for c in ("words", "counts", "grams", "logs"))):
                        if some is not None:
                            counts.update(zip(some.split(b" "), np.frombuffer(n, np.int64).tolist()))
                        else:
                            parts.append((np.frombuffer(grams, np.int64), np.frombuffer(values)))
                else:
                    if parts:
                        known, logs = pd.Index(np.concatenate([g for g, _ in parts])), np.concatenate([v for _, v in parts])
                        parts = []
                    for i in range(0, b - a, 250):
                        yield from finish(part.slice(i, 250))

    every = of_kind(words, 0).unionByName(of_kind(grams, 0)).unionByName(of_kind(texts, 1))
    return every.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(score, SCORED)


def language_scores(docs: DataFrame, modulus: int = 7, remainder: int = 2, depth: int = DEPTH, divergence: float = DIVERGENCE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for each row.

    Trained on the rows whose crc32 of the id's text leaves another remainder; a null id counts as the empty text. A
    null or blank text is its end token. Repeated rows are counted and scored each. Columns other than doc_id and
    text are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out("doc_id", modulus, remainder).alias("held_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size, trained = texts.agg(F.sum(F.octet_length("text")), F.sum((~F.col("held_out")).cast("long"))).first()
    blocks = max(1, math.ceil((size or 0) / BLOCK_BYTES))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))
    texts = texts.withColumn("block", block)
    blocked = texts.repartition("block").sortWithinPartitions("block", "held_out")
    counted = written(block_counts(blocked, depth), "block-counts")
    per_word = Window.partitionBy("word")
    words = counted.where("word is not null").select("block", "word", "n").withColumn("count", F.sum("n").over(per_word)).withColumn(
        "share", F.lit(1.0) / F.count(F.lit(1)).over(per_word)
    )
    words = written(packed(words, True), "block-words")
    n, v = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.round(F.sum("known")), F.lit(0)).cast("long")).first()
    trained = trained or 0
    tokens, kinds = n + trained, v + (trained > 0)
    grams = counted.where("gram is not null").select("block", "gram", "n")
    pair = F.shiftrightunsigned("gram", 8 * depth) * 256 + F.col("gram").bitwiseAND(255)
    pairs = np.zeros(256 * 256)
    for row in grams.where("n > 0").groupBy(pair.alias("pair")).agg(F.sum("n").alias("n")).collect():
        pairs[row.pair] = row.n
    logs = gram_scores(grams.groupBy("gram").agg(F.sum("n").alias("n")), pairs.reshape(256, 256), depth, divergence)
    logs = written(logs, "gram-scores")
    grams = packed(grams.join(logs, "gram").select("block", "gram", "log"), False)
    result = scored(texts, words, grams, depth, trained)
    return result.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.lit(math.log10(tokens + kinds + 1))).alias("base_score"),
        "score",
    )
