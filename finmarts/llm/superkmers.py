"""Removal of repeated passages by counting all windows of words exactly, partitioned by minimisers.

A window is `WINDOW` consecutive words of a document; its minimiser is the smallest hash of the `GRAM`-word sequences
in it. Equal windows have equal minimisers, so a window's count can be taken in its minimiser's bucket. Consecutive
windows with one minimiser, in the same place, form a super-k-mer, which stands for all of them. Its windows differ
from each other, as each has the minimiser at another distance from its start.

1. A scan describes every super-k-mer by its minimiser, a hash of its words and its place, without the words.
2. In a minimiser's bucket, a lone super-k-mer has no repeated window and is done. Super-k-mers with the same words
   repeat each other, so all their windows are repeated. Only where different super-k-mers share a minimiser are the
   words needed.
3. Those travel as one packed string each to their bucket, one string for all super-k-mers with the same words,
   where the windows are sorted and counted.
4. The repeated windows of each document are brought back to it and their words removed.

A bucket of more than `HOT` super-k-mers is not gathered in a task: its equal ones are counted with partial sums. Where
more than `HOT_STRINGS` different ones are left in a bucket, their windows are dealt out by window rather than by
minimiser.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from finmarts.llm.common import batches, words_of, written

WINDOW, GRAM = 35, 12
#: Super-k-mers of 44 bytes, and packed strings of some hundred bytes, that one bucket may bring to a task.
HOT, HOT_STRINGS = 200_000, 50_000
REMEMBERED = 1 << 20
NO_ID = -(1 << 63)

STEP = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        self[word] = value = xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def super_kmers(documents: list[list[bytes]], hashes: dict, window: int, gram: int) -> dict[str, np.ndarray]:
    """The super-k-mers of some documents: their document's place in the list, start, windows, minimiser and words' hash."""
    sizes = np.array([len(d) for d in documents], dtype=np.int64)
    total = int(sizes.sum())
    empty = {n: np.empty(0, np.int64) for n in ("document", "start", "windows", "minimiser", "content")}
    if total < window:
        return empty
    h = np.fromiter((hashes[w] for d in documents for w in d), np.uint64, total)
    grams = total - gram + 1
    g = h[:grams].copy()
    for j in range(1, gram):
        g = g * STEP + h[j : j + grams]
    g = _mixed(g)
    wide, span, low, where = window - gram + 1, 1, g, np.arange(grams)
    while span < wide:
        step = min(span, wide - span)
        left = low[:-step] <= low[step:]
        low, where = np.where(left, low[:-step], low[step:]), np.where(left, where[:-step], where[step:])
        span += step
    ends = np.cumsum(sizes)
    document = np.repeat(np.arange(len(documents)), sizes)[: len(low)]
    valid = np.arange(len(low)) + window <= ends[document]
    at = np.flatnonzero(valid)
    if not len(at):
        return empty
    low, where, document = low[at], where[at], document[at]
    first = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]) | (document[1:] != document[:-1])]))
    count = np.diff(np.append(first, len(at)))
    start = at[first]
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(total - 1, STEP)]), dtype=np.uint64)
        undo = np.cumprod(np.concatenate([[np.uint64(1)], np.full(total - 1, INVERSE)]), dtype=np.uint64)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mixed(h) * powers, dtype=np.uint64)])
        content = _mixed((sums[start + count + window - 1] - sums[start]) * undo[start] + count.astype(np.uint64))
    doc = document[first]
    return {
        "document": doc,
        "start": start - (ends - sizes)[doc],
        "windows": count,
        "minimiser": low[first].view(np.int64),
        "content": content.view(np.int64),
    }


def _window_keys(h: np.ndarray, window: int, salt: int) -> np.ndarray:
    """A 64-bit key of each window of a sequence of word hashes."""
    h = _mixed(h ^ np.uint64(salt))
    ones = np.ones(1, np.uint64)
    powers = np.cumprod(np.concatenate([ones, np.full(len(h), STEP)]), dtype=np.uint64)
    undo = np.cumprod(np.concatenate([ones, np.full(len(h), INVERSE)]), dtype=np.uint64)
    sums = np.concatenate([ones * 0, np.cumsum(h * powers[:-1], dtype=np.uint64)])
    return _mixed((sums[window:] - sums[:-window]) * undo[: len(h) - window + 1])


def repeated_in_bucket(strings: list[bytes], weights: list[int], window: int) -> list[list[int]]:
    """For each packed string of a bucket, which of its windows are found twice or more in the bucket.

    Windows are sorted by 128 bits made from their words, and equal neighbours counted; a string that stands for
    several super-k-mers has a weight of two.
    """
    words = [s.split() for s in strings]
    sizes = np.array([len(w) for w in words])
    hashes = _WordHashes()
    h = np.fromiter((hashes[x] for w in words for x in w), np.uint64, int(sizes.sum()))
    found: list[list[int]] = [[] for _ in strings]
    if len(h) < window:
        return found
    ends = np.cumsum(sizes)
    which = np.repeat(np.arange(len(words)), sizes)[: len(h) - window + 1]
    at = np.flatnonzero(np.arange(len(which)) + window <= ends[which])
    keys = [_window_keys(h, window, salt)[at] for salt in (0, 0x5851F42D4C957F2D)]
    order = np.lexsort(keys)
    one, two = keys[0][order], keys[1][order]
    first = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])[: len(order)])
    if not len(order):
        return found
    totals = np.add.reduceat(np.array(weights)[which[at[order]]], first)
    twice = np.sort(at[order[np.repeat(totals > 1, np.diff(np.append(first, len(order))))]])
    for w, i in zip(which[twice].tolist(), (twice - (ends - sizes)[which[twice]]).tolist()):
        found[w].append(i)
    return found


def intervals(places: list[int]) -> list[tuple[int, int]]:
    """Ascending numbers as (first, how many) of each run."""
    out: list[tuple[int, int]] = []
    for p in places:
        if out and p == out[-1][0] + out[-1][1]:
            out[-1] = (out[-1][0], out[-1][1] + 1)
        else:
            out.append((p, 1))
    return out


PLACE = "doc_key long, text_hash long, start long, windows long"
DESCRIBED = f"{PLACE}, minimiser long, content long"


def _long_schema(names: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in names.split(", "))])


def keyed(docs: DataFrame) -> DataFrame:
    """doc_key (the id, a fixed number for null), a hash of the text, and the text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_key"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )


def described(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """The super-k-mers of all documents, without their words."""
    schema = _long_schema(DESCRIBED)

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in rows:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                if len(hashes) > REMEMBERED:
                    hashes.clear()
                found = super_kmers([words_of(t) for t in part.column("text").to_pylist()], hashes, window, gram)
                which = pa.array(found["document"])
                columns = [part.column(n).take(which) for n in ("doc_key", "text_hash")]
                columns += [pa.array(found[n]) for n in ("start", "windows", "minimiser", "content")]
                whole = pa.RecordBatch.from_arrays(columns, schema=schema)
                yield from (whole.slice(i, 20_000) for i in range(0, whole.num_rows, 20_000))

    return keyed(docs).mapInArrow(scan, DESCRIBED)


def _judged(parts: DataFrame) -> DataFrame:
    """Super-k-mers with company in their bucket: ``weight`` 0 if all windows are repeated by an equal one.

    Rows with weight 1 (no equal) or 2 (one of several equals) are those whose words the bucket has to see.
    """
    names = f"{PLACE}, minimiser long, weight long"
    schema = _long_schema(names)

    def judge(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def settled(t: pa.Table) -> pa.RecordBatch | None:
            m, c = t.column("minimiser").to_numpy(), t.column("content").to_numpy()
            bucket = np.concatenate([[True], m[1:] != m[:-1]]).cumsum() - 1
            same = np.concatenate([[True], (m[1:] != m[:-1]) | (c[1:] != c[:-1])])
            content = same.cumsum() - 1
            copies = np.bincount(content)[content]
            kinds = np.bincount(bucket, weights=same).astype(np.int64)[bucket]
            # an equal super-k-mer settles all; its first stands for it where the bucket has others
            weight = np.where(copies > 1, 0, 1)
            ask = np.flatnonzero((copies == 1) & (kinds > 1))
            stand = np.flatnonzero((copies > 1) & (kinds > 1) & same)
            pick = np.concatenate([np.flatnonzero(copies > 1), ask, stand])
            weight = np.concatenate([weight[pick[: len(pick) - len(stand)]], np.full(len(stand), 2)])
            if not len(pick):
                return None
            out = t.select([n for n in schema.names if n != "weight"]).take(pa.array(pick)).combine_chunks()
            return out.append_column("weight", pa.array(weight.astype(np.int64))).to_batches()

        held: list[pa.RecordBatch] = []
        for batch in rows:
            if not batch.num_rows:
                continue
            m = batch.column("minimiser").to_numpy()
            cut = int(np.flatnonzero(m == m[-1])[0])  # the last bucket may go on in the next batch
            if cut or (held and held[-1].column("minimiser")[-1].as_py() != m[0]):
                done = pa.Table.from_batches([*held, *([batch.slice(0, cut)] if cut else [])])
                yield from settled(done) or []
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from settled(pa.Table.from_batches(held)) or []

    ordered = parts.repartition("minimiser").sortWithinPartitions("minimiser", "content")
    return ordered.mapInArrow(judge, names)


def _judged_hot(parts: DataFrame) -> DataFrame:
    """As `_judged`, for crowded buckets: equal super-k-mers are counted with partial sums and joined back."""
    row = F.xxhash64("doc_key", "text_hash", "start")
    rows = parts.withColumn("row", row)
    counts = rows.groupBy("minimiser", "content").agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("stand"))
    both = rows.join(counts, ["minimiser", "content"])
    copies = F.when(F.col("copies") == 1, F.array(F.lit(1))).otherwise(
        F.when(F.col("row") == F.col("stand"), F.array(F.lit(0), F.lit(2))).otherwise(F.array(F.lit(0)))
    )
    return both.withColumn("weight", F.explode(copies.cast("array<long>"))).select(
        "doc_key", "text_hash", "start", "windows", "minimiser", "weight"
    )


def _strings(docs: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """The words of super-k-mers as packed strings."""
    per_doc = asked.groupBy("doc_key", "text_hash").agg(
        F.collect_list(F.struct("start", "windows", "minimiser", "weight", "crowded")).alias("parts")
    )
    names = f"{PLACE}, minimiser long, weight long, crowded boolean, packed binary"
    schema = _long_schema(names)

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                words = words_of(row["text"])
                same = {n: row[n] for n in ("doc_key", "text_hash")}
                found = [
                    same | p | {"packed": b" ".join(words[p["start"] : p["start"] + p["windows"] + window - 1])}
                    for p in row["parts"]
                ]
                yield pa.RecordBatch.from_pylist(found, schema=schema)

    return docs.join(per_doc, ["doc_key", "text_hash"]).mapInArrow(cut, names)


def _counted(strings: DataFrame, window: int) -> DataFrame:
    """Repeated windows among the strings of each bucket, as places."""
    schema = _long_schema(PLACE)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(group: list[dict]) -> list[dict]:
            if len(group) < 2:
                return []
            found = repeated_in_bucket([g["packed"] for g in group], [g["weight"] for g in group], window)
            return [
                {"doc_key": g["doc_key"], "text_hash": g["text_hash"], "start": g["start"] + a, "windows": n}
                for g, places in zip(group, found)
                if g["weight"] == 1
                for a, n in intervals(places)
            ]

        group: list[dict] = []
        for batch in rows:
            out: list[dict] = []
            for row in batch.to_pylist():
                if group and group[0]["minimiser"] != row["minimiser"]:
                    out += finish(group)
                    group = []
                group.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if group and (out := finish(group)):
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    ordered = strings.repartition("minimiser").sortWithinPartitions("minimiser")
    return ordered.mapInArrow(count, PLACE)


def _counted_hot(strings: DataFrame, window: int) -> DataFrame:
    """Repeated windows of crowded buckets: every window is a row, counted by its words."""
    names = "doc_key long, text_hash long, place long, weight long, words binary"
    schema = _long_schema(names)

    def spread(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                words = row["packed"].split()
                n = row["windows"]
                out = {c: [row[c]] * n for c in ("doc_key", "text_hash", "weight")}
                out["place"] = [row["start"] + i for i in range(n)]
                out["words"] = [hashlib.sha256(b" ".join(words[i : i + window])).digest() for i in range(n)]
                yield from batches(out, schema)

    windows = strings.select("doc_key", "text_hash", "start", "windows", "weight", "packed").mapInArrow(spread, names)
    twice = windows.groupBy("words").agg(F.sum("weight").alias("found")).where(F.col("found") > 1).select("words")
    return windows.where("weight = 1").join(twice, "words").select(
        "doc_key", "text_hash", F.col("place").alias("start"), F.lit(1).cast("long").alias("windows")
    )


def _crowded(rows: DataFrame, most: int) -> DataFrame:
    """The minimisers with more than so many rows; few by nature, at most rows / most."""
    counts = rows.groupBy("minimiser").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    return written(counts.select("minimiser", F.lit(True).alias("crowded")), "crowded-minimisers")


def repeated_places(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, hot_strings: int = HOT_STRINGS) -> DataFrame:
    """(doc_key, text_hash, start, windows): runs of windows whose words also start elsewhere, in any document."""
    parts = written(described(docs, window, gram), "super-k-mers")
    marked = parts.join(_crowded(parts, hot), "minimiser", "left")
    plain = _judged(marked.where("crowded is null").drop("crowded"))
    judged = written(plain.unionByName(_judged_hot(marked.where("crowded").drop("crowded"))), "judged-super-k-mers")
    asked = judged.where("weight > 0")
    asked = asked.join(_crowded(asked, hot_strings), "minimiser", "left").withColumn("crowded", F.col("crowded").isNotNull())
    strings = written(_strings(keyed(docs), asked, window), "packed-strings")
    place = ["doc_key", "text_hash", "start", "windows"]
    settled = judged.where("weight = 0").select(*place)
    counted = _counted(strings.where("not crowded"), window).unionByName(_counted_hot(strings.where("crowded"), window))
    return settled.unionByName(counted.select(*place))


def covered(words: int, places: list[dict] | None, window: int) -> np.ndarray:
    """For each word, whether a repeated window covers it."""
    edges = np.zeros(words + 1, np.int64)
    for p in places or []:
        edges[p["start"]] += 1
        edges[p["start"] + p["windows"] + window - 1] -= 1
    return edges[:-1].cumsum() > 0


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, hot_strings: int = HOT_STRINGS) -> DataFrame:
    """doc_id, text_hash, n_words, n_removed and ``kept`` (the words left, joined by one space) for each row.

    A null text has no words. Shorter documents than a window keep all words. Repeated rows repeat each other, so
    both lose all words that a window covers. Columns other than doc_id and text are not read; an empty table gives
    no rows.
    """
    places = repeated_places(docs, window, gram, hot, hot_strings)
    per_doc = places.groupBy("doc_key", "text_hash").agg(F.collect_list(F.struct("start", "windows")).alias("places"))
    names = "doc_key long, text_hash long, n_words long, n_removed long, kept string"
    schema = _long_schema(names)

    def remove(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                out: dict[str, list] = {n: part.column(n).to_pylist() for n in ("doc_key", "text_hash")}
                out |= {"n_words": [], "n_removed": [], "kept": []}
                for text, places in zip(part.column("text").to_pylist(), part.column("places").to_pylist()):
                    words = words_of(text)
                    gone = covered(len(words), places, window) if places else np.zeros(len(words), bool)
                    left = [w for w, g in zip(words, gone.tolist()) if not g] if places else words
                    out["n_words"].append(len(words))
                    out["n_removed"].append(int(gone.sum()))
                    out["kept"].append(b" ".join(left).decode("utf-8", "surrogatepass"))
                yield from batches(out, schema, 500)

    joined = keyed(docs).join(per_doc, ["doc_key", "text_hash"], "left")
    done = joined.mapInArrow(remove, names)
    return done.select(F.nullif("doc_key", F.lit(NO_ID)).alias("doc_id"), "text_hash", "n_words", "n_removed", "kept")


def removed_from(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` without repeated passages, in its own columns, ``n_chars`` counted anew.

    A document with repeats keeps its other words, joined by one space; others keep their text as it is, and a
    document that is repeated altogether keeps an empty text. Texts are shuffled once to their places.
    """

    def left(texts: pd.Series, starts: pd.Series, windows: pd.Series) -> pd.Series:
        def cut(text, start, windows):
            if start is None:
                return text
            words = words_of(text)
            places = [{"start": a, "windows": n} for a, n in zip(start, windows)]
            gone = covered(len(words), places, window).tolist()
            return b" ".join(w for w, g in zip(words, gone) if not g).decode("utf-8", "surrogatepass")

        return pd.Series([cut(*row) for row in zip(texts, starts, windows)], dtype=object)

    per_doc = repeated_places(docs, window, gram).groupBy(F.col("doc_key").alias("__key"), F.col("text_hash").alias("__hash")).agg(
        F.collect_list(F.struct("start", "windows")).alias("__places")
    )
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    same = (key == F.col("__key")) & (F.xxhash64("text") == F.col("__hash"))
    text = F.pandas_udf(left, "string")("text", "__places.start", "__places.windows")
    changed = docs.join(per_doc, same, "left").withColumn("text", text)
    return changed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
