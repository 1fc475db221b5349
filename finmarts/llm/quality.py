"""Quality rules: a document's own figures and the lines that its host repeats across documents.

A line is normalised (A-Z in lower case, digits as 0, white space as single spaces) and hashed. A line of a host
that stands in more than `HOST_SHARE` of the host's distinct documents, and in more than `LEAST_DOCUMENTS` of them, is
removed; a document that keeps less than `KEPT_SHARE` of its words is depleted and goes. Documents with the same text
count once, so that a clean document isn't taken for boilerplate because it was copied; copies are for deduplication.
The pipeline's stage (`cleaned`) counts a group of near copies once for the same reason; the registered query's SQL
counts distinct texts.

Lines are counted with partial sums, so a line in a third of all documents shuffles a row a task. The lines above the
limit are few by nature: a host whose documents have L lines on average has at most L / `HOST_SHARE` of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from finmarts.llm.common import batches, written
from finmarts.llm.near_copies import classes

HOST_SHARE, LEAST_DOCUMENTS, KEPT_SHARE = 0.05, 10, 0.5
LEAST_WORDS, REPEAT_PERCENT = 50, 50

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
DIGITS = bytes.maketrans(b"123456789", b"000000000")


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words covered by a window of ``width`` words that is found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    keys = ids[:n]
    for step in range(1, width):
        if len(numbers) * (int(keys.max()) + 1) >= 1 << 62:
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * len(numbers) + ids[step : step + n]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for step in range(width):
        covered[step : step + n] |= twice
    return int(covered.sum())


def normal_line(line: bytes) -> bytes:
    return b" ".join(line.lower().split()).translate(DIGITS)


def line_hash(line: bytes) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(normal_line(line), seed=42)).astype(np.int64))


def measures(text: str | None) -> dict:
    """A document's own figures and its distinct normalised lines with their words."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    seen: set[bytes] = set()
    lines: dict[int, int] = {}
    duplicates = 0
    for line in data.split(b"\n"):
        n = len(line.split())
        if n:
            duplicates += line in seen
            seen.add(line)
            key = line_hash(line)
            lines[key] = lines.get(key, 0) + n
    return {
        "n_words": len(words),
        "word_chars": len(text) - sum(map(text.count, SPACES)),
        "n_symbols": sum(map(text.count, SYMBOLS)),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeated_words(words),
        "lines": [{"line": k, "words": v} for k, v in lines.items()],
    }


LINES = "array<struct<line:bigint,words:bigint>>"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, host (the source), a hash of the text, the document's own figures and its lines."""
    lines = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))
    kept = [("doc_id", pa.int64()), ("host", pa.string()), ("text_hash", pa.int64())]
    schema = pa.schema([*kept, *[(c, pa.int64()) for c in BASE], ("lines", lines)])

    def measure(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                out = {n: part.column(n).to_pylist() for n, _ in kept}
                found = [measures(t) for t in part.column("text").to_pylist()]
                yield from batches(out | {c: [f[c] for f in found] for c in (*BASE, "lines")}, schema)

    chosen = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("host"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("string").alias("text"),
    )
    return chosen.mapInArrow(
        measure, "doc_id long, host string, text_hash long, " + ", ".join(f"{c} long" for c in BASE) + f", lines {LINES}"
    )


def frequent_lines(
    figures: DataFrame, share: float = HOST_SHARE, least: int = LEAST_DOCUMENTS, groups: DataFrame | None = None
) -> DataFrame:
    """One row per host: host_key, host_null and ``frequent``, the hashes of its lines above the limits.

    With ``groups`` (text_hash, group) the texts of a group count once, otherwise each distinct text does.
    """
    counted = figures.withColumn("group", F.col("text_hash")) if groups is None else figures.join(groups, "text_hash")
    hosts = counted.select(
        F.coalesce("host", F.lit("")).alias("host_key"), F.col("host").isNull().alias("host_null"), "group", "lines"
    )
    sizes = hosts.groupBy("host_key", "host_null").agg(F.count_distinct("group").alias("documents"))
    counts = (
        hosts.select("host_key", "host_null", "group", F.explode("lines.line").alias("line"))
        .groupBy("host_key", "host_null", "line")
        .agg(F.count_distinct("group").alias("holding"))
        .where(F.col("holding") > least)
    )
    above = (F.col("holding") > share * F.col("documents")) & (F.col("holding") > least)
    return (
        counts.join(sizes, ["host_key", "host_null"])
        .where(above)
        .groupBy("host_key", "host_null")
        .agg(F.array_sort(F.collect_list("line")).alias("frequent"))
    )


def quality(docs: DataFrame, kept_share: float = KEPT_SHARE, groups: DataFrame | None = None) -> DataFrame:
    """The verdict on each document: doc_id, its figures, base_failed, n_removed_words, kept and ``frequent``.

    A null or blank text has no words and fails; a null source is a host of its own; repeated rows are judged alike
    and each gets a row. Columns other than doc_id, text and source are not read; an empty table gives no rows.
    """
    figures = written(measured(docs), "quality-figures")
    keyed = figures.withColumn("host_key", F.coalesce("host", F.lit(""))).withColumn("host_null", F.col("host").isNull())
    # a row per host that has such lines: written, so that Spark knows the size and need not deal rows out by host
    lines = written(frequent_lines(figures, groups=groups), "frequent-lines")
    judged = keyed.join(lines, ["host_key", "host_null"], "left")
    common = F.filter("lines", lambda x: F.array_contains(F.col("frequent"), x["line"]))
    removed = F.when(F.col("frequent").isNull(), F.lit(0)).otherwise(
        F.aggregate(common, F.lit(0).cast("long"), lambda total, x: total + x["words"])
    )
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    enough = F.col("n_words") - F.col("n_removed_words") >= kept_share * F.col("n_words")
    return (
        judged.withColumn("n_removed_words", removed.cast("long"))
        .withColumn("base_failed", base)
        .withColumn("kept", ~F.col("base_failed") & enough)
        .select("doc_id", "text_hash", *BASE, "base_failed", "kept", "n_removed_words", "frequent")
    )


def without_lines(text: str, frequent: list[int]) -> str:
    """The text without the lines whose hashes are in ``frequent``."""
    gone = set(frequent)
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    kept = [line for line in lines if not line.split() or line_hash(line) not in gone]
    return b"\n".join(kept).decode("utf-8", "surrogatepass")


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents that pass, without the lines above the limits; the columns of ``docs``, whatever their names.

    A group of near copies counts once when lines are counted, so that near-dedup can keep one of it.
    """
    groups = written(classes(docs).select("text_hash", "group").distinct(), "text-groups")
    verdicts = quality(docs, groups=groups).where("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("frequent").alias("__frequent")
    ).dropDuplicates(["__id", "__hash"])
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    cut = F.pandas_udf(_cut, "string")
    text = F.when(F.size("__frequent") > 0, cut("text", "__frequent")).otherwise(F.col("text"))
    passed = docs.join(verdicts, same).withColumn("text", text)
    return passed.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def _cut(texts: pd.Series, frequents: pd.Series) -> pd.Series:
    return texts.combine(frequents, lambda text, frequent: without_lines(text, [] if frequent is None else frequent))
