"""Mixing sources to target weights, with DataFrame functions alone.

Every source gets a target of words: its weight's share of the size of the mix, never more than `CAP` times its own
size, the excess shared again by weight among the others until none is above. The documents of a source stand in the
order of a seeded digest of their id; whole passes over that order and the start of one more make up the target, the
last document being cut. Each pass falls into blocks of about `BLOCK_WORDS` words of neighbouring documents, so a
source has an exact quota of blocks.

The quotas go to the output shards down a splitting tree. A node holds a number of blocks of each source; its left
child gets a uniformly random half of them without replacement, so that the sources' numbers in it follow the
multivariate hypergeometric distribution, and the right child the rest. Ranking all blocks by a seeded digest makes
all the draws at once: a node is a range of ranks and a split cuts the range. Blocks go to shards whole and
disjointly, and each shard is then put in an order of its own.

Nothing is gathered in one task: running totals are taken over the 4096 ranges of the digest's first twelve bits,
summed before they shuffle, and inside each range, so a source or a mix of any size is dealt over many tasks. The
windows over all sources or all ranges have a row for each source, or 4096.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from finmarts.llm.common import WORD, written

WEIGHTS = (3, 1, 2)
SHARE, CAP = 1.5, 2.0
BLOCK_WORDS, SHARD_WORDS = 4096, 1 << 20
SEED = "mix-1"

#: Stands for a null id.
NO_ID = -(1 << 63)
SOURCE = ["source_key", "source_null"]


def words_in(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def digest(seed: str, *parts: str) -> Column:
    """Hex digest that orders rows at random, but alike in every run."""
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(p).cast("string"), F.lit("")) for p in parts]))


def _before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def source_targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``weight`` and ``target`` for each source of (source_key, source_null, source_size).

    Sources are taken in code point order, null last. Ordered by what they can take for a unit of weight, the capped
    ones come first: a source is capped if it can take less than the level that all from it onward would share.
    """
    place = F.row_number().over(Window.orderBy("source_null", "source_key")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    by_room = Window.orderBy("per_weight", *SOURCE)
    level = (F.lit(share) * F.sum("source_size").over(every) - _before("most", by_room)) / (
        F.sum("weight").over(every) - _before("weight", by_room)
    )
    uncapped = F.when(F.col("per_weight") >= F.col("level"), F.struct("per_weight", *SOURCE, "level"))
    return (
        sources.withColumn("weight", weight)
        .withColumn("most", F.lit(cap) * F.col("source_size"))
        .withColumn("per_weight", F.col("most") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("shared", F.min(uncapped).over(every)["level"])
        .withColumn("target", F.coalesce(F.least("most", F.col("weight") * F.col("shared")), F.col("most")))
        .select(*SOURCE, "source_size", "weight", "target")
    )


def positions(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and ``pos``, the words before the document in its source's order.

    Clashing columns are replaced. A null or empty text has size 0 and a null source is a source. Rows with the same
    id stand beside each other, smaller sizes first and then in the order of a hash of their text. An empty table stays empty.
    """
    sized = (
        docs.withColumn("size", words_in("text"))
        .withColumn("source_key", F.coalesce(F.col("source").cast("string"), F.lit("")))
        .withColumn("source_null", F.col("source").isNull())
        .withColumn("ticket", digest(seed, "doc_id"))
        .withColumn("range", F.substring("ticket", 1, 3))
        .withColumn("tie", F.xxhash64("text"))
    )
    ranges = written(sized.groupBy(*SOURCE, "range").agg(F.sum("size").alias("words")), "mix-ranges")
    sources = ranges.groupBy(*SOURCE).agg(F.sum("words").alias("source_size"))
    before = ranges.select(*SOURCE, "range", _before("words", Window.partitionBy(*SOURCE).orderBy("range")).alias("range_pos"))
    placed = before.join(source_targets(sources, weights, share, cap), SOURCE)
    inside = Window.partitionBy(*SOURCE, "range").orderBy("ticket", "size", "tie")
    clashing = [c for c in ("source_size", "weight", "target", "range_pos", "pos") if c in docs.columns]
    return (
        sized.drop(*clashing)
        .join(placed, [*SOURCE, "range"])
        .withColumn("pos", (F.col("range_pos") + _before("size", inside)).cast("long"))
        .drop("ticket", "range", "range_pos", "tie")
    )


def pieces(placed: DataFrame, cap: float = CAP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """A row for each pass that takes a document, with ``epoch``, ``length`` (words taken) and ``block``."""
    passes = F.explode(F.sequence(F.lit(0), F.lit(math.ceil(cap) - 1)))
    left = F.floor("target") - F.col("epoch") * F.col("source_size") - F.col("pos")
    return (
        placed.withColumn("epoch", passes)
        .withColumn("length", F.least("size", left).cast("long"))
        .where(F.col("length") > 0)
        .withColumn("block", F.floor(F.col("pos") / block_words).cast("long"))
    )


def shards_of_blocks(blocks: DataFrame, shards: int, seed: str = SEED) -> DataFrame:
    """``blocks`` (source_key, source_null, epoch, block) with the ``shard`` that the splitting tree gives each."""
    depth = shards.bit_length() - 1
    ranked = blocks.withColumn("draw", digest(seed + "-block", *SOURCE, "epoch", "block")).withColumn(
        "draw_range", F.substring("draw", 1, 3)
    )
    counts = ranked.groupBy("draw_range").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(
        "draw_range",
        _before("n", Window.orderBy("draw_range")).alias("ahead"),
        F.sum("n").over(Window.partitionBy()).alias("all_blocks"),
    )
    inside = F.row_number().over(Window.partitionBy("draw_range").orderBy("draw", *SOURCE, "epoch", "block")) - 1

    def child(node: Column, _level: Column) -> Column:
        half = F.floor((node["blocks"] + 1) / 2).cast("long")
        right = node["rank"] >= half
        return F.struct(
            (node["shard"] * 2 + right.cast("long")).alias("shard"),
            F.when(right, node["rank"] - half).otherwise(node["rank"]).alias("rank"),
            F.when(right, node["blocks"] - half).otherwise(half).alias("blocks"),
        )

    root = F.struct(F.lit(0).cast("long").alias("shard"), F.col("rank"), F.col("all_blocks").alias("blocks"))
    levels = F.sequence(F.lit(1), F.lit(depth)) if depth else F.array().cast("array<int>")
    return (
        ranked.join(before, "draw_range")
        .withColumn("rank", (F.col("ahead") + inside).cast("long"))
        .withColumn("shard", F.aggregate(levels, root, child)["shard"])
        .select(*SOURCE, "epoch", "block", "shard")
    )


def mix(placed: DataFrame, cap: float = CAP, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED) -> DataFrame:
    """The mix: the rows of `pieces` with ``shard`` and ``position``, their place in the shard.

    The number of shards is the power of two that gives each at most ``shard_words`` words.
    """
    per_source = placed.groupBy(*SOURCE).agg(F.max(F.floor("target")).alias("words"))
    words = per_source.agg(F.sum("words")).first()[0] or 0
    shards = 1 << max(0, math.ceil(math.log2(max(1, words / shard_words))))
    taken = pieces(placed, cap, block_words)
    blocks = shards_of_blocks(taken.select(*SOURCE, "epoch", "block").distinct(), shards, seed)
    local = Window.partitionBy("shard").orderBy("local", *SOURCE, "epoch", "pos")
    return (
        taken.join(blocks, [*SOURCE, "epoch", "block"])
        .withColumn("local", digest(seed + "-local", *SOURCE, "epoch", "pos"))
        .withColumn("position", F.row_number().over(local) - 1)
        .drop("local")
    )


def mixed_text(text: str, length: str, size: str) -> Column:
    """The words a piece takes: the text itself if all of them, else the first ones joined by one space."""
    first = F.slice(F.regexp_extract_all(F.col(text), F.lit(f"({WORD})"), F.lit(1)), F.lit(1), F.col(length).cast("int"))
    return F.when(F.col(length) == F.col(size), F.col(text)).otherwise(F.array_join(first, " "))


def digest_per_document(docs: DataFrame) -> DataFrame:
    """Size, target and words taken of each document of the mix, with the first shard that holds some of it."""
    placed = written(positions(docs.select("doc_id", "text", "source")).drop("text"), "mix-positions")
    taken = mix(placed).groupBy(*SOURCE, F.col("pos").alias("at")).agg(
        F.sum("length").alias("words"), F.min("shard").alias("first_shard")
    )
    same = [placed[c] == taken[c] for c in SOURCE] + [placed["pos"] == taken["at"], placed["size"] > 0]
    return placed.join(taken, same, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).alias("taken"), "first_shard"
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents: a row for each piece, in the columns of ``docs``, shard by shard in the shards' order.

    The mix is made of ids, hashes, sources and sizes; texts are joined to the finished pieces. Equal rows stand for
    each other, so one of them gives its text to all their pieces.
    """
    keys = {"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "__hash": F.xxhash64(*docs.columns)}
    narrow = docs.withColumns(keys).select("doc_id", "text", "source", *keys)
    taken = mix(written(positions(narrow).drop("text"), "mix-positions")).select(
        *keys, *[F.col(c).alias(f"__{c}") for c in ("shard", "position", "length", "size")]
    )
    texts = docs.withColumns(keys).dropDuplicates(list(keys))
    text = mixed_text("text", "__length", "__size")
    whole = texts.join(taken, list(keys)).withColumn("text", text)
    changed = {"n_chars": F.length("text").cast("long")}
    ordered = whole.repartition("__shard").sortWithinPartitions("__shard", "__position")
    return ordered.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])
