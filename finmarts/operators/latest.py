"""Keep-latest, replace-by-key and sum-merge."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from finmarts.functions.numeric import TOTAL

#: Newest load first; batch and content hash make ties deterministic.
LOAD_ORDER = ("_ingested_at", "_batch_id", "_row_hash")
ROW_HASH = LOAD_ORDER[-1]
#: Keeps one row for each value of the key columns.
Keep = Callable[[DataFrame, Sequence[str]], DataFrame]


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str] = LOAD_ORDER) -> DataFrame:
    """One row per key: the highest in ``order``.

    Written as ``row_number() = 1`` because Spark then limits every key to one row
    inside each map task before the shuffle, so a key holding a large part of the
    table sends one row per task instead of its whole group.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def first_of_few(df: DataFrame, keys: Sequence[str], order: Sequence[str] = LOAD_ORDER) -> DataFrame:
    """As `latest`, for tables whose keys have few rows each, such as load versions.

    The cut before the shuffle sorts every map task's rows, whole, by key. Where hardly a key repeats within a task that
    saves nothing, and large files spill all their rows. Here rows are sorted after the shuffle only, in as many parts
    as there are shuffle partitions. All rows of a key meet in one task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    met = _meeting(df, keys) if ROW_HASH in order and ROW_HASH not in keys and _is_text(df, ROW_HASH) else df
    # not a rank: Spark would put the cut back in
    behind = met.withColumn("_behind", F.lag(F.lit(True)).over(newest))
    return behind.where(F.col("_behind").isNull()).drop("_behind")


def _is_text(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType == StringType()


def _meeting(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows brought together by key, of which the row hash travels as bytes where it is written in hex digits.

    The hash is half of a narrow row and doesn't compress. It is text again before anything compares it; a hash that
    its bytes wouldn't give back letter by letter travels as it is.
    """
    same = F.lower(F.hex(F.unhex(ROW_HASH))) == F.col(ROW_HASH)
    packed = df.select(
        *[c for c in df.columns if c != ROW_HASH],
        F.when(same, F.unhex(ROW_HASH)).alias("_hash_bytes"),
        F.when(~F.coalesce(same, F.lit(False)), F.col(ROW_HASH)).alias("_hash_text"),
    )
    text = F.coalesce(F.lower(F.hex("_hash_bytes")), "_hash_text").alias(ROW_HASH)
    return packed.repartition(*keys).select(*[text if c == ROW_HASH else c for c in df.columns])


def latest_live(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = LOAD_ORDER,
    tombstone_wins: bool = False,
) -> DataFrame:
    """Latest row per key without soft-deleted ones.

    By default deleted rows are dropped first, so an older row comes back when
    only the newest was deleted. With ``tombstone_wins`` the deletion removes the key.
    """
    live = F.col("_is_deleted") == 0
    if tombstone_wins:
        return latest(df, keys, order).where(live)
    return first_of_few(df.where(live), keys, order)


def replace_by_key(
    current: DataFrame, incoming: DataFrame, keys: Sequence[str], version: str = "_loaded_at_ts"
) -> DataFrame:
    """Current and incoming rows with the highest version per key.

    On equal versions the incoming row wins; equal rows on the same side are told
    apart by content, so a rerun gives the same table.
    """
    both = current.withColumn("_side", F.lit(0)).unionByName(incoming.withColumn("_side", F.lit(1)))
    content = [c for c in current.columns if c not in {*keys, version}]
    return latest(both, keys, [version, "_side", *content]).drop("_side")


def sum_merge(parts: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Add up partial aggregates that share a key.

    Only additive measures make sense here, so every column must be declared as a
    key or as a measure: ratios and distinct counts have to be recomputed instead.
    """
    for part in parts:
        extra = set(part.columns) - set(keys) - set(measures)
        if extra:
            raise ValueError(f"neither key nor additive measure: {sorted(extra)}")
    rows = reduce(DataFrame.unionByName, parts)
    for name in measures:
        kind = rows.schema[name].dataType.simpleString()
        if kind in ("float", "double"):
            raise ValueError(f"{name} is {kind}: ratios are not additive, recompute them")
    return rows.groupBy(*keys).agg(*[_total(rows, name).alias(name) for name in measures])


def _total(rows: DataFrame, name: str) -> Column:
    total = F.sum(name)
    return total.cast(TOTAL) if rows.schema[name].dataType.simpleString().startswith("decimal") else total
