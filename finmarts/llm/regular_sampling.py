"""Exact ranks of a large table by parallel sorting by regular sampling.

Every task sorts its own rows into a run. Rows at a regular stride of each run are the sample, whose own sorted order
gives splitters at regular places; with them every segment holds about as many rows as the others, whatever the keys.
Runs exchange segments, each segment is merged locally, and the prefix counts of the segments turn a row's place in
its segment into its rank. Row numbers inside the runs are the last key, so even equal rows are dealt out evenly.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from finmarts.llm.common import written

#: Rows that a segment is to hold, and the most segments there are; the sample has at most MOST_SEGMENTS squared rows
#: and one for each run.
SEGMENT_ROWS, MOST_SEGMENTS = 1 << 14, 2048
PLACE_BITS = 33


def segment_of(keys: Sequence[np.ndarray], splitters: Sequence[np.ndarray]) -> np.ndarray:
    """For each row the number of splitters that are not above it, comparing the keys one after another."""
    low = np.zeros(len(keys[0]), np.int64)
    high = np.full(len(keys[0]), len(splitters[0]), np.int64)
    while (open_ := low < high).any():
        middle = (low + high) // 2
        at = np.minimum(middle, len(splitters[0]) - 1)
        above = np.zeros(len(low), bool)  # the splitter is above the row
        equal = np.ones(len(low), bool)
        for k, s in zip(keys, splitters):
            above |= equal & (s[at] > k)
            equal &= s[at] == k
        high = np.where(open_ & above, middle, high)
        low = np.where(open_ & ~above, middle + 1, low)
    return low


def exact_ranks(df: DataFrame, keys: Sequence[str], segment_rows: int = SEGMENT_ROWS, most: int = MOST_SEGMENTS) -> DataFrame:
    """``df`` with ``rank``, from 1, in ascending order of ``keys``, which are long columns without nulls.

    Rows that agree in all keys get different ranks, in no stated order. An empty table gives no rows. The columns
    ``__run_place`` and ``__segment`` must not be in ``df``.
    """
    order = [*keys, "__run_place"]
    runs = written(df.sortWithinPartitions(*keys).withColumn("__run_place", F.monotonically_increasing_id()), "sorted-runs")
    total = runs.count()
    segments = max(1, min(most, -(-total // segment_rows)))
    stride = max(1, total // segments**2)
    place = F.col("__run_place").bitwiseAND((1 << PLACE_BITS) - 1)
    sample = runs.where(place % stride == 0).select(*order)
    numbered = sample.withColumn("__at", F.row_number().over(Window.orderBy(*order)))
    step = max(1, -(-total // stride) // segments)
    chosen = numbered.where((F.col("__at") % step == 0) & (F.col("__at") < step * segments)) if segments > 1 else None
    splitters = [np.array(c, np.int64) for c in zip(*sorted(tuple(r[k] for k in order) for r in chosen.collect()))] if chosen is not None else []

    def place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, np.int64)
            if splitters:
                found = segment_of([batch.column(k).to_numpy() for k in order], splitters)
            yield batch.append_column("__segment", pa.array(found))

    schema = StructType([*runs.schema.fields, StructField("__segment", LongType())])
    placed = runs.mapInArrow(place_rows, schema)
    counts = placed.groupBy("__segment").agg(F.count(F.lit(1)).alias("__rows"))
    # at most MOST_SEGMENTS rows
    before = F.sum("__rows").over(Window.orderBy("__segment").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("__segment", F.coalesce(before, F.lit(0)).alias("__before"))
    merged = placed.withColumn("__in", F.row_number().over(Window.partitionBy("__segment").orderBy(*order)))
    ranked = merged.join(F.broadcast(counts), "__segment")
    return ranked.select(*df.columns, (F.col("__in").cast("long") + F.col("__before")).alias("rank"))
