"""Which ranges of a key hold other rows than before, told from sums of row hashes.

Every row is read, but only the sums are moved. Rows may be new, changed or gone, and may have come in any order: a range
whose sums are as before holds the same rows, and all rows of a key lie in one range.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

#: Ranges when a table's keys are first cut, and the most its keys may come to span before they are cut anew.
RANGES, MOST_RANGES = 1024, 4096
#: Range of rows without a key.
NO_KEY = -(1 << 63)
#: Marks of a manifest that hold the width of the ranges and their sums.
WIDTH, SUMS = "range_width", "range_sums"


@dataclass(frozen=True)
class Ranges:
    """Keys a range, and per range the number of its rows with the sums of both halves of their hashes."""

    width: int
    sums: dict[int, str]

    def marks(self) -> dict[str, str]:
        return {WIDTH: str(self.width), SUMS: json.dumps({str(k): v for k, v in sorted(self.sums.items())})}

    def changed(self, before: Ranges) -> list[int]:
        return sorted(k for k in {*self.sums, *before.sums} if self.sums.get(k) != before.sums.get(k))


def noted(marks: dict[str, str]) -> Ranges | None:
    """The ranges that a manifest's marks hold, if any."""
    if WIDTH not in marks or SUMS not in marks:
        return None
    return Ranges(int(marks[WIDTH]), {int(k): v for k, v in json.loads(marks[SUMS]).items()})


def range_of(key: str, width: int) -> Column:
    # `div` divides whole numbers, which the operator would turn into doubles
    return F.coalesce(F.expr(f"cast(`{key}` as bigint) div {width}L"), F.lit(NO_KEY))


def in_ranges(key: str, width: int, ranges: Iterable[int]) -> Column:
    return range_of(key, width).isin(list(ranges))


def ranges_of(rows: DataFrame, key: str, before: Ranges | None = None) -> Ranges:
    """The ranges of a table's rows; as wide as they were before, unless its keys have come to span too many."""
    ends = rows.agg(F.min(F.col(key).cast("long")).alias("first"), F.max(F.col(key).cast("long")).alias("last")).first()
    span = ends.last - ends.first + 1 if ends.first is not None else 1
    width = before.width if before is not None and span <= before.width * MOST_RANGES else -(-span // RANGES)
    hashed = F.xxhash64(*rows.columns)
    halves = rows.select(
        range_of(key, width).alias("range"), hashed.bitwiseAND((1 << 32) - 1).alias("low"), F.shiftrightunsigned(hashed, 32).alias("high")
    )
    sums = halves.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.sum("low").alias("low"), F.sum("high").alias("high"))
    # at most MOST_RANGES, and those without a key
    return Ranges(width, {r.range: f"{r.n}:{r.low}:{r.high}" for r in sums.collect()})
