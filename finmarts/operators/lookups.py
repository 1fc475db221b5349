"""Fact-to-dimension joins that stay balanced when one key dominates."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_side(dim: DataFrame) -> DataFrame:
    """Prepare a deduplicated table to be the unique side of a join.

    A table that leaves ``latest`` is already partitioned by its key, so Spark joins
    it without another shuffle. That shape keeps adaptive execution from splitting a
    hot key of the fact side: both join inputs must be plain shuffles for that. The
    rebalance puts a size-driven shuffle in between, which costs one pass over the
    smaller side, and the fact side of a hot key is then read by many tasks.

    No broadcast is forced. Spark broadcasts the side itself while its size is
    below ``spark.sql.autoBroadcastJoinThreshold``, before or during the run.
    """
    return dim.hint("rebalance")
