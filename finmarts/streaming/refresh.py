"""The fact refresh fed by newly arrived files instead of a full source.

The batch refresh re-reads its source from the lookback on. Where rows arrive as
files, the arrivals themselves are the batch: none is left out for its date, and a
row replaces a stored one only if its version is as new or newer. The table is
therefore the same however the arrivals are cut into micro-batches and in whatever
order the files come.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from finmarts.operators.latest import LOAD_ORDER, latest
from finmarts.operators.upsert import upsert_table


def refresh_from(
    arriving: DataFrame, path: str, key: str, date: str, checkpoint: str, order: Sequence[str] = LOAD_ORDER
) -> StreamingQuery:
    """Upsert everything that has arrived into the table at ``path`` and stop.

    Deleted rows (``_is_deleted`` other than 0) are dropped before the newest
    version is taken, as in the clean layer. The table keeps the version columns in
    ``order``. A batch that is replayed after a failure changes nothing.
    """

    def apply(batch: DataFrame, _: int) -> None:
        live = batch.where(F.col("_is_deleted") == 0) if "_is_deleted" in batch.columns else batch
        upsert_table(latest(live, [key], order), path, key, date, lookback=None, version=order)

    writer = arriving.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
