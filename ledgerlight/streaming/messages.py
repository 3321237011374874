"""Landed message documents kept as a table by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlight.session import staged
from ledgerlight.sources.documents import flatten_messages
from ledgerlight.streaming.incremental import upsert_partitions

#: Folder column of the stored messages.
DAY = "created_day"


def stream_messages(
    stream: DataFrame, users: DataFrame, target: str, checkpoint: str, remember: str = "7 days", period: str = "day"
) -> StreamingQuery:
    """Flatten new message documents and upsert them by message id.

    A version of a message that was seen within ``remember`` is dropped by a keyed state
    store before it is flattened.  It remembers by the time of the batch, which only
    grows, so that no document is ever too late.  Whatever comes again after that, or
    after a failure, meets the upsert: the version updated last stays, and an older one
    that lands later changes nothing.  A message keeps the time of its creation, by whose
    day the table is stored, so a batch reads and rewrites the days of its messages.
    ``period`` is the time that a folder holds, named by its first day: ``day`` suits many
    messages a day, ``month`` or ``year`` few over a long time.
    """
    spark = stream.sparkSession
    seen = (
        stream.withColumns(
            {"__id": F.coalesce("message_id", "id"), "__version": F.col("last_updated_timestamp"), "__seen": F.current_timestamp()}
        )
        .withWatermark("__seen", remember)
        .dropDuplicatesWithinWatermark(["__id", "__version"])
        .drop("__id", "__version", "__seen")
    )

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = flatten_messages(batch, users).withColumn(DAY, F.date_trunc(period, "created_timestamp").cast("date"))
        upsert_partitions(staged(rows, spark), target, ["message_id"], ["last_updated_timestamp"], DAY, follows_key=True)

    return seen.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
