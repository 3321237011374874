"""Daily facts kept by event time: a state store for open days, recomputed days for late rows.

Two queries read the same stream.  One sums rows by day and key in a state store and
writes what changed in a batch; its watermark closes days, and rows for closed days are
not summed there.  The other notes the days of all rows that may be that late.  Then these
days are computed again from all landed rows and replaced, so that no row is lost and
state stays bounded by the days that are open.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ledgerlight.functions.time import as_column
from ledgerlight.session import holding, staged
from ledgerlight.sources.tables import write_partitions
from ledgerlight.streaming.incremental import exists, replace_groups, upsert_partitions

#: The day of event time that a partial row belongs to, the folder of that day, and the batch that wrote it.
DAY, FOLDER, BATCH = "event_day", "event_period", "batch_id"
NOTES = f"{DAY} date, newest timestamp, {BATCH} bigint"
#: Where the sums of open days are: on the local disks, within a bound of memory for all
#: state stores of an executor, not in its heap.  A stream that began otherwise goes on so.
STORES = "spark.sql.streaming.stateStore"
STATE = {
    f"{STORES}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{STORES}.rocksdb.boundedMemoryUsage": "true",
    f"{STORES}.rocksdb.maxMemoryUsageMB": "256",
    f"{STORES}.rocksdb.trackTotalNumberOfRows": "false",
}
#: Rows of a recomputed day: any later update of the state store replaces them.
RECOMPUTED = -1


@dataclass(frozen=True)
class DailyFact:
    """A fact as sums by key: what is summed, from which rows, and how sums are put together.

    ``rows`` turns landed rows into rows to be summed, one by one; it may join static
    tables.  ``parts`` are aggregates over rows, ``merged`` aggregates over parts.
    ``period`` is the time that a folder holds: a batch rewrites the folders that it has
    rows of, so ``day`` suits many rows a day, ``month`` or ``year`` few over a long time.
    """

    rows: Callable[[DataFrame], DataFrame]
    keys: Mapping[str, Column]
    parts: Mapping[str, Column]
    merged: Mapping[str, Column]
    at: str
    period: str = "day"

    def of_days(self, rows: DataFrame) -> DataFrame:
        """Parts by day and key."""
        keys = [column.alias(name) for name, column in self.keys.items()]
        window = F.window(self.at, "1 day").alias("__window")
        sums = self.rows(rows).groupBy(window, *keys).agg(*[c.alias(n) for n, c in self.parts.items()])
        start = F.col("__window.start")
        folder = F.date_trunc(self.period, start).cast("date").alias(FOLDER)
        return sums.select(start.cast("date").alias(DAY), *self.keys, *self.parts, folder)

    def read(self, spark: SparkSession, target: str) -> DataFrame:
        """The fact by key over all days."""
        parts = spark.read.parquet(f"{target}/parts")
        return parts.groupBy(*self.keys).agg(*[c.alias(n) for n, c in self.merged.items()])


def run_daily(fact: DailyFact, stream: DataFrame, landed: DataFrame, target: str, delay: str) -> list[date]:
    """Take all new files of ``stream`` into the fact at ``target``; the days that were recomputed.

    ``landed`` is a batch read of the same files.  ``delay`` is how long days stay open
    after their end, such as ``2 days``.  A run that broke off is started again: batches
    replace what they have written, and days noted but not recomputed stay noted.
    """
    spark = landed.sparkSession
    sums = fact.of_days(stream.withWatermark(fact.at, delay)).writeStream.outputMode("update").foreachBatch(_merge(fact, target, spark))
    with holding(spark, STATE):
        done = _ran(sums, f"{target}/progress-sums")
    # the watermark only grows: no row that this run left out is newer than its last one
    closed = [p["eventTime"]["watermark"] for p in done.recentProgress if p["numInputRows"] and p["eventTime"].get("watermark")]
    notes = stream.writeStream.foreachBatch(_note(fact.at, delay, target, closed[-1] if closed else None))
    _ran(notes, f"{target}/progress-notes")
    return recompute_late_days(fact, landed, target)


def _ran(writer: DataStreamWriter, progress: str) -> StreamingQuery:
    query = writer.option("checkpointLocation", progress).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _merge(fact: DailyFact, target: str, spark: SparkSession) -> Callable[[DataFrame, int], None]:
    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = staged(batch.withColumn(BATCH, F.lit(batch_id).cast("bigint")), spark)
        # the folder follows from the day, so only folders of the batch are read and rewritten
        upsert_partitions(rows, f"{target}/parts", [DAY, *fact.keys], [BATCH], FOLDER, follows_key=True)

    return merge


def _note(at: str, delay: str, target: str, closed: str | None) -> Callable[[DataFrame, int], None]:
    """Note the days of rows from before ``closed``, the watermark that the sums have reached.

    Where it is not known, since the sums were made by a run that broke off, it is the
    newest row's time less ``delay``.  Rows of the same batch count for the newest, so
    every row that the sums leave out is noted, wherever their batches began.
    """

    def note(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = read_notes(spark, target).filter(F.col(BATCH) < batch_id).select("newest")
        newest = batch.select(F.col(at).alias("newest")).unionByName(earlier).agg(F.max("newest").cast("string")).first()[0]
        bound = as_column(newest) - F.expr(f"interval {delay}") if closed is None else as_column(closed)
        days = batch.filter(F.col(at) < bound).select(F.col(at).cast("date").alias(DAY)).distinct()
        rows = days.unionByName(spark.range(1).select(F.lit(None).cast("date").alias(DAY)))
        noted = rows.select(DAY, as_column(newest).alias("newest"), F.lit(batch_id).cast("bigint").alias(BATCH))
        write_partitions(noted.coalesce(1), f"{target}/notes", [BATCH])

    return note


def read_notes(spark: SparkSession, target: str) -> DataFrame:
    """Late days by batch, each with the newest event time by then."""
    if not exists(spark, f"{target}/notes"):
        return spark.createDataFrame([], NOTES)
    return spark.read.schema(NOTES).parquet(f"{target}/notes")


def recompute_late_days(fact: DailyFact, landed: DataFrame, target: str) -> list[date]:
    """Replace the noted days that are not recomputed yet by what ``landed`` says of them."""
    spark = landed.sparkSession
    done = f"{target}/recomputed"
    upto = spark.read.schema(f"upto bigint, {BATCH} bigint").parquet(done).agg(F.max("upto")).first()[0] if exists(spark, done) else None
    open_ = read_notes(spark, target).filter(F.col(BATCH) > (-1 if upto is None else upto))
    last = open_.agg(F.max(BATCH)).first()[0]
    if last is None:
        return []
    days = sorted(r[0] for r in open_.select(DAY).filter(F.col(DAY).isNotNull()).distinct().collect())
    if days:
        start, end = (as_column(f"{d}") for d in (days[0], days[-1] + timedelta(days=1)))
        at = F.col(fact.at)
        rows = landed.filter((at >= start) & (at < end) & at.cast("date").isin(days))
        sums = staged(fact.of_days(rows).withColumn(BATCH, F.lit(RECOMPUTED).cast("bigint")))
        noted = spark.createDataFrame([(d,) for d in days], f"{DAY} date")
        gone = noted.withColumn(FOLDER, F.date_trunc(fact.period, DAY).cast("date"))
        replace_groups(sums, f"{target}/parts", gone, FOLDER)
    record = spark.createDataFrame([(last, last)], f"upto bigint, {BATCH} bigint")
    write_partitions(record, done, [BATCH])
    return days
