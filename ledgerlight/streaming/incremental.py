"""Incremental loads: high-water marks, a stream of daily partial sums, and upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlight.functions.time import Instant, as_column
from ledgerlight.operators.versions import latest_version
from ledgerlight.session import staged
from ledgerlight.sources.tables import write_partitions

MARKS = "source string, workspace_id string, high_mark timestamp"


def no_marks(spark: SparkSession) -> DataFrame:
    """The marks before any load: none."""
    return spark.createDataFrame([], MARKS)


def rows_after_marks(df: DataFrame, marks: DataFrame, source: str, at: str, overlap: str) -> DataFrame:
    """Rows of a source from the mark of their workspace on; all of a workspace without one.

    ``at`` should be the time a row arrived.  Where it is the time something happened,
    ``overlap`` has to be as long as rows can be late.  Rows at the mark and within the
    overlap are read again, so the load must be an upsert.
    """
    own = marks.filter(F.col("source") == source).select("workspace_id", "high_mark")
    since = F.col("high_mark") - F.expr(f"interval {overlap}")
    return (
        df.join(own, "workspace_id", "left")
        .filter(F.col("high_mark").isNull() | (F.col(at) >= since))
        .drop("high_mark")
    )


def advance_marks(marks: DataFrame, loaded: DataFrame, source: str, at: str) -> DataFrame:
    """The marks after a load: never lower than before."""
    reached = loaded.groupBy("workspace_id").agg(F.max(at).alias("high_mark")).withColumn("source", F.lit(source))
    return marks.unionByName(reached).groupBy("source", "workspace_id").agg(F.max("high_mark").alias("high_mark"))


def load_up_to(df: DataFrame, at: str, until: Instant) -> DataFrame:
    """Rows known at a moment, for loads in steps."""
    return df.filter(F.col(at) <= as_column(until))


def upsert_latest(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Both sets of rows with one row per key, the one with the greatest ``order``."""
    return latest_version(existing.unionByName(incoming), keys, order)


def upsert_partitions(
    incoming: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], partition: str, follows_key: bool = False
) -> None:
    """Upsert into a partitioned parquet folder, rewriting only the partitions touched.

    A key is one row in the whole folder.  The partitions touched are those of the
    incoming rows and those where their keys are now; their values become a filter of
    the scan.  A read of keys alone finds where keys are now.  ``follows_key`` says that
    the partition is a function of the key, so that a key never moves and nothing has to
    be looked up.  A partition that its last row has left is removed.
    """
    spark = incoming.sparkSession
    if not exists(spark, path):
        write_partitions(latest_version(incoming, keys, order), path, [partition])
        return
    # the partition column is read from folder names: as text first, cast on the way
    stored = spark.read.schema(incoming.schema).parquet(path)
    touched = incoming.select(partition)
    if not follows_key:
        held = stored.select(*dict.fromkeys([*keys, partition]))
        touched = touched.union(held.join(incoming.select(*keys).distinct(), list(keys), "left_semi").select(partition))
    values = _values(touched, partition)
    merged = staged(latest_version(stored.filter(_is_in(partition, values)).unionByName(incoming), keys, order))
    _replace(merged, path, partition, values)


def replace_groups(incoming: DataFrame, path: str, groups: DataFrame | None, partition: str) -> None:
    """Replace all rows of some groups in a partitioned parquet folder by ``incoming``.

    ``groups`` has the key columns of each group and the partitions that rows of it may
    be in; its other rows stay, and those of a group that ``incoming`` has no rows of go.
    Only these partitions, and those of ``incoming``, are read and rewritten, by a
    literal filter; one that its last row has left is removed.  None for ``groups``, or
    no folder yet, writes ``incoming`` alone.
    """
    spark = incoming.sparkSession
    if groups is None or not exists(spark, path):
        write_partitions(incoming, path, [partition])
        return
    stored = spark.read.schema(incoming.schema).parquet(path)
    values = _values(groups.select(partition).union(incoming.select(partition)), partition)
    keys = [c for c in groups.columns if c != partition]
    gone = groups.select(*[F.col(c).alias(f"__{c}") for c in keys]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys]
    kept = stored.filter(_is_in(partition, values)).join(gone, same, "left_anti")
    _replace(staged(kept.unionByName(incoming)), path, partition, values)


def _values(rows: DataFrame, partition: str) -> list[object]:
    """The distinct partitions of some rows: as many as there are folders, not rows."""
    return [r[0] for r in rows.select(partition).distinct().collect()]


def _is_in(partition: str, values: Sequence[object]) -> Column:
    chosen = F.col(partition).isin([v for v in values if v is not None])
    return chosen | F.col(partition).isNull() if None in values else chosen


def _replace(rows: DataFrame, path: str, partition: str, values: Sequence[object]) -> None:
    """Write the new rows of some partitions, and remove those of them that have none."""
    write_partitions(rows, path, [partition])
    left = set(_values(rows, partition))
    _drop_partitions(rows.sparkSession, path, partition, [v for v in values if v not in left])


def stream_partial_sums(
    stream: DataFrame, keys: Sequence[str], sums: Mapping[str, Column], target: str, checkpoint: str
) -> StreamingQuery:
    """Sum each micro-batch by ``keys`` into its own partition of ``target``.

    A batch that is repeated after a failure replaces its partition, so it counts once.
    Late rows are summed with the batch that brings them; none are dropped.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        partial = batch.groupBy(*keys).agg(*[F.sum(column).alias(name) for name, column in sums.items()])
        write_partitions(partial.withColumn("batch_id", F.lit(batch_id).cast("bigint")), target, ["batch_id"])

    return (
        stream.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_partial_sums(spark: SparkSession, target: str, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The fact that the partial sums of all batches add up to."""
    return spark.read.parquet(target).groupBy(*keys).agg(*[F.sum(name).alias(name) for name in names])


def _drop_partitions(spark: SparkSession, path: str, partition: str, values: Sequence[object]) -> None:
    """Remove the folders of partitions, named as Spark names them."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for value in values:
        text = None if value is None else str(value)
        folder = spark._jvm.org.apache.hadoop.fs.Path(path, names.getPartitionPathString(partition, text))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)
