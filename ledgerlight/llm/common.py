"""Helpers shared by the operators: words, Arrow slices, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlight.session import holding, shared_dir

#: A word for Java, the same as what ``bytes.split()`` gives for UTF-8.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, **options: str) -> DataFrame:
    """``df`` written to the shared folder of the cluster and read from there.

    Branches then share one computation, and a lost executor costs no rerun of it.
    ``options`` are those of the parquet writer.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid4().hex}"
    df.write.options(**options).parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made.stored_at = path
    return made


def dropped(df: DataFrame) -> None:
    """Remove the table that :func:`stored` gave; nothing may read it any more."""
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def without_shuffles(spark: SparkSession) -> AbstractContextManager:
    """What is written inside leaves no shuffle files behind; else they stay until the driver collects its garbage."""
    return holding(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def text_bytes(array: pa.Array) -> list[bytes]:
    """UTF-8 of each value; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    return [value or b"" for value in array.cast(kind).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``most_bytes`` of ``column``; no row is cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        lengths = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(lengths) - lengths) // most_bytes
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for start, end in zip(edges, edges[1:], strict=False):
            yield batch.slice(start, end - start)
    # a worker that waits for its next task keeps no buffers of the last
    pa.default_memory_pool().release_unused()


def prefix_sums(
    df: DataFrame, group: list[str], order: list[str], value: str, into: str, parts: int | None = None
) -> DataFrame:
    """Sum of ``value`` over the rows of the group that come before, in a total ``order``.

    Rows are ranged over (group, order), so that a group with a third of all rows
    spreads over a third of the tasks; within a range a window adds up, and between
    ranges the totals of the ranges do.  ``df`` should be stored: it is read twice.
    """
    keys = [F.col(c) for c in [*group, *order]]
    ranged = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    ranged = stored(ranged.withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy(*group, "_range").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(c).alias(f"_g_{c}") for c in group],
        F.col("_range").alias("_r"),
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group]
    within = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.withColumn("_inner", F.coalesce(F.sum(value).over(within), F.lit(0))).join(
        starts, [F.col("_range") == F.col("_r"), *same]
    )
    return joined.withColumn(into, F.col("_inner") + F.col("_before")).drop(
        "_inner", "_before", "_range", "_r", *[f"_g_{c}" for c in group]
    )
