"""Distinct counts that can be merged: bitmaps of numbered ids, or sketches.

A count of distinct users by day and space says nothing about the month.  A bitmap by day
and space does: bitmaps are or-ed over any dimensions, and the bits counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlight.session import staged

#: Columns of a bitmap row: which stretch of numbers it covers, and the bits.
BUCKET, BITS, SKETCH = "bucket", "bits", "sketch"


def number_ids(ids: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """(``column``, number): each distinct id with a number of its own, without gaps, from 0.

    ``known`` keeps its numbers, and new ids follow.  NULL is no id.  Ids are numbered
    within ranges, and the sizes of the ranges, one a task, give each range its start.
    """
    new = ids.select(column).filter(F.col(column).isNotNull()).distinct()
    first = 0
    if known is not None:
        new = new.join(known, column, "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    ranged = staged(new.repartitionByRange(column).withColumn("__range", F.spark_partition_id()))
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("n")).orderBy("__range").collect()
    starts, at = [], first
    for part, n in sizes:
        starts.append((part, at))
        at += n
    start = ids.sparkSession.createDataFrame(starts, "__range int, __start bigint")
    within = F.row_number().over(Window.partitionBy("__range").orderBy(column)) - 1
    numbered = ranged.join(F.broadcast(start), "__range").select(column, (F.col("__start") + within).cast("bigint").alias("number"))
    return numbered if known is None else known.select(column, "number").unionByName(numbered)


def distinct_bitmaps(rows: DataFrame, grain: Sequence[str], number: str = "number") -> DataFrame:
    """A row by grain and bucket of numbers, with the bits of the numbers seen there."""
    position = F.bitmap_bit_position(number)
    counted = rows.filter(F.col(number).isNotNull())
    return counted.groupBy(*grain, F.bitmap_bucket_number(number).alias(BUCKET)).agg(F.bitmap_construct_agg(position).alias(BITS))


def merge_bitmaps(bitmaps: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Bitmaps by coarser dimensions, which can be merged again."""
    return bitmaps.groupBy(*dims, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_bitmaps(bitmaps: DataFrame, dims: Sequence[str], out: str) -> DataFrame:
    """Exact number of distinct ids by dimensions."""
    bits = merge_bitmaps(bitmaps, dims).select(*dims, F.bitmap_count(BITS).alias("__n"))
    return bits.groupBy(*dims).agg(F.sum("__n").alias(out))


def distinct_sketches(rows: DataFrame, grain: Sequence[str], column: str, digits: int = 12) -> DataFrame:
    """A sketch by grain, for ids that are too many to number; counts are within some percent."""
    return rows.filter(F.col(column).isNotNull()).groupBy(*grain).agg(F.hll_sketch_agg(column, F.lit(digits)).alias(SKETCH))


def count_sketches(sketches: DataFrame, dims: Sequence[str], out: str) -> DataFrame:
    """About how many distinct ids there are by dimensions."""
    return sketches.groupBy(*dims).agg(F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias(out))
