"""Ordered computations over long keys, cut into time buckets.

A window over one key alone puts the whole history of that key in one task.  These
helpers order rows only inside a (key, bucket) group and take what crosses the bucket
edge from one summary row per bucket: an opening balance, the last value before it or
the first value after it.  The summaries are windowed per key, which is bounded by the
number of buckets on the calendar, not by the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def totals_and_next(
    df: DataFrame, keys: Sequence[str], bucket: str, order: str, value: str, total: str, following: str
) -> DataFrame:
    """Running sum of ``value`` and the next ``order``, per key by ``order``, unique per key.

    ``following`` is NULL on the last row.  One window per (key, bucket) and one summary
    of the same columns, so that both share the shuffle below them.
    """
    inside = Window.partitionBy(*keys, bucket).orderBy(order)
    across = Window.partitionBy(*keys).orderBy(bucket)
    # stated on both sides of the join below, so that what lies under them stays the same
    df = df.select(*keys, bucket, order, value).filter(F.col(bucket).isNotNull())
    edges = (
        df.groupBy(*keys, bucket)
        .agg(F.sum(value).alias("__sum"), F.min(order).alias("__first"))
        .select(
            *keys,
            bucket,
            F.coalesce(F.sum("__sum").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__opening"),
            F.lead("__first").over(across).alias("__following"),
        )
    )
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.withColumns({"__inside": F.sum(value).over(upto), "__lead": F.lead(order).over(inside)})
        .join(edges, [*keys, bucket])
        .withColumns({total: F.col("__opening") + F.col("__inside"), following: F.coalesce("__lead", "__following")})
        .drop("__opening", "__inside", "__lead", "__following")
    )


def runs(df: DataFrame, keys: Sequence[str], bucket: str, order: str, value: str, following: str) -> DataFrame:
    """The rows whose ``value`` is not that of the row before, and where the next such row is.

    Per key by ``order``, which must be unique per key; ``value`` is never NULL, and
    ``following`` is NULL on the last run.  Whether the first row of a bucket begins a
    run, and where the first run after a bucket begins, comes from its summary row.
    """
    inside = Window.partitionBy(*keys, bucket).orderBy(order)
    across = Window.partitionBy(*keys).orderBy(bucket)
    # stated on both sides of the join below, so that what lies under them stays the same
    df = df.select(*keys, bucket, order, value).filter(F.col(bucket).isNotNull())
    before = df.withColumn("__before", F.lag(value).over(inside))
    begins = F.when(F.col("__before") != F.col(value), F.col(order))
    edges = before.groupBy(*keys, bucket).agg(
        F.min(order).alias("__at"),
        F.min_by(value, order).alias("__first"),
        F.max_by(value, order).alias("__last"),
        F.min(begins).alias("__inner"),
    )
    edges = edges.withColumn("__carried", F.lag("__last").over(across))
    fresh = F.col("__carried").isNull() | (F.col("__carried") != F.col("__first"))
    edges = edges.withColumn("__begins", F.when(fresh, F.col("__at")).otherwise(F.col("__inner")))
    # from the end backwards: a frame up to the last row would be summed anew for each row
    coming = Window.partitionBy(*keys).orderBy(F.desc(bucket)).rowsBetween(Window.unboundedPreceding, -1)
    later = F.min("__begins").over(coming)
    edges = edges.select(*keys, bucket, "__carried", later.alias("__following"))
    coming = Window.partitionBy(*keys, bucket).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    after = F.min("__begin").over(coming)
    return (
        before.withColumn("__begin", begins)
        .withColumn("__after", after)
        .join(edges, [*keys, bucket])
        .filter(~F.coalesce("__before", "__carried").eqNullSafe(F.col(value)))
        .withColumn(following, F.coalesce("__after", "__following"))
        .drop("__before", "__begin", "__after", "__carried", "__following")
    )
