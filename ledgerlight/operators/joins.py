"""Joins whose key is often missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts that the rows without a key are spread over.
PARTS = 256


def lookup_or_null(left: DataFrame, right: DataFrame, key: str, spread_by: Sequence[str]) -> DataFrame:
    """Left join on ``key``, with the left rows that lack one kept apart from each other.

    Rows without a key match nothing, yet a shuffle would send all of them to one task.
    A second join column, which is zero wherever there is a key, spreads them by a hash
    of ``spread_by``.  The hash depends on the row alone, so a task that is run again
    sends each row to the same place.
    """
    apart = F.pmod(F.xxhash64(*spread_by), F.lit(PARTS))
    keyed = left.withColumn("__apart", F.when(F.col(key).isNull(), apart).otherwise(F.lit(0).cast("bigint")))
    return keyed.join(right.withColumn("__apart", F.lit(0).cast("bigint")), [key, "__apart"], "left").drop("__apart")
