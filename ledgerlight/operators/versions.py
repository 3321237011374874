"""One row per key: latest versions, best matches and representatives.

Each is an aggregate over an ordering struct instead of a ranking window, so rows are
combined before the shuffle and a key with very many rows stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F


def latest_version(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key; remaining columns break ties.

    NULL is the smallest value of an order column.  Columns that have no order, such as
    maps, break ties by their text.
    """
    fields = [f for f in df.schema.fields if f.name not in keys]
    rest = [f for f in fields if f.name not in order]
    if all(_has_order(f.dataType) for f in fields):
        ranked = F.struct(*order, *[f.name for f in rest])
        best = df.groupBy(*keys).agg(F.max(ranked).alias("__best"))
    else:
        ties = [F.col(f.name) if _has_order(f.dataType) else F.to_json(F.struct(f.name)).alias(f.name) for f in rest]
        row, ranked = F.struct(*[f.name for f in fields]), F.struct(*order, *ties)
        best = df.groupBy(*keys).agg(F.max_by(row, ranked).alias("__best"))
    return best.select(*keys, "__best.*").select(*df.columns)


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def crosswalk(df: DataFrame, scope: Sequence[str], name: str, target: str, weight: str) -> DataFrame:
    """``(scope, name) -> target``: the target of greatest total weight, ties to the smaller."""
    totals = (
        df.filter(F.col(name).isNotNull() & F.col(target).isNotNull())
        .groupBy(*scope, name, target)
        .agg(F.sum(weight).alias("__weight"))
    )
    best = F.min(F.struct((-F.col("__weight")).alias("w"), F.col(target).alias("t")))
    return totals.groupBy(*scope, name).agg(best["t"].alias(target))


def representative(
    df: DataFrame, group: Sequence[str], weight: str, tie: str, count: str = "entity_count"
) -> DataFrame:
    """The member of greatest weight per group, ties to the smaller, and the member count."""
    rest = [c for c in df.columns if c not in {*group, weight, tie}]
    ranked = F.struct(
        (-F.coalesce(F.col(weight), F.lit(0))).alias("__w"), F.col(tie), *[F.col(c) for c in rest]
    )
    return (
        df.groupBy(*group)
        .agg(F.min(ranked).alias("__best"), F.count("*").cast("int").alias(count))
        .select(*group, F.col("__best")[tie].alias(tie), *[F.col("__best")[c].alias(c) for c in rest], count)
    )
