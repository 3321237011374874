"""Totals against details, and named measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(
    total: DataFrame, detail: DataFrame, keys: Sequence[str], value: str, tolerance: float = 0.005
) -> DataFrame:
    """Per key: the stated total, the sum of the details, their gap, and whether they agree."""
    stated = total.groupBy(*keys).agg(F.sum(value).alias("total"))
    summed = detail.groupBy(*keys).agg(F.sum(value).alias("detail"))
    zero = F.lit(0).cast("double")
    return (
        stated.join(summed, list(keys), "full")
        .withColumns({c: F.coalesce(F.col(c).cast("double"), zero) for c in ("total", "detail")})
        .withColumn("gap", F.col("total") - F.col("detail"))
        .withColumn("reconciles", F.abs("gap") <= tolerance)
    )


def totals_against_billing(fact: DataFrame, priced: DataFrame) -> DataFrame:
    """One row: billed_units, billed_dollars and whether the totals of a fact equal them.

    A fact keeps six digits a row, so its total may be off by half of the last a row.
    """
    none = F.lit(None).cast("decimal(38,6)")
    sides = fact.select(
        F.col("units").alias("own_units"), F.col("dollars").alias("own_dollars"), none.alias("units"), none.alias("dollars")
    ).unionByName(priced.select(none.alias("own_units"), none.alias("own_dollars"), "units", "dollars"))
    names = ("own_units", "own_dollars", "units", "dollars")
    sums = sides.agg(F.count("own_dollars").alias("rows"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])
    slack = F.col("rows") * F.lit("0.0000005").cast("decimal(10,7)") + F.lit("0.000001").cast("decimal(10,7)")
    close = [F.abs(F.col(f"own_{c}") - F.col(c)) <= slack for c in ("units", "dollars")]
    return sums.select(
        F.col("units").alias("billed_units"), F.col("dollars").alias("billed_dollars"), (close[0] & close[1]).alias("equal_to_billing")
    )


def measure(df: DataFrame, dims: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Named aggregates of a fact by the chosen dimensions.

    Sums of a fact add up over any dimensions.  Distinct counts do not: take them from
    rows that still carry the counted id.
    """
    return df.groupBy(*dims).agg(*[column.alias(name) for name, column in measures.items()])


#: Columns of facts that count distinct ids of their own grain.
DISTINCT_COUNTS = ("distinct_users", "distinct_viewers")


def sum_measures(columns: Sequence[str]) -> dict[str, Column]:
    """Sums of fact columns; those that do not add up are refused."""
    refused = [c for c in columns if c in DISTINCT_COUNTS]
    if refused:
        raise ValueError(f"{refused} do not add up over rows: count their ids with distinct_measure")
    return {c: F.sum(c) for c in columns}


def distinct_measure(ids: str) -> Column:
    """Distinct ids, over rows that still hold them."""
    return F.count_distinct(ids)


def cost_measures() -> dict[str, Column]:
    """Measures that every cost fact supports."""
    return {"units": F.sum("units"), "dollars": F.sum("dollars"), "rows": F.count("*")}
