"""Cost allocation: work of a query, its hours, the cost of an hour and its shares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.classify import SOURCE_FIELDS, source_id, source_type
from ledgerlight.functions.time import (
    Instant,
    as_column,
    hour_of,
    seconds_between,
    whole_seconds_between,
)

#: The labels of ``billing_record_check``.
BILLED = "Has Billing Record"
NOT_BILLED = "No Billing Record for this hour and warehouse yet available"


def query_work(history: DataFrame) -> DataFrame:
    """Query history with the time a query worked and for how long.

    Work starts after queueing, waiting for compute and compiling, and ends after the
    result is fetched.  Task seconds are task, fetch and compile time together.
    """
    ms = {
        name: F.coalesce(F.col(f"{name}_duration_ms"), F.lit(0))
        for name in ("waiting_at_capacity", "waiting_for_compute", "compilation", "result_fetch", "total_task")
    }
    before = ms["waiting_at_capacity"] + ms["waiting_for_compute"] + ms["compilation"]
    task = ms["total_task"] + ms["result_fetch"] + ms["compilation"]
    return history.withColumns(
        {
            "query_work_task_time": task / F.lit(1000.0),
            "query_work_start_time": F.timestamp_add("MILLISECOND", before, "start_time"),
            "query_work_end_time": F.timestamp_add("MILLISECOND", ms["result_fetch"], "end_time"),
        }
    )


def classify_source(history: DataFrame, fields: Mapping[str, str] = SOURCE_FIELDS) -> DataFrame:
    """Query history with ``query_source_type``, ``query_source_id`` and a client label."""
    return history.withColumns(
        {
            "query_source_type": source_type(fields),
            "query_source_id": source_id(fields),
            "client_application": F.coalesce("client_application", F.lit("Unknown")),
        }
    )


def warehouse_queries(history: DataFrame, lo: Instant, hi: Instant) -> DataFrame:
    """Queries that ran work on a warehouse and touch the window ``[lo, hi)``."""
    return history.filter(
        F.col("statement_type").isNotNull()
        & (F.col("start_time") < as_column(hi))
        & (F.col("end_time") > as_column(lo))
        & (F.col("total_task_duration_ms") > 0)
        & F.col("compute.warehouse_id").isNotNull()
    ).withColumn("warehouse_id", F.col("compute.warehouse_id"))


def apportion_by_hour(work: DataFrame, precision: str = "microsecond") -> DataFrame:
    """Work of each statement spread over the hours it touches, by time in the hour.

    ``precision="microsecond"`` measures overlap and duration alike, so the parts add up
    to the whole, and work without any duration stays in its hour.  ``"second"`` cuts the
    overlap, but not the duration, to whole seconds; work without duration is lost.

    There is one row per row of ``work`` and hour, and nothing is shuffled: sums over the
    hour or the statement combine these rows where they are made.
    """
    if precision not in ("microsecond", "second"):
        raise ValueError(f"unknown precision {precision!r}")
    begin, finish = F.col("query_work_start_time"), F.col("query_work_end_time")
    hour = F.expr("interval 1 hour")
    hours = F.sequence(hour_of(begin), F.greatest(hour_of(begin), hour_of(finish)), hour)
    duration = seconds_between(begin, finish)
    elapsed = seconds_between if precision == "microsecond" else whole_seconds_between
    until = F.least(finish, F.col("hour_bucket") + hour)
    overlap = F.greatest(F.lit(0), elapsed(F.greatest(begin, F.col("hour_bucket")), until))
    without_duration = F.col("query_work_task_time") if precision == "microsecond" else F.lit(0.0)
    part = F.when(duration > 0, F.col("query_work_task_time") * (overlap / duration)).otherwise(without_duration)
    return (
        work.select(
            "statement_id",
            "warehouse_id",
            "query_work_start_time",
            "query_work_end_time",
            "query_work_task_time",
            F.explode(hours).alias("hour_bucket"),
        )
        .select(
            "statement_id",
            "warehouse_id",
            "hour_bucket",
            overlap.cast("double").alias("overlap_duration"),
            part.cast("double").alias("attributed_query_work"),
        )
    )


def share_of(df: DataFrame, keys: Sequence[str], value: str, total: str, share: str) -> DataFrame:
    """Each row's share of its group's total; NULL for a row without value.

    The totals are aggregated before they are shuffled and then joined back, so that a
    group of any size is spread by the join's skew handling.  A window over the group
    would hold all of it in one task.
    """
    totals = df.groupBy(*keys).agg(F.sum(value).alias(total))
    part = F.try_divide(F.col(value), F.col(total))
    return df.join(totals, list(keys)).withColumn(share, F.when(F.col(value) != 0, part))


def hour_cost(priced_usage: DataFrame, utilization: DataFrame, key: str = "warehouse_id") -> DataFrame:
    """Billed units and dollars per key and hour, with the utilization of the hour.

    Billing is summed to the hour first, so several billing rows in an hour never
    multiply what is joined to them.
    """
    billed = priced_usage.groupBy(key, hour_of("usage_start_time").alias("hour_bucket")).agg(
        F.sum("units").cast("double").alias("units"), F.sum("dollars").cast("double").alias("dollars")
    )
    used = utilization.withColumnRenamed("hour", "hour_bucket").select(
        key, "hour_bucket", "utilized_seconds", "idle_seconds", "total_seconds", "utilization_proportion"
    )
    return billed.join(used, [key, "hour_bucket"], "left")


def attribute_cost(
    work_by_hour: DataFrame, cost: DataFrame, latest: Column | None = None, spread_idle: bool = False
) -> DataFrame:
    """Dollars and units of each statement and hour: its share of the hour's used cost.

    All hour-level figures (total work, cost, utilization) are put together at hour grain,
    so the statements meet them in a single join.  ``latest`` is the latest billed hour;
    without it it is looked up in ``cost``.  Idle cost stays with the hour unless
    ``spread_idle`` is set.
    """
    hour = ["warehouse_id", "hour_bucket"]
    totals = work_by_hour.groupBy(*hour).agg(F.sum("attributed_query_work").alias("total_work_done_on_warehouse"))
    hours = totals.join(cost.withColumn("__billed", F.lit(True)), hour, "left")
    if latest is None:
        latest = cost.agg(F.max("hour_bucket")).scalar()
    used = F.col("utilization_proportion").cast("double")
    if spread_idle:
        used = F.when(used > 0, F.lit(1.0)).otherwise(used)
    hours = hours.select(
        *hour,
        "total_work_done_on_warehouse",
        (used * F.col("dollars")).alias("__dollars"),
        (used * F.col("units")).alias("__units"),
        F.when(F.col("__billed"), BILLED).otherwise(NOT_BILLED).alias("billing_record_check"),
    )
    share = F.try_divide(F.col("attributed_query_work"), F.col("total_work_done_on_warehouse"))
    return (
        work_by_hour.join(hours, hour)
        .withColumn("query_task_time_proportion", share)
        .withColumns(
            {
                "query_attributed_dollars_estimation": F.col("__dollars") * F.col("query_task_time_proportion"),
                "query_attributed_units_estimation": F.col("__units") * F.col("query_task_time_proportion"),
                "most_recent_billing_hour": latest,
            }
        )
        .drop("__dollars", "__units")
    )


def idle_residual(attributed: DataFrame, cost: DataFrame) -> DataFrame:
    """Per hour: billed cost, the part attributed to statements and what is left."""
    hour = ["warehouse_id", "hour_bucket"]
    spent = attributed.groupBy(*hour).agg(
        F.sum("query_attributed_dollars_estimation").alias("attributed_dollars"),
        F.sum("query_attributed_units_estimation").alias("attributed_units"),
    )
    return (
        cost.select(*hour, F.col("dollars").alias("billed_dollars"), F.col("units").alias("billed_units"))
        .join(spent, hour, "left")
        .withColumns(
            {
                "residual_dollars": _left_over("billed_dollars", "attributed_dollars"),
                "residual_units": _left_over("billed_units", "attributed_units"),
            }
        )
    )


def _left_over(billed: str, attributed: str) -> Column:
    return F.col(billed) - F.coalesce(F.col(attributed), F.lit(0.0))
