"""Cost per query, and the hourly base it is allocated from."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.functions.classify import LINK_PREFIXES, SOURCE_FIELDS, deep_link, profile_link
from ledgerlight.functions.time import Instant, as_column, hour_of
from ledgerlight.operators.allocation import (
    BILLED,
    NOT_BILLED,
    apportion_by_hour,
    attribute_cost,
    classify_source,
    hour_cost,
    query_work,
    warehouse_queries,
)
from ledgerlight.operators.intervals import (
    active_intervals,
    activity_steps,
    cluster_state,
    completeness_window,
    hourly_utilization,
    resolve_window,
    state_intervals,
    state_marks,
    utilization_sweep,
)
from ledgerlight.operators.pricing import PRICE_KEYS, price_usage
from ledgerlight.session import staged
from ledgerlight.sources.tables import conform


@dataclass(frozen=True)
class Rules:
    """Choices of the allocation.

    The defaults keep allocated cost conserved: half-open prices per SKU and cloud,
    microsecond overlaps and an unrounded utilization.  :data:`CLOSED_RULES` has the
    closed price intervals, whole-second overlaps and two-digit utilization of the
    original reports.
    """

    price_keys: tuple[str, ...] = PRICE_KEYS
    price_at: str = "usage_start_time"
    price_closed: str = "left"
    precision: str = "microsecond"
    utilization_decimal: str | None = None
    spread_idle: bool = False
    source_fields: Mapping[str, str] = field(default_factory=lambda: SOURCE_FIELDS)
    link_prefixes: Mapping[str, str] = field(default_factory=lambda: LINK_PREFIXES)


CLOSED_RULES = Rules(
    price_keys=("sku_name", "usage_unit"),
    price_at="usage_end_time",
    price_closed="both",
    precision="second",
    utilization_decimal="decimal(3,2)",
)


@dataclass(frozen=True)
class QueryFeeds:
    """The four feeds that cost per query is built from."""

    history: DataFrame
    events: DataFrame
    usage: DataFrame
    prices: DataFrame

    def window(self) -> tuple[Instant, Instant]:
        """Whole hours covered by history, events and billing alike."""
        return resolve_window(self.window_frame())

    def window_frame(self) -> DataFrame:
        return completeness_window(
            [
                (self.events, "event_time", "event_time"),
                (self.history, "start_time", "end_time"),
                (self.usage, "usage_end_time", "usage_end_time"),
            ]
        )


def narrow_work(feeds: QueryFeeds, lo: Instant, hi: Instant) -> DataFrame:
    """The columns of history that costs are allocated by, without any text."""
    return query_work(warehouse_queries(feeds.history, lo, hi)).select(
        "statement_id", "warehouse_id", "query_work_start_time", "query_work_end_time", "query_work_task_time"
    )


def query_states(feeds: QueryFeeds, lo: Instant, hi: Instant) -> DataFrame:
    """ON and OFF intervals of the warehouses that ran queries."""
    busy = warehouse_queries(feeds.history, lo, hi).select("warehouse_id").distinct()
    events = feeds.events.join(busy, "warehouse_id", "left_semi")
    return state_intervals(events, "warehouse_id", "event_time", cluster_state(F.col("cluster_count")), lo, hi)


def query_activity(feeds: QueryFeeds, lo: Instant, hi: Instant) -> DataFrame:
    """Number of queries at work on each warehouse over time."""
    work = query_work(warehouse_queries(feeds.history, lo, hi))
    return active_intervals(work, "warehouse_id", "query_work_start_time", "query_work_end_time", lo, hi)


def period_utilization(feeds: QueryFeeds, lo: Instant, hi: Instant, work: DataFrame | None = None) -> DataFrame:
    """Seconds of each warehouse and hour that were used, idle or off.

    ``work`` is :func:`narrow_work` where it is stored already.
    """
    key = "warehouse_id"
    work = narrow_work(feeds, lo, hi) if work is None else work
    steps = activity_steps(work, key, "query_work_start_time", "query_work_end_time", lo, hi)
    states = state_marks(feeds.events, key, "event_time", cluster_state(F.col("cluster_count")), lo, hi)
    return utilization_sweep(steps, states, key, lo, hi)


def warehouse_usage(feeds: QueryFeeds, lo: Instant, hi: Instant) -> DataFrame:
    """Billing rows of warehouses inside the window."""
    return (
        feeds.usage.filter(
            F.col("usage_metadata.warehouse_id").isNotNull()
            & (F.col("usage_start_time") >= as_column(lo))
            & (F.col("usage_end_time") <= as_column(hi))
        )
        .withColumn("warehouse_id", F.col("usage_metadata.warehouse_id"))
        .select("warehouse_id", "usage_start_time", "usage_end_time", "usage_quantity", "usage_unit", "sku_name", "cloud")
    )


def warehouse_hour_cost(
    feeds: QueryFeeds, lo: Instant, hi: Instant, rules: Rules = Rules(), work: DataFrame | None = None
) -> DataFrame:
    """Billed cost of each warehouse and hour inside the window, with its utilization."""
    priced = price_usage(
        warehouse_usage(feeds, lo, hi),
        feeds.prices,
        rules.price_keys,
        rules.price_at,
        rules.price_closed,
        on_missing=None,
        span=(lo, hi),
        since=lo,
    )
    used = hourly_utilization(period_utilization(feeds, lo, hi, work), "warehouse_id", rules.utilization_decimal)
    return hour_cost(priced, used)


def attributed_hours(
    feeds: QueryFeeds, lo: Instant, hi: Instant, rules: Rules = Rules(), latest: Column | None = None
) -> DataFrame:
    """Attributed cost at the grain of statement and hour.

    The narrow columns of history are stored once in the shared folder; utilization,
    the totals of an hour and the parts of a statement are all read from there.
    ``latest`` is the latest billed hour, which is looked up unless it is given.
    """
    work = staged(narrow_work(feeds, lo, hi))
    if latest is None:
        latest = warehouse_usage(feeds, lo, hi).agg(hour_of(F.max("usage_start_time"))).scalar()
    return attribute_cost(
        apportion_by_hour(work, rules.precision),
        warehouse_hour_cost(feeds, lo, hi, rules, work),
        latest,
        rules.spread_idle,
    )


def cost_per_query(
    feeds: QueryFeeds, window: tuple[Instant, Instant] | None = None, rules: Rules = Rules()
) -> DataFrame:
    """One row per statement with its attributed cost, by hour and in all.

    Hours are allocated on narrow columns; the wide ones, the statement text above all,
    are shuffled once, when the finished cost meets the history.
    """
    lo, hi = window or feeds.window()
    return roll_up(attributed_hours(feeds, lo, hi, rules), feeds, lo, hi, rules)


def roll_up(hours: DataFrame, feeds: QueryFeeds, lo: Instant, hi: Instant, rules: Rules = Rules()) -> DataFrame:
    """Cost per query from attributed hours."""
    per_hour = F.struct(
        "hour_bucket",
        F.col("query_attributed_dollars_estimation").alias("hour_attributed_cost"),
        F.col("query_attributed_units_estimation").alias("hour_attributed_units"),
    )
    cost = (
        hours.groupBy("statement_id", "warehouse_id")
        .agg(
            F.array_sort(F.collect_list(per_hour)).alias("statement_hour_bucket_costs"),
            F.sum("query_attributed_dollars_estimation").alias("query_attributed_dollars_estimation"),
            F.sum("query_attributed_units_estimation").alias("query_attributed_units_estimation"),
            F.max("most_recent_billing_hour").alias("most_recent_billing_hour"),
            F.bool_and(F.col("billing_record_check") == BILLED).alias("__billed"),
        )
    )
    described = classify_source(
        query_work(warehouse_queries(feeds.history, lo, hi)), rules.source_fields
    )
    fact = described.join(cost, ["statement_id", "warehouse_id"]).select(
        "statement_id",
        "query_source_id",
        "query_source_type",
        "client_application",
        "executed_by",
        "warehouse_id",
        "statement_text",
        "workspace_id",
        "statement_hour_bucket_costs",
        "start_time",
        "end_time",
        "query_work_start_time",
        "query_work_end_time",
        _milli_seconds("start_time", "end_time").alias("duration_seconds"),
        _milli_seconds("query_work_start_time", "query_work_end_time").alias("query_work_duration_seconds"),
        F.col("query_work_task_time").alias("query_work_task_time_seconds"),
        "query_attributed_dollars_estimation",
        "query_attributed_units_estimation",
        deep_link(F.col("query_source_type"), F.col("query_source_id"), rules.link_prefixes).alias("url_helper"),
        profile_link(F.col("statement_id")).alias("query_profile_url"),
        "most_recent_billing_hour",
        F.when(F.col("__billed"), BILLED).otherwise(NOT_BILLED).alias("billing_record_check"),
        hour_of("start_time").alias("query_start_hour"),
    )
    return conform(fact, schemas.fact("cost_per_query"))


def _milli_seconds(start: str, end: str):
    elapsed = F.timestamp_diff("MILLISECOND", F.col(start), F.col(end)) / F.lit(1000.0)
    return F.coalesce(elapsed, F.lit(0.0))
