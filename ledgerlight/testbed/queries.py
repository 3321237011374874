"""The registered queries: every operator over feeds derived from the test tables."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable
from functools import lru_cache
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.functions.classify import deep_link, profile_link
from ledgerlight.functions.time import as_column
from ledgerlight.operators import allocation, distinct, intervals, pricing, quality, reconcile, versions
from ledgerlight.plans import (
    app_usage,
    assistant_cost,
    billing_facts,
    billing_stream,
    category_table,
    incremental_cost,
    query_cost,
    reach,
    reports,
    serving_usage,
)
from ledgerlight.plans.query_cost import QueryFeeds
from ledgerlight.session import shared_dir, staged
from ledgerlight.sources import documents, tables
from ledgerlight.streaming import daily, incremental, messages
from ledgerlight.testbed.feeds import EVENTS_AS_OF, LINES_AS_OF, LINES_DAYS, Feeds

Query = Callable[[Feeds], DataFrame]
QUERIES: dict[str, Query] = {}

#: Range of the statement report.
REPORT_FROM, REPORT_TO = "2024-01-05 00:00:00", "2024-01-20 00:00:00"
#: Moment up to which the first step of the incremental load reads.
FIRST_LOAD = "2024-01-15 00:00:00"


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(make) for name, make in QUERIES.items()}


def _bind(make: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: comparable(make(_feeds(spark, folder)))


@lru_cache(maxsize=4)
def _feeds(spark: SparkSession, folder: str) -> Feeds:
    """The lazy feeds of a folder; only plans are kept, no rows."""
    return Feeds(spark, folder)


def comparable(df: DataFrame) -> DataFrame:
    """Numbers in bigint or in doubles of six digits and arrays as text, as in the SQL.

    The small addend settles ties of the seventh digit, which the binary value of a
    double would decide differently from one engine to another.
    """
    columns = []
    for field in df.schema.fields:
        kind, column = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double") + 1e-9, 6)
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            column = column.cast("bigint")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, "|")
        columns.append(column.alias(field.name))
    return df.select(*columns)


# -- allocation core ---------------------------------------------------------------------


def _window(feeds: Feeds) -> tuple[str, str]:
    return feeds.query_feeds.window()


def _work(feeds: Feeds) -> DataFrame:
    return allocation.query_work(allocation.warehouse_queries(feeds.query_history, *_window(feeds)))


def _cost(feeds: Feeds) -> DataFrame:
    """The finished fact, which reports read from storage."""
    return query_cost.cost_per_query(feeds.query_feeds)


@query
def completeness_window(feeds: Feeds) -> DataFrame:
    return feeds.query_feeds.window_frame()


@query
def price_usage_half_open(feeds: Feeds) -> DataFrame:
    priced = pricing.price_usage(
        feeds.billing_lines, feeds.list_prices, span=billing_facts.price_span(LINES_AS_OF, LINES_DAYS)
    )
    return priced.select("workspace_id", "sku_name", "cloud", "usage_start_time", "unit_price", "units", "dollars")


@query
def price_usage_closed(feeds: Feeds) -> DataFrame:
    priced = pricing.price_usage(
        feeds.billing_usage, feeds.list_prices, keys=("sku_name", "usage_unit"), at="usage_end_time",
        closed="both", on_missing=None,
    )
    return priced.select("workspace_id", "sku_name", "usage_end_time", "unit_price", "units", "dollars")


@query
def query_work(feeds: Feeds) -> DataFrame:
    return allocation.query_work(feeds.query_history).select(
        "statement_id", "query_work_start_time", "query_work_end_time", "query_work_task_time"
    )


@query
def source_type(feeds: Feeds) -> DataFrame:
    return allocation.classify_source(feeds.query_history).select(
        "statement_id", "query_source_type", "query_source_id", "client_application"
    )


@query
def state_intervals(feeds: Feeds) -> DataFrame:
    return query_cost.query_states(feeds.query_feeds, *_window(feeds))


@query
def concurrency_sweep(feeds: Feeds) -> DataFrame:
    return query_cost.query_activity(feeds.query_feeds, *_window(feeds))


@query
def split_by_day(feeds: Feeds) -> DataFrame:
    return intervals.split_by_day(query_cost.query_activity(feeds.query_feeds, *_window(feeds)))


@query
def timeline_segments(feeds: Feeds) -> DataFrame:
    lo, hi = _window(feeds)
    states = query_cost.query_states(feeds.query_feeds, lo, hi)
    active = query_cost.query_activity(feeds.query_feeds, lo, hi)
    keys = allocation.warehouse_queries(feeds.query_history, lo, hi).select("warehouse_id").distinct()
    edges = [(states, "start"), (states, "end"), (active, "start"), (active, "end")]
    return intervals.segment_timeline(keys, "warehouse_id", edges, lo, hi)


@query
def period_utilization(feeds: Feeds) -> DataFrame:
    return query_cost.period_utilization(feeds.query_feeds, *_window(feeds))


@query
def classify_periods(feeds: Feeds) -> DataFrame:
    lo, hi = _window(feeds)
    busy = allocation.warehouse_queries(feeds.query_history, lo, hi).select("warehouse_id").distinct()
    return intervals.classify_periods(
        busy,
        "warehouse_id",
        query_cost.query_states(feeds.query_feeds, lo, hi),
        query_cost.query_activity(feeds.query_feeds, lo, hi),
        lo,
        hi,
    )


@query
def hourly_utilization(feeds: Feeds) -> DataFrame:
    return intervals.hourly_utilization(
        query_cost.period_utilization(feeds.query_feeds, *_window(feeds)), "warehouse_id"
    )


@query
def hour_cost(feeds: Feeds) -> DataFrame:
    return query_cost.warehouse_hour_cost(feeds.query_feeds, *_window(feeds))


@query
def apportion_by_hour(feeds: Feeds) -> DataFrame:
    return allocation.apportion_by_hour(_work(feeds))


@query
def work_share(feeds: Feeds) -> DataFrame:
    return allocation.share_of(
        allocation.apportion_by_hour(_work(feeds)).drop("overlap_duration"),
        ["warehouse_id", "hour_bucket"],
        "attributed_query_work",
        "total_work_done_on_warehouse",
        "proportion_of_warehouse_time_used_by_query",
    )


@query
def attribute_cost(feeds: Feeds) -> DataFrame:
    return query_cost.attributed_hours(feeds.query_feeds, *_window(feeds)).drop("overlap_duration")


@query
def idle_residual(feeds: Feeds) -> DataFrame:
    lo, hi = _window(feeds)
    return allocation.idle_residual(
        query_cost.attributed_hours(feeds.query_feeds, lo, hi),
        query_cost.warehouse_hour_cost(feeds.query_feeds, lo, hi),
    )


@query
def cost_per_query(feeds: Feeds) -> DataFrame:
    hours = F.size("statement_hour_bucket_costs").alias("hours")
    return query_cost.cost_per_query(feeds.query_feeds).select("*", hours).drop("statement_hour_bucket_costs")


@query
def cost_per_query_hours(feeds: Feeds) -> DataFrame:
    cost = query_cost.cost_per_query(feeds.query_feeds)
    return cost.select("statement_id", F.inline("statement_hour_bucket_costs"))


@query
def cost_per_query_closed(feeds: Feeds) -> DataFrame:
    cost = query_cost.cost_per_query(feeds.query_feeds, rules=query_cost.CLOSED_RULES)
    return cost.select(
        "statement_id",
        "query_work_task_time_seconds",
        "query_attributed_dollars_estimation",
        "query_attributed_units_estimation",
        "billing_record_check",
    )


@query
def deep_links(feeds: Feeds) -> DataFrame:
    sources = allocation.classify_source(feeds.query_history)
    return sources.select(
        "statement_id",
        deep_link(F.col("query_source_type"), F.col("query_source_id")).alias("url_helper"),
        profile_link(F.col("statement_id")).alias("query_profile_url"),
    )


# -- facts -------------------------------------------------------------------------------


def _index_cost(feeds: Feeds) -> DataFrame:
    return billing_facts.index_cost_fact(
        feeds.billing_lines, feeds.list_prices, feeds.workspaces, LINES_AS_OF, LINES_DAYS
    )


@query
def token_usage_fact(feeds: Feeds) -> DataFrame:
    return billing_facts.token_usage_fact(
        feeds.billing_lines, feeds.list_prices, feeds.spaces, LINES_AS_OF, LINES_DAYS
    )


@query
def token_usage_fact_closed(feeds: Feeds) -> DataFrame:
    return billing_facts.token_usage_fact(
        feeds.billing_lines, feeds.list_prices, feeds.spaces,
        price_keys=("sku_name", "usage_unit"), price_at="usage_end_time", price_closed="both",
    )


@query
def index_cost_fact(feeds: Feeds) -> DataFrame:
    return _index_cost(feeds)


@query
def app_billing(feeds: Feeds) -> DataFrame:
    return app_usage.app_billing(feeds.billing_usage, feeds.list_prices, EVENTS_AS_OF)


@query
def name_crosswalk(feeds: Feeds) -> DataFrame:
    return app_usage.name_crosswalk(feeds.billing_usage, EVENTS_AS_OF)


@query
def app_audit(feeds: Feeds) -> DataFrame:
    return app_usage.app_audit(feeds.audit_events, EVENTS_AS_OF)


@query
def app_usage_fact(feeds: Feeds) -> DataFrame:
    return app_usage.app_usage_fact(
        feeds.billing_usage, feeds.list_prices, feeds.audit_events, feeds.workspaces, EVENTS_AS_OF
    )


@query
def latest_version(feeds: Feeds) -> DataFrame:
    return serving_usage.current_entities(feeds.served_entities, EVENTS_AS_OF)


def _by_entity(feeds: Feeds) -> DataFrame:
    return serving_usage.entity_requests(feeds.endpoint_requests, latest_version(feeds), EVENTS_AS_OF)


@query
def request_usage(feeds: Feeds) -> DataFrame:
    return serving_usage.request_usage(_by_entity(feeds))


@query
def serving_billing(feeds: Feeds) -> DataFrame:
    return serving_usage.serving_billing(feeds.billing_usage, feeds.list_prices, EVENTS_AS_OF)


@query
def representative_entity(feeds: Feeds) -> DataFrame:
    return serving_usage.representative_entity(latest_version(feeds), _by_entity(feeds))


@query
def serving_usage_fact(feeds: Feeds) -> DataFrame:
    return serving_usage.serving_usage_fact(
        feeds.billing_usage, feeds.list_prices, feeds.served_entities, feeds.endpoint_requests,
        feeds.workspaces, EVENTS_AS_OF,
    )


@query
def reach_fact(feeds: Feeds) -> DataFrame:
    return reach.reach_fact(feeds.spaces, feeds.audit_events, feeds.workspaces, EVENTS_AS_OF)


@query
def dashboard_views(feeds: Feeds) -> DataFrame:
    return reach.dashboard_views(feeds.dashboards, feeds.audit_events, feeds.workspaces, EVENTS_AS_OF)


# -- assistant spaces --------------------------------------------------------------------


def _messages(feeds: Feeds) -> DataFrame:
    return documents.flatten_messages(feeds.raw_messages, feeds.users)


def _statements(feeds: Feeds) -> DataFrame:
    return documents.message_statements(feeds.raw_messages, feeds.users)


def _per_message(feeds: Feeds) -> DataFrame:
    return assistant_cost.cost_per_message(_statements(feeds), _cost(feeds), _messages(feeds))


def _categorised(feeds: Feeds) -> DataFrame:
    return assistant_cost.categorise_cost(_cost(feeds), _statements(feeds))


@query
def cost_per_message(feeds: Feeds) -> DataFrame:
    return _per_message(feeds)


@query
def cost_category(feeds: Feeds) -> DataFrame:
    return _categorised(feeds).select(
        "statement_id", "query_source_id", "workspace_id", "query_attributed_dollars_estimation",
        "cost_category", "cost_class",
    )


@query
def space_cost(feeds: Feeds) -> DataFrame:
    return assistant_cost.space_cost(_cost(feeds))


@query
def space_cost_by_category(feeds: Feeds) -> DataFrame:
    return assistant_cost.space_cost_by_category(_categorised(feeds), feeds.spaces)


@query
def reconcile_space_cost(feeds: Feeds) -> DataFrame:
    return assistant_cost.reconcile_space_cost(_cost(feeds), _per_message(feeds))


@query
def space_statements(feeds: Feeds) -> DataFrame:
    return reports.space_statements(_cost(feeds), _messages(feeds), REPORT_FROM, REPORT_TO).select(
        "statement_id", "query_source_id", "start_time", "query_attributed_dollars_estimation"
    )


@query
def error_mix(feeds: Feeds) -> DataFrame:
    return reports.error_mix(_messages(feeds))


@query
def user_engagement(feeds: Feeds) -> DataFrame:
    return reports.user_engagement(_messages(feeds))


@query
def cost_by_source(feeds: Feeds) -> DataFrame:
    return reports.cost_by_source(_cost(feeds))


@query
def cost_trend(feeds: Feeds) -> DataFrame:
    return reports.cost_trend(_cost(feeds), _messages(feeds), EVENTS_AS_OF)


# -- documents ---------------------------------------------------------------------------


@query
def flatten_messages(feeds: Feeds) -> DataFrame:
    return _messages(feeds)


@query
def message_statements(feeds: Feeds) -> DataFrame:
    return _statements(feeds)


def _comments(feeds: Feeds) -> DataFrame:
    return documents.message_comments(feeds.raw_comments, _messages(feeds))


@query
def message_comments(feeds: Feeds) -> DataFrame:
    return _comments(feeds)


@query
def comment_counts(feeds: Feeds) -> DataFrame:
    counted = documents.with_child_count(_messages(feeds), _comments(feeds), "message_id")
    return counted.select("message_id", "feedback_rating", "num_comments")


@query
def resolve_users(feeds: Feeds) -> DataFrame:
    orders = feeds.table("orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("user_id"))
    return documents.resolve_users(orders, feeds.users)


@query
def acl_counts(feeds: Feeds) -> DataFrame:
    return documents.acl_counts(feeds.acl_documents).select(
        "full_name", "num_users_with_access", "num_groups_with_access"
    )


@query
def served_models(feeds: Feeds) -> DataFrame:
    return documents.served_models(feeds.endpoint_documents).select("id", "models")


@query
def flatten_apps(feeds: Feeds) -> DataFrame:
    return documents.flatten_apps(feeds.app_documents)


@query
def flatten_subscriptions(feeds: Feeds) -> DataFrame:
    return documents.flatten_subscriptions(feeds.subscription_documents)


@query
def parse_times(feeds: Feeds) -> DataFrame:
    docs = feeds.acl_documents.select("full_name", "created_at", "updated_at", F.col("name").alias("iso"))
    return documents.parse_times(docs, ["created_at", "updated_at"], ["iso"])


@query
def parse_times_whole_seconds(feeds: Feeds) -> DataFrame:
    docs = feeds.acl_documents.select("full_name", "created_at")
    return documents.parse_times(docs, ["created_at"], keep_millis=False)


@query
def entity_models(feeds: Feeds) -> DataFrame:
    return documents.entity_table(feeds.acl_documents, "models")


@query
def entity_serving_endpoints(feeds: Feeds) -> DataFrame:
    return documents.entity_table(feeds.endpoint_documents, "serving_endpoints")


@query
def entity_apps(feeds: Feeds) -> DataFrame:
    return documents.entity_table(feeds.app_documents, "apps")


@query
def entity_subscriptions(feeds: Feeds) -> DataFrame:
    return documents.entity_table(feeds.subscription_documents, "dashboard_subscriptions")


@query
def entity_spaces(feeds: Feeds) -> DataFrame:
    raw = feeds.table("supplier").select(
        F.concat(F.lit("sp-"), F.col("s_suppkey").cast("string")).alias("space_id"),
        F.col("s_name").alias("title"),
        F.lit(None).cast("string").alias("description"),
        F.concat(F.lit("wh-"), F.col("s_nationkey").cast("string")).alias("warehouse_id"),
    )
    return documents.entity_table(raw, "spaces")


@query
def entity_conversations(feeds: Feeds) -> DataFrame:
    conv, turn = F.col("conv_id"), F.col("turn")
    raw = feeds.table("conversations").select(
        F.concat(F.lit("sp-"), (conv % 7).cast("string")).alias("space_id"),
        F.concat_ws("-", conv.cast("string"), turn.cast("string")).alias("conversation_id"),
        (F.lit(1704067200123) + conv * 3600000 + turn * 60000).alias("created_timestamp"),
        F.col("text").alias("title"),
        conv.alias("user_id"),
    )
    return documents.entity_table(raw, "conversations")


def _board_documents(feeds: Feeds) -> DataFrame:
    key = F.col("o_orderkey").cast("string")
    at = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return feeds.table("orders").select(
        F.concat(F.lit("d-"), key).alias("dashboard_id"),
        F.concat(F.lit("sc-"), key).alias("schedule_id"),
        F.concat(F.lit("Board "), F.col("o_orderpriority")).alias("display_name"),
        at.alias("create_time"),
        F.when(F.col("o_orderstatus") == "F", "TRASHED").otherwise("ACTIVE").alias("lifecycle_state"),
        F.when(F.col("o_orderstatus") == "O", "unknown").otherwise(at).alias("update_time"),
        F.concat(F.lit("wh-"), F.col("o_custkey").cast("string")).alias("warehouse_id"),
        F.when(F.col("o_orderstatus") == "F", "PAUSED").otherwise("UNPAUSED").alias("pause_status"),
    )


@query
def entity_dashboards(feeds: Feeds) -> DataFrame:
    return documents.entity_table(_board_documents(feeds), "dashboards")


@query
def entity_dashboard_schedules(feeds: Feeds) -> DataFrame:
    return documents.entity_table(_board_documents(feeds), "dashboard_schedules")


# -- quality -----------------------------------------------------------------------------


@query
def dq_unique(feeds: Feeds) -> DataFrame:
    return quality.check_unique(feeds.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_unique_facts(feeds: Feeds) -> DataFrame:
    """Grain violations of the three billed facts together; there are none."""
    apps = quality.check_unique(app_usage_fact(feeds), ["app_id", "usage_date", "workspace_id"])
    serving = quality.check_unique(serving_usage_fact(feeds), ["endpoint_id", "usage_date", "workspace_id"])
    index = quality.check_unique(_index_cost(feeds), ["endpoint_id", "usage_date", "workspace_id", "sku_name"])
    parts = [
        violations.agg(F.count("*").alias("violations")).withColumn("fact", F.lit(name))
        for name, violations in (("app_usage", apps), ("serving_usage", serving), ("index_cost", index))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def bad_documents(feeds: Feeds) -> DataFrame:
    """Lines that are no documents, and how many are: a tenth of the event properties is cut short."""
    line = F.when(F.col("k") % 10 == 0, F.left("props", F.lit(5))).otherwise(F.col("props"))
    good, bad = tables.split_documents(feeds.events.select(line.alias("value")), schemas.struct("k int"))
    counted = bad.groupBy("bad_line").agg(F.count("*").alias("lines"))
    return counted.unionByName(good.agg(F.count("*").alias("lines")).withColumn("bad_line", F.lit("good")))


@query
def dq_schema_facts(feeds: Feeds) -> DataFrame:
    """Schema problems of all nine facts, with the rows of each fact."""
    cost = _cost(feeds)
    built = {
        "index_cost": _index_cost(feeds),
        "token_usage": token_usage_fact(feeds),
        "app_usage": app_usage_fact(feeds),
        "serving_usage": serving_usage_fact(feeds),
        "reach": reach_fact(feeds),
        "dashboard_views": dashboard_views(feeds),
        "cost_per_query": cost,
        "cost_per_message": cost_per_message(feeds),
        "cost_category": _categorised(feeds),
    }
    rows = None
    for name, fact in built.items():
        problems = quality.check_schema(fact, schemas.fact(name), name).agg(F.count("*").alias("problems"))
        counted = problems.select(F.lit(name).alias("fact"), "problems", fact.agg(F.count("*")).scalar().alias("rows"))
        rows = counted if rows is None else rows.unionByName(counted)
    return rows


@query
def dq_facts(feeds: Feeds) -> DataFrame:
    """Negative measures and missing labels in the three billed facts; there are none."""
    sides = [
        ("index_cost", _index_cost(feeds), ["units", "dollars"], ["endpoint_name"]),
        ("app_usage", app_usage_fact(feeds), ["units", "dollars", "lifecycle_events", "distinct_users"], ["app_name"]),
        ("serving_usage", serving_usage_fact(feeds), ["units", "dollars", "request_count"], ["entity_name"]),
    ]
    rows = None
    for name, fact, measures, labels in sides:
        negative = F.count_if(functools.reduce(operator.or_, [F.col(c) < 0 for c in measures]))
        missing = F.count_if(functools.reduce(operator.or_, [F.col(c).isNull() for c in labels]))
        counted = fact.agg(negative.alias("negative"), missing.alias("unlabelled"), F.count("*").alias("rows"))
        counted = counted.withColumn("fact", F.lit(name))
        rows = counted if rows is None else rows.unionByName(counted)
    return rows


@query
def usage_measures(feeds: Feeds) -> DataFrame:
    """Requests and tokens of endpoints by workspace, and the users of apps from rows that hold them."""
    requests = reconcile.measure(
        serving_usage_fact(feeds),
        ["workspace_id"],
        reconcile.sum_measures(["request_count", "input_tokens", "output_tokens"]),
    )
    events = app_usage.app_events(feeds.audit_events, EVENTS_AS_OF)
    users = reconcile.measure(events, ["workspace_id"], {"app_users": reconcile.distinct_measure("email")})
    return requests.join(users, "workspace_id", "full")


@query
def fact_totals(feeds: Feeds) -> DataFrame:
    """Billed totals of each fact, and whether the fact's own totals equal them.

    A fact rounds each of its rows to six digits, so it may differ by half of the last
    digit a row.
    """
    lines, since = feeds.billing_lines, billing_facts.price_span(LINES_AS_OF, LINES_DAYS)
    origin = (F.col("usage_type") == "TOKEN") & (F.col("record_type") == "ORIGINAL")
    year = billing_facts.price_span(EVENTS_AS_OF, 365)
    sides = [
        ("index_cost", _index_cost(feeds), billing_facts.product_usage(lines, "VECTOR_INDEX", LINES_AS_OF, LINES_DAYS), since),
        (
            "token_usage",
            token_usage_fact(feeds).withColumnsRenamed({"token_units": "units", "token_cost": "dollars"}),
            billing_facts.product_usage(lines, "ASSISTANT", LINES_AS_OF, LINES_DAYS).where(origin),
            since,
        ),
        ("app_usage", app_usage_fact(feeds), app_usage.app_rows(feeds.billing_usage, EVENTS_AS_OF, 365), year),
        (
            "serving_usage",
            serving_usage_fact(feeds),
            billing_facts.product_usage(feeds.billing_usage, "MODEL_SERVING", EVENTS_AS_OF, 365),
            year,
        ),
    ]
    rows = [
        reconcile.totals_against_billing(fact, pricing.price_usage(rows, feeds.list_prices, span=span)).withColumn("fact", F.lit(name))
        for name, fact, rows, span in sides
    ]
    merged = rows[0]
    for more in rows[1:]:
        merged = merged.unionByName(more)
    return merged.withColumns({c: F.round(F.col(c).cast("double"), 3) for c in ("billed_units", "billed_dollars")})


@query
def dq_non_negative(feeds: Feeds) -> DataFrame:
    balances = feeds.table("customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return quality.check_non_negative(balances, ["c_acctbal", "c_nationkey"])


@query
def dq_not_null(feeds: Feeds) -> DataFrame:
    rows = feeds.query_history.select("statement_id", "client_application", "statement_type")
    return quality.check_not_null(rows, ["client_application", "statement_type"])


@query
def dq_schema(feeds: Feeds) -> DataFrame:
    """Schema problems of the events table, with the rows they concern."""
    events = feeds.table("events")
    expected = schemas.struct(
        "event_id bigint, ts timestamp_ntz, user_id string, event_type string, value double, session_id string"
    )
    problems = quality.check_schema(events, expected, "events")
    return problems.withColumn("rows", events.agg(F.count("*")).scalar())


@query
def observed_values(feeds: Feeds) -> DataFrame:
    return quality.observed_values(feeds.billing_lines, "sku_name", "usage_start_time", LINES_AS_OF, 30)


# -- incremental -------------------------------------------------------------------------


@query
def incremental_usage(feeds: Feeds) -> DataFrame:
    """Daily sums kept by a file stream over the events."""
    spark = feeds.spark
    folder = f"{shared_dir(spark)}/incremental-{uuid4().hex}"
    stream = (
        spark.readStream.schema(feeds.table("events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(feeds.folder)
        .withColumn("usage_date", F.col("ts").cast("date"))
    )
    keys = ["usage_date", "event_type"]
    sums = {"events": F.lit(1).cast("bigint"), "amount": F.col("value").cast("decimal(18,6)")}
    incremental.stream_partial_sums(stream, keys, sums, f"{folder}/sums", f"{folder}/progress").awaitTermination()
    return incremental.read_partial_sums(spark, f"{folder}/sums", keys, list(sums))


def _arriving(rows: DataFrame, at: str, late: Column) -> DataFrame:
    """Rows with ``arrived_at``: when they happened, or for late ones a day after the first load."""
    after = as_column(FIRST_LOAD) + F.expr("interval 1 day")
    return rows.withColumn("arrived_at", F.when(F.coalesce(late, F.lit(False)), F.greatest(F.col(at), after)).otherwise(F.col(at)))


def _one_in(n: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)) == 0


@query
def cost_per_query_incremental(feeds: Feeds) -> DataFrame:
    """Cost per query in three loads.

    The second follows the stored marks of the first to later and late rows of history,
    events and billing.  The third corrects end times, deletes statements and events,
    brings the earlier prices of a SKU, and billing from before the window.
    """
    spark, whole = feeds.spark, feeds.query_feeds
    folder = f"{shared_dir(spark)}/cost-{uuid4().hex}"
    begins = as_column(whole.window()[0]) + F.expr("interval 2 days")

    # what is wrong until the third load
    wrong, extra = _one_in(40, "statement_id"), _one_in(60, "statement_id")
    delayed = F.when(wrong, F.col("end_time") + F.expr("interval 6 hours")).otherwise(F.col("end_time"))
    bogus = whole.history.filter(extra).withColumn("statement_id", F.concat(F.lit("gone-"), "statement_id"))
    history = whole.history.withColumn("end_time", delayed).unionByName(bogus)
    bogus_events = whole.events.filter(_one_in(20, "event_time")).withColumns(
        {"event_time": F.col("event_time") + F.expr("interval 3 hours"), "cluster_count": F.lit(0)}
    )
    events = whole.events.unionByName(bogus_events)
    early_prices = (F.col("sku_name") == "WH_1") & F.col("price_end_time").isNotNull()
    old_billing = F.col("usage_start_time") < begins
    prices, usage = whole.prices.filter(~early_prices), whole.usage.filter(~old_billing)

    feed = {
        "query_history": _arriving(history, "start_time", _one_in(50, "statement_id")),
        "warehouse_events": _arriving(events, "event_time", _one_in(50, "event_time")),
        "billing_usage": _arriving(usage, "usage_start_time", _one_in(50, "usage_start_time", "sku_name")),
    }
    first = {name: incremental.load_up_to(rows, "arrived_at", FIRST_LOAD) for name, rows in feed.items()}
    incremental_cost.load_costs(folder, QueryFeeds(*first.values(), prices))
    marks = incremental.no_marks(spark)
    for name, rows in first.items():
        marks = incremental.advance_marks(marks, rows, name, "arrived_at")
    incremental_cost.save_marks(marks, f"{folder}/marks", 0)

    marks = incremental_cost.read_marks(spark, f"{folder}/marks", 0)
    new = [incremental.rows_after_marks(rows, marks, name, "arrived_at", overlap="0 seconds") for name, rows in feed.items()]
    second = QueryFeeds(*feed.values(), prices)
    incremental_cost.load_costs(folder, second, QueryFeeds(*new, prices.limit(0)))

    corrected = whole.history.filter(wrong)
    changed = QueryFeeds(
        incremental_cost.both_versions(history, corrected, ["statement_id"], deleted=bogus),
        bogus_events,
        whole.usage.filter(old_billing),
        whole.prices.filter(early_prices),
    )
    incremental_cost.load_costs(folder, whole, changed)
    cost = incremental_cost.read_costs(spark, folder)
    return cost.withColumn("hours", F.size("statement_hour_bucket_costs")).drop("statement_hour_bucket_costs")


def _streamed(feeds: Feeds, fact: daily.DailyFact) -> DataFrame:
    """Sums of a daily fact after three runs over files in the order of arrival.

    The lines of each half of the days come by themselves; one in thirty is late and
    comes last, up to years after its day.
    """
    spark, folder = feeds.spark, f"{shared_dir(feeds.spark)}/daily-{uuid4().hex}"
    lines, landed = feeds.billing_lines, f"{folder}/landed"
    late = _one_in(30, "usage_start_time", "usage_metadata.endpoint_id", "identity_metadata.run_as")
    middle = as_column(f"{LINES_AS_OF}") - F.make_interval(days=F.lit(LINES_DAYS // 2))
    first = F.col("usage_start_time") < middle
    for part in (~late & first, ~late & ~first, late):
        lines.filter(part).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(lines.schema).parquet(landed)
        daily.run_daily(fact, stream, spark.read.schema(lines.schema).parquet(landed), folder, "3 days")
    return fact.read(spark, folder)


@query
def index_cost_stream(feeds: Feeds) -> DataFrame:
    """Index cost kept by an event-time stream, with late lines."""
    fact = billing_stream.index_stream_fact(feeds.list_prices, LINES_AS_OF, LINES_DAYS, "year")
    return billing_facts.index_fact_of(_streamed(feeds, fact), feeds.workspaces)


@query
def token_usage_stream(feeds: Feeds) -> DataFrame:
    """Token usage kept by an event-time stream, with late lines."""
    fact = billing_stream.token_stream_fact(feeds.list_prices, LINES_AS_OF, LINES_DAYS, "year")
    return billing_facts.token_fact_of(_streamed(feeds, fact), feeds.spaces)


@query
def messages_stream(feeds: Feeds) -> DataFrame:
    """Messages kept by a stream, with files that land twice and versions that land late."""
    spark, folder = feeds.spark, f"{shared_dir(feeds.spark)}/messages-{uuid4().hex}"
    raw, landed = feeds.raw_messages, f"{folder}/landed"
    early = F.pmod(F.xxhash64("id"), F.lit(3)) > 0
    older = raw.filter(_one_in(5, "id")).withColumns(
        {"last_updated_timestamp": F.col("last_updated_timestamp") - 60000, "content": F.lit("an older version")}
    )
    for part in (raw.filter(early), raw.filter(~early).unionByName(raw.filter(_one_in(4, "id"))), older):
        part.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(raw.schema).parquet(landed)
        kept = messages.stream_messages(stream, feeds.users, f"{folder}/messages", f"{folder}/progress", period="year")
        kept.awaitTermination()
    return spark.read.parquet(f"{folder}/messages").drop(messages.DAY)


@query
def distinct_users_by_month(feeds: Feeds) -> DataFrame:
    """Viewers by workspace and month, from bitmaps by workspace, space and day."""
    viewed = feeds.audit_events.filter(F.col("service_name") == "assistant").select(
        "workspace_id",
        F.col("request_params")["space_id"].alias("space_id"),
        F.col("event_date").alias("day"),
        F.col("user_identity.email").alias("email"),
    )
    numbers = distinct.number_ids(viewed, "email")
    daily_bits = distinct.distinct_bitmaps(viewed.join(numbers, "email"), ["workspace_id", "space_id", "day"])
    by_month = daily_bits.withColumn("month", F.date_trunc("month", "day").cast("date"))
    return distinct.count_bitmaps(by_month, ["workspace_id", "month"], "distinct_users")


@query
def space_cost_by_stored_category(feeds: Feeds) -> DataFrame:
    """Cost by category from the stored categories, which were filled in two loads."""
    spark, cost, run = feeds.spark, staged(_cost(feeds)), uuid4().hex
    links = _statements(feeds).select("statement_id")
    first = F.col("start_time") <= as_column(FIRST_LOAD)
    categories, costs = f"cost_categories_{run}", f"space_costs_{run}"
    # a third of the links are not known at first
    category_table.fill_categories(cost.filter(first), links.filter(~_one_in(3, "statement_id")), categories, buckets=8)
    category_table.fill_categories(cost, links, categories, buckets=8)
    category_table.save_cost(cost, costs, buckets=8)
    stored = category_table.categorised_cost(spark, costs, categories)
    return assistant_cost.space_cost_by_category(stored, feeds.spaces)


@query
def dq_in_write(feeds: Feeds) -> DataFrame:
    """Violations counted while tables are written."""
    folder = f"{shared_dir(feeds.spark)}/written-{uuid4().hex}"
    customer = feeds.table("customer").select("c_custkey", "c_nationkey", "c_acctbal")
    history = feeds.query_history.select("statement_id", "client_application", "statement_type")
    counts = {
        "customer": quality.write_checked(
            customer, lambda df: df.write.parquet(f"{folder}/customer"), unique=["c_nationkey", "c_acctbal"], non_negative=["c_acctbal"]
        ),
        "history": quality.write_checked(
            history,
            lambda df: df.write.parquet(f"{folder}/history"),
            unique=["statement_id"],
            not_null=["client_application", "statement_type"],
        ),
    }
    rows = [(table, rule, n) for table, found in counts.items() for rule, n in found.items()]
    return tables.rows_to_frame(feeds.spark, rows, "table_name string, rule string, n bigint")


@query
def incremental_marks(feeds: Feeds) -> DataFrame:
    """Rows that a first load and the load after its marks read, by workspace."""
    history = feeds.query_history.select("workspace_id", "statement_id", "start_time")
    first = incremental.load_up_to(history, "start_time", FIRST_LOAD)
    marks = incremental.advance_marks(incremental.no_marks(feeds.spark), first, "query_history", "start_time")
    again = incremental.rows_after_marks(history, marks, "query_history", "start_time", overlap="1 hour")
    second = again.join(first.select("statement_id"), "statement_id", "left_anti")
    steps = first.withColumn("step", F.lit("first")).unionByName(second.withColumn("step", F.lit("second")))
    return steps.groupBy("workspace_id", "step").agg(F.count("*").alias("rows"))


@query
def upsert_latest(feeds: Feeds) -> DataFrame:
    existing = feeds.table("orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderdate").cast("timestamp").alias("changed_at"),
        F.col("o_orderstatus").alias("status"),
    )
    incoming = feeds.table("lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_shipdate").cast("timestamp").alias("changed_at"),
        F.col("l_linestatus").alias("status"),
    )
    return incremental.upsert_latest(existing, incoming, ["order_key"], ["changed_at"])


@query
def measures_by_dim(feeds: Feeds) -> DataFrame:
    return reconcile.measure(_index_cost(feeds), ["workspace_name", "sku_name"], reconcile.cost_measures())


@query
def crosswalk_by_brand(feeds: Feeds) -> DataFrame:
    """The supplier that sold most of each brand in each nation."""
    sold = (
        feeds.table("lineitem")
        .join(feeds.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
        .join(feeds.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey")
        .withColumn("quantity", F.col("l_quantity").cast("decimal(18,2)"))
    )
    return versions.crosswalk(sold, ["s_nationkey"], "p_brand", "l_suppkey", "quantity")
