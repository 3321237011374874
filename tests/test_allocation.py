import pytest
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.functions.classify import deep_link
from ledgerlight.operators import allocation as al
from ledgerlight.plans.query_cost import CLOSED_RULES, QueryFeeds, Rules, attributed_hours, cost_per_query, warehouse_hour_cost

WORK = "statement_id string, warehouse_id string, query_work_start_time timestamp, query_work_end_time timestamp, query_work_task_time double"


@pytest.fixture
def work(frame):
    return frame(
        WORK,
        ("two hours", "w", "2024-01-01 10:45:00", "2024-01-01 11:15:00.5", 30.0),
        ("midnight", "w", "2024-01-01 23:59:59.5", "2024-01-02 00:00:00.25", 8.0),
        ("in a second", "w", "2024-01-01 12:00:00.1", "2024-01-01 12:00:00.2", 2.0),
        ("no time", "w", "2024-01-01 13:00:00", "2024-01-01 13:00:00", 4.0),
        ("backwards", "w", "2024-01-01 14:00:00.7", "2024-01-01 13:59:59", 5.0),
        ("full hour", "w", "2024-01-01 15:00:00", "2024-01-01 16:00:00", 6.0),
    )


def test_apportioned_work_adds_up(work):
    parts = al.apportion_by_hour(work).groupBy("statement_id").agg(F.sum("attributed_query_work").alias("w"))
    got = {r.statement_id: round(r.w, 9) for r in parts.collect()}
    assert got == {"two hours": 30.0, "midnight": 8.0, "in a second": 2.0, "no time": 4.0, "backwards": 5.0, "full hour": 6.0}


def test_whole_second_overlaps(work):
    parts = al.apportion_by_hour(work, "second").groupBy("statement_id").agg(F.sum("attributed_query_work").alias("w"))
    got = {r.statement_id: round(r.w, 6) for r in parts.collect()}
    assert got["in a second"] == 0 and got["no time"] == 0 and got["backwards"] == 0
    assert got["two hours"] == round(30 * 1800 / 1800.5, 6)


def test_unknown_precision_is_refused(work):
    with pytest.raises(ValueError, match="precision"):
        al.apportion_by_hour(work, "minute")


def test_shares_add_up_to_one(work):
    shared = al.share_of(al.apportion_by_hour(work), ["warehouse_id", "hour_bucket"], "attributed_query_work", "total", "share")
    for row in shared.groupBy("hour_bucket").agg(F.sum("share").alias("s")).collect():
        assert row.s is None or abs(row.s - 1) < 1e-9


def history_row(statement, start, end, warehouse="w", task=1000, kind="SELECT", source=None, client="Console", text="SELECT 1", **ms):
    source = source or {}
    return {
        "statement_id": statement, "workspace_id": "1", "executed_by": "u", "statement_text": text,
        "statement_type": kind, "client_application": client, "compute": {"warehouse_id": warehouse},
        "total_task_duration_ms": task, "waiting_at_capacity_duration_ms": ms.get("queue"),
        "waiting_for_compute_duration_ms": ms.get("wait"), "compilation_duration_ms": ms.get("compile"),
        "result_fetch_duration_ms": ms.get("fetch"), "start": start, "end": end, "query_source": source,
    }


@pytest.fixture
def history(spark):
    ddl = schemas.FEEDS["query_history"].replace("start_time timestamp, end_time timestamp", "start string, end string")

    def make(*given):
        df = spark.createDataFrame(list(given), ddl)
        return df.withColumns({"start_time": df.start.cast("timestamp"), "end_time": df.end.cast("timestamp")}).drop("start", "end")

    return make


def test_work_follows_waiting_and_includes_the_fetch(history, rows):
    got = al.query_work(history(history_row("a", "2024-01-01 10:00:00", "2024-01-01 10:01:00", queue=500, wait=250, compile=250, fetch=100)))
    assert rows(got, "query_work_start_time", "query_work_end_time", "query_work_task_time") == [
        ("2024-01-01 10:00:01", "2024-01-01 10:01:00.1", 1.35)
    ]


def test_sources_by_priority(history, rows):
    day = ("2024-01-01 10:00:00", "2024-01-01 10:01:00")
    got = al.classify_source(history(
        history_row("1", *day, source={"job_info": {"job_id": "j"}, "alert_id": "al"}),
        history_row("2", *day, source={"legacy_dashboard_id": "l", "dashboard_id": "d"}),
        history_row("3", *day, source={"alert_id": "al", "notebook_id": "n"}),
        history_row("4", *day, source={"assistant_space_id": "s"}),
        history_row("5", *day),
        history_row("6", *day, client=None),
    )).withColumn("link", deep_link(F.col("query_source_type"), F.col("query_source_id")))
    assert rows(got, "statement_id", "query_source_type", "query_source_id", "client_application", "link") == [
        ("1", "JOB", "j", "Console", "/jobs/j"),
        ("2", "LEGACY DASHBOARD", "l", "Console", "/sql/dashboards/l"),
        ("3", "ALERT", "al", "Console", "/sql/alerts/al"),
        ("4", "ASSISTANT SPACE", "s", "Console", ""),
        ("5", "Console", "UNKNOWN", "Console", ""),
        ("6", "UNKNOWN", "UNKNOWN", "Unknown", ""),
    ]


@pytest.fixture
def feeds(frame, history):
    """One warehouse, ON 10:00-11:30, two queries in hour 10 and one in hour 11 without billing."""
    events = frame("warehouse_id string, event_time timestamp, cluster_count int",
                   ("w", "2024-01-01 09:00:00", 1), ("w", "2024-01-01 11:30:00", 0), ("unused", "2024-01-01 10:00:00", 1))
    usage = frame("warehouse_id string, usage_start_time timestamp, usage_end_time timestamp, usage_quantity string",
                  ("w", "2024-01-01 10:00:00", "2024-01-01 11:00:00", "3"), ("w", "2024-01-01 10:00:00", "2024-01-01 11:00:00", "1"),
                  ("w", "2024-01-01 12:00:00", "2024-01-01 13:00:00", "5"), (None, "2024-01-01 10:00:00", "2024-01-01 11:00:00", "7"))
    usage = usage.select(F.struct("warehouse_id").alias("usage_metadata"), "usage_start_time", "usage_end_time", "usage_quantity",
                         F.lit("S").alias("sku_name"), F.lit("U").alias("usage_unit"), F.lit("A").alias("cloud"))
    prices = frame("sku_name string, cloud string, usage_unit string, currency_code string, price_start_time timestamp, price_end_time timestamp, p string",
                   ("S", "A", "U", "USD", "2023-01-01", None, "0.5"))
    prices = prices.withColumn("pricing", F.struct(F.struct(F.col("p").cast("decimal(38,18)").alias("default")).alias("effective_list")))
    given = history(
        history_row("a", "2024-01-01 10:00:00", "2024-01-01 10:20:00", task=3000),
        history_row("b", "2024-01-01 10:10:00", "2024-01-01 10:30:00", task=1000),
        history_row("c", "2024-01-01 11:00:00", "2024-01-01 11:10:00", task=1000),
        history_row("metadata", "2024-01-01 10:00:00", "2024-01-01 10:20:00", task=0),
        history_row("untyped", "2024-01-01 10:00:00", "2024-01-01 10:20:00", kind=None),
        history_row("elsewhere", "2024-01-01 10:00:00", "2024-01-01 10:20:00", warehouse=None),
    )
    return QueryFeeds(given, events, usage, prices)


WINDOW = ("2024-01-01 10:00:00", "2024-01-01 13:00:00")


def test_cost_per_query(feeds, rows):
    cost = cost_per_query(feeds, WINDOW)
    # hour 10: 4 units, 2 dollars, used for half an hour of one; three quarters of the work is a's
    assert rows(cost, "statement_id", "query_attributed_dollars_estimation", "query_attributed_units_estimation", "billing_record_check") == [
        ("a", 0.75, 1.5, al.BILLED), ("b", 0.25, 0.5, al.BILLED), ("c", None, None, al.NOT_BILLED),
    ]
    assert {r.most_recent_billing_hour for r in cost.select(F.col("most_recent_billing_hour").cast("string").alias("most_recent_billing_hour")).collect()} == {"2024-01-01 12:00:00"}
    declared = schemas.fact("cost_per_query")
    assert {f.name: f.dataType.simpleString() for f in cost.schema} == {f.name: f.dataType.simpleString() for f in declared}


def test_attributed_and_idle_cost_are_what_was_billed(feeds):
    lo, hi = WINDOW
    rest = al.idle_residual(attributed_hours(feeds, lo, hi), warehouse_hour_cost(feeds, lo, hi)).collect()
    assert {(r.billed_dollars, r.attributed_dollars, r.residual_dollars) for r in rest} == {(2.0, 1.0, 1.0), (2.5, None, 2.5)}


def test_idle_cost_can_be_spread(feeds, rows):
    spread = cost_per_query(feeds, WINDOW, Rules(spread_idle=True))
    assert rows(spread.filter("statement_id < 'c'"), "statement_id", "query_attributed_dollars_estimation") == [("a", 1.5), ("b", 0.5)]


def test_closed_rules_run_on_the_same_feeds(feeds, rows):
    closed = cost_per_query(feeds, WINDOW, CLOSED_RULES)
    assert rows(closed.filter("statement_id < 'c'"), "statement_id", "query_attributed_dollars_estimation") == [("a", 0.75), ("b", 0.25)]
