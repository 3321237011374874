from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from casebook import SMALL
from ledgerlight import schemas
from ledgerlight.operators import quality
from ledgerlight.operators.reconcile import cost_measures, measure, reconcile
from ledgerlight.operators.versions import crosswalk, latest_version, representative
from ledgerlight.plans import app_usage, billing_facts, serving_usage
from ledgerlight.sources.tables import conform
from ledgerlight.testbed.feeds import EVENTS_AS_OF, LINES_AS_OF, LINES_DAYS, Feeds

DAY = "2024-01-10"


@pytest.fixture
def prices(frame):
    return frame(
        "sku_name string, cloud string, currency_code string, usage_unit string, price_start_time timestamp, price_end_time timestamp",
        ("S", "A", "USD", "U", "2023-01-01", None),
    ).withColumn("pricing", F.struct(F.struct(F.lit(2).cast("decimal(38,18)").alias("default")).alias("effective_list")))


@pytest.fixture
def billing(frame):
    def make(product, *rows):
        df = frame(
            "workspace_id string, app_id string, app_name string, endpoint_id string, endpoint_name string, usage_start_time timestamp, usage_quantity string",
            *rows,
        )
        metadata = F.struct("app_id", "app_name", "endpoint_id", "endpoint_name")
        return df.select(
            "workspace_id", "usage_start_time", "usage_quantity", metadata.alias("usage_metadata"),
            F.col("usage_start_time").cast("date").alias("usage_date"), F.lit("S").alias("sku_name"),
            F.lit("A").alias("cloud"), F.lit(product).alias("billing_origin_product"),
        )
    return make


@pytest.fixture
def workspaces(frame):
    return frame("workspace_id string, workspace_name string", ("1", "one"))


@pytest.fixture
def audit(frame):
    def make(*rows):
        df = frame("workspace_id string, email string, event_time timestamp, params map<string,string>", *rows)
        return df.select(
            "workspace_id", "event_time", F.col("event_time").cast("date").alias("event_date"),
            F.struct("email").alias("user_identity"), F.lit("apps").alias("service_name"),
            F.col("params").alias("request_params"),
        )
    return make


def test_apps_join_events_by_name(billing, prices, audit, workspaces, rows):
    usage = billing(
        "APPS",
        ("1", "id-2", "shared", None, None, DAY, "3"),
        ("1", "id-1", "shared", None, None, DAY, "3"),  # a tie: the smaller id wins
        ("1", "id-3", "first name", None, None, DAY, "1"),
        ("1", "id-3", "second name", None, None, DAY, "1"),
    )
    events = audit(
        ("1", "x@a", f"{DAY} 01:00:00", {"name": "shared"}),
        ("1", "x@a", f"{DAY} 02:00:00", {"app": '{"name": "shared"}'}),
        ("1", "x@a", f"{DAY} 03:00:00", {"app_name": "first name"}),
        ("1", "x@a", f"{DAY} 04:00:00", {"app_name": "second name"}),  # the same app and user
        ("2", "y@a", f"{DAY} 05:00:00", {"name": "never billed"}),
        ("1", "y@a", f"{DAY} 05:00:00", {"other": "no name"}),
        ("1", "y@a", "2022-01-01 05:00:00", {"name": "shared"}),  # before the window
    )
    fact = app_usage.app_usage_fact(usage, prices, events, workspaces, "2024-02-01")
    assert rows(fact, "app_id", "app_name", "workspace_name", "units", "dollars", "lifecycle_events", "distinct_users") == [
        ("id-1", "shared", "one", Decimal("3.000000"), Decimal("6.000000"), 2, 1),
        ("id-2", "shared", "one", Decimal("3.000000"), Decimal("6.000000"), 0, 0),
        ("id-3", "second name", "one", Decimal("2.000000"), Decimal("4.000000"), 2, 1),
        ("never billed", "never billed", None, Decimal("0.000000"), Decimal("0.000000"), 1, 1),
    ]
    assert quality.check_unique(fact, ["app_id", "usage_date", "workspace_id"]).count() == 0


ENTITY = (
    "served_entity_id string, workspace_id string, endpoint_name string, endpoint_id string, entity_type string, entity_name string,"
    " entity_version string, endpoint_config_version int, change_time timestamp, endpoint_delete_time timestamp"
)


def entity(name, endpoint, version=1, deleted=None, label=None):
    return (name, "1", f"name of {endpoint}", endpoint, "CUSTOM", label or f"model {name}", "1", version, "2024-01-01", deleted)


def test_serving_keeps_all_cost_and_names_one_entity(frame, billing, prices, workspaces, rows):
    entities = frame(
        ENTITY,
        entity("e1", "p", 1, label="old"), entity("e1", "p", 2, label="new"), entity("e0", "p"),
        entity("gone29", "q", deleted="2024-01-03"), entity("gone31", "r", deleted="2024-01-01"),
    )
    requests = frame(
        "workspace_id string, served_entity_id string, request_time timestamp, input_token_count bigint, output_token_count bigint",
        ("1", "e1", f"{DAY} 01:00:00", 5, None), ("1", "e0", f"{DAY} 02:00:00", 1, 2), ("1", "gone31", f"{DAY} 02:00:00", 1, 2),
    )
    usage = billing(
        "MODEL_SERVING",
        ("1", None, None, "p", "billed p", DAY, "1"), ("1", None, None, "q", "billed q", DAY, "1"),
        ("1", None, None, "r", "billed r", DAY, "1"), ("1", None, None, None, None, DAY, "1"),
    )
    fact = serving_usage.serving_usage_fact(usage, prices, entities, requests, workspaces, "2024-02-01")
    assert rows(fact, "endpoint_id", "endpoint_name", "served_entity_id", "entity_name", "entity_count", "request_count", "input_tokens", "output_tokens", "dollars") == [
        ("p", "name of p", "e0", "model e0", 2, 2, 6, 2, Decimal("2.000000")),  # a tie: the smaller id
        ("q", "name of q", "gone29", "model gone29", 1, 0, 0, 0, Decimal("2.000000")),
        ("r", "billed r", None, "billed r", 0, 0, 0, 0, Decimal("2.000000")),
    ]


def test_one_row_per_key(frame, rows):
    versions = frame("k string, v int, at timestamp, x string", ("a", 1, "2024-01-02", "old"), ("a", 2, "2024-01-01", "new"), ("a", None, "2024-01-03", "none"))
    assert rows(latest_version(versions, ["k"], ["v", "at"])) == [("a", 2, "2024-01-01 00:00:00", "new")]
    names = frame("s string, n string, t string, w int", ("s", "n", "t2", 5), ("s", "n", "t1", 2), ("s", "n", "t1", 3), ("s", None, "t9", 99))
    assert rows(crosswalk(names, ["s"], "n", "t", "w")) == [("s", "n", "t1")]
    members = frame("g string, m string, w int, x string", ("g", "m1", None, "a"), ("g", "m2", 1, "b"))
    assert rows(representative(members, ["g"], "w", "m")) == [("g", "m2", "b", 2)]


def test_reconcile_shows_gaps_on_either_side(frame, rows):
    total = frame("k string, v double", ("a", 1.0), ("b", 2.0))
    detail = frame("k string, v double", ("a", 0.4), ("a", 0.6), ("c", 3.0))
    assert rows(reconcile(total, detail, ["k"], "v")) == [("a", 1.0, 1.0, 0.0, True), ("b", 2.0, 0.0, 2.0, False), ("c", 0.0, 3.0, -3.0, False)]


@pytest.fixture(scope="module")
def feeds(spark):
    return Feeds(spark, SMALL)


@pytest.fixture(scope="module")
def facts(feeds):
    args = (feeds.billing_usage, feeds.list_prices)
    return {
        "index_cost": (billing_facts.index_cost_fact(feeds.billing_lines, feeds.list_prices, feeds.workspaces, LINES_AS_OF, LINES_DAYS),
                       ["endpoint_id", "usage_date", "workspace_id", "sku_name"], "endpoint_name"),
        "app_usage": (app_usage.app_usage_fact(*args, feeds.audit_events, feeds.workspaces, EVENTS_AS_OF),
                      ["app_id", "usage_date", "workspace_id"], "app_name"),
        "serving_usage": (serving_usage.serving_usage_fact(*args, feeds.served_entities, feeds.endpoint_requests, feeds.workspaces, EVENTS_AS_OF),
                          ["endpoint_id", "usage_date", "workspace_id"], "entity_name"),
    }


@pytest.mark.parametrize("name", ["index_cost", "app_usage", "serving_usage"])
def test_facts_hold_their_invariants(facts, name):
    fact, grain, label = facts[name]
    fact = conform(fact, schemas.fact(name)).cache()
    assert fact.count() > 0
    quality.enforce(quality.check_unique(fact, grain), "grain")
    quality.enforce(quality.check_non_negative(fact, ["units", "dollars"]), "measures")
    quality.enforce(quality.check_not_null(fact, [label]), "label")
    fact.unpersist()


@pytest.mark.parametrize(("name", "source", "product"), [("index_cost", "billing_lines", "VECTOR_INDEX"), ("app_usage", "billing_usage", "APPS"), ("serving_usage", "billing_usage", "MODEL_SERVING")])
def test_fact_totals_are_billing_totals(feeds, facts, name, source, product):
    billed = getattr(feeds, source).filter(F.col("billing_origin_product") == product).agg(F.sum("usage_quantity")).first()[0]
    total, rows = facts[name][0].agg(F.sum("units"), F.count("*")).first()
    assert abs(total - billed) <= rows * Decimal("0.0000005")  # each row of a fact has six digits


def test_measures_add_up_over_any_dimension(facts):
    fact = facts["index_cost"][0]
    by_sku = measure(fact, ["sku_name"], cost_measures()).agg(F.sum("dollars")).first()[0]
    assert by_sku == measure(fact, [], cost_measures()).first().dollars
