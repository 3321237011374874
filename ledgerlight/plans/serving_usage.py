"""Serving usage: billed cost of endpoints next to their tracked requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.functions.time import Instant, lookback
from ledgerlight.operators.pricing import billed_measures, price_usage
from ledgerlight.operators.versions import latest_version, representative
from ledgerlight.plans.billing_facts import name_workspaces, price_since, price_span, product_usage
from ledgerlight.sources.tables import conform

DAY = ["endpoint_id", "usage_date", "workspace_id"]
REQUESTS = ["request_count", "input_tokens", "output_tokens"]


def current_entities(entities: DataFrame, as_of: Instant, keep_deleted_days: int = 30) -> DataFrame:
    """Latest configuration of each served entity, without those deleted long ago."""
    kept = entities.filter(
        F.col("endpoint_delete_time").isNull()
        | (F.col("endpoint_delete_time") > lookback(as_of, keep_deleted_days))
    )
    latest = latest_version(kept, ["served_entity_id"], ["endpoint_config_version", "change_time"])
    return latest.select(
        "endpoint_id", "endpoint_name", "served_entity_id", "entity_type", "entity_name", "entity_version", "workspace_id"
    )


def entity_requests(requests: DataFrame, current: DataFrame, as_of: Instant, days: int = 365) -> DataFrame:
    """Requests and tokens by served entity, day and workspace, with its endpoint.

    Counted before the lookup of the endpoint, which then sees one row per entity and day.
    """
    counted = (
        requests.filter(F.col("request_time") >= lookback(as_of, days))
        .groupBy("workspace_id", "served_entity_id", F.col("request_time").cast("date").alias("usage_date"))
        .agg(
            F.count("*").alias("request_count"),
            F.sum(F.coalesce("input_token_count", F.lit(0))).alias("input_tokens"),
            F.sum(F.coalesce("output_token_count", F.lit(0))).alias("output_tokens"),
        )
    )
    return counted.join(current.select("served_entity_id", "endpoint_id"), "served_entity_id")


def request_usage(by_entity: DataFrame) -> DataFrame:
    """Requests and tokens by endpoint, day and workspace."""
    return by_entity.groupBy(*DAY).agg(*[F.sum(c).alias(c) for c in REQUESTS])


def serving_billing(
    usage: DataFrame, prices: DataFrame, as_of: Instant, days: int = 365, product: str = "MODEL_SERVING"
) -> DataFrame:
    """Units and cost by endpoint, day and workspace."""
    rows = (
        product_usage(usage, product, as_of, days)
        .withColumn("endpoint_id", F.col("usage_metadata.endpoint_id"))
        .filter(F.col("endpoint_id").isNotNull())
    )
    return (
        price_usage(rows, prices, span=price_span(as_of, days), since=price_since(as_of, days))
        .groupBy(*DAY)
        .agg(F.max("usage_metadata.endpoint_name").alias("billed_name"), *billed_measures())
    )


def representative_entity(current: DataFrame, by_entity: DataFrame) -> DataFrame:
    """The served entity with the most requests on each endpoint, and how many there are."""
    group = ["endpoint_id", "workspace_id"]
    counts = by_entity.groupBy(*group, "served_entity_id").agg(F.sum("request_count").alias("request_count"))
    members = current.join(counts, [*group, "served_entity_id"], "left")
    return representative(members, group, "request_count", "served_entity_id")


def serving_usage_fact(
    usage: DataFrame,
    prices: DataFrame,
    entities: DataFrame,
    requests: DataFrame,
    workspaces: DataFrame,
    as_of: Instant,
    days: int = 365,
) -> DataFrame:
    """Cost and requests by endpoint, day and workspace.

    Billing drives the cost, whether or not requests are tracked or the endpoint is in
    the dimension, so totals equal billing; cost is never repeated per served entity.
    """
    current = current_entities(entities, as_of)
    by_entity = entity_requests(requests, current, as_of, days)
    billed = serving_billing(usage, prices, as_of, days)
    nothing = F.lit(0).cast("decimal(38,6)")
    both = (
        billed.join(request_usage(by_entity), DAY, "full")
        .filter(F.col("usage_date").isNotNull())
        .join(representative_entity(current, by_entity), ["endpoint_id", "workspace_id"], "left")
    )
    fact = name_workspaces(both, workspaces).select(
        "endpoint_id",
        F.coalesce("endpoint_name", "billed_name").alias("endpoint_name"),
        "served_entity_id",
        "entity_type",
        F.coalesce("entity_name", "billed_name").alias("entity_name"),
        "entity_version",
        F.coalesce("entity_count", F.lit(0)).alias("entity_count"),
        "usage_date",
        "workspace_id",
        "workspace_name",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in REQUESTS],
        *[F.coalesce(c, nothing).alias(c) for c in ("units", "dollars")],
    )
    return conform(fact, schemas.fact("serving_usage"))
