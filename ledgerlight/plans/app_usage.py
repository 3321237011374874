"""App usage: billed cost and audit events of the same app, under one id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.functions.time import Instant, lookback, on_days_since
from ledgerlight.operators.pricing import billed_measures, price_usage
from ledgerlight.operators.versions import crosswalk
from ledgerlight.plans.billing_facts import name_workspaces, price_since, price_span, product_usage
from ledgerlight.sources.tables import conform

DAY = ["app_id", "usage_date", "workspace_id"]


def app_rows(usage: DataFrame, as_of: Instant, days: int, product: str = "APPS") -> DataFrame:
    """Billing rows of apps, with the app's id and name as columns."""
    return (
        product_usage(usage, product, as_of, days)
        .withColumns({"app_id": F.col("usage_metadata.app_id"), "app_name": F.col("usage_metadata.app_name")})
        .filter(F.col("app_id").isNotNull())
    )


def app_billing(
    usage: DataFrame, prices: DataFrame, as_of: Instant, days: int = 365, product: str = "APPS"
) -> DataFrame:
    """Units and cost by app, day and workspace."""
    priced = price_usage(app_rows(usage, as_of, days, product), prices, span=price_span(as_of, days), since=price_since(as_of, days))
    return priced.groupBy(*DAY).agg(F.max("app_name").alias("app_name"), *billed_measures())


def name_crosswalk(usage: DataFrame, as_of: Instant, days: int = 365, product: str = "APPS") -> DataFrame:
    """App id of each (workspace, app name): the one with the most units."""
    rows = app_rows(usage, as_of, days, product).withColumn("units", F.col("usage_quantity"))
    return crosswalk(rows, ["workspace_id"], "app_name", "app_id", "units")


def app_events(audit: DataFrame, as_of: Instant, days: int = 365, service: str = "apps") -> DataFrame:
    """Audit rows of apps by name, day, workspace and user, counted.

    The name stands under a key that depends on the action, once inside JSON.
    """
    since = lookback(as_of, days)
    return (
        audit.filter(
            (F.col("service_name") == service)
            & on_days_since("event_date", since)
            & (F.col("event_time") >= since)
        )
        .withColumns({"app_name": _app_name(), "usage_date": F.col("event_date"), "email": F.col("user_identity.email")})
        .filter(F.col("app_name").isNotNull())
        .groupBy("workspace_id", "app_name", "usage_date", "email")
        .agg(F.count("*").alias("events"))
    )


def app_audit(audit: DataFrame, as_of: Instant, days: int = 365, service: str = "apps") -> DataFrame:
    """Lifecycle events and distinct users by app name, day and workspace."""
    return app_events(audit, as_of, days, service).groupBy("workspace_id", "app_name", "usage_date").agg(*_audit())


def app_usage_fact(
    usage: DataFrame, prices: DataFrame, audit: DataFrame, workspaces: DataFrame, as_of: Instant, days: int = 365
) -> DataFrame:
    """Cost and lifecycle events by app, day and workspace, from both sides.

    Events carry only a name.  It is mapped to the billed id, or stands in for the id of
    an app never billed, before events are counted, so that two names of one app add up
    and their users are counted once.
    """
    names = name_crosswalk(usage, as_of, days)
    seen = (
        app_events(audit, as_of, days)
        .join(names, ["workspace_id", "app_name"], "left")
        .withColumn("app_id", F.coalesce("app_id", "app_name"))
        .groupBy(*DAY)
        .agg(F.max("app_name").alias("__event_name"), *_audit())
    )
    billed = app_billing(usage, prices, as_of, days)
    nothing = F.lit(0).cast("decimal(38,6)")
    joined = billed.join(seen, DAY, "full").select(
        *DAY,
        F.coalesce("app_name", "__event_name").alias("app_name"),
        F.coalesce("units", nothing).alias("units"),
        F.coalesce("dollars", nothing).alias("dollars"),
        F.coalesce("lifecycle_events", F.lit(0)).alias("lifecycle_events"),
        F.coalesce("distinct_users", F.lit(0)).alias("distinct_users"),
    )
    return conform(name_workspaces(joined, workspaces), schemas.fact("app_usage"))


def _app_name() -> Column:
    params = F.col("request_params")
    return F.coalesce(params["name"], params["app_name"], F.get_json_object(params["app"], "$.name"))


def _audit() -> list[Column]:
    return [F.sum("events").alias("lifecycle_events"), F.count_distinct("email").alias("distinct_users")]
