"""Facts driven by billing: index cost and token usage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.functions.time import Instant, lookback, on_days_since
from ledgerlight.operators.pricing import PRICE_KEYS, price_usage
from ledgerlight.sources.tables import conform

#: Label of index cost that billing does not tie to an endpoint.
UNATTRIBUTED = "(no endpoint)"


def product_usage(usage: DataFrame, product: str, as_of: Instant, days: int | None) -> DataFrame:
    """Billing rows of one product, from ``days`` before ``as_of`` on; all of them for None."""
    rows = usage.filter(F.col("billing_origin_product") == product)
    if days is None:
        return rows
    since = lookback(as_of, days)
    return rows.filter(on_days_since("usage_date", since) & (F.col("usage_start_time") >= since))


def price_span(as_of: Instant, days: int | None) -> tuple[Instant, Instant] | None:
    """Span that :func:`interval_lookup` splits price keys over."""
    return None if days is None else (lookback(as_of, days), F.lit(as_of).cast("timestamp"))


def price_since(as_of: Instant, days: int | None) -> Column | None:
    """Moment before which :func:`product_usage` keeps no row."""
    return None if days is None else lookback(as_of, days)


def name_workspaces(fact: DataFrame, workspaces: DataFrame, how: str = "left") -> DataFrame:
    """The fact with ``workspace_name``; the dimension has one row per workspace."""
    return fact.join(workspaces.select("workspace_id", "workspace_name"), "workspace_id", how)


def index_rows(
    usage: DataFrame, prices: DataFrame, as_of: Instant, days: int | None = 365, product: str = "VECTOR_INDEX"
) -> DataFrame:
    """Priced usage of indexes."""
    return price_usage(
        product_usage(usage, product, as_of, days), prices, span=price_span(as_of, days), since=price_since(as_of, days)
    )


def index_grain() -> dict[str, Column]:
    """Grain of the index cost fact."""
    return {
        "endpoint_id": F.col("usage_metadata.endpoint_id"),
        "usage_date": F.col("usage_date"),
        "workspace_id": F.col("workspace_id"),
        "sku_name": F.col("sku_name"),
    }


def index_parts() -> dict[str, Column]:
    """Aggregates of the index cost fact over priced usage."""
    return {"endpoint_name": F.max("usage_metadata.endpoint_name"), "units": F.sum("units"), "dollars": F.sum("dollars")}


def index_fact_of(sums: DataFrame, workspaces: DataFrame) -> DataFrame:
    """The index cost fact from its sums; usage without an endpoint goes under a label."""
    named = sums.withColumn("endpoint_name", F.coalesce("endpoint_name", F.lit(UNATTRIBUTED)))
    return conform(name_workspaces(named, workspaces), schemas.fact("index_cost"))


def index_cost_fact(
    usage: DataFrame,
    prices: DataFrame,
    workspaces: DataFrame,
    as_of: Instant,
    days: int = 365,
    product: str = "VECTOR_INDEX",
) -> DataFrame:
    """Index cost by endpoint, day, workspace and SKU.

    Usage without an endpoint is kept under a label, so that totals equal billing.
    """
    priced = index_rows(usage, prices, as_of, days, product)
    return index_fact_of(_summed(priced, index_grain(), index_parts()), workspaces)


def token_rows(
    usage: DataFrame,
    prices: DataFrame,
    as_of: Instant | None = None,
    days: int | None = None,
    product: str = "ASSISTANT",
    price_keys: Sequence[str] = PRICE_KEYS,
    price_at: str = "usage_start_time",
    price_closed: str = "left",
) -> DataFrame:
    """Priced token usage."""
    rows = product_usage(usage, product, as_of, days).filter(
        (F.col("usage_type") == "TOKEN") & (F.col("record_type") == "ORIGINAL")
    )
    return price_usage(rows, prices, price_keys, price_at, price_closed, span=price_span(as_of, days), since=price_since(as_of, days))


def token_grain(free_sku: str = "ASSISTANT_FREE_USAGE", region_prefix: str = "REALTIME_INFERENCE_") -> dict[str, Column]:
    """Grain of the token usage fact."""
    free = F.col("sku_name") == free_sku
    return {
        "workspace_id": F.col("workspace_id"),
        "user_email": F.col("identity_metadata.run_as"),
        "surface": F.col("usage_metadata.assistant.surface"),
        "channel": F.col("usage_metadata.assistant.channel"),
        "agent_id": F.col("usage_metadata.assistant.agent_id"),
        "offering": F.col("product_features.assistant.offering_type"),
        "tier": F.when(free, "FREE").otherwise("PAID"),
        "sku_name": F.col("sku_name"),
        "cloud_region": F.when(~free, F.regexp_replace("sku_name", f"^{region_prefix}", "")),
        "usage_date": F.col("usage_date"),
    }


def token_parts() -> dict[str, Column]:
    """Aggregates of the token usage fact over priced usage."""
    return {"token_units": F.sum("units"), "token_cost": F.sum("dollars"), "usage_records": F.count("*")}


def token_fact_of(sums: DataFrame, spaces: DataFrame) -> DataFrame:
    """The token usage fact from its sums."""
    names = spaces.select(F.col("space_id").alias("agent_id"), F.col("name").alias("space_name"))
    return conform(sums.join(names, "agent_id", "left"), schemas.fact("token_usage"))


def token_usage_fact(
    usage: DataFrame,
    prices: DataFrame,
    spaces: DataFrame,
    as_of: Instant | None = None,
    days: int | None = None,
    product: str = "ASSISTANT",
    free_sku: str = "ASSISTANT_FREE_USAGE",
    region_prefix: str = "REALTIME_INFERENCE_",
    price_keys: Sequence[str] = PRICE_KEYS,
    price_at: str = "usage_start_time",
    price_closed: str = "left",
) -> DataFrame:
    """Token units and cost by workspace, user, surface, channel, agent, tier, SKU and day."""
    priced = token_rows(usage, prices, as_of, days, product, price_keys, price_at, price_closed)
    return token_fact_of(_summed(priced, token_grain(free_sku, region_prefix), token_parts()), spaces)


def _summed(rows: DataFrame, grain: Mapping[str, Column], sums: Mapping[str, Column]) -> DataFrame:
    return rows.groupBy(*[c.alias(n) for n, c in grain.items()]).agg(*[c.alias(n) for n, c in sums.items()])
