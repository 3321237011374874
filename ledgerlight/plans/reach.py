"""Reach: who opened assistant spaces and dashboards, from the audit log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.functions.time import Instant, as_column, on_days_since
from ledgerlight.plans.billing_facts import name_workspaces
from ledgerlight.sources.tables import conform

VIEW_ACTIONS = ("getSpace", "assistantGetSpace")
CREATE_ACTIONS = ("assistantCreateSpace",)
DRAFT_VIEW, PUBLISHED_VIEW = "getDashboard", "getPublishedDashboard"


def recent_audit(audit: DataFrame, service: str, as_of: Instant, days: int) -> DataFrame:
    """Audit rows of one service, less than ``days`` before ``as_of``."""
    since = as_column(as_of) - F.make_interval(days=F.lit(days))
    return audit.filter(
        (F.col("service_name") == service) & on_days_since("event_date", since) & (F.col("event_time") > since)
    )


def reach_fact(
    spaces: DataFrame,
    audit: DataFrame,
    workspaces: DataFrame,
    as_of: Instant,
    days: int = 180,
    service: str = "assistant",
    views: Sequence[str] = VIEW_ACTIONS,
    creates: Sequence[str] = CREATE_ACTIONS,
) -> DataFrame:
    """Views, distinct viewers and creations by space, workspace and day.

    Only spaces with activity appear.  Actions are counted per user before the space is
    looked up, which leaves far fewer rows to join.
    """
    viewed = F.col("action_name").isin(*views)
    per_user = (
        recent_audit(audit, service, as_of, days)
        .groupBy(
            F.col("request_params")["space_id"].alias("space_id"),
            "workspace_id",
            F.col("event_date").alias("activity_date"),
            F.col("user_identity.email").alias("email"),
        )
        .agg(
            F.count_if(viewed).alias("space_views"),
            F.count_if(F.col("action_name").isin(*creates)).alias("spaces_created"),
        )
    )
    fact = (
        per_user.join(spaces.select("space_id", F.col("name").alias("space_name")), "space_id")
        .groupBy("space_id", "space_name", "workspace_id", "activity_date")
        .agg(
            F.sum("space_views").alias("space_views"),
            F.count_distinct(F.when(F.col("space_views") > 0, F.col("email"))).alias("distinct_viewers"),
            F.sum("spaces_created").alias("spaces_created"),
        )
    )
    return conform(name_workspaces(fact, workspaces), schemas.fact("reach"))


def dashboard_views(
    dashboards: DataFrame,
    audit: DataFrame,
    workspaces: DataFrame,
    as_of: Instant,
    days: int = 180,
    service: str = "dashboards",
) -> DataFrame:
    """Views by dashboard, day and workspace, in all, as draft and as published."""
    counted = (
        recent_audit(audit, service, as_of, days)
        .filter(F.col("action_name").isin(DRAFT_VIEW, PUBLISHED_VIEW))
        .groupBy(
            F.col("request_params")["dashboard_id"].alias("dashboard_id"),
            F.col("event_date").alias("viewed_date"),
            "workspace_id",
        )
        .agg(
            F.count("event_date").alias("num_views"),
            F.count_if(F.col("action_name") == DRAFT_VIEW).alias("draft_views"),
            F.count_if(F.col("action_name") == PUBLISHED_VIEW).alias("published_views"),
        )
    )
    named = counted.join(
        dashboards.select("dashboard_id", F.col("display_name").alias("dashboard_name")), "dashboard_id"
    )
    return conform(name_workspaces(named, workspaces, "inner"), schemas.fact("dashboard_views"))
