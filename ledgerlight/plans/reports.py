"""Example reports over cost per query and assistant messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlight.functions.time import Instant, as_column, hour_of
from ledgerlight.plans.assistant_cost import DOLLARS, SPACE

EVERY_SPACE = "ALL"


def space_statements(
    cost: DataFrame,
    messages: DataFrame,
    lo: Instant,
    hi: Instant,
    space: str = EVERY_SPACE,
    source: str | None = SPACE,
) -> DataFrame:
    """Statements of spaces that have messages, started in the closed range ``[lo, hi]``.

    Only statements of the kind ``source`` are looked at, so that the many without a
    source never meet the messages; None looks at all kinds.
    """
    rows = cost.filter(F.col("start_time").between(as_column(lo), as_column(hi)))
    if source is not None:
        rows = rows.filter(F.col("query_source_type") == source)
    if space != EVERY_SPACE:
        rows = rows.filter(F.col("query_source_id") == space)
    observed = messages.select(F.col("space_id").alias("query_source_id")).distinct()
    return rows.join(observed, "query_source_id", "left_semi")


def error_mix(messages: DataFrame) -> DataFrame:
    """Messages by space, status and error, with their percentage of the space."""
    counted = messages.groupBy("space_name", "status", "error_type").agg(F.count("*").alias("message_count"))
    of_space = F.sum("message_count").over(Window.partitionBy("space_name"))
    return counted.withColumn("pct_of_space", F.round(F.col("message_count") * 100.0 / of_space, 2))


def user_engagement(messages: DataFrame, k: int = 20) -> DataFrame:
    """The users with the most messages, ties by address, and how they rated answers."""
    rating = F.upper("feedback_rating")
    return (
        messages.filter(F.col("user_email").isNotNull())
        .groupBy("user_email")
        .agg(
            F.count_distinct("conversation_id").alias("total_conversations"),
            F.count("message_id").alias("total_messages"),
            F.count_if(rating == "POSITIVE").alias("positive_feedback"),
            F.count_if(rating == "NEGATIVE").alias("negative_feedback"),
        )
        .orderBy(F.desc("total_messages"), "user_email")
        .limit(k)
    )


def cost_by_source(cost: DataFrame) -> DataFrame:
    """Count, cost and duration of queries by source and client."""
    seconds = F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))
    return (
        cost.filter(F.col(DOLLARS).isNotNull())
        .groupBy("query_source_type", "client_application")
        .agg(
            F.count("*").alias("query_count"),
            F.round(F.avg(DOLLARS), 4).alias("avg_cost_dollars"),
            F.round(F.sum(DOLLARS), 2).alias("total_cost_dollars"),
            F.round(F.avg(seconds), 2).alias("avg_duration_sec"),
        )
    )


def cost_trend(cost: DataFrame, messages: DataFrame, as_of: Instant, days: int = 90, k: int = 100) -> DataFrame:
    """Queries and cost of the latest hours, with the messages of the spaces at work in them.

    Each statement counts once.  Messages are counted per space before they meet the
    distinct spaces of an hour, so neither side multiplies the other.
    """
    since = as_column(as_of) - F.make_interval(days=F.lit(days))
    recent = cost.filter(F.col("start_time") >= since).withColumn("hour_bucket", hour_of("start_time"))
    hours = recent.groupBy("hour_bucket").agg(
        F.count_distinct("statement_id").alias("total_queries"),
        F.round(F.sum(DOLLARS), 2).alias("total_cost"),
        F.round(F.avg(DOLLARS), 4).alias("avg_cost_per_query"),
    )
    asked = messages.groupBy(F.col("space_id").alias("query_source_id")).agg(
        F.count_distinct("message_id").alias("messages")
    )
    spoken = (
        recent.select("hour_bucket", "query_source_id")
        .distinct()
        .join(asked, "query_source_id")
        .groupBy("hour_bucket")
        .agg(F.sum("messages").alias("assistant_messages"))
    )
    return (
        hours.join(spoken, "hour_bucket", "left")
        .withColumn("assistant_messages", F.coalesce("assistant_messages", F.lit(0)))
        .orderBy(F.desc("hour_bucket"))
        .limit(k)
    )
