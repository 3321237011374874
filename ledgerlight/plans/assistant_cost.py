"""Cost of assistant spaces: per message, by activity, in total and reconciled."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T
from pyspark.sql import functions as F

from ledgerlight import schemas
from ledgerlight.functions.classify import activity_category, activity_class
from ledgerlight.operators.joins import lookup_or_null
from ledgerlight.operators.reconcile import reconcile
from ledgerlight.sources.tables import conform

SPACE = "ASSISTANT SPACE"
DOLLARS, UNITS = "query_attributed_dollars_estimation", "query_attributed_units_estimation"


def cost_per_message(statements: DataFrame, cost: DataFrame, messages: DataFrame) -> DataFrame:
    """Cost of all statements a message ran, and how many of them have no cost record.

    This is the part of a space's cost that can be tied to listed conversations, not all
    of it.
    """
    costed = cost.select("statement_id", DOLLARS, UNITS, F.lit(True).alias("__costed"))
    priced = lookup_or_null(statements, costed, "statement_id", ["message_id"])
    rolled = priced.groupBy("space_id", "space_name", "conversation_id", "message_id").agg(
        F.max("user_email").alias("user_email"),
        F.count("statement_id").alias("num_statements"),
        F.count_if(F.col("__costed").isNull()).alias("num_statements_missing_cost"),
        F.sum(F.coalesce(DOLLARS, F.lit(0.0))).alias("message_cost"),
        F.sum(F.coalesce(UNITS, F.lit(0.0))).alias("message_units"),
    )
    described = messages.groupBy("message_id").agg(
        F.max("user_question").alias("user_question"),
        F.max("created_timestamp").alias("created_datetime"),
        F.max("feedback_rating").alias("feedback_rating"),
    )
    return conform(rolled.join(described, "message_id", "left"), schemas.fact("cost_per_message"))


def categorise_cost(cost: DataFrame, statements: DataFrame, source: str = SPACE) -> DataFrame:
    """Statements of assistant spaces with what they were run for, in the declared columns.

    The statement text is matched once here.  :func:`ledgerlight.sources.tables.replace_table`
    of the result is the table that later reports read instead of matching again.
    """
    linked = statements.filter(F.col("statement_id").isNotNull()).select("statement_id").distinct()
    text, known = F.col("statement_text"), F.col("__linked").isNotNull()
    categorised = (
        cost.filter(F.col("query_source_type") == source)
        .join(linked.withColumn("__linked", F.lit(True)), "statement_id", "left")
        .withColumns(
            {
                "cost_category": activity_category(known, text, F.col("query_work_task_time_seconds")),
                "cost_class": activity_class(known, text),
            }
        )
        .drop("__linked")
    )
    declared = [f for f in schemas.fact("cost_category").fields if f.name in categorised.columns]
    return conform(categorised, T.StructType(declared))


def space_cost(cost: DataFrame, workspace: str | None = None, source: str = SPACE) -> DataFrame:
    """Total cost of each space, the figure other views are held against."""
    rows = cost.filter(F.col("query_source_type") == source)
    if workspace is not None:
        rows = rows.filter(F.col("workspace_id") == workspace)
    return rows.groupBy(F.col("query_source_id").alias("space_id")).agg(F.sum(DOLLARS).alias("space_cost"))


def space_cost_by_category(categorised: DataFrame, spaces: DataFrame, workspace: str | None = None) -> DataFrame:
    """Statements and cost by space and activity category."""
    rows = categorised if workspace is None else categorised.filter(F.col("workspace_id") == workspace)
    counted = rows.groupBy(F.col("query_source_id").alias("space_id"), "cost_category").agg(
        F.count("*").alias("statements"), F.sum(DOLLARS).alias("cost")
    )
    names = spaces.select("space_id", F.col("name").alias("space_name"))
    return (
        counted.join(names, "space_id", "left")
        .groupBy("space_name", "cost_category")
        .agg(F.sum("statements").alias("statements"), F.sum("cost").alias("cost"))
    )


def reconcile_space_cost(cost: DataFrame, per_message: DataFrame, tolerance: float = 0.005) -> DataFrame:
    """Per space: total cost, the part tied to messages, and the gap between them."""
    total = space_cost(cost).select("space_id", F.col("space_cost").alias("cost"))
    detail = per_message.select("space_id", F.col("message_cost").alias("cost"))
    return reconcile(total, detail, ["space_id"], "cost", tolerance)
