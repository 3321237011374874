"""Activity categories of statements, matched once and stored beside the cost by statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.functions.classify import activity_category, activity_class
from ledgerlight.plans.assistant_cost import DOLLARS, SPACE, UNITS
from ledgerlight.sources.tables import save_bucketed

KEY = "statement_id"
NARROW = [KEY, "query_source_id", "workspace_id", DOLLARS, UNITS]


def fill_categories(cost: DataFrame, statements: DataFrame, table: str, buckets: int = 64, source: str = SPACE) -> int:
    """Categorise the statements that ``table`` lacks, and those that a message names by now; the number of the load.

    Only these have their text read and matched.  The table is bucketed by statement and
    grows; the row of the last load counts.  ``cost`` is the cost per query.
    """
    spark = cost.sparkSession
    linked = statements.filter(F.col(KEY).isNotNull()).select(KEY).distinct().withColumn("linked", F.lit(True))
    rows = cost.filter(F.col("query_source_type") == source).select(KEY, "statement_text", "query_work_task_time_seconds")
    load = 0
    if spark.catalog.tableExists(table):
        had = read_categories(spark, table).select(KEY, F.col("linked").alias("__had"))
        load = spark.table(table).agg(F.coalesce(F.max("load") + 1, F.lit(0))).first()[0]
        changed = F.col("__had").isNull() | (F.coalesce("linked", F.lit(False)) != F.col("__had"))
        rows = rows.join(had, KEY, "left").join(linked, KEY, "left").filter(changed)
    else:
        rows = rows.join(linked, KEY, "left")
    known, text = F.coalesce("linked", F.lit(False)), F.col("statement_text")
    made = rows.select(
        KEY,
        activity_category(known, text, F.col("query_work_task_time_seconds")).alias("cost_category"),
        activity_class(known, text).alias("cost_class"),
        known.alias("linked"),
        F.lit(load).cast("int").alias("load"),
    )
    save_bucketed(made, table, KEY, buckets, "append")
    return load


def read_categories(spark: SparkSession, table: str) -> DataFrame:
    """The category and class of each statement; its buckets are where its rows meet, without a shuffle."""
    last = F.max_by(F.struct("cost_category", "cost_class", "linked"), "load").alias("__last")
    return spark.table(table).groupBy(KEY).agg(last).select(KEY, "__last.*")


def save_cost(cost: DataFrame, table: str, buckets: int = 64, source: str = SPACE) -> None:
    """The cost of the statements of assistant spaces, without text, in the buckets of their categories."""
    save_bucketed(cost.filter(F.col("query_source_type") == source).select(*NARROW), table, KEY, buckets, "overwrite")


def categorised_cost(spark: SparkSession, cost_table: str, category_table: str) -> DataFrame:
    """Cost and category by statement: two tables in the same buckets, joined where they are."""
    categories = read_categories(spark, category_table).drop("linked")
    return spark.table(cost_table).hint("merge").join(categories, KEY)
