"""Tables: typed reads, typed writes, comments and housekeeping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql import functions as F

from ledgerlight.session import shared_dir

BAD_LINE = "bad_line"


def read_documents(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed JSON documents, one per line, under a declared schema; broken lines are left out."""
    return split_documents(spark.read.text(path), schema)[0]


def read_bad_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lines, as ``bad_line``, that are no documents of the schema."""
    return split_documents(spark.read.text(path), schema)[1]


def split_documents(lines: DataFrame, schema: T.StructType, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """Documents from lines of JSON, and the lines that are none.

    A line that does not parse, or a value in it that its column cannot hold, makes it a
    bad line; blank lines are neither.
    """
    whole = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    filled = lines.where(F.trim(F.col(line)) != "")
    parsed = filled.select(F.from_json(F.col(line), whole, options).alias("d"), F.col(line).alias("l"))
    broken = F.col("d").isNull() | F.col(f"d.{BAD_LINE}").isNotNull()
    good = parsed.where(~broken).select(*[F.col(f"d.`{f.name}`").alias(f.name) for f in schema.fields])
    return good, parsed.where(broken).select(F.col("l").alias(BAD_LINE))


def rows_to_frame(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """A few driver-side rows under a declared schema, never an inferred one."""
    return spark.createDataFrame(list(rows), schema)


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType, fill_missing: bool = False) -> DataFrame:
    """The declared columns in declared order and type, with their comments.

    A column the frame lacks is an error, or NULL with ``fill_missing``.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing and not fill_missing:
        raise ValueError(f"columns missing for the declared schema: {missing}")
    columns = [
        (F.lit(None) if f.name in missing else F.col(f.name)).cast(f.dataType).alias(f.name, metadata=f.metadata)
        for f in schema.fields
    ]
    return df.select(*columns)


def union_frames(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """Frames of one table from several places, matched by column name."""
    result = conform(frames[0], schema, fill_missing=True)
    for frame in frames[1:]:
        result = result.unionByName(conform(frame, schema, fill_missing=True))
    return result


def replace_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    sort_within: Sequence[str] = (),
    comment: str | None = None,
) -> None:
    """Create or replace a managed table from a query, schema included."""
    writer = _laid_out(df, partition_by, sort_within).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)
    if comment is not None:
        comment_table(df.sparkSession, table, comment)


def declare_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    comment: str | None = None,
) -> None:
    """Create an empty typed table with column comments, unless it exists."""
    if not spark.catalog.tableExists(table):
        replace_table(conform(empty_table(spark, schema), schema), table, partition_by, comment=comment)


def insert_overwrite(df: DataFrame, table: str, touched_only: bool = False) -> None:
    """Replace the rows of a declared table; columns are matched by name and cast.

    All rows go, those of partitions that ``df`` has no rows of too.  With
    ``touched_only`` the partitions that ``df`` does not touch stay.  The session's own
    overwrite mode does not count.
    """
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode, None)
    spark.conf.set(mode, "dynamic" if touched_only else "static")
    try:
        conform(df, spark.table(table).schema).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.unset(mode) if before is None else spark.conf.set(mode, before)


def write_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_within: Sequence[str] = ()
) -> None:
    """Replace only the partitions that ``df`` holds rows of; the others stay."""
    (
        _laid_out(df, partition_by, sort_within)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str) -> None:
    """Write rows into the buckets of ``key``, in its order, so that tables of the same buckets join without a shuffle.

    The rows are dealt by the same hash first: a task then writes the files of its own
    buckets, one each.  The table's folder is in the shared folder of the cluster.
    """
    spark = df.sparkSession
    rows = df.repartition(buckets, key)
    writer = rows.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key)
    if not spark.catalog.tableExists(table):
        writer = writer.option("path", f"{shared_dir(spark)}/{table}")
    writer.saveAsTable(table)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A parquet folder whose files were written under growing schemas."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def comment_table(spark: SparkSession, table: str, comment: str) -> None:
    escaped = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {table} IS '{escaped}'")


def drop_tables(spark: SparkSession, tables: Iterable[str]) -> list[str]:
    """Drop the tables that exist, and name them."""
    present = [t for t in tables if spark.catalog.tableExists(t)]
    for table in present:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return present


def table_or_empty(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """A table, or no rows of its schema where it does not exist yet."""
    return spark.table(table) if spark.catalog.tableExists(table) else empty_table(spark, schema)


def query(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """SQL with bound parameters, for tables (``IDENTIFIER(:t)``) and values alike."""
    return spark.sql(sql, args=dict(args or {}))


def _laid_out(df: DataFrame, partition_by: Sequence[str], sort_within: Sequence[str]) -> DataFrame:
    """Rows of a partition brought together, so tasks do not each write into all of them.

    ``rebalance`` lets adaptive execution split a large partition over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_within:
        df = df.sortWithinPartitions(*partition_by, *sort_within)
    return df
