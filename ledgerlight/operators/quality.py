"""Checks that return the rows breaking a rule, and one function that raises on them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, types as T
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlight.functions.time import Instant, as_column, lookback


class QualityError(ValueError):
    """A check found rows that break its rule."""


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def check_non_negative(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a negative value in one of the columns."""
    return df.filter(reduce(or_, [F.col(c) < 0 for c in columns]))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in one of the columns."""
    return df.filter(reduce(or_, [F.col(c).isNull() for c in columns]))


def check_schema(df: DataFrame, expected: T.StructType, table: str = "") -> DataFrame:
    """Columns that are missing, extra or of another type, as ``(table, column, problem, ...)``."""
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for name in sorted({*wanted, *actual}):
        want, have = wanted.get(name), actual.get(name)
        if want != have:
            problem = "missing" if have is None else "extra" if want is None else "type changed"
            rows.append((table, name, problem, want, have))
    return df.sparkSession.createDataFrame(
        rows, "table_name string, column_name string, problem string, expected_type string, actual_type string"
    )


def observed_values(df: DataFrame, column: str, at: str, as_of: Instant, days: int = 30) -> DataFrame:
    """Distinct values of a column over the last days before ``as_of``."""
    recent = (F.col(at) >= lookback(as_of, days)) & (F.col(at) <= as_column(as_of))
    return df.filter(recent).select(column).distinct()


def write_checked(
    df: DataFrame,
    write: Callable[[DataFrame], None],
    unique: Sequence[str] = (),
    non_negative: Sequence[str] = (),
    not_null: Sequence[str] = (),
) -> dict[str, int]:
    """Write a fact and count, in the same pass, its rows and those that break a rule.

    ``write`` is called with the fact and has to run one job over it.  ``rows`` counts all
    rows, ``unique`` those that share their key with others, ``non_negative:c`` and
    ``not_null:c`` those that break the rule of a column.  A fact grouped by its key is
    dealt by it already, so that looking for others with the key costs a sort and no
    shuffle.  The counts ride on the writing job: nothing is read again.
    """
    rules = {f"non_negative:{c}": F.col(c) < 0 for c in non_negative} | {f"not_null:{c}": F.col(c).isNull() for c in not_null}
    checked = df
    if unique:
        checked = df.withColumn("__same", F.count("*").over(Window.partitionBy(*unique)))
        rules["unique"] = F.col("__same") > 1
    seen = Observation()
    observed = checked.observe(seen, F.count("*").alias("rows"), *[F.count_if(rule).alias(name) for name, rule in rules.items()])
    write(observed.select(*df.columns))
    return dict(seen.get)


def enforce(violations: DataFrame, message: str) -> None:
    """Raise :class:`QualityError` unless the check came back empty."""
    found = violations.limit(3).collect()
    if found:
        raise QualityError(f"{message}: {[row.asDict() for row in found]}")


def assert_empty(violations: DataFrame, message: str) -> DataFrame:
    """One row with a NULL; running it raises inside Spark when the check found rows."""
    return violations.agg(F.assert_true(F.count("*") == 0, F.lit(message)).alias("passed"))
