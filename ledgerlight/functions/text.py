"""Text and array helpers on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(text: Column) -> Column:
    """The text, with the empty string read as NULL."""
    return F.nullif(text, F.lit(""))


def join_filled(parts: Column, separator: str) -> Column:
    """Array elements that are neither NULL nor empty, joined; NULL if there are none."""
    return filled(F.array_join(F.filter(parts, lambda p: p != ""), separator))
