"""Index cost and token usage kept by streams of billing rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.time import Instant
from ledgerlight.plans.billing_facts import (
    index_grain,
    index_parts,
    index_rows,
    token_grain,
    token_parts,
    token_rows,
)
from ledgerlight.streaming.daily import DailyFact

#: When a billing row counts, which days are cut by.
AT = "usage_start_time"


def index_stream_fact(prices: DataFrame, as_of: Instant, days: int | None = 365, period: str = "day") -> DailyFact:
    """Index cost; :func:`~ledgerlight.plans.billing_facts.index_fact_of` names what is read back."""
    merged = {"endpoint_name": F.max("endpoint_name"), "units": F.sum("units"), "dollars": F.sum("dollars")}
    return DailyFact(lambda usage: index_rows(usage, prices, as_of, days), index_grain(), index_parts(), merged, AT, period)


def token_stream_fact(prices: DataFrame, as_of: Instant | None = None, days: int | None = None, period: str = "day") -> DailyFact:
    """Token usage; :func:`~ledgerlight.plans.billing_facts.token_fact_of` names what is read back."""
    parts = token_parts()
    merged = {name: F.sum(name) for name in parts}
    return DailyFact(lambda usage: token_rows(usage, prices, as_of, days), token_grain(), parts, merged, AT, period)
