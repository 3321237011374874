"""Effective-dated prices: the lookup of the interval in force, and priced usage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.time import Instant, as_column

PRICE_KEYS = ("sku_name", "cloud")
#: Quantities and prices with all 18 digits of the feeds.  Their whole parts are narrow
#: enough that a product keeps 17 digits; a wider value is an error, never cut.
UNITS, PRICE = "decimal(31,18)", "decimal(25,18)"


def unit_prices(
    prices: DataFrame,
    currency: str = "USD",
    keys: Sequence[str] = PRICE_KEYS,
    price: str = "pricing.effective_list.default",
) -> DataFrame:
    """One currency of a price list, reduced to keys, interval and unit price.

    Distinct, because price lists repeat a price once per contract or region, and a
    repeated interval would multiply the usage it is joined to.
    """
    return (
        prices.filter(F.col("currency_code") == currency)
        .select(*keys, "price_start_time", "price_end_time", F.col(price).cast(PRICE).alias("unit_price"))
        .distinct()
    )


def interval_lookup(
    left: DataFrame,
    at: str,
    right: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str],
    closed: str = "left",
    span: tuple[Instant, Instant] | None = None,
) -> DataFrame:
    """Left join to the right row whose interval holds ``at``; a NULL end is open.

    ``closed`` is ``"left"`` for ``[start, end)`` or ``"both"`` for ``[start, end]``.

    The join is an equi join with the interval test as a residual.  Spark broadcasts
    ``right`` when its measured size is under the session threshold and sorts and
    merges otherwise.  For the second case ``span`` splits each key by month, so that
    one busy key spreads over many tasks: an interval is repeated for the months it
    touches inside the span, and times before or after the span fall in its first or
    last month, so the result does not depend on the span.
    """
    if closed not in ("left", "both"):
        raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")
    kept = right.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.col(start).alias("__start"),
        F.col(end).alias("__end"),
        *[c for c in right.columns if c not in {*keys, start, end}],
    )
    match = [F.col(k) == F.col(f"__{k}") for k in keys]
    time = F.col(at)
    below = time < F.col("__end") if closed == "left" else time <= F.col("__end")
    match += [time >= F.col("__start"), F.col("__end").isNull() | below]
    drop = [f"__{k}" for k in keys] + ["__start", "__end"]
    if span is not None:
        first, last = (F.date_trunc("month", as_column(s)) for s in span)
        touched = F.sequence(
            _month(F.col("__start"), first, last),
            _month(F.coalesce(F.col("__end"), last), first, last),
            F.expr("interval 1 month"),
        )
        kept = kept.filter(F.col("__end").isNull() | (F.col("__start") <= F.col("__end")))
        kept = kept.withColumn("__month", F.explode(touched))
        left = left.withColumn("__at_month", _month(time, first, last))
        match.append(F.col("__at_month") == F.col("__month"))
        drop += ["__month", "__at_month"]
    return left.join(kept, match, "left").drop(*drop)


def price_usage(
    usage: DataFrame,
    prices: DataFrame,
    keys: Sequence[str] = PRICE_KEYS,
    at: str = "usage_start_time",
    closed: str = "left",
    on_missing: int | None = 0,
    span: tuple[Instant, Instant] | None = None,
    currency: str = "USD",
    since: Instant | None = None,
) -> DataFrame:
    """Usage with ``unit_price``, ``units`` and ``dollars``, unrounded.

    Sum them before they are cast to fewer digits: many small amounts may each round
    to nothing.  ``since`` says that no usage is earlier, so older price intervals are
    left out.  Usage without a price counts as ``on_missing``; None leaves its dollars NULL.
    """
    if since is not None:
        prices = prices.filter(F.col("price_end_time").isNull() | (F.col("price_end_time") >= as_column(since)))
    priced = interval_lookup(
        usage,
        at,
        unit_prices(prices, currency, keys),
        "price_start_time",
        "price_end_time",
        keys,
        closed,
        span,
    )
    rate = F.col("unit_price")
    if on_missing is not None:
        rate = F.coalesce(rate, F.lit(on_missing).cast(PRICE))
    units = F.col("usage_quantity").cast(UNITS)
    return priced.withColumns({"units": units, "dollars": units * rate})


def billed_measures(measure: str = "decimal(38,6)") -> list[Column]:
    """Aggregates of priced usage in the type of the facts."""
    return [F.sum(name).cast(measure).alias(name) for name in ("units", "dollars")]


def _month(ts: Column, first: Column, last: Column) -> Column:
    return F.greatest(first, F.least(last, F.date_trunc("month", ts)))
