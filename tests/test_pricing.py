from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlight.operators.pricing import billed_measures, interval_lookup, price_usage, unit_prices

USAGE = "id string, sku_name string, cloud string, usage_unit string, usage_start_time timestamp, usage_end_time timestamp, usage_quantity string"
PRICES = "sku_name string, cloud string, usage_unit string, currency_code string, price_start_time timestamp, price_end_time timestamp, price string"


@pytest.fixture
def usage(frame):
    return frame(
        USAGE,
        ("before", "S", "A", "U", "2024-01-01 10:00:00", "2024-01-01 11:00:00", "2"),
        ("ends at change", "S", "A", "U", "2024-01-01 11:00:00", "2024-01-01 12:00:00", "2"),
        ("after", "S", "A", "U", "2024-01-01 12:00:00", "2024-01-01 13:00:00", "2"),
        ("other cloud", "S", "B", "U", "2024-01-01 10:00:00", "2024-01-01 11:00:00", "2"),
        ("no price", "T", "A", "U", "2024-01-01 10:00:00", "2024-01-01 11:00:00", "2"),
        ("long after", "S", "A", "U", "2031-01-01 10:00:00", "2031-01-01 11:00:00", "1.5"),
    )


@pytest.fixture
def prices(frame):
    listed = frame(
        PRICES,
        ("S", "A", "U", "USD", "2023-01-01", "2024-01-01 12:00:00", "0.10"),
        ("S", "A", "U", "USD", "2024-01-01 12:00:00", None, "0.20"),
        ("S", "A", "U", "USD", "2024-01-01 12:00:00", None, "0.20"),
        ("S", "B", "U", "USD", "2023-01-01", None, "0.50"),
        ("S", "A", "U", "EUR", "2023-01-01", None, "9"),
    )
    return listed.withColumn(
        "pricing", F.struct(F.struct(F.col("price").cast("decimal(38,18)").alias("default")).alias("effective_list"))
    )


def dollars(priced):
    return sorted((r.id, None if r.dollars is None else r.dollars.normalize()) for r in priced.collect())


def test_half_open_prices_each_row_once(usage, prices):
    assert dollars(price_usage(usage, prices)) == [
        ("after", Decimal("0.4")),
        ("before", Decimal("0.2")),
        ("ends at change", Decimal("0.2")),
        ("long after", Decimal("0.3")),
        ("no price", Decimal("0")),
        ("other cloud", Decimal("1")),
    ]


@pytest.mark.parametrize("span", [("2024-01-01", "2024-02-01"), ("2020-05-05", "2021-01-01"), ("2040-01-01", "2041-01-01")])
@pytest.mark.parametrize("closed", ["left", "both"])
def test_the_span_never_changes_the_result(usage, prices, span, closed):
    assert dollars(price_usage(usage, prices, closed=closed, span=span)) == dollars(
        price_usage(usage, prices, closed=closed)
    )


def test_closed_intervals_match_twice_at_a_change(usage, prices):
    closed = price_usage(usage, prices, ("sku_name", "usage_unit"), "usage_end_time", "both", on_missing=None)
    found = [d for name, d in dollars(closed) if name == "ends at change"]
    # two periods of cloud A meet at the change and cloud B has the same SKU and unit
    assert found == [Decimal("0.2"), Decimal("0.4"), Decimal("1")]


def test_missing_prices_stay_null_on_request(usage, prices):
    assert ("no price", None) in dollars(price_usage(usage, prices, on_missing=None))


def test_repeated_intervals_count_once(prices):
    assert unit_prices(prices).count() == 3


def test_products_keep_every_digit(frame, prices):
    tiny = frame(USAGE, ("x", "S", "A", "U", "2024-01-01 10:00:00", "2024-01-01 11:00:00", "0.000001"))
    assert price_usage(tiny, prices).first().dollars == Decimal("0.000000100000")


def test_unknown_bounds_are_refused(usage, prices):
    with pytest.raises(ValueError, match="closed"):
        interval_lookup(usage, "usage_start_time", prices, "price_start_time", "price_end_time", ["cloud"], "right")


@pytest.mark.parametrize(("quantity", "price"), [("0.0000004", "1000000"), ("1000000", "0.0000004")])
def test_many_small_amounts_do_not_round_to_nothing(spark, quantity, price):
    start = "timestamp'2024-01-01'"
    usage = spark.sql(
        f"SELECT 'S' sku_name, 'A' cloud, {start} usage_start_time, CAST('{quantity}' AS DECIMAL(38,18)) usage_quantity FROM range(1000)"
    )
    prices = spark.sql(
        f"SELECT 'S' sku_name, 'A' cloud, 'USD' currency_code, {start} price_start_time, CAST(NULL AS TIMESTAMP) price_end_time,"
        f" named_struct('effective_list', named_struct('default', CAST('{price}' AS DECIMAL(38,18)))) pricing"
    )
    total = price_usage(usage, prices).agg(*billed_measures()).first()
    assert (total.units, total.dollars) == (1000 * Decimal(quantity), Decimal(400))
