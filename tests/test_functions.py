from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from transferlens.functions import classify, display, money, timeparts


def one(spark, column, **values):
    row = {k: v for k, v in values.items()}
    kinds = {bool: "boolean", int: "bigint", float: "double", str: "string", Decimal: "decimal(38,18)", type(None): "string"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in row.items())
    return spark.createDataFrame([tuple(row.values())], schema).select(column.alias("r")).first().r


@pytest.mark.parametrize(
    "wei, eth",
    [
        ("1", Decimal("0.000000000000000001")),
        ("99999999600000000000", Decimal("99.9999996")),
        ("100000000000000000000", Decimal(100)),
        ("0", Decimal(0)),
        ("0" * 60 + "5", Decimal("0.000000000000000005")),
        ("9" * 38, Decimal("9" * 20 + "." + "9" * 18)),
        ("1" + "0" * 38, None),
        ("7" * 78, None),
        ("", None),
        ("-5", None),
        ("12 ", None),
        ("1e3", None),
        (None, None),
    ],
)
def test_wei_to_eth_is_exact_or_null(spark, wei, eth):
    assert one(spark, money.wei_to_eth("v"), v=wei) == eth


def test_wei_to_eth_rounded_form(spark):
    assert one(spark, money.wei_to_eth("v", exact=False), v="99999999600000000000") == Decimal(100)
    assert one(spark, money.wei_to_eth("v", exact=False), v="7" * 78) is None


def test_fee_beyond_bigint(spark):
    fee = one(spark, money.fee_eth("g", "p"), g=30_000_000, p=9_000_000_000_000_000_000)
    assert fee == Decimal(30_000_000) * 9


@pytest.mark.parametrize("wei, reached", [("99999999999999999999", False), ("100000000000000000000", True), ("1" + "0" * 77, True), (None, False), ("x", False)])
def test_threshold_on_raw_amounts(spark, wei, reached):
    assert one(spark, money.at_least_eth("v", 100), v=wei) is reached


def test_token_amount_keeps_zero_decimals(spark):
    assert one(spark, money.token_amount("v", F.lit(0)), v="42") == 42.0
    assert one(spark, money.token_amount("v", F.lit(6)), v="2500000") == 2.5
    assert one(spark, money.token_amount("v", F.lit(6)), v="abc") is None


@pytest.mark.parametrize("value, name", [(9999.99, "Whale"), (10000.0, "Humpback"), (1000.0, "Whale"), (999.99, "Shark"), (100.0, "Shark"), (99.99, "Crab")])
def test_tiers(spark, value, name):
    assert one(spark, classify.tier("v"), v=value) == name


@pytest.mark.parametrize("value, name", [(1000.0, "Humpback"), (500.0, "Whale"), (499.0, "Shark"), (99.0, "Crab")])
def test_day_tiers(spark, value, name):
    assert one(spark, classify.tier("v", classify.DAY_TIERS), v=value) == name


@pytest.mark.parametrize("rank, name", [(1, "Top1"), (2, "Top3"), (3, "Top3"), (4, "Top10"), (10, "Top10"), (11, "Hot"), (50, "Hot"), (51, "Normal")])
def test_popularity_tiers(spark, rank, name):
    assert one(spark, classify.popularity_tier("v"), v=rank) == name


@pytest.mark.parametrize(
    "label, brand, strict",
    [("Binance 14", "Binance", "Binance"), ("Uniswap V3: Router", "Uniswap V", "Uniswap V"), ("1inch: Router", "1inch: Router", ""), ("Unknown", "Unknown", "Unknown")],
)
def test_entity(spark, label, brand, strict):
    assert one(spark, classify.entity("v"), v=label) == brand
    assert one(spark, classify.entity("v", strict=True), v=label) == strict


@pytest.mark.parametrize(
    "sender, receiver, name",
    [
        ("Unknown", "CEX", "CEX_DEPOSIT"),
        ("CEX", "Unknown", "CEX_WITHDRAWAL"),
        ("CEX", "DEX", "DEX_TRADE"),
        ("DEX", "Bridge", "DEX_TRADE"),
        ("Bridge", "Unknown", "BRIDGE_MOVE"),
        ("Unknown", "Unknown", "PRIVATE_MOVE"),
        ("CEX", "CEX", "OTHER"),
        ("DeFi", "Unknown", "OTHER"),
    ],
)
def test_flow_type(spark, sender, receiver, name):
    assert one(spark, classify.flow_type("s", "r"), s=sender, r=receiver) == name


@pytest.mark.parametrize(
    "deposit, withdrawal, name",
    [
        (0.0, 0.0, "NEUTRAL"),
        (5.0, 0.0, "STRONG_SELL_PRESSURE"),
        (0.0, 5.0, "STRONG_BUY_PRESSURE"),
        (151.0, 100.0, "STRONG_SELL_PRESSURE"),
        (150.0, 100.0, "MILD_SELL_PRESSURE"),
        (100.0, 100.0, "NEUTRAL"),
        (67.0, 100.0, "MILD_BUY_PRESSURE"),
        (66.0, 100.0, "STRONG_BUY_PRESSURE"),
    ],
)
def test_pressure(spark, deposit, withdrawal, name):
    ratio = classify.flow_ratio("d", "w")
    assert one(spark, classify.pressure_label("d", "w", ratio), d=deposit, w=withdrawal) == name


def test_ratio_of_no_withdrawal_is_missing(spark):
    assert one(spark, classify.flow_ratio("d", "w"), d=3.0, w=0.0) is None


@pytest.mark.parametrize(
    "change, rank, name",
    [(100.0, 20, "Surging"), (100.0, 21, None), (99.9, 1, "Rising"), (50.0, 20, "Rising"), (49.9, 1, None), (-50.0, 99, "Cooling"), (-49.9, 1, None)],
)
def test_trending_signal(spark, change, rank, name):
    assert one(spark, classify.trending_signal("c", "r"), c=change, r=rank) == name


def test_signs(spark):
    assert [one(spark, classify.position_label("v"), v=v) for v in (0.1, -0.1, 0.0)] == ["Accumulator", "Dumper", "Neutral"]
    assert [one(spark, classify.cex_flow_label("v"), v=v) for v in (0.0002, -0.0002, 0.0001)] == ["CEX_INFLOW", "CEX_OUTFLOW", "NEUTRAL"]


def test_time_parts_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        assert str(one(spark, timeparts.unix_date("v"), v=1_700_006_399)) == "2023-11-14"
        assert one(spark, timeparts.unix_hour("v"), v=1_700_006_399) == 23
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_display(spark):
    assert one(spark, display.volume_text("v"), v=1234.5) == "1.23 K"
    assert one(spark, display.volume_text("v"), v=0.0) == "0"
    assert one(spark, display.volume_text("v"), v=2.5e9) == "2.50 B"
    assert one(spark, display.eth_text("v"), v=1500.0) == "1.5K"
    assert one(spark, display.eth_text("v"), v=15.0) == "15.00"
    assert one(spark, display.short_address("v"), v="0x1234567890abcdef") == "0x1234…cdef"
    assert one(spark, display.short_address("v"), v="0x12") == "0x12"
    ages = [one(spark, display.age_text("v", 10_000), v=v) for v in (9_990, 9_900, 2_000, 20_000)]
    assert ages == ["Just now", "1m ago", "2h ago", "Just now"]
    assert one(spark, display.valid_address("v"), v="0x" + "aB" * 20) is True
    assert one(spark, display.valid_address("v"), v="0x12") is False
    assert one(spark, display.valid_address("v"), v=None) is False
