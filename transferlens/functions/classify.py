"""Labels derived from amounts, categories and ranks. Thresholds and weights are arguments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# Default thresholds and the names that belong to them.
TX_TIERS = ((10_000, "Humpback"), (1_000, "Whale"), (100, "Shark"))
DAY_TIERS = ((1_000, "Humpback"), (500, "Whale"), (100, "Shark"))
LOWEST_TIER = "Crab"
POPULARITY_TIERS = ((1, "Top1"), (3, "Top3"), (10, "Top10"), (50, "Hot"))
POPULARITY_REST = "Normal"
SCORE_WEIGHTS = {"tx_count": 0.55, "unique_addresses": 0.45, "total_volume": 0.0}
FLOW_BAND = 0.0001
HIGH_FREQ_COUNT = 5
HIGH_FREQ_SUM = 500
SELL_BANDS = ((1.5, "STRONG_SELL_PRESSURE"), (1.0, "MILD_SELL_PRESSURE"))
BUY_BANDS = ((0.67, "STRONG_BUY_PRESSURE"), (1.0, "MILD_BUY_PRESSURE"))
PRESSURE_REST = "NEUTRAL"
TREND_TOP = 20
RISING_STEPS = ((100, "Surging"), (50, "Rising"))
FALLING_STEPS = ((-50, "Cooling"),)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at_least(value: Column | str, steps: Sequence[tuple[float, str]], rest: str | None) -> Column:
    """Name of the first step whose threshold the value reaches, highest step first."""
    value, out = _col(value), F.lit(rest)
    for limit, name in sorted(steps):
        out = F.when(value >= F.lit(limit), F.lit(name)).otherwise(out)
    return out


def at_most(value: Column | str, steps: Sequence[tuple[float, str]], rest: str | None) -> Column:
    """Name of the first step whose threshold the value does not exceed, lowest step first."""
    value, out = _col(value), F.lit(rest)
    for limit, name in sorted(steps, reverse=True):
        out = F.when(value <= F.lit(limit), F.lit(name)).otherwise(out)
    return out


def tier(value: Column | str, steps: Sequence[tuple[float, str]] = TX_TIERS) -> Column:
    return at_least(value, steps, LOWEST_TIER)


def sign_label(value: Column | str, above: str, below: str, between: str = "Neutral", band: float = 0) -> Column:
    value = _col(value)
    return F.when(value > F.lit(band), above).when(value < F.lit(-band), below).otherwise(between)


def position_label(net: Column | str) -> Column:
    return sign_label(net, "Accumulator", "Dumper")


def cex_flow_label(net: Column | str, band: float = FLOW_BAND) -> Column:
    return sign_label(net, "CEX_INFLOW", "CEX_OUTFLOW", "NEUTRAL", band)


def popularity_tier(rank: Column | str) -> Column:
    return at_most(rank, POPULARITY_TIERS, POPULARITY_REST)


def entity(label: Column | str, strict: bool = False) -> Column:
    """Brand part of a label: the text before the first digit, colon or hash sign.

    A label that starts with such a character has no brand part; it stands for itself unless
    ``strict`` asks for the empty string.
    """
    label = _col(label)
    brand = F.trim(F.regexp_extract(label, r"^([^0-9:#]+)", 1))
    return brand if strict else F.when(brand == "", label).otherwise(brand)


def both_unknown(sender: Column | str, receiver: Column | str) -> Column:
    return (_col(sender) == UNKNOWN) & (_col(receiver) == UNKNOWN)


def flow_type(sender: Column | str, receiver: Column | str) -> Column:
    """What a transfer does, from the categories of its two sides. The first rule that holds wins."""
    sender, receiver = _col(sender), _col(receiver)

    def either(category: str) -> Column:
        return (sender == category) | (receiver == category)

    rules = (
        ("CEX_DEPOSIT", (sender == UNKNOWN) & (receiver == "CEX")),
        ("CEX_WITHDRAWAL", (sender == "CEX") & (receiver == UNKNOWN)),
        ("DEX_TRADE", either("DEX")),
        ("BRIDGE_MOVE", either("Bridge")),
        ("PRIVATE_MOVE", both_unknown(sender, receiver)),
    )
    return F.coalesce(*[F.when(holds, F.lit(name)) for name, holds in rules], F.lit("OTHER"))


def high_frequency(
    count: Column | str, total: Column | str, min_count: int = HIGH_FREQ_COUNT, min_sum: float = HIGH_FREQ_SUM
) -> Column:
    return (_col(count) >= min_count) & (_col(total) >= F.lit(min_sum))


def flow_ratio(deposit: Column | str, withdrawal: Column | str) -> Column:
    """Deposits per withdrawal, 4 places; missing where nothing was withdrawn."""
    deposit, withdrawal = _col(deposit).cast("double"), _col(withdrawal).cast("double")
    return F.round(deposit / F.when(withdrawal != 0, withdrawal), 4)


def pressure_label(
    deposit: Column | str,
    withdrawal: Column | str,
    ratio: Column | str,
    sell: Sequence[tuple[float, str]] = SELL_BANDS,
    buy: Sequence[tuple[float, str]] = BUY_BANDS,
    rest: str = PRESSURE_REST,
) -> Column:
    """Selling pressure (ratio above a band of ``sell``) or buying pressure (below a band of ``buy``).

    Where only one side moved anything, it has the strongest name of that side.
    """
    deposit, withdrawal, ratio = _col(deposit), _col(withdrawal), _col(ratio)
    band = F.lit(rest)
    for limit, name in sorted(buy, reverse=True):
        band = F.when(ratio < F.lit(limit), name).otherwise(band)
    for limit, name in sorted(sell):
        band = F.when(ratio > F.lit(limit), name).otherwise(band)
    only_deposits = F.when(deposit > 0, max(sell)[1]).otherwise(rest)
    return F.when(withdrawal == 0, only_deposits).when(deposit == 0, min(buy)[1]).otherwise(band)


def trending_signal(
    change_pct: Column | str,
    rank: Column | str,
    top: int = TREND_TOP,
    rising: Sequence[tuple[float, str]] = RISING_STEPS,
    falling: Sequence[tuple[float, str]] = FALLING_STEPS,
) -> Column:
    """Rising steps count for the first ``top`` ranks only, falling ones for all; null between them."""
    change = _col(change_pct)
    return F.coalesce(F.when(_col(rank) <= top, at_least(change, rising, None)), at_most(change, falling, None))


def direction(sender: Column | str, address: str) -> Column:
    return F.when(F.lower(_col(sender)) == address.lower(), "OUT").otherwise("IN")


def tx_type(code: Column | str) -> Column:
    """Name of a transaction type code."""
    code = _col(code)
    return F.when(code == 2, "eip1559").when(code == 1, "access_list").when(code == 0, "legacy").otherwise("other")
