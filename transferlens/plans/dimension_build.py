"""Building the label and token dimensions from their raw sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transferlens.functions.display import valid_address

# Tags per category, in the order of the source list.
CATEGORY_TAGS = {
    "CEX": (
        "exchange", "binance", "coinbase", "kraken", "okex", "kucoin", "bybit", "bitfinex", "bithumb", "upbit",
        "huobi", "gate-io", "gemini", "bitstamp",
    ),
    "DEX": (
        "dex", "uniswap", "sushiswap", "curve-fi", "balancer", "1inch", "pancakeswap", "dydx", "paraswap",
        "cowswap", "0x-protocol", "kyberswap",
    ),
    "Bridge": (
        "bridge", "optimism-bridge", "hop-protocol", "stargate", "wormhole", "multichain", "celer-network",
        "across", "synapse",
    ),
    "DeFi": ("defi", "aave", "compound", "makerdao", "lido", "yearn", "convex", "lending"),
    "Mixer": ("tornado-cash",),
    "Sanctioned": ("phish-hack", "heist"),
}
TAG_CATEGORY = {tag: category for category, tags in CATEGORY_TAGS.items() for tag in tags}

# Tokens that belong in the dimension whatever their rank.
MANDATORY_COINS = (
    "weth", "staked-ether", "wrapped-bitcoin", "rocket-pool-eth", "frax-ether", "mantle-staked-ether", "binance-eth",
)


def tag_category(tags, mapping: Mapping[str, str] = TAG_CATEGORY):
    """Category of the first tag that has one; tags that have none are noise and skipped."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.filter(F.transform(tags, lambda t: F.try_element_at(table, t)), lambda c: c.isNotNull())
    return F.get(found, 0)


def build_labels(
    raw: DataFrame, mapping: Mapping[str, str] = TAG_CATEGORY, check_address: bool = True
) -> DataFrame:
    """(address, name, category) from (address, name, labels array). One row per address.

    The mapping is a literal inside the expression: no join, no shuffle before the dedupe.
    Where an address comes twice the smallest (category, name) stays.
    """
    rows = raw.select(
        F.lower(F.trim("address")).alias("address"),
        F.coalesce("name", F.lit("")).alias("name"),
        tag_category(F.col("labels"), mapping).alias("category"),
    ).where(F.col("category").isNotNull())
    if check_address:
        rows = rows.where(valid_address("address"))
    kept = rows.groupBy("address").agg(F.min(F.struct("category", "name")).alias("r"))
    return kept.select("address", "r.name", "r.category")


def category_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("category").agg(F.count(F.lit(1)).alias("addresses")).orderBy(F.desc("addresses"), "category")


def coin_addresses(platforms: DataFrame, chain: str = "ethereum") -> DataFrame:
    """(coin_id, address) from (id, platforms map); only addresses on ``chain``."""
    address = F.lower(F.trim(F.try_element_at("platforms", F.lit(chain))))
    return platforms.select(F.col("id").alias("coin_id"), address.alias("address")).where(
        F.col("address").startswith("0x")
    )


def build_tokens(
    markets: DataFrame,
    addresses: DataFrame,
    mandatory: Sequence[str] = MANDATORY_COINS,
    cap: int = 1000,
) -> DataFrame:
    """The token dimension: mandatory coins, then the largest others up to ``cap``, re-ranked.

    ``markets`` is (coin_id, symbol, name, market_cap, market_rank, decimals); an address that
    comes twice keeps its best coin. ``cap`` is the size of the dimension, so the final ranking
    window holds at most ``cap`` rows.
    """
    required = F.col("coin_id").isin(*mandatory)
    capital = F.coalesce(F.col("market_cap").cast("long"), F.lit(0))
    coins = markets.join(addresses, "coin_id").withColumns(
        {"__late": (~required).cast("int"), "market_cap_usd": capital}
    )
    order = F.struct("__late", (-F.col("market_cap_usd")).alias("neg_cap"), "coin_id")
    best = coins.groupBy("address").agg(
        F.min_by(
            F.struct("__late", "coin_id", "symbol", "name", "decimals", "market_rank", "market_cap_usd"), order
        ).alias("c")
    ).select("address", "c.*")
    chosen = best.orderBy("__late", F.desc("market_cap_usd"), "coin_id", "address").limit(cap)
    by_capital = Window.partitionBy(F.lit(0)).orderBy(F.desc("market_cap_usd"), "coin_id", "address")
    return chosen.select(
        F.row_number().over(by_capital).cast("long").alias("rank"),
        "market_rank",
        "name",
        F.upper("symbol").alias("symbol"),
        "address",
        F.coalesce("decimals", F.lit(18)).alias("decimals"),
        "market_cap_usd",
    )
