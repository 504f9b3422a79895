"""Questions a dashboard asks of the stored ledger. ``as_of`` (unix seconds) replaces the clock.

Frames: addresses in lower case (see :func:`lowered`): ``transactions`` (hash, block_timestamp, from_address, to_address, value, gas_price) with
raw amounts as text; ``transfers`` (transaction_hash, log_index, block_timestamp, token_address,
from_address, to_address, value); ``tokens`` and ``labels`` as in the dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.functions import classify, money
from transferlens.operators.labels import with_labels
from transferlens.operators.search import fuzzy_search
from transferlens.operators.stats import top

HOUR = 3600


def lowered(df: DataFrame, *columns: str) -> DataFrame:
    """Addresses in lower case, as the serving tables keep them: questions then compare bare columns."""
    return df.withColumns({c: F.lower(c) for c in columns})


def gas_price(transactions: DataFrame, as_of: int, window_seconds: int = 300) -> DataFrame:
    """Mean gas price of the last minutes up to ``as_of`` in gwei; else the latest price known then; else 0.

    One plan: the window's mean is an aggregate, and the history is joined to it where it is missing. The side that tells is
    broadcast first, so with a price in the window adaptive execution drops the history before it is read.
    """
    price, time = F.col("gas_price").try_cast("double"), F.col("block_timestamp")
    recent = transactions.where((time >= as_of - window_seconds) & (time <= as_of)).agg(F.avg(price).alias("wei"))
    missing = recent.where(F.col("wei").isNull()).select(F.col("wei").isNull().alias("__known"))  # one row or none
    known = transactions.where(time <= as_of).select("block_timestamp", "hash", price.alias("wei"), price.isNotNull().alias("__known"))
    latest = known.join(F.broadcast(missing), "__known", "left_semi").agg(F.max_by("wei", F.struct("block_timestamp", "hash")).alias("wei"))
    both = recent.unionByName(latest).agg(F.coalesce(F.max("wei"), F.lit(0.0)).alias("wei"))
    return both.select(F.round(money.wei_to_gwei("wei"), 2).alias("average_gas_price_gwei"))


def recent_whales(transactions: DataFrame, labels: DataFrame, threshold: float = 100, limit: int = 50) -> DataFrame:
    """Latest large transactions. The top-n comes first, so labels are joined to ``limit`` rows."""
    large = transactions.where(money.at_least_eth("value", threshold))
    newest = top(large, [F.desc("block_timestamp"), F.asc("hash")], limit)
    return with_labels(newest, labels, missing=None).select(
        "hash",
        "block_timestamp",
        "from_address",
        "to_address",
        money.wei_to_eth("value").cast("double").alias("value_eth"),
        "from_label",
        "to_label",
        "from_category",
        "to_category",
    )


def trending_tokens(transfers: DataFrame, tokens: DataFrame, as_of: int, hours: int = 1, limit: int = 10) -> DataFrame:
    """Tokens with most transfers in the last hours; counted before the token join."""
    counts = (
        transfers.where((F.col("block_timestamp") >= as_of - hours * HOUR) & (F.col("block_timestamp") <= as_of))
        .groupBy("token_address")
        .agg(F.count(F.lit(1)).alias("transfer_count"))
    )
    named = counts.join(tokens, "token_address").select("token_address", "symbol", "token_name", "transfer_count")
    return top(named, [F.desc("transfer_count"), F.asc("token_address")], limit)


def token_trend(
    transfers: DataFrame, address: str, as_of: int, width_seconds: int = HOUR, buckets: int = 24
) -> DataFrame:
    """Transfers and raw volume of one token per time bucket, oldest first."""
    own = transfers.where(
        (F.col("token_address") == address.lower())
        & (F.col("block_timestamp") >= as_of - width_seconds * buckets)
        & (F.col("block_timestamp") <= as_of)
    )
    start = (F.floor(F.col("block_timestamp") / width_seconds) * width_seconds).cast("long")
    return (
        own.groupBy(start.alias("bucket_start"))
        .agg(
            F.count(F.lit(1)).alias("transfer_count"),
            F.coalesce(F.sum(F.col("value").cast("string").try_cast("double")), F.lit(0.0)).alias("total_value"),
        )
        .orderBy("bucket_start")
    )


def trend_total(trend: DataFrame, decimals: int = 18) -> DataFrame:
    """All buckets of :func:`token_trend` together, volume in whole tokens."""
    return trend.agg(
        F.coalesce(F.sum("transfer_count"), F.lit(0)).alias("transfer_count"),
        (F.coalesce(F.sum("total_value"), F.lit(0.0)) / F.lit(float(10**decimals))).alias("volume"),
    )


def starts_with(column: str, prefix: str) -> Column:
    """Case-insensitive prefix match; the prefix is taken literally, wildcards included."""
    literal = prefix.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return F.col(column).ilike(literal + "%")


def non_alphabetic(column: str) -> Column:
    return ~F.col(column).rlike("^[A-Za-z]")


def list_tokens(tokens: DataFrame, limit: int = 100, offset: int = 0, prefix: str | None = None) -> DataFrame:
    """A page of the token directory. Prefix ``#`` asks for symbols that start with no letter."""
    if prefix == "#":
        tokens = tokens.where(non_alphabetic("symbol"))
    elif prefix:
        tokens = tokens.where(starts_with("symbol", prefix))
    return top(tokens, [F.asc_nulls_last("symbol"), F.asc("token_address")], limit, offset).select(
        "token_address", "symbol", "token_name", "decimals"
    )


def search_tokens(tokens: DataFrame, query: str, size: int = 10) -> DataFrame:
    return fuzzy_search(tokens, query, size)


def _history(rows: DataFrame, address: str, limit: int, order: list[Column], dedupe_self: bool) -> DataFrame:
    """Latest outgoing and incoming rows of one address, in one scan; a self transfer shows on both sides."""
    own = address.lower()
    sent, received = F.col("from_address") == own, F.col("to_address") == own
    if dedupe_self:
        received = received & ~F.coalesce(sent, F.lit(False))
    sides = F.array_compact(F.array(F.when(sent, F.lit("OUT")), F.when(received, F.lit("IN"))))
    both = rows.where((F.col("from_address") == own) | (F.col("to_address") == own)).withColumn("side", F.explode(sides))
    return top(both, order, limit).drop("side")


def wallet_transactions(
    transactions: DataFrame, labels: DataFrame, address: str, limit: int = 10, dedupe_self: bool = False
) -> DataFrame:
    order = [F.desc("block_timestamp"), F.asc("hash")]
    rows = transactions.select("hash", "block_timestamp", "from_address", "to_address", "value", "gas_price")
    return with_labels(_history(rows, address, limit, order, dedupe_self), labels, missing=None).select(
        "hash",
        "block_timestamp",
        classify.direction("from_address", address).alias("type"),
        "from_address",
        "to_address",
        (F.col("value").try_cast("double") / 1e18).alias("value_eth"),
        money.wei_to_gwei("gas_price").alias("gas_price_gwei"),
        "from_label",
        "to_label",
        "from_category",
        "to_category",
    )


def wallet_token_transfers(
    transfers: DataFrame,
    tokens: DataFrame,
    labels: DataFrame,
    address: str,
    limit: int = 10,
    dedupe_self: bool = False,
) -> DataFrame:
    order = [F.desc("block_timestamp"), F.asc("transaction_hash"), F.asc("log_index")]
    rows = transfers.select(
        "transaction_hash", "log_index", "block_timestamp", "from_address", "to_address", "value", "token_address"
    )
    latest = _history(rows, address, limit, order, dedupe_self)
    named = with_labels(latest.join(tokens, "token_address", "left"), labels, missing=None)
    return named.select(
        F.col("transaction_hash").alias("hash"),
        "log_index",
        "block_timestamp",
        classify.direction("from_address", address).alias("type"),
        "from_address",
        "to_address",
        F.coalesce("symbol", F.lit("UNKNOWN")).alias("symbol"),
        money.token_amount("value", F.coalesce("decimals", F.lit(18))).alias("value"),
        "from_label",
        "to_label",
        "from_category",
        "to_category",
    )
