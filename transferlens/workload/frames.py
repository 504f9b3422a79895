"""The given tables as ledger frames.

events -> transactions, receipts, token transfers; orders and lineitem -> transactions, receipts,
blocks and transfers; customer -> labels; part -> tokens. Every frame covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlens.functions import timeparts
from transferlens.functions.money import ETH


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def cents(amount: str) -> Column:
    return F.round(F.col(amount) * 100).cast("bigint")


def wei_text(amount: str) -> Column:
    return F.concat(cents(amount).cast("string"), F.lit("0" * 16))


def gas_wei() -> Column:
    return cents("value") * 100_000_000


def event_transactions(events: DataFrame) -> DataFrame:
    seconds = timeparts.to_unix("ts")
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").cast("string").alias("hash"),
        F.floor(seconds / 3600).alias("block_number"),
        seconds.alias("block_timestamp"),
        F.col("user_id").cast("string").alias("from_address"),
        F.get_json_object("props", "$.k").alias("to_address"),
        wei_text("value").alias("value"),
        gas_wei().alias("gas_price"),
        F.when(kind == "view", "0x").otherwise("0xa9059cbb").alias("input"),
        F.when(kind.isin("purchase", "click"), 2).otherwise(0).alias("transaction_type"),
        kind.alias("event_type"),
        F.round("value", 2).alias("amount"),
    )


def event_receipts(events: DataFrame, min_value: float = 100) -> DataFrame:
    """Receipts exist for large transactions only."""
    return events.where(F.col("value") >= min_value).select(
        F.col("event_id").cast("string").alias("transaction_hash"),
        F.floor(timeparts.to_unix("ts") / 3600).alias("block_number"),
        F.when(F.col("event_type") == "error", 0).otherwise(1).alias("status"),
        F.lit(21_000).cast("bigint").alias("gas_used"),
        gas_wei().alias("effective_gas_price"),
    )


def event_enriched(events: DataFrame) -> DataFrame:
    """Transactions whose outcome is known for every row, as input of the whale queries."""
    rows = event_transactions(events)
    return rows.select(
        "hash",
        "block_number",
        "block_timestamp",
        "from_address",
        "to_address",
        F.col("amount").cast(ETH).alias("value_eth"),
        (F.col("event_type") != "error").alias("is_success"),
        timeparts.unix_date("block_timestamp").alias("dt"),
    )


def event_transfers(events: DataFrame) -> DataFrame:
    """Token transfers: the token is the event type, amounts have 18 decimals."""
    rows = event_transactions(events)
    return rows.select(
        F.col("hash").alias("transaction_hash"),
        F.lit(0).cast("bigint").alias("log_index"),
        "block_timestamp",
        "block_number",
        F.col("event_type").alias("token_address"),
        "from_address",
        "to_address",
        "value",
    )


def event_tokens(events: DataFrame) -> DataFrame:
    kinds = events.select(F.col("event_type").alias("token_address")).distinct()
    return kinds.select(
        "token_address",
        F.upper(F.substring("token_address", 1, 4)).alias("symbol"),
        F.col("token_address").alias("token_name"),
        F.lit(18).alias("decimals"),
    )


def event_flow(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Hourly token flow: the receiving side's number is the token, too."""
    from transferlens.operators.labels import with_labels

    rows = event_transactions(events)
    flow = rows.select(
        F.col("hash").alias("transaction_hash"),
        "block_timestamp",
        timeparts.unix_hour("block_timestamp").alias("hour"),
        timeparts.unix_date("block_timestamp").alias("dt"),
        F.concat(F.lit("t"), "to_address").alias("token_address"),
        F.concat(F.lit("T"), "to_address").alias("symbol"),
        F.concat(F.lit("token "), "to_address").alias("token_name"),
        "from_address",
        "to_address",
        "amount",
    )
    return with_labels(flow, labels)


def raw_labels(customer: DataFrame) -> DataFrame:
    segment = F.col("c_mktsegment")
    category = (
        F.when(segment == "BUILDING", "CEX").when(segment == "AUTOMOBILE", "DEX").when(segment == "MACHINERY", "Bridge")
    )
    return customer.select(
        F.col("c_custkey").cast("string").alias("address"),
        F.col("c_name").alias("label_name"),
        category.alias("label_category"),
    )


def labels(customer: DataFrame) -> DataFrame:
    return raw_labels(customer).where(F.col("label_category").isNotNull())


def tokens(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").cast("string").alias("token_address"),
        F.col("p_brand").alias("symbol"),
        F.col("p_name").alias("token_name"),
        (F.col("p_size") % 19).cast("int").alias("decimals"),
    )


def order_transactions(orders: DataFrame) -> DataFrame:
    """Transactions without a receiver (1-URGENT: null, 2-HIGH: empty) are deployments."""
    seconds = timeparts.to_unix("o_orderdate")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    receiver = (
        F.when(priority == "1-URGENT", F.lit(None))
        .when(priority == "2-HIGH", "")
        .otherwise((F.col("o_custkey") + 1).cast("string"))
    )
    return orders.select(
        F.col("o_orderkey").cast("string").alias("hash"),
        F.floor(seconds / timeparts.DAY).alias("block_number"),
        seconds.alias("block_timestamp"),
        F.col("o_custkey").cast("string").alias("from_address"),
        receiver.alias("to_address"),
        wei_text("o_totalprice").alias("value"),
        F.when(status == "O", "0x").when(status == "F", "0xa9059cbb").alias("input"),
        F.when(priority.isin("3-MEDIUM", "4-NOT SPECIFIED"), 2).otherwise(0).alias("transaction_type"),
    )


def lineitem_receipts(lineitem: DataFrame) -> DataFrame:
    """One receipt per order that has lines; it failed if more than one line was returned."""
    per = lineitem.groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.sum("l_quantity").cast("bigint").alias("quantity"),
        F.max(cents("l_extendedprice")).alias("price"),
    )
    return per.select(
        F.col("l_orderkey").cast("string").alias("transaction_hash"),
        F.when(F.col("returned") > 1, 0).otherwise(1).alias("status"),
        (F.col("quantity") * 1000).alias("gas_used"),
        (F.col("price") * 1000).alias("effective_gas_price"),
    )


def order_blocks(orders: DataFrame) -> DataFrame:
    """One block per order day, with the number of orders it holds."""
    seconds = timeparts.to_unix("o_orderdate")
    return orders.groupBy(F.floor(seconds / timeparts.DAY).alias("number")).agg(
        F.min(seconds).alias("timestamp"), F.count(F.lit(1)).alias("transaction_count")
    )


def line_transfers(lineitem: DataFrame, orders: DataFrame, part: DataFrame, hashed: bool = True) -> DataFrame:
    """Supplier sends a part to the customer; raw amount = quantity shifted by the decimals.

    ``order_timestamp`` is the time of the order: a bound on it reaches the scan of the orders. Without ``hashed`` the hash is
    the line's key only, so that joins move no long texts; ``line_hash`` makes the text of it behind them.
    """
    rows = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        part, F.col("l_partkey") == F.col("p_partkey")
    )
    zeros = F.expr("repeat('0', p_size % 19)")
    return rows.select(
        F.col("l_partkey").cast("string").alias("token_address"),
        F.col("l_suppkey").cast("string").alias("from_address"),
        F.col("o_custkey").cast("string").alias("to_address"),
        F.concat(F.col("l_quantity").cast("bigint").cast("string"), zeros).alias("value"),
        (
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
            if hashed
            else F.struct("l_orderkey", "l_linenumber")
        ).alias("transaction_hash"),
        F.col("l_orderkey").cast("string").alias("order_hash"),
        timeparts.to_unix("o_orderdate").alias("order_timestamp"),
        F.floor(timeparts.to_unix("l_shipdate") / timeparts.DAY).alias("block_number"),
    )


def line_hash() -> Column:
    """The hash of ``line_transfers`` from a line's key, its token and its sender."""
    return F.concat_ws("-", "transaction_hash.l_orderkey", "transaction_hash.l_linenumber", "token_address", "from_address")


def swap_flow(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Transfers of one asset among the hundred receivers, both directions occurring: the
    input of the reciprocal-transfer queries. Two events of one second share a transaction."""
    from transferlens.operators.labels import with_labels

    rows = event_transactions(events).select(
        F.concat_ws("-", F.floor(F.col("block_timestamp") / 600), F.lit("tx")).alias("transaction_hash"),
        F.col("event_type").alias("token_address"),
        F.upper("event_type").alias("symbol"),
        "from_address",
        "to_address",
        "amount",
    )
    return with_labels(rows, labels)
