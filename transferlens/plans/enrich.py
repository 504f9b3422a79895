"""Enriched transactions and token flow, from raw ledger tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from transferlens import schemas
from transferlens.functions import classify, money, timeparts
from transferlens.operators.labels import with_labels


def enrich_transactions(transactions: DataFrame, receipts: DataFrame, exact: bool = True) -> DataFrame:
    """Every transaction, with value, fee and outcome; both unknown where no receipt exists."""
    outcome = receipts.select(
        F.col("transaction_hash").alias("hash"), "status", "gas_used", "effective_gas_price"
    )
    to = F.col("to_address")
    deploy = F.coalesce(to, F.lit("")) == ""
    return transactions.drop("gas_used").join(outcome, "hash", "left").select(
        "hash",
        "block_number",
        "block_timestamp",
        "from_address",
        "to_address",
        money.wei_to_eth("value", exact).alias("value_eth"),
        money.fee_eth("gas_used", "effective_gas_price").alias("tx_fee_eth"),
        (F.col("status") == 1).alias("is_success"),
        (~deploy & (F.col("input") != "0x")).alias("is_contract_call"),
        deploy.alias("is_contract_deploy"),
        classify.tx_type("transaction_type").alias("tx_type"),
        timeparts.unix_date("block_timestamp").alias("dt"),
    )


def token_flow(
    transfers: DataFrame,
    tokens: DataFrame,
    blocks: DataFrame,
    labels: DataFrame,
    receipts: DataFrame | None = None,
    observed: Observation | None = None,
) -> DataFrame:
    """Transfers of tracked tokens, with time, amount and labels.

    With ``receipts`` only transfers of successful transactions stay, and ``status`` is kept. ``observed`` takes the counts of
    ``quality.flow_sources`` while transfers pass.
    """
    times = blocks.select(F.col("number").alias("block_number"), F.col("timestamp").alias("block_timestamp"))
    flow = transfers.drop("block_timestamp")
    flow = flow.join(tokens, "token_address") if observed is None else _counted(flow, tokens, observed)
    flow = flow.join(times, "block_number", "left")
    extra = []
    if receipts is not None:
        done = receipts.where(F.col("status") == 1).select("transaction_hash", "status")
        flow = flow.join(done, "transaction_hash")
        extra = ["status"]
    flow = with_labels(flow.withColumn("amount", money.token_amount("value", "decimals")), labels)
    # behind the joins with labels, which move what stands before them
    flow = flow.withColumns({"hour": timeparts.unix_hour("block_timestamp"), "dt": timeparts.unix_date("block_timestamp")})
    return flow.select(*schemas.TOKEN_FLOW.fieldNames(), *extra)


def _counted(transfers: DataFrame, tokens: DataFrame, observed: Observation) -> DataFrame:
    """The inner join with tokens, while all transfers and those of known tokens are counted.

    The one join of the flow does both, and its sides are plain frames, so that a hot token is split. Counts are of rows behind
    the join: a token that is listed twice counts its transfers twice (see ``quality.source_counts``).
    """
    rows = transfers.join(tokens.withColumn("__tracked", F.lit(True)), "token_address", "left")
    rows = rows.observe(observed, F.count("__tracked").alias("tracked_rows"), F.count(F.lit(1)).alias("all_rows"))
    return rows.where(F.col("__tracked")).drop("__tracked")


# Fixed value: topic that marks a token transfer log.
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"


def decode_transfer_logs(logs: DataFrame) -> DataFrame:
    """Token transfers from raw event logs; the amount stays as hex text."""
    topics = F.col("topics")

    def address(i: int):
        return F.concat(F.lit("0x"), F.substring(F.lower(F.element_at(topics, i)), -40, 40))

    return logs.where((F.lower(F.element_at(topics, 1)) == TRANSFER_TOPIC) & (F.size(topics) >= 3)).select(
        F.lower("address").alias("token_address"),
        address(2).alias("from_address"),
        address(3).alias("to_address"),
        F.col("data").alias("value_hex"),
        "transaction_hash",
        "log_index",
        "block_number",
    )
