"""Table shapes. Column names and types of the ledger's tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "decimal(38,18)": T.DecimalType(38, 18),
    "decimal(38,4)": T.DecimalType(38, 4),
    "decimal(28,6)": T.DecimalType(28, 6),
    "decimal(25,4)": T.DecimalType(25, 4),
    "array<string>": T.ArrayType(T.StringType()),
}


def _schema(columns: str) -> T.StructType:
    # built here rather than by fromDDL, which needs a running session at import time
    pairs = [c.split(" ") for c in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


BLOCKS = _schema(
    "number bigint, hash string, parent_hash string, nonce string, sha3_uncles string, logs_bloom string, "
    "transactions_root string, state_root string, receipts_root string, miner string, difficulty bigint, "
    "total_difficulty string, size int, extra_data string, gas_limit bigint, gas_used bigint, "
    "timestamp bigint, transaction_count int, base_fee_per_gas bigint"
)
TRANSACTIONS = _schema(
    "hash string, nonce bigint, block_hash string, block_number bigint, transaction_index int, "
    "from_address string, to_address string, value string, gas bigint, gas_price bigint, input string, "
    "block_timestamp bigint, max_fee_per_gas bigint, max_priority_fee_per_gas bigint, transaction_type int"
)
RECEIPTS = _schema(
    "transaction_hash string, transaction_index int, block_hash string, block_number bigint, "
    "cumulative_gas_used bigint, gas_used bigint, contract_address string, root string, status int, "
    "effective_gas_price bigint"
)
LOGS = _schema(
    "log_index bigint, transaction_hash string, transaction_index bigint, block_hash string, "
    "block_number bigint, address string, data string, topics array<string>"
)
TOKEN_TRANSFERS = _schema(
    "token_address string, from_address string, to_address string, value string, transaction_hash string, "
    "log_index bigint, block_number bigint"
)
CONTRACTS = _schema(
    "address string, bytecode string, function_sighashes array<string>, is_erc20 boolean, "
    "is_erc721 boolean, block_number bigint"
)
BRONZE = {
    "blocks": BLOCKS,
    "transactions": TRANSACTIONS,
    "receipts": RECEIPTS,
    "logs": LOGS,
    "token_transfers": TOKEN_TRANSFERS,
    "contracts": CONTRACTS,
}

ENRICHED = _schema(
    "hash string, block_number bigint, block_timestamp bigint, from_address string, to_address string, "
    "value_eth decimal(38,18), tx_fee_eth decimal(38,18), is_success boolean, is_contract_call boolean, "
    "is_contract_deploy boolean, tx_type string, dt date"
)
WHALES = _schema(
    "hash string, block_timestamp bigint, hour int, dt date, "
    "from_address string, from_label string, from_entity string, from_category string, "
    "to_address string, to_label string, to_entity string, to_category string, "
    "value_eth decimal(38,18), cumul_sent_eth decimal(38,18), cumul_tx_count bigint, "
    "cumul_recv_eth decimal(38,18), whale_tier string, flow_type string, is_private_transaction boolean, "
    "flag_high_freq boolean"
)
TOKEN_FLOW = _schema(
    "transaction_hash string, block_timestamp bigint, hour int, dt date, token_address string, "
    "symbol string, token_name string, from_address string, from_label string, from_category string, "
    "to_address string, to_label string, to_category string, amount double"
)
SILVER = {"txn_enriched": ENRICHED, "whale_txns": WHALES, "token_flow": TOKEN_FLOW}

TOP_WHALES_DAILY = _schema(
    "dt date, address string, entity_name string, entity_category string, whale_tier string, "
    "position_label string, net_flow_eth decimal(28,6), total_sent_eth decimal(38,18), "
    "total_recv_eth decimal(38,18), total_activity_eth decimal(28,6), total_tx_count bigint, "
    "tx_count_as_sender bigint, tx_count_as_receiver bigint, rank_accumulator bigint, rank_dumper bigint, "
    "rank_activity bigint, flag_high_freq boolean"
)
MARKET_FLOW_HOURLY = _schema(
    "dt date, hour int, flow_type string, total_eth decimal(25,4), cex_deposit_eth decimal(38,4), "
    "cex_withdrawal_eth decimal(38,4), deposit_withdrawal_ratio double, pressure_label string"
)
TOKEN_POPULARITY_DAILY = _schema(
    "dt date, token_address string, symbol string, token_name string, rank_popularity bigint, "
    "popularity_tier string, popularity_score double, tx_count bigint, total_volume double, "
    "unique_addresses bigint, cex_net_flow double, cex_flow_label string"
)
TOKEN_POPULARITY_HOURLY = _schema(
    "dt date, hour int, token_address string, symbol string, rank_by_tx_count bigint, tx_count bigint, "
    "total_volume double, tx_count_change_pct double, cex_net_flow double, trending_signal string"
)
GOLD = {
    "top_whales_daily": TOP_WHALES_DAILY,
    "market_flow_hourly": MARKET_FLOW_HOURLY,
    "token_popularity_daily": TOKEN_POPULARITY_DAILY,
    "token_popularity_hourly": TOKEN_POPULARITY_HOURLY,
}

LABELS = _schema("address string, label_name string, label_category string")
TOKENS = _schema("token_address string, symbol string, token_name string, decimals int")

# streamed messages, before validation: every scalar is read as text
STREAM_BLOCK = _schema("number string, timestamp string, block_timestamp string, item_timestamp string")
STREAM_TRANSACTION = _schema(
    "hash string, timestamp string, block_timestamp string, item_timestamp string, from_address string, "
    "to_address string, value string, gas_price string"
)
STREAM_TRANSFER = _schema(
    "transaction_hash string, log_index string, timestamp string, block_timestamp string, "
    "item_timestamp string, block_number string, token_address string, from_address string, "
    "to_address string, value string"
)
ALERT = _schema(
    "hash string, timestamp string, from_address string, to_address string, value string, value_eth double"
)
REQUEST_LOG = _schema(
    "timestamp string, level string, name string, message string, method string, url string, "
    "status_code int, duration_ms double"
)
