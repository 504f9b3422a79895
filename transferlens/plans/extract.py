"""Measures and selections over raw ledger tables: ranges, hashes, contracts, run summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.functions import money, timeparts

# Cost model of a run.
UNITS_PER_RECEIPT = 15
PRICE_PER_GIB = 0.02


def block_range(blocks: DataFrame) -> DataFrame:
    """First and last block of each UTC day."""
    return blocks.groupBy(timeparts.unix_date("timestamp").alias("dt")).agg(
        F.min("number").alias("start_block"),
        F.max("number").alias("end_block"),
        F.count(F.lit(1)).alias("blocks"),
    )


def block_day(blocks: DataFrame, number: int) -> DataFrame:
    return blocks.where(F.col("number") == number).select("number", timeparts.unix_date("timestamp").alias("dt"))


def whale_hashes(transactions: DataFrame, min_eth: float = 100) -> DataFrame:
    """Hashes of transactions that move at least ``min_eth``, decided on the raw amount."""
    return transactions.where(money.at_least_eth("value", min_eth)).select("hash")


def contract_addresses(transfers: DataFrame) -> DataFrame:
    return transfers.select("token_address").distinct()


def run_summary(
    blocks: DataFrame, transactions: DataFrame, receipts: DataFrame, total_bytes: DataFrame, min_eth: float = 100
) -> DataFrame:
    """One row: block span, transactions, whales, receipts, bytes and cost.

    ``total_bytes`` has a column ``bytes`` (see ``sources.files.file_sizes``). The parts are
    reduced to one row each and put side by side by one more aggregate over their union.
    """
    number, none = F.col("number"), F.lit(None).cast("long")
    names = ["start_block", "end_block", "block_count", "total_tx_in_blocks", "whale_count", "receipt_count", "total_bytes"]

    def part(df: DataFrame, **filled: Column) -> DataFrame:
        return df.agg(*[filled.get(n, none).cast("long").alias(n) for n in names])

    parts = [
        part(
            blocks,
            start_block=F.min(number),
            end_block=F.max(number),
            block_count=F.count(F.lit(1)),
            total_tx_in_blocks=F.coalesce(F.sum("transaction_count"), F.lit(0)),
        ),
        part(whale_hashes(transactions, min_eth), whale_count=F.count(F.lit(1))),
        part(receipts, receipt_count=F.count(F.lit(1))),
        part(total_bytes, total_bytes=F.coalesce(F.sum("bytes"), F.lit(0))),
    ]
    merged = parts[0]
    for other in parts[1:]:
        merged = merged.unionByName(other)
    return merged.agg(*[F.max(n).alias(n) for n in names]).withColumns(
        {
            "total_mb": F.round(F.col("total_bytes") / (1024.0 * 1024.0), 2),
            "compute_units": F.col("whale_count") * UNITS_PER_RECEIPT,
            "monthly_storage_usd": F.round(F.col("total_bytes") / float(1024**3) * PRICE_PER_GIB, 6),
        }
    )
