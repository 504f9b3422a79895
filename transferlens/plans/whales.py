"""Large successful transfers: labels, tiers, flow types, running totals."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.functions import classify, timeparts
from transferlens.functions.money import ETH
from transferlens.operators.labels import with_labels
from transferlens.operators.running import running_totals


def large_transfers(enriched: DataFrame, threshold: float | str = 100) -> DataFrame:
    """Successful transfers of at least ``threshold``; an unknown outcome is not a success."""
    limit = F.lit(Decimal(str(threshold))).cast(ETH)
    return enriched.where((F.col("value_eth") >= limit) & F.col("is_success"))


def whale_transactions(
    enriched: DataFrame,
    labels: DataFrame,
    threshold: float | str = 100,
    tiers: Sequence[tuple[float, str]] = classify.TX_TIERS,
    min_count: int = classify.HIGH_FREQ_COUNT,
    min_sum: float = classify.HIGH_FREQ_SUM,
    strict_entity: bool = False,
) -> DataFrame:
    """Running totals are taken per address and day in time order; equal times order by hash."""
    large = large_transfers(enriched, threshold).select(
        "hash", "block_timestamp", "dt", "from_address", "to_address", "value_eth"
    )
    slot = F.col("block_timestamp")  # an address-day has at most 86,400, however many rows
    order = ["block_timestamp", "hash"]
    moved = running_totals(
        large,
        keys=["from_address", "dt"],
        order_by=order,
        slot=slot,
        sums={"cumul_sent_eth": F.col("value_eth"), "cumul_tx_count": F.col("hash").isNotNull().cast("long")},
    )
    moved = running_totals(
        moved,
        keys=["to_address", "dt"],
        order_by=order,
        slot=slot,
        sums={"cumul_recv_eth": F.col("value_eth")},
        source=large,
    )
    # brands are cut out once per label, not once per transfer
    branded = labels.withColumn("label_entity", classify.entity("label_name", strict_entity))
    named = with_labels(moved, branded, extra={"label_entity": "entity"})
    return named.select(
        "hash",
        "block_timestamp",
        timeparts.unix_hour("block_timestamp").alias("hour"),
        "dt",
        "from_address",
        "from_label",
        "from_entity",
        "from_category",
        "to_address",
        "to_label",
        "to_entity",
        "to_category",
        "value_eth",
        "cumul_sent_eth",
        "cumul_tx_count",
        "cumul_recv_eth",
        classify.tier("value_eth", tiers).alias("whale_tier"),
        classify.flow_type("from_category", "to_category").alias("flow_type"),
        classify.both_unknown("from_category", "to_category").alias("is_private_transaction"),
        classify.high_frequency("cumul_tx_count", "cumul_sent_eth", min_count, min_sum).alias("flag_high_freq"),
    )
