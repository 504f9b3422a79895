"""The daily run: raw tables to silver, checks, then gold, in one session."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from transferlens import schemas
from transferlens.operators.lookup import SMALL_ROWS, counted_broadcast
from transferlens.plans import enrich, quality, rollups, whales
from transferlens.plans.quality import seen as _seen
from transferlens.plans.quality import settled as _settled
from transferlens.session import stored
from transferlens.sources.dimensions import read_labels, read_tokens
from transferlens.sources.files import day_of, read_days, read_json
from transferlens.sources.sinks import write_days


@dataclass(frozen=True)
class DayConfig:
    bronze: str
    silver: str
    gold: str
    labels: str | None = None
    tokens: str | None = None
    threshold: float = 100
    enforce: bool = True
    small_blocks: int = SMALL_ROWS


def run_day(spark: SparkSession, day: str, config: DayConfig) -> DataFrame:
    """Builds one day. Each silver table is written, then read back by the steps that need it,
    so no step recomputes another and a lost executor only repeats its own step. Raw tables are read once: how many rows
    they have is observed while silver is written from them.

    Returns the check results; with ``enforce`` a failed critical rule stops the run before gold.
    """
    day = day_of(day)
    bronze = {
        name: read_json(spark, f"{config.bronze}/{name}", schemas.BRONZE[name], day).drop("dt")
        for name in ("blocks", "transactions", "receipts", "token_transfers")
    }
    labels, tokens = read_labels(spark, config.labels), read_tokens(spark, config.tokens)

    def silver(name: str) -> DataFrame:
        return read_days(spark, f"{config.silver}/{name}", schemas.SILVER[name], day)

    def of_day(df: DataFrame) -> DataFrame:
        # a row belongs to the day whose folder it came from, also where its block time is unknown
        return df.withColumn("dt", F.lit(day).cast("date"))

    sent, moved = Observation("transactions"), Observation("token_transfers")
    transactions = bronze["transactions"].observe(sent, F.count(F.lit(1)).alias("source_rows"))
    write_days(of_day(enrich.enrich_transactions(transactions, bronze["receipts"])), f"{config.silver}/txn_enriched")
    tracked = quality.tracked_transfers(bronze["token_transfers"], tokens).observe(
        moved, F.count("tracked").alias("tracked_rows"), F.count(F.lit(1)).alias("all_rows")
    )
    transfers = tracked.where(F.col("tracked")).drop("tracked")
    times = counted_broadcast(bronze["blocks"].select("number", "timestamp"), "block-times", config.small_blocks)
    write_days(of_day(enrich.token_flow(transfers, tokens, times, labels)), f"{config.silver}/token_flow")
    write_days(
        whales.whale_transactions(silver("txn_enriched"), labels, config.threshold), f"{config.silver}/whale_txns"
    )

    sources = _settled(
        _seen(sent),
        {"source_rows": silver("txn_enriched").count()},
        lambda: {"source_rows": bronze["transactions"].count()},
    )
    flow_sources = _settled(
        _seen(moved),
        {"tracked_rows": silver("token_flow").count()},
        lambda: quality.flow_sources(bronze["token_transfers"], tokens).first().asDict(),
    )
    results = quality.all_checks(
        [
            quality.check_enriched(silver("txn_enriched"), sources),
            quality.check_flow(silver("token_flow"), flow_sources, keep=stored),
            quality.check_whales(silver("whale_txns")),
        ]
    )
    results = stored(results, "checks")
    if config.enforce:
        quality.enforce(results)

    write_days(rollups.top_whales_daily(silver("whale_txns"), keep=stored), f"{config.gold}/top_whales_daily")
    write_days(rollups.market_flow_hourly(silver("whale_txns")), f"{config.gold}/market_flow_hourly")
    write_days(rollups.token_popularity_daily(silver("token_flow")), f"{config.gold}/token_popularity_daily")
    write_days(rollups.token_popularity_hourly(silver("token_flow")), f"{config.gold}/token_popularity_hourly")
    return results
