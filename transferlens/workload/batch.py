"""Silver and gold queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from transferlens.functions import display, money
from transferlens.plans import enrich, rollups, whales
from transferlens.session import stored
from transferlens.workload import frames, sql
from transferlens.workload.catalog import query
from transferlens.workload.frames import table

TX_TIERS = ((200, "Humpback"), (100, "Whale"), (50, "Shark"))
DAY_TIERS = ((300, "Humpback"), (150, "Whale"), (50, "Shark"))


def whale_frame(spark: SparkSession, d: str) -> DataFrame:
    return whales.whale_transactions(
        frames.event_enriched(table(spark, d, "events")),
        frames.labels(table(spark, d, "customer")),
        threshold=20,
        tiers=TX_TIERS,
        min_count=3,
        min_sum=50,
    )


def event_flow(spark: SparkSession, d: str) -> DataFrame:
    return frames.event_flow(table(spark, d, "events"), frames.labels(table(spark, d, "customer")))


def line_flow(spark: SparkSession, d: str, receipts: bool = False, observed: Observation | None = None) -> DataFrame:
    lineitem, orders, part = (table(spark, d, n) for n in ("lineitem", "orders", "part"))
    transfers = frames.line_transfers(lineitem, orders, part, hashed=False)
    done = None
    if receipts:
        transfers = transfers.withColumn("transaction_hash", F.col("order_hash"))
        done = frames.lineitem_receipts(lineitem)
    flow = enrich.token_flow(
        transfers, frames.tokens(part), frames.order_blocks(orders), frames.labels(table(spark, d, "customer")), done, observed
    )
    return flow if receipts else flow.withColumn("transaction_hash", frames.line_hash())


def enriched_frame(spark: SparkSession, d: str) -> DataFrame:
    return enrich.enrich_transactions(
        frames.order_transactions(table(spark, d, "orders")), frames.lineitem_receipts(table(spark, d, "lineitem"))
    )


@query(f"""WITH {sql.ENRICHED}
SELECT hash, block_number, block_timestamp, from_address, to_address, value_eth, round(tx_fee_eth, 12) AS tx_fee_eth,
       is_success, is_contract_call, is_contract_deploy, tx_type, CAST(dt AS VARCHAR) AS dt FROM enriched""")
def enrich_transactions(spark, d):
    return enriched_frame(spark, d).withColumn("tx_fee_eth", F.round(F.col("tx_fee_eth").cast("double"), 12))


@query(f"""WITH {sql.WHALES}
SELECT hash, s AS block_timestamp, hour, CAST(dt AS VARCHAR) AS dt, f AS from_address, fl AS from_label, fe AS from_entity,
       fc AS from_category, t AS to_address, tl AS to_label, te AS to_entity, tc AS to_category, c / 100.0 AS value_eth,
       sent_c / 100.0 AS cumul_sent_eth, CAST(sent_n AS BIGINT) AS cumul_tx_count, recv_c / 100.0 AS cumul_recv_eth,
       {sql.steps('c', (20000, 10000, 5000), ('Humpback', 'Whale', 'Shark'), 'Crab')} AS whale_tier, flow_type,
       fc = 'Unknown' AND tc = 'Unknown' AS is_private_transaction, hf AS flag_high_freq FROM whales""")
def whale_transactions(spark, d):
    return whale_frame(spark, d)


_LINE_FLOW_OUT = """hash AS transaction_hash, s AS block_timestamp, hour, CAST(dt AS VARCHAR) AS dt, token AS token_address,
       symbol, token_name, f AS from_address, fl AS from_label, fc AS from_category, t AS to_address, tl AS to_label,
       tc AS to_category, amount"""


@query(f"WITH {sql.LINE_FLOW} SELECT {_LINE_FLOW_OUT} FROM flow")
def token_flow(spark, d):
    return line_flow(spark, d)


@query(f"""WITH {sql.LINE_FLOW}, {sql.RECEIPTS}
SELECT {_LINE_FLOW_OUT.replace('hash AS transaction_hash', 'order_hash AS transaction_hash')}, CAST(status AS BIGINT) AS status
FROM flow JOIN (SELECT hash AS rh, status FROM rec WHERE status = 1) r ON order_hash = rh""")
def token_flow_successful(spark, d):
    return line_flow(spark, d, receipts=True)


@query(f"""WITH {sql.WHALES},
sides AS (
  SELECT dt, f AS address, fe AS entity, fc AS category, c AS sent, 0 AS recv, 1 AS snd, hf FROM whales UNION ALL
  SELECT dt, t, te, tc, 0, c, 0, false FROM whales),
days AS (
  SELECT address, dt, CAST(sum(sent) AS BIGINT) AS sc, CAST(sum(recv) AS BIGINT) AS rc, CAST(sum(snd) AS BIGINT) AS ns,
         CAST(sum(1 - snd) AS BIGINT) AS nr, bool_or(hf) AS hf FROM sides GROUP BY 1, 2),
votes AS (
  SELECT address, dt, entity, category, row_number() OVER (PARTITION BY address, dt
    ORDER BY (entity = 'Unknown'), count(*) DESC, entity, category) AS k
  FROM sides WHERE address IS NOT NULL GROUP BY address, dt, entity, category)
SELECT CAST(d.dt AS VARCHAR) AS dt, d.address, v.entity AS entity_name, v.category AS entity_category,
       {sql.steps('(sc + rc)', (30000, 15000, 5000), ('Humpback', 'Whale', 'Shark'), 'Crab')} AS whale_tier,
       CASE WHEN rc > sc THEN 'Accumulator' WHEN rc < sc THEN 'Dumper' ELSE 'Neutral' END AS position_label,
       (rc - sc) / 100.0 AS net_flow_eth, sc / 100.0 AS total_sent_eth, rc / 100.0 AS total_recv_eth,
       (sc + rc) / 100.0 AS total_activity_eth, ns + nr AS total_tx_count, ns AS tx_count_as_sender,
       nr AS tx_count_as_receiver,
       CAST(rank() OVER (PARTITION BY d.dt ORDER BY rc - sc DESC) AS BIGINT) AS rank_accumulator,
       CAST(rank() OVER (PARTITION BY d.dt ORDER BY rc - sc) AS BIGINT) AS rank_dumper,
       CAST(rank() OVER (PARTITION BY d.dt ORDER BY rc + sc DESC) AS BIGINT) AS rank_activity, hf AS flag_high_freq
FROM days d LEFT JOIN votes v ON d.address = v.address AND d.dt = v.dt AND v.k = 1""")
def top_whales_daily(spark, d):
    return rollups.top_whales_daily(stored(whale_frame(spark, d), "whale-txns"), tiers=DAY_TIERS, keep=stored)


@query(f"""WITH {sql.WHALES},
totals AS (SELECT dt, hour, flow_type, CAST(sum(c) AS BIGINT) AS c FROM whales GROUP BY 1, 2, 3),
sides AS (
  SELECT *, coalesce(max(CASE WHEN flow_type = 'CEX_DEPOSIT' THEN c END) OVER w, 0) / 100.0 AS dep,
         coalesce(max(CASE WHEN flow_type = 'CEX_WITHDRAWAL' THEN c END) OVER w, 0) / 100.0 AS wd
  FROM totals WINDOW w AS (PARTITION BY dt, hour)),
rated AS (SELECT *, CASE WHEN wd <> 0 THEN round(dep / wd, 4) END AS r FROM sides)
SELECT CAST(dt AS VARCHAR) AS dt, hour, flow_type, c / 100.0 AS total_eth, dep AS cex_deposit_eth, wd AS cex_withdrawal_eth,
       r AS deposit_withdrawal_ratio,
       CASE WHEN dep = 0 AND wd = 0 THEN 'NEUTRAL' WHEN wd = 0 THEN 'STRONG_SELL_PRESSURE' WHEN dep = 0 THEN 'STRONG_BUY_PRESSURE'
            WHEN r > 1.5 THEN 'STRONG_SELL_PRESSURE' WHEN r > 1 THEN 'MILD_SELL_PRESSURE' WHEN r < 0.67 THEN 'STRONG_BUY_PRESSURE'
            WHEN r < 1 THEN 'MILD_BUY_PRESSURE' ELSE 'NEUTRAL' END AS pressure_label
FROM rated""")
def market_flow_hourly(spark, d):
    return rollups.market_flow_hourly(whale_frame(spark, d))


@query(f"""WITH {sql.EVENT_FLOW},
base AS (
  SELECT dt, token, symbol, token_name, count(hash) AS n, round(sum(amount), 4) AS vol, count(DISTINCT f || '_' || t) AS pairs,
         round(sum(CASE WHEN tc = 'CEX' THEN amount WHEN fc = 'CEX' THEN -amount ELSE 0 END), 4) AS net
  FROM flow GROUP BY 1, 2, 3, 4),
scored AS (
  SELECT *, round(0.55 * ((n - min(n) OVER w) / greatest(max(n) OVER w - min(n) OVER w, 1)::DOUBLE)
                + 0.45 * ((pairs - min(pairs) OVER w) / greatest(max(pairs) OVER w - min(pairs) OVER w, 1)::DOUBLE), 4) AS score
  FROM base WINDOW w AS (PARTITION BY dt)),
ranked AS (SELECT *, rank() OVER (PARTITION BY dt ORDER BY score DESC) AS r FROM scored)
SELECT CAST(dt AS VARCHAR) AS dt, token AS token_address, symbol, token_name, CAST(r AS BIGINT) AS rank_popularity,
       CASE WHEN r = 1 THEN 'Top1' WHEN r <= 3 THEN 'Top3' WHEN r <= 10 THEN 'Top10' WHEN r <= 50 THEN 'Hot' ELSE 'Normal' END AS popularity_tier,
       score AS popularity_score, CAST(n AS BIGINT) AS tx_count, vol AS total_volume, CAST(pairs AS BIGINT) AS unique_addresses,
       net AS cex_net_flow, CASE WHEN net > 0.0001 THEN 'CEX_INFLOW' WHEN net < -0.0001 THEN 'CEX_OUTFLOW' ELSE 'NEUTRAL' END AS cex_flow_label
FROM ranked""")
def token_popularity_daily(spark, d):
    return rollups.token_popularity_daily(event_flow(spark, d), exact_pairs=True)


@query(f"""WITH {sql.EVENT_FLOW} SELECT CAST(dt AS VARCHAR) AS dt, token AS token_address, CAST(count(DISTINCT f || '_' || t) AS BIGINT) AS exact_pairs,
  true AS within_three_errors FROM flow GROUP BY 1, 2""")
def token_popularity_daily_approx(spark, d):
    """The sketch beside the exact count; its relative standard error is 5 percent."""
    flow = event_flow(spark, d)
    keys = ["dt", "token_address"]
    sketch = rollups.token_popularity_daily(flow).select(*keys, F.col("unique_addresses").alias("sketch"))
    exact = rollups.token_popularity_daily(flow, exact_pairs=True).select(*keys, F.col("unique_addresses").alias("exact_pairs"))
    within = F.abs(F.col("sketch") - F.col("exact_pairs")) <= F.greatest(0.15 * F.col("exact_pairs"), F.lit(1))
    return exact.join(sketch, keys).select(*keys, "exact_pairs", within.alias("within_three_errors"))


def _hourly(previous: str) -> str:
    return f"""WITH {sql.EVENT_FLOW},
base AS (
  SELECT dt, hour, token, symbol, count(hash) AS n, round(sum(amount), 4) AS vol,
         round(sum(CASE WHEN tc = 'CEX' THEN amount WHEN fc = 'CEX' THEN -amount ELSE 0 END), 4) AS net
  FROM flow GROUP BY 1, 2, 3, 4),
lagged AS (
  SELECT *, {previous} AS p, rank() OVER (PARTITION BY dt, hour ORDER BY n DESC) AS r
  FROM base WINDOW w AS (PARTITION BY token, dt ORDER BY hour)),
changed AS (SELECT *, CASE WHEN p > 0 THEN round((n - p) / p::DOUBLE * 100, 2) END AS pct FROM lagged)
SELECT CAST(dt AS VARCHAR) AS dt, hour, token AS token_address, symbol, CAST(r AS BIGINT) AS rank_by_tx_count,
       CAST(n AS BIGINT) AS tx_count, vol AS total_volume, pct AS tx_count_change_pct, net AS cex_net_flow,
       CASE WHEN pct >= 100 AND r <= 20 THEN 'Surging' WHEN pct >= 50 AND r <= 20 THEN 'Rising' WHEN pct <= -50 THEN 'Cooling' END AS trending_signal
FROM changed"""


@query(_hourly("lag(n) OVER w"))
def token_popularity_hourly(spark, d):
    return rollups.token_popularity_hourly(event_flow(spark, d))


@query(_hourly("CASE WHEN lag(hour) OVER w = hour - 1 THEN lag(n) OVER w END"))
def token_popularity_hourly_dense(spark, d):
    return rollups.token_popularity_hourly(event_flow(spark, d), dense=True)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS hash, CAST(round(o_totalprice * 100) AS BIGINT) / 100.0 AS exact_eth,
  CAST(round(o_totalprice * 100) AS BIGINT) / 100.0 AS rounded_eth,
  round(CAST(round(o_totalprice * 100) AS BIGINT) / 100.0 * 1e9, 0) AS gwei FROM orders""")
def wei_conversion(spark, d):
    tx = frames.order_transactions(table(spark, d, "orders"))
    return tx.select(
        "hash",
        money.wei_to_eth("value").alias("exact_eth"),
        money.wei_to_eth("value", exact=False).alias("rounded_eth"),
        F.round(money.wei_to_gwei("value"), 0).alias("gwei"),
    )


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS hash,
  CASE WHEN p >= 1e9 THEN printf('%.2f', p / 1e9) || ' B' WHEN p >= 1e6 THEN printf('%.2f', p / 1e6) || ' M'
       WHEN p >= 1e3 THEN printf('%.2f', p / 1e3) || ' K' ELSE printf('%.2f', p) END AS volume,
  CASE WHEN o_totalprice >= 1e3 THEN printf('%.1f', (round(o_totalprice) + 0.0625) / 1e3) || 'K' ELSE printf('%.2f', round(o_totalprice) + 0.0625) END AS eth,
  substr(lpad(CAST(o_custkey AS VARCHAR), 42, 'a'), 1, 6) || '…' || right(lpad(CAST(o_custkey AS VARCHAR), 42, 'a'), 4) AS short,
  CASE WHEN age < 60 THEN 'Just now' WHEN age < 3600 THEN CAST(age // 60 AS VARCHAR) || 'm ago'
       ELSE CAST(age // 3600 AS VARCHAR) || 'h ago' END AS age
FROM (SELECT *, round(o_totalprice) + 0.25 AS p, greatest(0, 1100000000 - CAST(epoch(o_orderdate) AS BIGINT)) AS age FROM orders)""")
def display_texts(spark, d):
    from transferlens.functions import timeparts

    orders = table(spark, d, "orders")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("hash"),
        display.volume_text(F.round("o_totalprice") + 0.25).alias("volume"),
        display.eth_text(F.round("o_totalprice") + 0.0625).alias("eth"),
        display.short_address(F.lpad(F.col("o_custkey").cast("string"), 42, "a")).alias("short"),
        display.age_text(timeparts.to_unix("o_orderdate"), 1_100_000_000).alias("age"),
    )
