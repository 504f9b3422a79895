"""Serving queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from transferlens.plans import serving
from transferlens.workload import frames, sql
from transferlens.workload.catalog import query
from transferlens.workload.frames import table

AS_OF = 1_705_362_600  # 2024-01-15 23:50:00, in the middle of the events
WALLET = "7"


def _tx(spark, d):
    return serving.lowered(frames.event_transactions(table(spark, d, "events")), "from_address", "to_address")


def _transfers(spark, d):
    return serving.lowered(frames.event_transfers(table(spark, d, "events")), "token_address", "from_address", "to_address")


def _labels(spark, d):
    return frames.labels(table(spark, d, "customer"))


@query(f"""WITH {sql.TX}
SELECT round(coalesce(avg(CASE WHEN s >= {AS_OF} - 300 THEN c * 1e8 END), arg_max(c * 1e8, ts), 0.0) / 1e9, 2) AS average_gas_price_gwei FROM tx WHERE s <= {AS_OF}""")
def gas_now(spark, d):
    return serving.gas_price(_tx(spark, d), AS_OF)


LATE = 2_000_000_000  # a window behind the last event


@query(f"""WITH {sql.TX}
SELECT round(coalesce(arg_max(c * 1e8, (s, hash)), 0.0) / 1e9, 2) AS average_gas_price_gwei FROM tx WHERE s <= {LATE}""")
def gas_after_history(spark, d):
    """The latest known price, from the whole table."""
    return serving.gas_price(_tx(spark, d), LATE)


_NAMES = """x.name AS from_label, y.name AS to_label, x.category AS from_category, y.category AS to_category"""
_JOINS = "LEFT JOIN lab x ON r.f = x.address LEFT JOIN lab y ON r.t = y.address"


@query(f"""WITH {sql.TX}, {sql.LABELS}, r AS (SELECT * FROM tx WHERE c >= 10000 ORDER BY s DESC, hash LIMIT 50)
SELECT hash, s AS block_timestamp, f AS from_address, t AS to_address, c / 100.0 AS value_eth, {_NAMES} FROM r {_JOINS}""")
def recent_whales(spark, d):
    return serving.recent_whales(_tx(spark, d), _labels(spark, d))


_TRENDING = f"""WITH {sql.TX}
SELECT event_type AS token_address, upper(substr(event_type, 1, 4)) AS symbol, event_type AS token_name,
       CAST(count(*) AS BIGINT) AS transfer_count
FROM tx WHERE s BETWEEN {AS_OF} - {{hours}} * 3600 AND {AS_OF} GROUP BY 1, 2, 3 ORDER BY transfer_count DESC, token_address LIMIT {{limit}}"""


@query(_TRENDING.format(hours=24, limit=3))
def trending_tokens(spark, d):
    return serving.trending_tokens(_transfers(spark, d), frames.event_tokens(table(spark, d, "events")), AS_OF, 24, 3)


_TREND = f"""WITH {sql.TX}, b AS (
  SELECT s // 3600 * 3600 AS bucket_start, CAST(count(*) AS BIGINT) AS transfer_count, CAST(sum(c) AS DOUBLE) * 1e16 AS total_value
  FROM tx WHERE event_type = 'purchase' AND s BETWEEN {AS_OF} - 3600 * 240 AND {AS_OF} GROUP BY 1)"""


@query(f"{_TREND} SELECT bucket_start, transfer_count, round(total_value / 1e16, 0) AS total_value FROM b")
def token_trend(spark, d):
    trend = serving.token_trend(_transfers(spark, d), "PURCHASE", AS_OF, 3600, 240)
    return trend.withColumn("total_value", F.round(F.col("total_value") / 1e16, 0))


@query(f"{_TREND} SELECT CAST(sum(transfer_count) AS BIGINT) AS transfer_count, round(sum(total_value) / 1e18, 4) AS volume FROM b")
def token_trend_total(spark, d):
    total = serving.trend_total(serving.token_trend(_transfers(spark, d), "purchase", AS_OF, 3600, 240), 18)
    return total.withColumn("volume", F.round("volume", 4))


_PART = "SELECT CAST(p_partkey AS VARCHAR) AS token_address, p_brand AS symbol, p_name AS token_name, CAST(p_size % 19 AS BIGINT) AS decimals FROM part"


@query(f"{_PART} WHERE p_brand ILIKE 'brand#1%' ORDER BY symbol NULLS LAST, token_address LIMIT 100 OFFSET 20")
def token_list(spark, d):
    return serving.list_tokens(frames.tokens(table(spark, d, "part")), 100, 20, "brand#1")


@query(f"SELECT * FROM ({_PART}) WHERE false OR NOT regexp_matches(symbol, '^[A-Za-z]') ORDER BY symbol, token_address LIMIT 100".replace(
    "p_brand AS symbol", "CASE WHEN p_type = 'SMALL' THEN CAST(p_size AS VARCHAR) || p_brand ELSE p_brand END AS symbol"))
def token_list_non_alphabetic(spark, d):
    part = table(spark, d, "part")
    symbol = F.when(F.col("p_type") == "SMALL", F.concat(F.col("p_size").cast("string"), "p_brand")).otherwise(F.col("p_brand"))
    return serving.list_tokens(frames.tokens(part.withColumn("p_brand", symbol)), 100, 0, "#")


def _search(terms: tuple[tuple[str, int], ...], limit: int) -> str:
    def field(words: str) -> str:
        parts = []
        for term, edits in terms:
            hit = f"CASE WHEN levenshtein(w, '{term}') <= {edits} THEN 1.0 - levenshtein(w, '{term}') / {float(len(term))} ELSE 0.0 END"
            parts.append(f"coalesce(list_max([{hit} FOR w IN list_filter(string_split_regex(lower({words}), '[^a-z0-9]+'), lambda w: w <> '')]), 0.0)")
        return " + ".join(parts)

    return f"""WITH p AS ({_PART}), scored AS (
  SELECT *, round(CAST(greatest(2 * ({field('symbol')}), {field('token_name')}) AS DOUBLE), 6) AS score FROM p)
SELECT token_address, symbol, token_name, decimals, score FROM scored WHERE score > 0 ORDER BY score DESC, token_address LIMIT {limit}"""


@query(_search((("smal", 1), ("rign", 1)), 10))
def token_search(spark, d):
    return serving.search_tokens(frames.tokens(table(spark, d, "part")), "Smal Rign")


@query(_search((("bradn", 1), ("17", 0), ("widgett", 2)), 25))
def token_search_symbol(spark, d):
    return serving.search_tokens(frames.tokens(table(spark, d, "part")), "bradn#17 widgett", 25)


def _history(columns: str, order: str, limit: int) -> str:
    def side(column: str) -> str:
        return f"(SELECT * FROM tx WHERE {column} = '{WALLET}' ORDER BY {order} LIMIT {limit})"

    return f"""WITH {sql.TX}, {sql.LABELS}, r AS (
  SELECT * FROM ({side('f')} UNION ALL {side('t')}) ORDER BY {order} LIMIT {limit})
SELECT hash, s AS block_timestamp, CASE WHEN lower(f) = '{WALLET}' THEN 'OUT' ELSE 'IN' END AS type, f AS from_address,
       t AS to_address, {columns}, {_NAMES} FROM r {_JOINS}"""


@query(_history("c / 100.0 AS value_eth, c / 10.0 AS gas_price_gwei", "s DESC, hash", 60))
def wallet_transactions(spark, d):
    return serving.wallet_transactions(_tx(spark, d), _labels(spark, d), WALLET, 60)


@query(_history(
    """CASE WHEN event_type = 'view' THEN 'UNKNOWN' ELSE upper(substr(event_type, 1, 4)) END AS symbol, c / 100.0 AS value,
       CAST(0 AS BIGINT) AS log_index""", "s DESC, hash", 60))
def wallet_token_transfers(spark, d):
    tokens = frames.event_tokens(table(spark, d, "events")).where(F.col("token_address") != "view")
    return serving.wallet_token_transfers(_transfers(spark, d), tokens, _labels(spark, d), WALLET, 60)
