"""Shared pieces of the check SQL: the given tables as ledger frames, in plain SQL."""

TX = """tx AS (
  SELECT CAST(event_id AS VARCHAR) AS hash, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(ts AS DATE) AS dt,
         CAST(extract(hour FROM ts) AS BIGINT) AS hour, CAST(user_id AS VARCHAR) AS f,
         json_extract_string(props, '$.k') AS t, CAST(round(value * 100) AS BIGINT) AS c, event_type, ts
  FROM events)"""

LABELS = """lab AS (
  SELECT CAST(c_custkey AS VARCHAR) AS address, c_name AS name,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'CEX' WHEN 'AUTOMOBILE' THEN 'DEX' WHEN 'MACHINERY' THEN 'Bridge' END AS category
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY'))"""

FLOW_CASE = """CASE
    WHEN fc = 'Unknown' AND tc = 'CEX' THEN 'CEX_DEPOSIT'
    WHEN fc = 'CEX' AND tc = 'Unknown' THEN 'CEX_WITHDRAWAL'
    WHEN fc = 'DEX' OR tc = 'DEX' THEN 'DEX_TRADE'
    WHEN fc = 'Bridge' OR tc = 'Bridge' THEN 'BRIDGE_MOVE'
    WHEN fc = 'Unknown' AND tc = 'Unknown' THEN 'PRIVATE_MOVE'
    ELSE 'OTHER' END"""

# whale transactions of value >= 20 among successful events
WHALES = f"""{TX}, {LABELS}, big AS (SELECT * FROM tx WHERE c >= 2000 AND event_type <> 'error'),
named AS (
  SELECT b.*, coalesce(x.name, 'Unknown') AS fl, coalesce(x.category, 'Unknown') AS fc,
         coalesce(y.name, 'Unknown') AS tl, coalesce(y.category, 'Unknown') AS tc,
         sum(c) OVER ws AS sent_c, count(hash) OVER ws AS sent_n, sum(c) OVER wr AS recv_c
  FROM big b LEFT JOIN lab x ON b.f = x.address LEFT JOIN lab y ON b.t = y.address
  WINDOW ws AS (PARTITION BY f, dt ORDER BY s, hash ROWS UNBOUNDED PRECEDING),
         wr AS (PARTITION BY t, dt ORDER BY s, hash ROWS UNBOUNDED PRECEDING)),
whales AS (
  SELECT *, trim(regexp_extract(fl, '^([^0-9:#]+)', 1)) AS fe, trim(regexp_extract(tl, '^([^0-9:#]+)', 1)) AS te,
         {FLOW_CASE} AS flow_type, sent_n >= 3 AND sent_c >= 5000 AS hf
  FROM named)"""

# hourly token flow of events, the receiver being the token as well
EVENT_FLOW = f"""{TX}, {LABELS}, flow AS (
  SELECT tx.*, 't' || t AS token, 'T' || t AS symbol, 'token ' || t AS token_name, c / 100.0 AS amount,
         coalesce(x.name, 'Unknown') AS fl, coalesce(x.category, 'Unknown') AS fc,
         coalesce(y.name, 'Unknown') AS tl, coalesce(y.category, 'Unknown') AS tc
  FROM tx LEFT JOIN lab x ON tx.f = x.address LEFT JOIN lab y ON tx.t = y.address)"""

# token flow of lineitem: supplier to customer
LINE_FLOW = f"""{LABELS}, blk AS (
  SELECT CAST(floor(epoch(o_orderdate) / 86400) AS BIGINT) AS number, min(CAST(epoch(o_orderdate) AS BIGINT)) AS s
  FROM orders GROUP BY 1),
lines AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS hash,
         CAST(l_orderkey AS VARCHAR) AS order_hash, CAST(l_partkey AS VARCHAR) AS token,
         p_brand AS symbol, p_name AS token_name, CAST(l_suppkey AS VARCHAR) AS f, CAST(o_custkey AS VARCHAR) AS t,
         l_quantity AS amount, CAST(floor(epoch(l_shipdate) / 86400) AS BIGINT) AS block_number
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
flow AS (
  SELECT lines.*, blk.s, CAST((blk.s % 86400) // 3600 AS BIGINT) AS hour,
         DATE '1970-01-01' + CAST(blk.s // 86400 AS INTEGER) AS dt,
         coalesce(x.name, 'Unknown') AS fl, coalesce(x.category, 'Unknown') AS fc,
         coalesce(y.name, 'Unknown') AS tl, coalesce(y.category, 'Unknown') AS tc
  FROM lines LEFT JOIN blk ON lines.block_number = blk.number
  LEFT JOIN lab x ON lines.f = x.address LEFT JOIN lab y ON lines.t = y.address)"""

RECEIPTS = """rec AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS hash,
         CASE WHEN sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) > 1 THEN 0 ELSE 1 END AS status,
         CAST(sum(l_quantity) AS BIGINT) * 1000 AS gas_used,
         CAST(max(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) * 1000 AS price
  FROM lineitem GROUP BY l_orderkey)"""

ENRICHED = f"""{RECEIPTS}, ord AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS hash, CAST(floor(epoch(o_orderdate) / 86400) AS BIGINT) AS block_number,
         CAST(epoch(o_orderdate) AS BIGINT) AS block_timestamp, CAST(o_custkey AS VARCHAR) AS from_address,
         CASE o_orderpriority WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN '' ELSE CAST(o_custkey + 1 AS VARCHAR) END AS to_address,
         CAST(round(o_totalprice * 100) AS BIGINT) / 100.0 AS value_eth,
         CASE o_orderstatus WHEN 'O' THEN '0x' WHEN 'F' THEN '0xa9059cbb' END AS input,
         CASE WHEN o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') THEN 'eip1559' ELSE 'legacy' END AS tx_type,
         CAST(o_orderdate AS DATE) AS dt
  FROM orders),
enriched AS (
  SELECT ord.hash, block_number, block_timestamp, from_address, to_address, value_eth,
         CAST(gas_used AS DOUBLE) * price / 1e18 AS tx_fee_eth, status = 1 AS is_success,
         (coalesce(to_address, '') <> '' AND input <> '0x') AS is_contract_call,
         coalesce(to_address, '') = '' AS is_contract_deploy, tx_type, dt
  FROM ord LEFT JOIN rec ON ord.hash = rec.hash)"""


def steps(column: str, limits: tuple, names: tuple, rest: str) -> str:
    cases = " ".join(f"WHEN {column} >= {limit} THEN '{name}'" for limit, name in zip(limits, names))
    return f"CASE {cases} ELSE '{rest}' END"
