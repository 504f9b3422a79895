"""Dimension builds, extract selections, keyed merges."""

from __future__ import annotations

from pyspark.sql import functions as F

from transferlens.operators.labels import latest_per_key
from transferlens.operators.upsert import insert_ignore, upsert
from transferlens.plans import dimension_build, extract
from transferlens.session import work_folder
from transferlens.sources.dimensions import clean_tokens, load_version, read_label_csv, read_token_csv
from transferlens.sources.sinks import project_days
from transferlens.workload import frames, sql
from transferlens.workload.catalog import query
from transferlens.workload.frames import table

# tags of the given customers: a noise tag first, then one that depends on the segment
_TAGS = {"BUILDING": "binance", "AUTOMOBILE": "uniswap", "MACHINERY": "hop-protocol", "FURNITURE": "heist"}


def _raw_labels(spark, d):
    customer = table(spark, d, "customer")
    segment = F.col("c_mktsegment")
    tag = F.coalesce(*[F.when(segment == s, t) for s, t in _TAGS.items()], F.lit("donate"))
    hexed = F.lower(F.hex("c_custkey"))
    address = F.concat(F.lit("0x"), F.lpad(hexed, 40, "0"))
    return customer.select(
        F.when(segment == "MACHINERY", F.upper(F.substring(address, 3, 40))).otherwise(address).alias("address"),
        F.col("c_name").alias("name"),
        F.array(F.lit("old-contract"), tag, F.lit("lido")).alias("labels"),
        (segment != "HOUSEHOLD").alias("tagged"),
    ).select("address", "name", F.when(F.col("tagged"), F.col("labels")).otherwise(F.slice("labels", 1, 2)).alias("labels"))


_BUILT = """built AS (
  SELECT '0x' || lpad(lower(to_hex(c_custkey)), 40, '0') AS address, c_name AS name,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'CEX' WHEN 'AUTOMOBILE' THEN 'DEX' WHEN 'FURNITURE' THEN 'Sanctioned' END AS category
  FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'FURNITURE'))"""


@query(f"WITH {_BUILT} SELECT address, name, category FROM built")
def label_build(spark, d):
    return dimension_build.build_labels(_raw_labels(spark, d))


@query(f"WITH {_BUILT} SELECT category, CAST(count(*) AS BIGINT) AS addresses FROM built GROUP BY 1")
def label_category_counts(spark, d):
    return dimension_build.category_counts(dimension_build.build_labels(_raw_labels(spark, d)))


def _coins(spark, d):
    part = table(spark, d, "part")
    coin = F.concat(F.lit("coin-"), F.col("p_partkey").cast("string"))
    platforms = part.select(
        coin.alias("id"),
        F.when(
            F.col("p_type") != "SMALL",
            F.create_map(F.lit("ethereum"), F.concat(F.lit(" 0x"), F.upper(F.col("p_name")))),
        ).otherwise(F.create_map(F.lit("solana"), F.lit("0xnone"))).alias("platforms"),
    )
    markets = part.select(
        coin.alias("coin_id"),
        F.col("p_brand").alias("symbol"),
        F.col("p_name").alias("name"),
        (F.col("p_retailprice") * 10).cast("bigint").alias("market_cap"),
        F.col("p_partkey").alias("market_rank"),
        F.col("p_size").alias("decimals"),
    )
    return markets, dimension_build.coin_addresses(platforms)


@query("""WITH coins AS (
  SELECT 'coin-' || p_partkey AS coin_id, p_brand, p_name, CAST(floor(p_retailprice * 10) AS BIGINT) AS cap, p_partkey, p_size,
         '0x' || lower(p_name) AS address, CASE WHEN p_name = 'red widget' THEN 0 ELSE 1 END AS late
  FROM part WHERE p_type <> 'SMALL'),
best AS (SELECT *, row_number() OVER (PARTITION BY address ORDER BY CASE WHEN coin_id = 'coin-1' THEN 0 ELSE 1 END, cap DESC, coin_id) AS k FROM coins),
chosen AS (SELECT * FROM best WHERE k = 1 ORDER BY CASE WHEN coin_id = 'coin-1' THEN 0 ELSE 1 END, cap DESC, coin_id, address LIMIT 40)
SELECT CAST(row_number() OVER (ORDER BY cap DESC, coin_id, address) AS BIGINT) AS rank, p_partkey AS market_rank, p_name AS name,
       upper(p_brand) AS symbol, address, CAST(p_size AS BIGINT) AS decimals, cap AS market_cap_usd FROM chosen""")
def token_build(spark, d):
    markets, addresses = _coins(spark, d)
    return dimension_build.build_tokens(markets, addresses, mandatory=("coin-1",), cap=40)


@query("""SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt, min(o_orderkey) AS start_block, max(o_orderkey) AS end_block,
  CAST(count(*) AS BIGINT) AS blocks FROM orders GROUP BY 1""")
def block_range(spark, d):
    orders = table(spark, d, "orders")
    from transferlens.functions import timeparts

    return extract.block_range(orders.select(F.col("o_orderkey").alias("number"), timeparts.to_unix("o_orderdate").alias("timestamp")))


@query("SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS token_address FROM lineitem")
def contract_list(spark, d):
    lineitem, orders, part = (table(spark, d, n) for n in ("lineitem", "orders", "part"))
    return extract.contract_addresses(frames.line_transfers(lineitem, orders, part))


@query(f"WITH {sql.TX} SELECT hash FROM tx WHERE c >= 10000")
def whale_hashes(spark, d):
    return extract.whale_hashes(frames.event_transactions(table(spark, d, "events")), 100)


@query("""SELECT address, any_value(symbol) AS symbol, any_value(name) AS name, any_value(decimals) AS decimals FROM (
  SELECT lower(p_name) AS address, arg_max(p_brand, p_partkey) AS symbol, arg_max(p_name, p_partkey) AS name,
         arg_max(CASE WHEN p_size > 25 THEN 18 ELSE CAST(p_size AS BIGINT) END, p_partkey) AS decimals FROM part GROUP BY 1
  UNION ALL SELECT c_name, 'OLD', c_name, CAST(0 AS BIGINT) FROM customer) GROUP BY address""")
def token_upsert(spark, d):
    """New token rows over an old table of customer names and stale copies of the part names."""
    part = table(spark, d, "part")
    raw = part.select(
        F.upper("p_name").alias("address"),
        F.col("p_brand").alias("symbol"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") > 25, "n/a").otherwise(F.col("p_size").cast("string")).alias("decimals"),
        F.col("p_partkey").alias("load_order"),
    )
    old_names = table(spark, d, "customer").select(F.col("c_name").alias("address"), F.col("c_name").alias("name"))
    stale = part.select("p_name").distinct().select(F.col("p_name").alias("address"), F.lit("stale").alias("name"))
    old = old_names.unionByName(stale).select("address", F.lit("OLD").alias("symbol"), "name", F.lit(0).alias("decimals"))
    return upsert(old, clean_tokens(raw), ["address"], "load_order")


@query("""SELECT 'tokens' AS kind, lower(c_name) AS address, CASE WHEN c_custkey % 3 = 0 THEN 'NEW' ELSE 'T' || c_nationkey END AS name,
  CAST(CASE WHEN c_custkey % 3 = 0 THEN 18 ELSE c_nationkey END AS BIGINT) AS decimals FROM customer
UNION ALL SELECT 'labels', 'fixed', 'Burn', NULL UNION ALL SELECT 'early', NULL, NULL, 0""")
def dimension_load(spark, d):
    """Tokens from CSV files: a first load, one over it that changes a third of the rows and has no decimals, one without a file. Labels:
    their file is missing from the start, so the fixed rows hold. The version before the first load has no rows."""
    root, customer = work_folder(spark, "dimension"), table(spark, d, "customer")
    schema = "address string, symbol string, name string, decimals int"
    shape = spark.createDataFrame([], schema).schema
    first = customer.select(F.col("c_name").alias("address"), F.lit("S").alias("symbol"), F.concat(F.lit("T"), "c_nationkey").alias("name"), F.col("c_nationkey").alias("decimals"))
    second = customer.where(F.col("c_custkey") % 3 == 0).select(F.upper("c_name").alias("address"), F.lit("S").alias("symbol"), F.lit("NEW").alias("name"), F.lit("n/a").alias("decimals"))
    early = load_version(spark, f"{root}/tokens", f"{root}/none.csv", read_token_csv, shape)
    for name, rows in (("one", first), ("two", second), ("three", None)):
        if rows is not None:
            rows.write.option("header", True).csv(f"{root}/{name}")
        tokens = load_version(spark, f"{root}/tokens", f"{root}/{name}", read_token_csv, shape)
    fixed = spark.createDataFrame([("fixed", "Burn", "Burn")], "address string, name string, category string")
    labels = load_version(spark, f"{root}/labels", f"{root}/none", read_label_csv, fixed.schema, fixed=fixed)
    told = tokens.select(F.lit("tokens").alias("kind"), "address", "name", "decimals")
    named = labels.select(F.lit("labels").alias("kind"), "address", "name", F.lit(None).cast("int").alias("decimals"))
    counted = early.agg(F.count(F.lit(1)).cast("int").alias("decimals"))
    nothing = F.lit(None).cast("string")
    return told.unionByName(named).unionByName(counted.select(F.lit("early").alias("kind"), nothing.alias("address"), nothing.alias("name"), "decimals"))


@query("SELECT CAST(event_id AS VARCHAR) AS hash FROM events WHERE event_type NOT IN ('view', 'click')")
def insert_if_absent(spark, d):
    rows = frames.event_transactions(table(spark, d, "events"))
    stored = rows.where(F.col("event_type").isin("view", "click")).select("hash", "block_timestamp")
    twice = rows.select("hash", "block_timestamp").unionByName(rows.select("hash", "block_timestamp"))
    return insert_ignore(stored, twice, ["hash", "block_timestamp"]).select("hash")


@query("""SELECT address, CASE WHEN k < 50 THEN 'file' ELSE 'fixed' END AS source, name FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS address, 0 AS k, c_name AS name FROM customer
  UNION ALL SELECT DISTINCT 'x' || p_size, 99, 'Size ' || p_size FROM part)""")
def label_merge(spark, d):
    """Two label sets with overlapping addresses; the first set wins."""
    first = frames.raw_labels(table(spark, d, "customer")).select("address", F.lit("file").alias("source"), F.col("label_name").alias("name"))
    size = F.col("p_size").cast("string")
    second = table(spark, d, "part").select(F.concat(F.lit("x"), size).alias("address"), F.concat(F.lit("Size "), size).alias("name")).distinct()
    clash = first.select("address", F.lit("clash").alias("name"))
    second = second.unionByName(clash).select("address", F.lit("fixed").alias("source"), "name")
    both = first.withColumn("at", F.lit(1)).unionByName(second.withColumn("at", F.lit(0)))
    return latest_per_key(both, ["address"], ["at"]).drop("at")


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS transaction_hash, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS block_date,
  strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-12-31'""")
def backfill_projection(spark, d):
    orders = table(spark, d, "orders")
    rows = project_days(orders, "o_orderdate", "1995-01-01", "1996-12-31", {"o_orderkey": "transaction_hash", "o_orderstatus": "status"})
    return rows.withColumn("transaction_hash", F.col("transaction_hash").cast("string"))
