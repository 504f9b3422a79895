"""Sources and sinks, exercised through the cluster's shared folder."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens import schemas
from transferlens.plans import quality
from transferlens.plans.day import DayConfig, run_day
from transferlens.session import work_folder
from transferlens.sources import compaction, files, folders, sinks
from transferlens.streaming import alerts as alert_ops
from transferlens.workload import frames, sql
from transferlens.workload.catalog import query
from transferlens.workload.frames import table

_PER_DAY = f"""WITH {sql.TX} SELECT CAST(dt AS VARCHAR) AS dt, CAST(count(*) AS BIGINT) AS n, sum(c) / 100.0 AS total
FROM tx {{where}} GROUP BY 1"""


def _days(spark, d):
    return frames.event_enriched(table(spark, d, "events")).select("hash", "from_address", "block_timestamp", "value_eth", "dt")


def _totals(df):
    return df.groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value_eth").cast("double").alias("total")
    )


@query(_PER_DAY.format(where=""))
def replace_days(spark, d):
    """All days written, one rewritten twice: the table is unchanged by the rewrites."""
    root = work_folder(spark, "replace-days")
    rows = _days(spark, d)
    sinks.write_days(rows, root)
    for _ in range(2):
        sinks.write_days(rows.where(F.col("dt") == F.lit("2024-01-05").cast("date")), root)
    return _totals(files.read_days(spark, root, rows.schema))


@query(_PER_DAY.format(where="WHERE dt BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'"))
def read_day_range(spark, d):
    root = work_folder(spark, "day-range")
    rows = _days(spark, d)
    sinks.write_days(rows, root)
    return _totals(files.read_days(spark, root, rows.schema, "dt=2024-01-10", "2024-01-19"))


@query(f"SELECT *, true AS clustered FROM ({_PER_DAY.format(where='')})")
def clustered_layout(spark, d):
    """Day totals, and whether the address ranges of a day's files meet at their ends only."""
    root = work_folder(spark, "clustered")
    rows = _days(spark, d)
    sinks.write_clustered(rows, root, "from_address", "block_timestamp", files=96)
    back = files.read_days(spark, root, rows.schema)
    per_file = back.groupBy("dt", F.col("_metadata.file_path").alias("file")).agg(
        F.min("from_address").alias("low"), F.max("from_address").alias("high")
    )
    before = F.lag("high").over(Window.partitionBy("dt").orderBy("low", "high"))
    meets = per_file.withColumn("meets", F.coalesce(F.col("low") >= before, F.lit(True)))
    per_day = meets.groupBy(F.col("dt").cast("string").alias("dt")).agg(F.every("meets").alias("clustered"))
    return _totals(back).join(per_day, "dt")


@query("""SELECT CAST(2 * sum(strlen(props) + 1) AS BIGINT) AS bytes_before, CAST(sum(strlen(props) + 1) AS BIGINT) AS bytes_after,
  CASE WHEN count(*) > 0 THEN 50.0::DOUBLE END AS saved_pct FROM events""")
def storage_saved(spark, d):
    """Bytes of the events' texts stored twice and, after dropping the copies, once."""
    before, after = work_folder(spark, "before"), work_folder(spark, "after")
    lines = table(spark, d, "events").select("props")
    lines.union(lines).write.text(before)
    lines.write.text(after)
    return sinks.saved_bytes(spark, before, after)


@query(_PER_DAY.format(where="WHERE dt >= DATE '2024-01-16'"))
def retention_days(spark, d):
    """Day folders older than half a year go; the others stay as they are."""
    root = work_folder(spark, "expiry")
    rows = _days(spark, d)
    sinks.write_days(rows, root)
    sinks.drop_expired(spark, root, date(2024, 7, 16), 6)
    return _totals(files.read_days(spark, root, rows.schema))


@query(f"""SELECT p.*, dt < '2024-01-24' AS compacted, dt < '2024-01-24' AS clustered FROM ({_PER_DAY.format(where='')}) p""")
def compacted_days(spark, d):
    """Aged days become few sorted files, young ones stay.

    The table has young days, aged ones, two that an earlier run compacted, one that got rows after that, and one whose swap was broken
    off after its old folder went aside. The last run is made twice.
    """
    root = work_folder(spark, "compaction")
    rows = _days(spark, d)
    late = (F.col("dt") == F.lit("2024-01-03").cast("date")) & (F.col("event_type") == "view")
    typed = rows.join(table(spark, d, "events").select(F.col("event_id").cast("string").alias("hash"), "event_type"), "hash")
    sinks.write_days(typed.where(~late).drop("event_type").repartition(8), root)
    how = {"schema": rows.schema, "segment_by": "from_address", "order_by": "block_timestamp"}
    compaction.compact(spark, root, as_of=date(2024, 1, 11), **how)
    typed.where(late).drop("event_type").write.partitionBy("dt").mode("append").parquet(root)
    broken = [day for day in compaction.aged_days(spark, root, date(2024, 1, 14)) if day != "dt=2024-01-03"][-1:]
    if broken:
        compaction.rewrite(spark, root, broken, rows.schema, "from_address", "block_timestamp")
        compaction.set_aside(spark, root, broken[0])
    for _ in range(2):
        compaction.compact(spark, root, as_of=date(2024, 1, 31), **how)
    days = [day for day in folders.children(spark, root) if day.startswith("dt=")]
    done = spark.createDataFrame([(day[3:], compaction.is_compacted(spark, root, day)) for day in days], "dt string, compacted boolean")
    back = files.read_days(spark, root, rows.schema)
    per_file = back.groupBy("dt", F.col("_metadata.file_path").alias("file")).agg(F.min("from_address").alias("low"), F.max("from_address").alias("high"))
    before = F.lag("high").over(Window.partitionBy("dt").orderBy("low", "high"))
    meets = per_file.withColumn("meets", F.coalesce(F.col("low") >= before, F.lit(True)))
    sorted_ = meets.groupBy(F.col("dt").cast("string").alias("dt")).agg(F.every("meets").alias("meets"))
    out = _totals(back).join(done, "dt").join(sorted_, "dt")
    return out.select("dt", "n", "total", "compacted", (F.col("compacted") & F.col("meets")).alias("clustered"))


@query("""SELECT 'orc' AS fmt, o_orderpriority AS priority, o_orderstatus AS status, CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 2, 3
UNION ALL SELECT 'json', o_orderpriority, o_orderstatus, CAST(count(*) AS BIGINT), CAST(sum(o_orderkey) AS BIGINT) FROM orders GROUP BY 2, 3""")
def warehouse_append(spark, d):
    """Orders appended in two batches to stores of two formats, partitioned by priority and status; each batch is loaded twice, its
    first load of other rows than the second: the store holds the second loads, once."""
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    open_, closed = orders.where(F.col("status") == "O"), orders.where(F.col("status") != "O")
    out = []
    for fmt in ("orc", "json"):
        root = work_folder(spark, f"warehouse-{fmt}")
        for batch, rows, wrong in (("open", open_, closed), ("closed", closed, open_)):
            for load in (wrong, rows, rows):
                sinks.append_once(load, root, batch, fmt, ["priority", "status"])
        back = spark.read.schema("o_orderkey long, priority string, status string, load_batch string").format(fmt).load(root)
        counts = back.groupBy(F.lit(fmt).alias("fmt"), "priority", "status")
        out.append(counts.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys")))
    return out[0].unionByName(out[1])


_SPAN = "BETWEEN DATE '1995-01-01' AND DATE '1995-03-31'"


@query(f"""WITH o AS (SELECT *, CAST(o_orderdate AS DATE) AS dt FROM orders WHERE CAST(o_orderdate AS DATE) {_SPAN}),
l AS (SELECT CAST(o_orderdate AS DATE) AS dt FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(o_orderdate AS DATE) {_SPAN})
SELECT entity, CAST(dt AS VARCHAR) AS dt, CAST(count(*) AS BIGINT) AS n, CAST(count(k) AS BIGINT) AS keys FROM (
  SELECT DISTINCT 'blocks' AS entity, dt, '' AS k FROM o UNION ALL SELECT 'logs', dt, '' FROM l UNION ALL SELECT 'token_transfers', dt, '' FROM l
  UNION ALL SELECT 'contracts', dt, '' FROM o WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') UNION ALL SELECT 'transactions', dt, '' FROM o
  UNION ALL SELECT 'receipts', dt, '' FROM o) GROUP BY 1, 2""")
def backfill_entities(spark, d):
    """All six exports of a span of days in one job, written twice and read back by schema."""
    orders, lines, part = table(spark, d, "orders"), table(spark, d, "lineitem"), table(spark, d, "part")
    wide = frames.order_transactions(orders)
    named = wide.columns
    missing = [f for f in schemas.TRANSACTIONS if f.name not in named]
    wide = wide.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    wide = wide.withColumns({c: F.lit(None).cast("string") for c in sinks.RECEIPT_COLUMNS if c not in wide.columns})
    moved = frames.line_transfers(lines, orders, part).withColumnRenamed("order_timestamp", "block_timestamp")
    deployed = wide.where(F.coalesce("to_address", F.lit("")) == "")
    tables = {
        "blocks": frames.order_blocks(orders),
        "transactions": wide.withColumn("receipt_status", F.lit(1)),
        "token_transfers": moved.drop("order_hash"),
        "logs": moved.select("transaction_hash", F.col("token_address").alias("address"), "block_number", "block_timestamp"),
        "contracts": deployed.select(F.col("hash").alias("address"), "block_number", "block_timestamp"),
    }
    root = work_folder(spark, "backfill")
    for _ in range(2):
        sinks.backfill_all(tables, root, "1995-01-01", "1995-03-31")
    key = {"blocks": "number", "logs": "address", "contracts": "address", "transactions": "hash"}
    counts = []
    for name in sinks.EXPORTS:
        schema = T.StructType([*schemas.BRONZE[name].fields, T.StructField("dt", T.DateType())])
        back = spark.read.schema(schema).json(f"{root}/{name}")
        per_day = back.groupBy(F.lit(name).alias("entity"), F.col("dt").cast("string").alias("dt"))
        counts.append(per_day.agg(F.count(F.lit(1)).alias("n"), F.count(key.get(name, "transaction_hash")).alias("keys")))
    return reduce(DataFrame.unionByName, counts)


@query(f"WITH {sql.TX} SELECT hash, f AS from_address, t AS to_address, s AS block_timestamp, CAST(c AS VARCHAR) || '0000000000000000' AS value, c * 100000000 AS gas_price FROM tx")
def json_scan(spark, d):
    """Transactions written as JSON with quoted integers and read back typed."""
    root = work_folder(spark, "json")
    rows = frames.event_transactions(table(spark, d, "events")).drop("event_type", "amount")
    rows.withColumns({c: F.col(c).cast("string") for c in ("block_timestamp", "gas_price")}).write.json(root)
    back = files.read_json(spark, root, schemas.TRANSACTIONS)
    return back.select("hash", "from_address", "to_address", "block_timestamp", "value", "gas_price")


@query("""SELECT CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS kind, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1""")
def json_quarantine(spark, d):
    """Lines that do not parse go to a second output; none is lost."""
    root = work_folder(spark, "json-lines")
    rows = frames.event_transactions(table(spark, d, "events"))
    # times of one kind are quoted integers, which is no reason to refuse a line
    quoted = F.to_json(F.struct("hash", F.col("block_timestamp").cast("string").alias("block_timestamp"), "value"))
    line = F.when(F.col("event_type") == "view", quoted).otherwise(F.to_json(F.struct("hash", "block_timestamp", "value")))
    rows.select(F.when(F.col("event_type") == "error", F.concat(line, F.lit("}{"))).otherwise(line).alias("value")).select(
        F.when(F.col("value").endswith("}{"), F.substring_index("value", "}", 1)).otherwise(F.col("value")).alias("value")
    ).write.text(root)
    good, bad = files.read_json_split(spark, root, schemas.TRANSACTIONS)
    kinds = good.select(F.lit("good").alias("kind")).unionByName(bad.select(F.lit("bad").alias("kind")))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {sql.TX} SELECT CASE WHEN event_type <> 'error' THEN hash END AS hash, CASE WHEN event_type <> 'error' THEN c / 100.0 END AS value_eth FROM tx""")
def alert_decode(spark, d):
    """Alert messages, with and without the derived amount; broken ones give null rows."""
    rows = frames.event_transactions(table(spark, d, "events"))
    full = F.to_json(F.struct("hash", "value", (F.col("value").cast("double") / 1e18).alias("value_eth")))
    short = F.to_json(F.struct("hash", "value"))
    kind = F.col("event_type")
    message = F.when(kind == "error", "invalid json").when(kind == "view", full).otherwise(short)
    return alert_ops.decode(rows.select(message.alias("value"))).select("hash", F.round("value_eth", 6).alias("value_eth"))


@query(f"""WITH {sql.TX}, whales AS (SELECT * FROM tx WHERE value >= 100 AND c >= 10000 AND event_type <> 'error')
SELECT 'txn_enriched' AS name, CAST(count(*) AS BIGINT) AS n FROM tx UNION ALL SELECT 'whale_txns', CAST(count(*) AS BIGINT) FROM whales
UNION ALL SELECT 'token_flow', CAST(count(*) AS BIGINT) FROM tx
UNION ALL SELECT 'top_whales_daily', CAST(count(*) AS BIGINT) FROM (SELECT f FROM whales UNION SELECT t FROM whales) WHERE f IS NOT NULL
UNION ALL SELECT 'token_popularity_daily', CAST(count(DISTINCT event_type) AS BIGINT) FROM tx
UNION ALL SELECT 'check txn_enriched', 4 UNION ALL SELECT 'check token_flow', 5 UNION ALL SELECT 'check whale_txns', 4""".replace(
    "c, event_type, ts", "c, event_type, ts, value"
))
def day_run(spark, d):
    """The daily run over all events as one day's raw JSON: rows of the tables it wrote, rules its checks evaluated."""
    root, results = _run_day(spark, d)
    rules = results.groupBy(F.concat(F.lit("check "), "table").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    written = [f"silver/{n}" for n in schemas.SILVER] + ["gold/top_whales_daily", "gold/token_popularity_daily"]
    counts = [
        spark.read.parquet(f"{root}/{path}").agg(F.lit(path.split("/")[1]).alias("name"), F.count(F.lit(1)).alias("n"))
        for path in written
    ]
    return reduce(DataFrame.unionByName, [*counts, rules])


@query(f"""WITH {sql.TX}, m AS (SELECT count(*) AS n, count(DISTINCT event_type) AS tokens, avg(CASE WHEN value >= 100 THEN CAST(event_type <> 'error' AS INT) END) AS ok,
  avg(CASE WHEN value >= 100 THEN 21000 * c / 1e10 END) AS fee, count(*) FILTER (value >= 100 AND c >= 10000 AND event_type <> 'error') AS whales FROM tx)
SELECT "table", rule, round(value, 6) AS value, passed FROM (
  SELECT 'txn_enriched' AS "table", 'retention' AS rule, 1.0::DOUBLE AS value, true AS passed FROM m
  UNION ALL SELECT 'txn_enriched', 'success_rate', ok, ok >= 0.8 FROM m UNION ALL SELECT 'txn_enriched', 'tx_count', n, n >= 1000 FROM m
  UNION ALL SELECT 'txn_enriched', 'avg_fee_eth', fee, fee <= 1 FROM m UNION ALL SELECT 'token_flow', 'retention', 1, true FROM m
  UNION ALL SELECT 'token_flow', 'row_count', n, n >= 10 FROM m UNION ALL SELECT 'token_flow', 'active_tokens', tokens, tokens >= 1 FROM m
  UNION ALL SELECT 'token_flow', 'unfiltered_retention', 1, true FROM m UNION ALL SELECT 'whale_txns', 'row_count', whales, whales >= 1 FROM m
  UNION ALL SELECT 'whale_txns', 'null_rows', 0, true FROM m UNION ALL SELECT 'whale_txns', 'non_positive_rows', 0, true FROM m
  UNION ALL SELECT 'raised', CASE WHEN ok >= 0.8 THEN 'nothing' ELSE 'txn_enriched: success_rate = ' || round(ok, 6) || ' (limit 0.8)' END, 0, ok >= 0.8 FROM m)""".replace("c, event_type, ts", "c, event_type, ts, value"))
def day_checks(spark, d):
    """The check values of the daily run, whose source counts are observed while it writes; the gate is enforced and its message returned."""
    _, results = _run_day(spark, d)
    try:
        quality.enforce(results)
        message = "nothing"
    except quality.QualityError as error:
        message = str(error)
    told = spark.createDataFrame([("raised", message, 0.0, message == "nothing")], '`table` string, rule string, value double, passed boolean')
    kept = results.where(~F.col("rule").isin("wash_ratio", "flag_rate")).select("table", "rule", "value", "passed")
    return kept.unionByName(told)


def _run_day(spark, d):
    root, day = work_folder(spark, "day"), "2024-01-31"
    events = table(spark, d, "events")
    transactions = frames.event_transactions(events)
    blocks = transactions.groupBy(F.col("block_number").alias("number")).agg(
        F.min("block_timestamp").alias("timestamp"), F.count(F.lit(1)).alias("transaction_count")
    )
    raw = {
        "transactions": transactions.drop("event_type", "amount"),
        "receipts": frames.event_receipts(events),
        "blocks": blocks,
        "token_transfers": frames.event_transfers(events).drop("block_timestamp"),
    }
    for name, rows in raw.items():
        rows.write.json(f"{root}/bronze/{name}/dt={day}")
    frames.labels(table(spark, d, "customer")).toDF("address", "name", "category").write.parquet(f"{root}/labels")
    frames.event_tokens(events).toDF("address", "symbol", "name", "decimals").write.parquet(f"{root}/tokens")
    config = DayConfig(f"{root}/bronze", f"{root}/silver", f"{root}/gold", f"{root}/labels", f"{root}/tokens", enforce=False)
    return root, run_day(spark, day, config)
