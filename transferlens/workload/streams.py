"""Streaming queries: each reads its messages from a topic that is filled part by part, and its result is read back.

The given table is cut by time into ``PARTS`` parts. A part is sent, the job runs over what is new and stops; the next run goes
on from the checkpoint. So every query sees several micro-batches and restarts, and returns what a single batch would.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transferlens.session import stored, work_folder
from transferlens.sources.folders import children, system_of
from transferlens.streaming import alerts as alert_ops
from transferlens.streaming import jobs, messages, views
from transferlens.workload import frames, sql
from transferlens.workload.catalog import query
from transferlens.workload.frames import table

PARTS = 3
#: Unix time of the message that ends a bounded replay: the watermark passes all earlier windows. Its own stay open.
END = "4102444800"


#: When the first part of a dated topic arrives, and a day, in milliseconds.
FIRST_DAY_MS, DAY_MS = 1_767_225_600_000, 86_400_000


class _Topic:
    def __init__(self, spark: SparkSession, name: str, limit: int | None = None) -> None:
        self.spark, self.path, self.limit, self.dated = spark, work_folder(spark, f"{name}-topic"), limit, set()

    def send(self, *rows: DataFrame, arrived_ms: int | None = None) -> None:
        """``arrived_ms`` is the time at which these messages count as arrived; else it is now."""
        for part in rows:
            part.select("value").write.mode("append").text(self.path)
        if arrived_ms is not None:
            system, folder = system_of(self.spark, self.path)
            for file in system.listStatus(folder):
                if (name := file.getPath().getName()) not in self.dated:
                    self.dated.add(name)
                    system.setTimes(file.getPath(), arrived_ms, -1)

    def end(self, **fields: str) -> None:
        self.send(self.spark.createDataFrame([(fields,)], "m map<string,string>").select(F.to_json("m").alias("value")))

    def read(self, kind: str) -> DataFrame:
        return messages.decode(messages.read_topic(self.spark, "text", limit=self.limit, path=self.path), kind)


def _cuts(rows: DataFrame, time: str) -> list[int]:
    """Microseconds that cut the rows into ``PARTS`` parts of about the same size; none for an empty table."""
    at = [(k + 1) / PARTS for k in range(PARTS - 1)]
    return rows.agg(F.percentile_approx(F.unix_micros(F.col(time).cast("timestamp")), at)).first()[0] or []


def _even_cuts(rows: DataFrame, time: str) -> tuple[list[int], int]:
    """Microseconds that cut the span of the times into ``PARTS`` equal lengths, and the last time; both can be told in SQL."""
    us = F.unix_micros(F.col(time).cast("timestamp"))
    low, high = rows.agg(F.min(us), F.max(us)).first()
    if low is None:
        return [], 0
    return [low + (high - low) * (k + 1) // PARTS for k in range(PARTS - 1)], high


def _parts(rows: DataFrame, time: str, cuts: list[int] | None = None) -> list[DataFrame]:
    cuts = _cuts(rows, time) if cuts is None else cuts
    part = sum([(F.unix_micros(F.col(time).cast("timestamp")) >= c).cast("int") for c in cuts], F.lit(0))
    return [rows.where(F.coalesce(part, F.lit(0)) == k) for k in range(len(cuts) + 1)]


def _drain(spark: SparkSession, name: str, stream: Callable[[], DataFrame], steps: list[Callable[[], None]]) -> DataFrame:
    """Sends one step after the other and runs the job over each; the rows that all runs appended."""
    out, checkpoint = work_folder(spark, name), work_folder(spark, f"{name}-checkpoint")
    _run(steps, lambda: jobs.start(stream(), checkpoint, path=out))
    return spark.read.schema(stream().schema).parquet(out)


def _run(steps: list[Callable[[], None]], start: Callable[[], StreamingQuery]) -> None:
    for send in steps:
        send()
        start().awaitTermination()


def _once(topic: _Topic, parts: list[DataFrame]) -> list[Callable[[], None]]:
    return [lambda p=p: topic.send(p) for p in parts]


def _repeated(topic: _Topic, parts: list[DataFrame], arrived_ms: Callable[[int], int | None] = lambda k: None) -> list[Callable[[], None]]:
    """Every part is sent twice, and once more with the part after it; ``arrived_ms`` tells when the k-th step arrives."""
    before = [parts[0].limit(0), *parts[:-1]]
    return [lambda p=p, q=q, k=k: topic.send(p, p, q, arrived_ms=arrived_ms(k)) for k, (p, q) in enumerate(zip(parts, before, strict=True))]


def _seconds(time: str) -> Column:
    """Unix seconds as text, with their fraction."""
    return (F.unix_micros(F.col(time).cast("timestamp")) / 1e6).cast("decimal(20,6)").cast("string")


def _message(rows: DataFrame, time_key: str = "block_timestamp") -> DataFrame:
    """Transactions as JSON messages; the time keeps its fraction and goes by ``time_key``."""
    fields = F.struct(
        F.col("event_id").cast("string").alias("hash"),
        _seconds("ts").alias(time_key),
        F.col("user_id").cast("string").alias("from_address"),
        F.get_json_object("props", "$.k").alias("to_address"),
        frames.wei_text("value").alias("value"),
        frames.gas_wei().cast("string").alias("gas_price"),
    )
    return rows.select(F.to_json(fields).alias("value"), "event_type", "ts")


def _event_parts(spark, d, time_key: str = "block_timestamp") -> list[DataFrame]:
    return _parts(_message(table(spark, d, "events"), time_key), "ts")


def _transactions(topic: _Topic) -> DataFrame:
    return messages.accepted(topic.read("transactions")).drop("arrived")


def _without_sender(part: DataFrame) -> DataFrame:
    """Messages of one kind lose their sender."""
    broken = F.regexp_replace("value", '"from_address":"[^"]*",', "")
    return part.withColumn("value", F.when(F.col("event_type") == "signup", broken).otherwise(F.col("value")))


@query(f"WITH {sql.TX} SELECT hash, f AS from_address, t AS to_address, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, CAST(c AS VARCHAR) || '0000000000000000' AS value FROM tx WHERE event_type <> 'signup'")
def stream_validate(spark, d):
    """Messages under different time names; those of one kind lack the sender and are refused."""
    topic = _Topic(spark, "validate")
    parts = [_without_sender(p) for p in _event_parts(spark, d, "item_timestamp")]
    rows = _drain(spark, "validate", lambda: _transactions(topic), _once(topic, parts))
    return rows.select("hash", "from_address", "to_address", "event_time", "value")


@query("SELECT 'from_address' AS problems, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'signup'")
def stream_quarantine(spark, d):
    topic = _Topic(spark, "quarantine")
    parts = [_without_sender(p) for p in _event_parts(spark, d)]
    refused = _drain(spark, "quarantine", lambda: messages.quarantined(topic.read("transactions")), _once(topic, parts))
    return refused.groupBy(F.array_join("problems", ",").alias("problems")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CAST(event_id AS VARCHAR) AS hash FROM events")
def stream_dedup(spark, d):
    """Copies in the same micro-batch, in the next one and behind the watermark: one row comes out."""
    topic = _Topic(spark, "dedup")
    steps = _repeated(topic, _event_parts(spark, d))
    return _drain(spark, "dedup", lambda: jobs.deduplicated(_transactions(topic), ["hash", "event_time"]), steps).select("hash")


_BOUND = 30


@query(f"""WITH blocks AS (SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus <> 'P')
SELECT CAST(l_orderkey AS VARCHAR) AS transaction_hash, CAST(l_linenumber AS BIGINT) AS log_index, CAST(l_partkey AS VARCHAR) AS token_address,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS event_time
FROM lineitem LEFT JOIN blocks ON l_orderkey = o_orderkey AND o_orderdate BETWEEN l_shipdate - INTERVAL {_BOUND} DAY AND l_shipdate + INTERVAL {_BOUND} DAY""")
def stream_block_time(spark, d):
    """Lines wait for their order's time, blocks come several times; lines that get no time come out without, all of them."""
    lines, blocks = _Topic(spark, "lines"), _Topic(spark, "blocks")
    line = F.struct(
        F.col("l_orderkey").cast("string").alias("transaction_hash"),
        F.col("l_linenumber").cast("string").alias("log_index"),
        _seconds("l_shipdate").alias("timestamp"),
        F.col("l_orderkey").cast("string").alias("block_number"),
        F.col("l_partkey").cast("string").alias("token_address"),
        F.col("l_suppkey").cast("string").alias("from_address"),
        F.col("l_partkey").cast("string").alias("to_address"),
        F.col("l_quantity").cast("bigint").cast("string").alias("value"),
    )
    block = F.struct(F.col("o_orderkey").cast("string").alias("number"), _seconds("o_orderdate").alias("timestamp"))
    items, orders = table(spark, d, "lineitem"), table(spark, d, "orders").where(F.col("o_orderstatus") != "P")
    cuts = _cuts(items, "l_shipdate")
    sent = _once(lines, _parts(items.select(F.to_json(line).alias("value"), "l_shipdate"), "l_shipdate", cuts))
    known = _repeated(blocks, _parts(orders.select(F.to_json(block).alias("value"), "o_orderdate"), "o_orderdate", cuts))
    zero = {"log_index": "0", "token_address": "", "from_address": "", "to_address": "", "value": "0"}

    def end() -> None:
        lines.end(transaction_hash="end", timestamp=END, block_number="-1", **zero)
        blocks.end(number="-2", timestamp=END)

    def joined() -> DataFrame:
        # the time of the message is the line's arrival; the event time is to come from the block
        waiting = messages.accepted(lines.read("token_transfers")).drop("arrived").withColumnRenamed("event_time", "arrived")
        return jobs.with_block_time(
            waiting, messages.accepted(blocks.read("blocks")), delay="1 day", bound=f"{_BOUND} days"
        )

    def both(a: Callable[[], None], b: Callable[[], None]) -> Callable[[], None]:
        return lambda: (a(), b())

    steps = [both(a, b) for a, b in zip(sent, known, strict=True)]
    rows = _drain(spark, "block-time", joined, [*steps, end])
    return rows.select("transaction_hash", "log_index", "token_address", "event_time")


@query(f"WITH {sql.TX} SELECT hash AS key, c / 100.0 AS value_eth FROM tx WHERE c >= 10000")
def stream_alerts(spark, d):
    """Rows are stored, then alerts written; the alerts are read back and decoded."""
    target, alerts, checkpoint = (work_folder(spark, n) for n in ("stored", "alerts", "alerts-checkpoint"))
    topic = _Topic(spark, "alerts")
    body = jobs.store_and_alert(target, ["hash", "event_time"], jobs.file_alert_sink(alerts), 100)
    _run(_once(topic, _event_parts(spark, d)), lambda: jobs.start(_transactions(topic), checkpoint, body=body))
    sent = spark.read.schema("key string, value string").json(alerts)
    decoded = alert_ops.decode(sent.select("value"))
    return decoded.select(F.col("hash").alias("key"), "value_eth")


@query(f"""WITH {sql.TX} SELECT 'transactions' AS kind, hash, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, CAST(c AS VARCHAR) || '0000000000000000' AS value FROM tx
UNION ALL SELECT 'token_transfers', hash, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END, CAST(c AS VARCHAR) FROM tx
UNION ALL SELECT 'alerts', hash, NULL, CAST(c AS VARCHAR) || '0000000000000000' FROM tx WHERE c >= 10000""")
def stream_ledger(spark, d):
    """Transactions and token transfers of two topics, stored in one step and alerted after it.

    Each part arrives on a later day and is sent again with the next one. Transfers of one kind have no time, so the copy
    belongs to another day than the first: each is stored once all the same. Alerts are appended to a folder of JSON lines.
    """
    topics = {kind: _Topic(spark, kind) for kind in ("transactions", "token_transfers")}
    stores = {kind: work_folder(spark, f"ledger-{kind}") for kind in topics}
    alerts, checkpoint = work_folder(spark, "ledger-alerts"), work_folder(spark, "ledger-checkpoint")
    keys = {"transactions": ["hash", "event_time"], "token_transfers": ["transaction_hash", "log_index"]}
    body = jobs.ledger_body({k: (stores[k], keys[k]) for k in topics}, jobs.topic_alert_sink("json", path=alerts), 100, fold_every=2)
    events = table(spark, d, "events")
    transfer = F.struct(
        F.col("event_id").cast("string").alias("transaction_hash"),
        F.lit("0").alias("log_index"),
        F.when(F.col("event_type") != "error", _seconds("ts")).alias("timestamp"),
        F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).cast("string").alias("block_number"),
        F.col("event_type").alias("token_address"),
        F.col("user_id").cast("string").alias("from_address"),
        F.col("user_id").cast("string").alias("to_address"),
        frames.cents("value").cast("string").alias("value"),
    )
    cuts = _cuts(events, "ts")
    sent = _repeated(topics["transactions"], _parts(_message(events), "ts", cuts))
    parts = _parts(events.select(F.to_json(transfer).alias("value"), "ts"), "ts", cuts)
    moved = _repeated(topics["token_transfers"], parts, lambda k: FIRST_DAY_MS + k * DAY_MS)

    def ledger() -> DataFrame:
        rows = [messages.accepted(topic.read(kind)).withColumn("kind", F.lit(kind)) for kind, topic in topics.items()]
        return rows[0].unionByName(rows[1], allowMissingColumns=True)

    steps = [lambda a=a, b=b: (a(), b()) for a, b in zip(sent, moved, strict=True)]
    _run(steps, lambda: jobs.start(ledger(), checkpoint, body=body))
    stored = [
        spark.read.parquet(stores[kind]).select(F.lit(kind).alias("kind"), F.col(keys[kind][0]).alias("hash"), "event_time", "value")
        for kind in topics
    ]
    sent_alerts = alert_ops.decode(spark.read.schema("key string, value string").json(alerts).select("value")).distinct()
    told = sent_alerts.select(F.lit("alerts").alias("kind"), "hash", F.lit(None).cast("timestamp").alias("event_time"), "value")
    return stored[0].unionByName(stored[1]).unionByName(told)


@query(f"WITH {sql.TX} SELECT hash, f AS from_address, t AS to_address, CAST(c AS VARCHAR) || '0000000000000000' AS value FROM tx")
def stream_store(spark, d):
    """Every part is sent three times, in two micro-batches; the keyed table holds every row once."""
    target, checkpoint, topic = work_folder(spark, "store"), work_folder(spark, "store-checkpoint"), _Topic(spark, "store")

    def body(batch, batch_id):
        jobs.store_batch(batch, batch_id, target, ["hash", "event_time"])

    _run(_repeated(topic, _event_parts(spark, d)), lambda: jobs.start(_transactions(topic), checkpoint, body=body))
    return spark.read.parquet(target).select("hash", "from_address", "to_address", "value")


@query(f"""WITH {sql.TX} SELECT hash, c / 100.0 AS value_eth FROM tx WHERE c >= 10000
ORDER BY ts DESC, hash LIMIT 50""")
def stream_alert_feed(spark, d):
    path, checkpoint, topic = work_folder(spark, "feed"), work_folder(spark, "feed-checkpoint"), _Topic(spark, "feed")
    _run(
        _repeated(topic, _event_parts(spark, d)),
        lambda: jobs.start(alert_ops.alerts(_transactions(topic), 100), checkpoint, body=jobs.feed_body(path, 50)),
    )
    return jobs.latest_feed(spark, path).select("hash", "value_eth")


def _to_the_end(spark, d, name: str, counted: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Windows over all events; a message from the far future closes the last ones."""
    topic = _Topic(spark, name)
    steps = _once(topic, _event_parts(spark, d))

    def end() -> None:
        topic.end(hash="end", timestamp=END, from_address="", to_address="", value="0", gas_price="0")

    return _drain(spark, name, lambda: counted(_transactions(topic).withColumn("token_address", F.col("to_address"))), [*steps, end])


@query(f"""WITH {sql.TX}, wins AS (
  SELECT (s // 60 - i) * 60 AS start, c FROM tx, range(5) r(i))
SELECT strftime(make_timestamp(CAST(start AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(make_timestamp(CAST(start + 300 AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end,
       round(avg(c * 1e8) / 1e9, 6) AS average_gas_price_gwei, CAST(count(*) AS BIGINT) AS transactions
FROM wins GROUP BY start""")
def stream_gas(spark, d):
    return _to_the_end(spark, d, "gas", lambda rows: jobs.gas_by_window(rows, digits=6))


@query(f"""WITH {sql.TX}, wins AS (SELECT (s // 600 - i) * 600 AS start, t FROM tx, range(6) r(i))
SELECT strftime(make_timestamp(CAST(start AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(make_timestamp(CAST(start + 3600 AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS window_end,
       t AS token_address, CAST(count(*) AS BIGINT) AS transfer_count
FROM wins GROUP BY start, t""")
def stream_trending(spark, d):
    return _to_the_end(spark, d, "trending", jobs.trending_by_window)


@query(f"""WITH {sql.TX}
SELECT strftime(make_timestamp(CAST(s // 3600 * 3600 AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS bucket_start, t AS token_address,
       CAST(count(*) AS BIGINT) AS transfer_count, sum(c) / 100.0 AS total_value
FROM tx GROUP BY s // 3600, t""")
def stream_trend_buckets(spark, d):
    out = _to_the_end(spark, d, "buckets", jobs.trend_by_bucket)
    return out.withColumn("total_value", F.round(F.col("total_value") / 1e18, 2))


_SENT = f"""{sql.TX}, span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM tx),
sent AS (SELECT part, tx.* FROM tx, span, range(1, {PARTS + 1}) r(part) WHERE part = {PARTS} OR epoch_us(ts) < lo + (hi - lo) * part // {PARTS})"""
_TIME = "strftime(make_timestamp(CAST({0} AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')"


def _watched(spark, d, name: str, steps_of: Callable[[DataFrame], DataFrame], keys: list[str], read: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a dashboard sees in a live view after each part, with the number of the part."""
    topic, path, checkpoint = _Topic(spark, name), work_folder(spark, f"{name}-view"), work_folder(spark, f"{name}-checkpoint")
    events = table(spark, d, "events")
    cuts, _ = _even_cuts(events, "ts")
    body, out = views.view_body(path, keys, keep="1 day"), []
    for k, part in enumerate(_parts(_message(events), "ts", cuts)):
        topic.send(part)
        steps = steps_of(_transactions(topic))
        views.start_view(steps, checkpoint, body).awaitTermination()
        # a later version replaces this one, so what is seen now is kept
        out.append(stored(read(views.latest_view(spark, path, steps)).withColumn("part", F.lit(k + 1).cast("long")), f"{name}-seen"))
    return reduce(DataFrame.unionByName, out)


@query(f"""WITH {_SENT}, newest AS (SELECT part, max(s // 60 * 60) AS last FROM sent GROUP BY 1),
wins AS (SELECT part, (s // 60 - i) * 60 AS start, c FROM sent JOIN newest USING (part), range(5) r(i) WHERE s // 60 * 60 > last - 86400)
SELECT CAST(part AS BIGINT) AS part, {_TIME.format('start')} AS window_start, {_TIME.format('start + 300')} AS window_end,
       round(CAST(sum(c) * 100000000 AS DOUBLE) / count(*) / 1e9, 6) AS average_gas_price_gwei, CAST(count(*) AS BIGINT) AS transactions
FROM wins GROUP BY part, start""")
def stream_live_gas(spark, d):
    """The gas view after each part: open windows are in it, with what has come so far."""
    return _watched(spark, d, "live-gas", views.gas_steps, ["step_start"], lambda view: views.live_gas(view, digits=6))


@query(f"""WITH {_SENT}, newest AS (SELECT part, max(s // 600 * 600) AS last FROM sent GROUP BY 1),
wins AS (SELECT part, (s // 600 - i) * 600 AS start, t FROM sent JOIN newest USING (part), range(6) r(i) WHERE s // 600 * 600 > last - 86400)
SELECT CAST(part AS BIGINT) AS part, {_TIME.format('start')} AS window_start, {_TIME.format('start + 3600')} AS window_end,
       t AS token_address, CAST(count(*) AS BIGINT) AS transfer_count
FROM wins GROUP BY part, start, t""")
def stream_live_trending(spark, d):
    def steps(rows: DataFrame) -> DataFrame:
        return views.token_steps(rows.withColumn("token_address", F.col("to_address")))

    return _watched(spark, d, "live-trending", steps, ["step_start", "token_address"], views.live_trending)


@query("SELECT CAST(count(*) AS BIGINT) AS stored_rows, CAST(count(*) AS BIGINT) AS observed_rows, true AS bounded FROM events")
def stream_backlog(spark, d):
    """A backlog of many files goes through in micro-batches of at most five files; every row is stored once, none twice."""
    limit, topic = 5, _Topic(spark, "backlog", limit=5)
    target, checkpoint = work_folder(spark, "backlog"), work_folder(spark, "backlog-checkpoint")
    events = table(spark, d, "events")
    _message(events).repartition(24).select("value").write.text(topic.path)
    files = sum(not name.startswith(("_", ".")) for name in children(spark, topic.path))
    body = jobs.ledger_body({"transactions": (target, ["hash", "event_time"])}, jobs.file_alert_sink(f"{target}-alerts"), 100)
    job = jobs.start(jobs.with_batch_metrics(_transactions(topic)), checkpoint, body=body)
    job.awaitTermination()
    batches = jobs.batch_metrics(job)
    seen, bounded = sum(b["rows"] for b in batches), limit * len(batches) >= files
    kept = spark.read.parquet(target).agg(F.count_distinct("hash").alias("hashes"), F.count(F.lit(1)).alias("stored_rows"))
    bounded = F.lit(bounded) & (F.col("hashes") == F.col("stored_rows"))
    return kept.select("stored_rows", F.lit(seen).cast("long").alias("observed_rows"), bounded.alias("bounded"))


@query(f"""WITH {_SENT}, own AS (SELECT min(part) AS part, hash, ts FROM sent GROUP BY 2, 3),
waited AS (SELECT epoch_us(ts) AS us, CASE WHEN part = {PARTS} THEN hi ELSE lo + (hi - lo) * part // {PARTS} END // 1000 + 5000 AS ms FROM own, span),
lag AS (SELECT ms, round((ms * 1000 - us) / 1e6, 3) AS lag FROM waited)
SELECT strftime(date_trunc('minute', make_timestamp(ms * 1000)), '%Y-%m-%d %H:%M:%S') AS window_start, CAST(count(*) AS BIGINT) AS rows,
  count(*) / 60 AS rows_per_second, quantile_disc(lag, 0.5) AS p50_seconds, quantile_disc(lag, 0.95) AS p95_seconds FROM lag GROUP BY ms""")
def stream_lag(spark, d):
    """Delays of a stored stream: a row's time of storing is that of the micro-batch that stored it, here of its latest message.

    A part arrives five seconds after its end, so its rows have waited from five seconds to a third of the whole span.
    """
    topic, target, checkpoint = _Topic(spark, "lag"), work_folder(spark, "lag"), work_folder(spark, "lag-checkpoint")
    events = table(spark, d, "events")
    cuts, last = _even_cuts(events, "ts")

    def body(batch: DataFrame, batch_id: int) -> None:
        now = batch.agg(F.max(F.unix_micros("arrived"))).first()[0]
        clock = F.timestamp_micros(F.lit(now).cast("long"))
        jobs.store_batch(batch, batch_id, target, ["hash", "event_time"], stored_at=clock)

    parts = _parts(_message(events), "ts", cuts)
    steps = [lambda p=p, us=us: topic.send(p, arrived_ms=us // 1000 + 5000) for p, us in zip(parts, [*cuts, last], strict=True)]
    _run(steps, lambda: jobs.start(messages.accepted(topic.read("transactions")), checkpoint, body=body))
    delays = jobs.ingest_delay(spark.read.parquet(target))
    return delays.withColumns({c: F.round(c, 3) for c in ("p50_seconds", "p95_seconds")})


@query("""SELECT strftime(date_trunc('minute', ts + INTERVAL 90 SECOND), '%Y-%m-%d %H:%M:%S') AS window_start, CAST(count(*) AS BIGINT) AS rows,
  count(*) / 60 AS rows_per_second, 90.0::DOUBLE AS p50_seconds, 90.0::DOUBLE AS p95_seconds FROM events GROUP BY 1""")
def ingest_delay(spark, d):
    events = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("event_time"))
    return jobs.ingest_delay(events.withColumn("stored_at", F.col("event_time") + F.expr("interval 90 seconds")))
