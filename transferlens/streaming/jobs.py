"""Stateful stream operators and the jobs that store them.

All of them take streaming frames whose time column is a timestamp; every stateful one sets a
watermark, so state is dropped once it can no longer change a result.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transferlens.sources.folders import children, delete, exists
from transferlens.streaming.alerts import alerts, encode, feed
from transferlens.streaming.keys import BUCKETS, FOLD_EVERY, add_keys, fold_keys, index_of, key_bucket, known_keys


def deduplicated(stream: DataFrame, keys: Sequence[str], time: str = "event_time", delay: str = "10 minutes") -> DataFrame:
    """First row per key; a copy that arrives within ``delay`` of it is dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def with_block_time(
    transfers: DataFrame,
    blocks: DataFrame,
    time: str = "arrived",
    delay: str = "10 minutes",
    bound: str = "10 minutes",
) -> DataFrame:
    """Transfers with their block's time as ``event_time``; without a block it stays null.

    ``time`` is the transfer's own arrival time. A block is looked for within ``bound`` around
    it; the transfer comes out unmatched once the watermark has passed that bound.
    """
    left = transfers.withWatermark(time, delay).alias("t")
    right = blocks.select(F.col("number").alias("__number"), F.col("event_time").alias("__block_time"))
    right = right.withWatermark("__block_time", delay)
    # a block sent twice must not double its transfers
    right = right.dropDuplicatesWithinWatermark(["__number"]) if right.isStreaming else right.dropDuplicates(["__number"])
    right = right.alias("b")
    near = (F.col("__block_time") >= F.col(f"t.{time}") - F.expr(f"interval {bound}")) & (
        F.col("__block_time") <= F.col(f"t.{time}") + F.expr(f"interval {bound}")
    )
    joined = left.join(right, (F.col("t.block_number") == F.col("__number")) & near, "left_outer")
    kept = [F.col(f"t.{c}") for c in transfers.columns if c != "event_time"]
    own = [F.col("t.event_time")] if "event_time" in transfers.columns else []
    return joined.select(*kept, F.coalesce(*own, F.col("__block_time")).alias("event_time"))


def gas_by_window(
    transactions: DataFrame,
    width: str = "5 minutes",
    slide: str = "1 minute",
    delay: str = "1 minute",
    digits: int = 2,
) -> DataFrame:
    """Mean gas price in gwei per sliding window."""
    windows = transactions.withWatermark("event_time", delay).groupBy(F.window("event_time", width, slide).alias("w"))
    price = F.avg(F.col("gas_price").cast("double")) / 1e9
    counted = windows.agg(F.round(price, digits).alias("average_gas_price_gwei"), F.count(F.lit(1)).alias("transactions"))
    return counted.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "average_gas_price_gwei",
        "transactions",
    )


def trending_by_window(
    transfers: DataFrame, width: str = "1 hour", slide: str = "10 minutes", delay: str = "1 minute"
) -> DataFrame:
    """Transfers per token and sliding window; the top-n of a window is a batch question on it."""
    windows = transfers.withWatermark("event_time", delay).groupBy(
        F.window("event_time", width, slide).alias("w"), "token_address"
    )
    return windows.agg(F.count(F.lit(1)).alias("transfer_count")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "token_address", "transfer_count"
    )


def trend_by_bucket(transfers: DataFrame, width: str = "1 hour", delay: str = "1 minute") -> DataFrame:
    """Transfers and raw volume per token and tumbling bucket."""
    buckets = transfers.withWatermark("event_time", delay).groupBy(
        F.window("event_time", width).alias("w"), "token_address"
    )
    volume = F.sum(F.col("value").cast("string").try_cast("double"))
    return buckets.agg(
        F.count(F.lit(1)).alias("transfer_count"), F.coalesce(volume, F.lit(0.0)).alias("total_value")
    ).select(F.col("w.start").alias("bucket_start"), "token_address", "transfer_count", "total_value")


def ingest_delay(stored: DataFrame, width: str = "1 minute") -> DataFrame:
    """Seconds from event to store per minute of storing: p50, p95 and rows per second."""
    lag = F.unix_micros("stored_at") - F.unix_micros("event_time")
    rows = stored.withColumn("lag", lag / 1e6)
    per = rows.groupBy(F.window("stored_at", width).alias("w")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.percentile_approx("lag", 0.5, 10_000).alias("p50_seconds"),
        F.percentile_approx("lag", 0.95, 10_000).alias("p95_seconds"),
    )
    length = F.unix_seconds("w.end") - F.unix_seconds("w.start")
    return per.select(
        F.col("w.start").alias("window_start"),
        "rows",
        (F.col("rows") / length).alias("rows_per_second"),
        "p50_seconds",
        "p95_seconds",
    )


# ---- storing ---------------------------------------------------------------------------------


def store_batch(
    batch: DataFrame,
    batch_id: int,
    target: str,
    keys: Sequence[str],
    buckets: int = BUCKETS,
    fold_every: int = FOLD_EVERY,
    stored_at: Column | None = None,
) -> None:
    """Writes the rows of one micro-batch whose key the table lacks, whatever the day of the row that has it.

    Each batch owns the folders ``dt=*/batch=<id>``, and of the key index ``delta/bucket=*/batch=<id>``. A replay overwrites
    exactly those and does not count its own earlier attempt as stored, so replays change nothing. A row belongs to the day of its
    event, without a time to the day it arrived (``arrived``, if the batch has it). Of the index only the buckets
    that the batch's keys fall into are read. ``stored_at`` adds the time of storing. ``batch`` is read twice: persist it if it is costly.
    """
    spark, index, keys = batch.sparkSession, index_of(target), list(keys)
    times = [F.col(c) for c in ("event_time", "arrived") if c in batch.columns]
    rows = batch.dropDuplicates(keys).withColumn("dt", F.to_date(F.coalesce(*times)))
    if stored_at is not None:
        rows = rows.withColumn("stored_at", stored_at)
    schema = rows.select(*keys).schema
    touched = [r["b"] for r in rows.select(key_bucket(keys, buckets).alias("b")).distinct().collect()]  # at most ``buckets``
    known = known_keys(spark, index, schema, touched, batch_id)
    if known is not None:
        known = known.select(*[F.col(k).alias(f"__{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
        rows = rows.join(known, same, "left_anti")
    rows = rows.persist()
    try:
        own = rows.withColumn("batch", F.lit(batch_id).cast("long")).hint("rebalance", "dt")
        own.write.option("partitionOverwriteMode", "dynamic").partitionBy("dt", "batch").mode("overwrite").parquet(target)
        add_keys(rows, index, keys, batch_id, buckets)
    finally:
        rows.unpersist()
    if batch_id and batch_id % fold_every == 0:
        fold_keys(spark, index, schema, batch_id - 1)


def store_and_alert(
    target: str,
    keys: Sequence[str],
    alert_sink: Callable[[DataFrame, int], None],
    threshold: float = 100,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body: store first, then alert. If either fails the batch is replayed,
    so alerts are delivered at least once and never before their rows are stored."""
    return ledger_body({"transactions": (target, keys)}, alert_sink, threshold)


def ledger_body(
    tables: Mapping[str, tuple[str, Sequence[str]]],
    alert_sink: Callable[[DataFrame, int], None],
    threshold: float = 100,
    **settings,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that stores every kind of row, then alerts on transactions, in one step.

    ``tables`` maps a kind to its table and keys; with more than one the batch names it in ``kind``. ``settings`` go to
    :func:`store_batch`.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        # read several times below; unpersisted the stream's operators would run each time
        batch = batch.persist()
        try:
            for kind, (target, keys) in tables.items():
                store_batch(_of_kind(batch, kind), batch_id, target, keys, **settings)
            # alerts come from the batch, not from the newly stored rows: after a failed alert
            # the replay must send them although their rows are already stored
            _, keys = tables["transactions"]
            rows = _of_kind(batch, "transactions").dropDuplicates(list(keys))
            alert_sink(encode(alerts(rows, threshold)), batch_id)
        finally:
            batch.unpersist()

    return run


def _of_kind(batch: DataFrame, kind: str) -> DataFrame:
    return batch.where(F.col("kind") == kind).drop("kind") if "kind" in batch.columns else batch


def file_alert_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Alerts as JSON files, one folder per batch, overwritten on replay."""

    def write(alert_rows: DataFrame, batch_id: int) -> None:
        alert_rows.write.mode("overwrite").json(f"{path}/batch={batch_id}")

    return write


def topic_alert_sink(fmt: str = "kafka", **options) -> Callable[[DataFrame, int], None]:
    """Alerts appended to a topic, or to a folder in any format; a replay sends them again."""

    def write(alert_rows: DataFrame, batch_id: int) -> None:
        alert_rows.write.format(fmt).options(**options).mode("append").save()

    return write


def start(
    stream: DataFrame,
    checkpoint: str,
    body: Callable[[DataFrame, int], None] | None = None,
    path: str | None = None,
    available_now: bool = True,
    interval: str = "5 seconds",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Starts a job that hands micro-batches to ``body`` or appends them to ``path``."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    if body is not None:
        return writer.foreachBatch(body).start()
    return writer.format(fmt).option("path", path).start()


def drain(query: StreamingQuery) -> None:
    """Ends a running job without leaving anything behind: what has arrived is processed, then it stops."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    query.awaitTermination()


def with_batch_metrics(stream: DataFrame, time: str = "event_time", name: str = "batch") -> DataFrame:
    """The stream with metrics that Spark takes of every micro-batch as it runs: rows, and the first and last event time."""
    return stream.observe(name, F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_event"), F.max(time).alias("last_event"))


def batch_metrics(query: StreamingQuery, name: str = "batch") -> list[dict]:
    """One entry per recent micro-batch that had input: its id, rows, event times, and milliseconds it took."""
    out = []
    for progress in query.recentProgress:
        seen = (progress["observedMetrics"] or {}).get(name)
        if seen is not None and seen["rows"]:
            out.append({"batch": progress["batchId"], "took_ms": progress["durationMs"].get("triggerExecution"), **seen.asDict()})
    return out


def feed_body(path: str, size: int = 50) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that keeps the newest alerts. Version n is built from version n-1,
    so a replay of a batch rebuilds the same version. Versions before that are dropped."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = f"{path}/version={batch_id - 1}"
        known = spark.read.schema(batch.schema).parquet(before) if batch_id and exists(spark, before) else None
        feed(known, batch, size).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        delete(spark, f"{path}/version={batch_id - 2}")

    return run


def latest_feed(spark: SparkSession, path: str) -> DataFrame:
    """The feed's newest version."""
    versions = [int(name.split("=")[1]) for name in children(spark, path) if "=" in name]
    return spark.read.parquet(f"{path}/version={max(versions)}")
