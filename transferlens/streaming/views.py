"""Live views: small tables that a dashboard polls while a stream runs, open windows included.

The stream counts per step of time in update mode: each micro-batch hands over the steps it changed. They are merged by key into the view,
whose version n is built from version n - 1, so a replayed micro-batch builds the same version again. Steps leave the view
``keep`` after the newest one. Sliding windows are made from the few steps when the view is read, so the stream's state
holds every row once and not once a window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from transferlens.sources.folders import children, delete, exists


def gas_steps(transactions: DataFrame, step: str = "1 minute", delay: str = "1 minute") -> DataFrame:
    """Exact sum of gas prices (wei) and number of transactions per step."""
    steps = transactions.withWatermark("event_time", delay).groupBy(F.window("event_time", step).alias("w"))
    counted = steps.agg(F.sum(F.col("gas_price").cast("decimal(28,0)")).alias("gas_wei"), F.count(F.lit(1)).alias("transactions"))
    return counted.select(F.col("w.start").alias("step_start"), "gas_wei", "transactions")


def token_steps(transfers: DataFrame, step: str = "10 minutes", delay: str = "1 minute") -> DataFrame:
    """Transfers per token and step."""
    steps = transfers.withWatermark("event_time", delay).groupBy(F.window("event_time", step).alias("w"), "token_address")
    return steps.agg(F.count(F.lit(1)).alias("transfer_count")).select(F.col("w.start").alias("step_start"), "token_address", "transfer_count")


def _version(path: str, batch_id: int) -> str:
    return f"{path}/version={batch_id}"


def view_body(path: str, keys: Sequence[str], time: str = "step_start", keep: str = "1 hour") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that overlays the view with the steps a micro-batch changed.

    The old version is read beside the batch, and both are cut at ``keep`` before the newest step of either; versions older than the one
    before go. A batch without changes carries the view over.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, _version(path, batch_id - 1)
        rows = batch.withColumn("__new", F.lit(1))
        if batch_id and exists(spark, f"{before}/_SUCCESS"):
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(before).withColumn("__new", F.lit(0)))
        others = [c for c in batch.columns if c not in keys]
        merged = rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "__new").alias("row")) if others else rows.select(*keys).distinct()
        flat = merged.select(*keys, "row.*") if others else merged
        newest = flat.agg(F.max(time).alias("__newest"))  # one row
        kept = flat.join(F.broadcast(newest), F.col(time) > F.col("__newest") - F.expr(f"interval {keep}")).drop("__newest")
        kept.select(*batch.columns).write.mode("overwrite").parquet(_version(path, batch_id))
        delete(spark, _version(path, batch_id - 2))

    return run


def start_view(steps: DataFrame, checkpoint: str, body: Callable[[DataFrame, int], None], interval: str | None = None) -> StreamingQuery:
    """Runs a view over what is there, or every ``interval`` until it is stopped."""
    writer = steps.writeStream.option("checkpointLocation", checkpoint).outputMode("update").foreachBatch(body)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def latest_view(spark: SparkSession, path: str, steps: DataFrame) -> DataFrame:
    """The newest complete version; without one an empty frame of the steps' schema."""
    versions = [int(n.split("=")[1]) for n in children(spark, path) if n.startswith("version=") and exists(spark, f"{path}/{n}/_SUCCESS")]
    if not versions:
        return spark.createDataFrame([], steps.schema)
    return spark.read.schema(steps.schema).parquet(_version(path, max(versions)))


def _windows(view: DataFrame, width: int, step: int) -> DataFrame:
    """Each step in every window of ``width`` seconds that holds it; windows start at whole steps."""
    starts = F.expr(f"transform(sequence(0, {width // step - 1}), i -> timestamp_seconds(unix_seconds(step_start) - i * {step}))")
    return view.withColumn("window_start", F.explode(starts)).withColumn("window_end", F.timestamp_seconds(F.unix_seconds("window_start") + width))


def live_gas(view: DataFrame, width: int = 300, step: int = 60, digits: int = 2) -> DataFrame:
    """Mean gas price in gwei per sliding window, open ones as far as they are known."""
    windows = _windows(view, width, step).groupBy("window_start", "window_end")
    total = windows.agg(F.sum("gas_wei").cast("double").alias("gas_wei"), F.sum("transactions").alias("transactions"))
    price = F.round(F.col("gas_wei") / F.col("transactions") / 1e9, digits)
    return total.select("window_start", "window_end", price.alias("average_gas_price_gwei"), "transactions")


def live_trending(view: DataFrame, width: int = 3600, step: int = 600) -> DataFrame:
    """Transfers per token and sliding window, open ones as far as they are known."""
    windows = _windows(view, width, step).groupBy("window_start", "window_end", "token_address")
    return windows.agg(F.sum("transfer_count").alias("transfer_count"))
