"""Streamed JSON messages: source, decoding, validation. Nothing invalid is dropped silently."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens import schemas


def read_topic(spark: SparkSession, fmt: str, schema: T.StructType | None = None, limit: int | None = None, **options) -> DataFrame:
    """A message stream as (value, arrived). ``fmt="kafka"`` reads a topic from its start; any
    other format is a file stream whose column ``value`` (or whole row as JSON) is the message.

    ``limit`` bounds a micro-batch: to so many messages of a topic, or so many files of a folder. A backlog then goes through
    in several bounded batches, also with ``availableNow``.
    """
    reader = spark.readStream.format(fmt)
    if limit is not None:
        options["maxOffsetsPerTrigger" if fmt == "kafka" else "maxFilesPerTrigger"] = str(limit)
    if fmt == "kafka":
        stream = reader.options(**{"startingOffsets": "earliest", **options}).load()
        return stream.select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrived"))
    path = options.pop("path")
    if schema is not None:
        reader = reader.schema(schema)
    stream = reader.options(**options).load(path)
    value = F.col("value") if "value" in stream.columns and len(stream.columns) == 1 else F.to_json(F.struct("*"))
    return stream.select(value.alias("value"), F.col("_metadata.file_modification_time").alias("arrived"))


def message_time() -> Column:
    """Event time under whichever of its three names is present, as unix seconds; else null."""
    text = F.coalesce("m.timestamp", "m.block_timestamp", "m.item_timestamp")
    seconds = text.try_cast("double")
    return F.when(seconds > 0, F.timestamp_micros((seconds * 1_000_000).cast("bigint")))


def _whole(name: str) -> Column:
    return F.col(f"m.{name}").try_cast("bigint")


def _amount(name: str) -> Column:
    text = F.coalesce(f"m.{name}", F.lit("0"))
    return F.when(text.rlike("^-?[0-9]+$"), text)


def once(parsed: Column) -> Column:
    """``parsed`` as a generator of one row.

    Later filters on its fields stay above it; pushed below they would parse the message once
    per field they look at.
    """
    return F.explode(F.array(parsed))


_FIELDS = {
    "blocks": (
        schemas.STREAM_BLOCK,
        {"number": lambda: _whole("number"), "event_time": message_time},
        ("number", "event_time"),
    ),
    "transactions": (
        schemas.STREAM_TRANSACTION,
        {
            "hash": lambda: F.col("m.hash"),
            "event_time": message_time,
            "from_address": lambda: F.col("m.from_address"),
            "to_address": lambda: F.col("m.to_address"),
            "value": lambda: _amount("value"),
            "gas_price": lambda: _amount("gas_price"),
        },
        ("hash", "event_time", "from_address", "value", "gas_price"),
    ),
    "token_transfers": (
        schemas.STREAM_TRANSFER,
        {
            "transaction_hash": lambda: F.col("m.transaction_hash"),
            "log_index": lambda: _whole("log_index"),
            "event_time": message_time,
            "block_number": lambda: _whole("block_number"),
            "token_address": lambda: F.col("m.token_address"),
            "from_address": lambda: F.col("m.from_address"),
            "to_address": lambda: F.col("m.to_address"),
            "value": lambda: _amount("value"),
        },
        ("transaction_hash", "log_index", "block_number", "token_address", "from_address", "to_address", "value"),
    ),
}


def decode(raw: DataFrame, kind: str) -> DataFrame:
    """Typed rows of one message kind plus ``problems``, the required fields that are unusable.

    Tombstones (null messages) are skipped. Works on batch and streaming frames alike.
    """
    schema, fields, required = _FIELDS[kind]
    carried = [c for c in raw.columns if c != "value"]
    typed = raw.where(F.col("value").isNotNull()).select(
        *carried, F.col("value").alias("raw"), once(F.from_json("value", schema)).alias("m")
    )
    rows = typed.select(*carried, "raw", *[make().alias(name) for name, make in fields.items()])
    problems = F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in required]))
    return rows.withColumn("problems", problems)


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.size("problems") == 0).drop("raw", "problems")


def quarantined(decoded: DataFrame) -> DataFrame:
    return decoded.where(F.size("problems") > 0).select("raw", "problems")
