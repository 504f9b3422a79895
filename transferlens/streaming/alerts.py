"""Alerts for large transactions: building, encoding, decoding, the bounded feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens import schemas
from transferlens.functions import money
from transferlens.operators.labels import latest_per_key
from transferlens.sources.files import CORRUPT
from transferlens.streaming.messages import once


def _iso(time: str) -> Column:
    """ISO 8601 with offset; a fraction only where there is one, so texts sort like times."""
    whole = F.date_format(time, "yyyy-MM-dd'T'HH:mm:ssxxx")
    return F.when(F.unix_micros(time) % 1_000_000 == 0, whole).otherwise(
        F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    )


def alerts(transactions: DataFrame, threshold: float = 100) -> DataFrame:
    """Rows at or above the threshold, in the alert's shape. Missing outcomes do not matter here."""
    large = transactions.where(money.at_least_eth("value", threshold))
    return large.select(
        "hash",
        _iso("event_time").alias("timestamp"),
        "from_address",
        "to_address",
        "value",
        (F.col("value").try_cast("double") / 1e18).alias("value_eth"),
    )


def encode(alert_rows: DataFrame) -> DataFrame:
    """(key, value) rows for a topic: the hash and the alert as JSON."""
    return alert_rows.select(F.col("hash").alias("key"), F.to_json(F.struct(*alert_rows.columns)).alias("value"))


def decode(raw: DataFrame) -> DataFrame:
    """Alert rows from JSON in ``value``; text that is no JSON object gives a null row.

    ``value_eth`` is filled in from ``value`` where the message lacks it.
    """
    shape = T.StructType([*schemas.ALERT.fields, T.StructField(CORRUPT, T.StringType())])
    body = F.from_json("value", shape, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = raw.select(once(body).alias("p"))
    rows = parsed.select(F.when(F.col(f"p.{CORRUPT}").isNull(), F.col("p")).alias("a"))
    eth = F.coalesce("a.value_eth", F.coalesce("a.value", F.lit("0")).try_cast("double") / 1e18)
    return rows.select(
        "a.hash",
        "a.timestamp",
        "a.from_address",
        "a.to_address",
        "a.value",
        F.when(F.col("a").isNotNull(), eth).alias("value_eth"),
    )


def feed(known: DataFrame | None, fresh: DataFrame, size: int = 50) -> DataFrame:
    """The ``size`` newest distinct alerts of ``known`` and ``fresh`` together.

    Of copies of a hash the newest counts; copies go first and then the rows are cut.
    """
    rows = fresh if known is None else known.unionByName(fresh)
    return latest_per_key(rows, ["hash"], ["timestamp"]).orderBy(F.desc("timestamp"), F.asc("hash")).limit(size)
