"""Label and token dimensions from CSV or Parquet files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens import schemas
from transferlens.operators.labels import merge_labels
from transferlens.operators.upsert import upsert
from transferlens.sources.folders import children, delete, exists

DEFAULT_DECIMALS = 18


def _parquet_or_none(spark: SparkSession, path: str | None) -> DataFrame | None:
    if path is None:
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_labels(spark: SparkSession, path: str | None) -> DataFrame:
    """(address, label_name, label_category): the file's rows plus the burn addresses."""
    found = _parquet_or_none(spark, path)
    if found is not None:
        found = found.select(
            "address", F.col("name").alias("label_name"), F.col("category").alias("label_category")
        )
    return merge_labels(found, spark)


def read_tokens(spark: SparkSession, path: str | None) -> DataFrame:
    """(token_address, symbol, token_name, decimals); no file gives the empty frame of that shape."""
    found = _parquet_or_none(spark, path)
    if found is None:
        return spark.createDataFrame([], schemas.TOKENS)
    return found.select(
        F.col("address").alias("token_address"),
        "symbol",
        F.col("name").alias("token_name"),
        F.col("decimals").cast("int").alias("decimals"),
    )


def _csv(spark: SparkSession, path: str) -> DataFrame:
    # the order of lines decides which duplicate wins: files by name, then blocks of a file, then lines of a block
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("line"))
    return spark.read.option("header", True).csv(path).select("*", place.alias("load_order"))


def read_token_csv(spark: SparkSession, path: str) -> DataFrame:
    """Token rows with ``load_order``; addresses in lower case, odd decimals become 18."""
    return clean_tokens(_csv(spark, path))


def clean_tokens(raw: DataFrame) -> DataFrame:
    digits = F.col("decimals").cast("string")
    return raw.select(
        F.lower("address").alias("address"),
        "symbol",
        "name",
        F.when(digits.rlike("^[0-9]+$"), digits.try_cast("int")).otherwise(DEFAULT_DECIMALS).alias("decimals"),
        "load_order",
    )


def read_label_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = _csv(spark, path)
    return raw.select(F.lower("address").alias("address"), "name", "category", "load_order")


# ---- versioned tables ------------------------------------------------------------------------


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions of a dimension, ascending."""
    named = [int(n.split("=")[1]) for n in children(spark, root) if n.startswith("version=")]
    return sorted(n for n in named if exists(spark, f"{root}/version={n}/_SUCCESS"))


def latest_version(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame | None:
    """The newest complete version; None before the first load."""
    found = _versions(spark, root)
    return spark.read.schema(schema).parquet(f"{root}/version={found[-1]}") if found else None


def load_version(
    spark: SparkSession,
    root: str,
    csv: str,
    read: Callable[[SparkSession, str], DataFrame],
    schema: T.StructType,
    keys: Sequence[str] = ("address",),
    fixed: DataFrame | None = None,
    keep: int = 2,
) -> DataFrame:
    """Loads CSV files over the previous version of a dimension, as its next version; returns what is now current.

    A missing file leaves the previous version as it is, or gives the ``fixed`` rows where there is none. A load that fails half-way
    leaves an incomplete version that nobody reads; the next one takes its place. Rows of the files win over older ones, later lines over
    earlier ones; ``fixed`` rows are there unless a file has their key. The ``keep`` newest versions stay for readers that still use them.
    """
    before = latest_version(spark, root, schema)
    ground = before if before is not None else fixed
    if not exists(spark, csv):
        return ground if ground is not None else spark.createDataFrame([], schema)
    rows = upsert(ground, read(spark, csv), keys, "load_order").select(*schema.names)
    found = _versions(spark, root)
    at = found[-1] + 1 if found else 1
    rows.write.mode("overwrite").parquet(f"{root}/version={at}")
    for old in found[: len(found) + 1 - keep] if len(found) + 1 > keep else []:
        delete(spark, f"{root}/version={old}")
    return latest_version(spark, root, schema)
