"""Writing tables: idempotent partition replacement, append, clustered compaction, retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlens import schemas
from transferlens.sources.files import file_sizes
from transferlens.sources.folders import children, delete, exists


def write_days(df: DataFrame, root: str, partition: Sequence[str] = ("dt",), fmt: str = "parquet", **options) -> None:
    """Replaces the partitions that ``df`` touches and leaves the others alone.

    The rebalance hint gathers each partition's rows into files of AQE's target size and splits
    a large one over many tasks. Running it again gives the same table.
    """
    (
        df.hint("rebalance", *partition)
        .write.format(fmt)
        .options(**options)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .mode("overwrite")
        .save(root)
    )


def append(df: DataFrame, target: str, fmt: str = "parquet", partition: Sequence[str] = ("dt",), **options) -> None:
    """Plain append, for stores without partition replacement. A second run adds the rows again."""
    df.write.format(fmt).options(**options).partitionBy(*partition).mode("append").save(target)


def append_once(df: DataFrame, target: str, batch: str, fmt: str = "parquet", partition: Sequence[str] = ("dt",), **options) -> None:
    """Append under a batch's own mark, for file formats of any kind: a second run replaces what the first one added.

    The mark is a last partition column ``load_batch``. Folders that an earlier attempt of the batch left and this one does not
    write go first, so a rerun with fewer rows leaves none behind.
    """
    spark = df.sparkSession
    tagged = df.withColumn("load_batch", F.lit(batch))
    for folder in _batch_folders(spark, target.rstrip("/"), len(partition), f"load_batch={batch}"):
        delete(spark, folder)
    writer = tagged.hint("rebalance", *partition).write.format(fmt).options(**options)
    writer.partitionBy(*partition, "load_batch").mode("append").save(target)


def _batch_folders(spark: SparkSession, root: str, depth: int, name: str) -> list[str]:
    """Folders of one batch below ``depth`` partition levels; one metadata call each level and folder."""
    if depth == 0:
        return [f"{root}/{name}"] if exists(spark, f"{root}/{name}") else []
    below = [child for child in children(spark, root) if "=" in child]
    return [folder for child in below for folder in _batch_folders(spark, f"{root}/{child}", depth - 1, name)]


def write_clustered(
    df: DataFrame, root: str, segment_by: str, order_by: str, partition: Sequence[str] = ("dt",), files: int | None = None
) -> None:
    """Rows of one ``segment_by`` value side by side, newest first, for min/max file skipping.

    Range partitioning on (partition, segment, order) lets one hot address span many tasks.
    """
    keys = [*partition, segment_by, F.desc(order_by)]
    placed = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    (
        placed.sortWithinPartitions(*keys)
        .write.option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .mode("overwrite")
        .parquet(root)
    )


def saved_bytes(spark: SparkSession, before: str, after: str) -> DataFrame:
    """Bytes under two table folders and the percentage saved."""

    tagged = file_sizes(spark, before).withColumn("old", F.lit(True)).unionByName(
        file_sizes(spark, after).withColumn("old", F.lit(False))
    )

    def total(old: bool):
        return F.coalesce(F.sum(F.when(F.col("old") == old, F.col("bytes"))), F.lit(0))

    both = tagged.agg(total(True).alias("bytes_before"), total(False).alias("bytes_after"))
    return both.withColumn(
        "saved_pct",
        F.round(F.when(F.col("bytes_before") > 0, 100 * (1 - F.col("bytes_after") / F.col("bytes_before"))), 2),
    )


def cutoff(as_of: date, months: int = 6) -> date:
    month = as_of.year * 12 + as_of.month - 1 - months
    year, month = divmod(month, 12)
    last = [31, 29 if year % 4 == 0 and (year % 100 or year % 400 == 0) else 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
    return date(year, month + 1, min(as_of.day, last[month]))


def drop_expired(spark: SparkSession, root: str, as_of: date, months: int = 6) -> list[str]:
    """Removes the day folders older than ``months``; returns the days removed."""
    oldest = cutoff(as_of, months).isoformat()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = []
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("dt=") and name[3:] < oldest:
            files.delete(status.getPath(), True)
            removed.append(name[3:])
    return sorted(removed)


def backfill(
    df: DataFrame,
    root: str,
    time_column: str,
    first: str,
    last: str,
    renames: dict[str, str] | None = None,
    fmt: str = "json",
) -> None:
    """Writes the days ``first`` to ``last`` of a table in one job, projected and renamed."""
    write_days(project_days(df, time_column, first, last, renames), root, ["dt"], fmt)


def project_days(
    df: DataFrame, time_column: str, first: str, last: str, renames: dict[str, str] | None = None
) -> DataFrame:
    """Rows of the days ``first`` to ``last``, projected to ``renames`` (old name to new name)."""
    day = F.to_date(F.col(time_column).cast("timestamp"))
    kept = df.where(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    columns = [F.col(old).alias(new) for old, new in (renames or {c: c for c in df.columns}).items()]
    return kept.select(*columns, day.alias("block_date"), day.alias("dt"))


# Which columns of a transaction row make up its receipt.
RECEIPT_COLUMNS = {
    "hash": "transaction_hash",
    "transaction_index": "transaction_index",
    "block_hash": "block_hash",
    "block_number": "block_number",
    "receipt_cumulative_gas_used": "cumulative_gas_used",
    "receipt_gas_used": "gas_used",
    "receipt_contract_address": "contract_address",
    "receipt_root": "root",
    "receipt_status": "status",
    "receipt_effective_gas_price": "effective_gas_price",
}

# Which columns of the wide table make up a transaction row.
TRANSACTION_COLUMNS = {f.name: f.name for f in schemas.TRANSACTIONS}

# Folder -> (table it comes from, its time column, columns kept or None for all).
EXPORTS = {
    "blocks": ("blocks", "timestamp", None),
    "logs": ("logs", "block_timestamp", None),
    "token_transfers": ("token_transfers", "block_timestamp", None),
    "contracts": ("contracts", "block_timestamp", None),
    "transactions": ("transactions", "block_timestamp", TRANSACTION_COLUMNS),
    "receipts": ("transactions", "block_timestamp", RECEIPT_COLUMNS),
}


def backfill_all(tables: Mapping[str, DataFrame], root: str, first: str, last: str, fmt: str = "json") -> None:
    """Every export of ``EXPORTS`` whose table is given, a folder each; a second run replaces the same days."""
    for name, (source, time_column, renames) in EXPORTS.items():
        if source in tables:
            backfill(tables[source], f"{root}/{name}", time_column, first, last, renames, fmt)
