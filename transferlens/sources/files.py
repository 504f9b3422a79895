"""Reading ledger files: newline JSON (bronze) and day-partitioned Parquet (silver, gold)."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def day_of(day: str) -> str:
    """``dt=2026-05-01`` or ``2026-05-01`` to the plain date."""
    return day.split("=", 1)[-1]


def _as_text(schema: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(f.name, f.dataType if isinstance(f.dataType, T.ArrayType) else T.StringType())
            for f in schema
        ]
    )


def day_folders(spark: SparkSession, root: str, first: str, last: str | None = None) -> list[str]:
    """The folders of the days ``first`` to ``last`` that exist; other days are not listed."""
    start, end = date.fromisoformat(day_of(first)), date.fromisoformat(day_of(last or first))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = [start + timedelta(n) for n in range((end - start).days + 1)]
    folders = [f"{root.rstrip('/')}/dt={day.isoformat()}" for day in days]
    return [folder for folder in folders if system.exists(path(folder))]


def _dated(schema: T.StructType) -> T.StructType:
    return schema if "dt" in schema.names else T.StructType([*schema.fields, T.StructField("dt", T.DateType())])


def read_json(
    spark: SparkSession, root: str, schema: T.StructType, day: str | None = None, mode: str = "PERMISSIVE"
) -> DataFrame:
    """Newline JSON under ``root``, with ``schema``; a field that does not fit is null.

    Scalars are read as text and cast with ``try_cast``, so quoted integers survive. With ``day`` only that
    day's folder is listed and read, and the frame has the ``dt`` column; a day without a folder gives no rows.
    ``mode="FAILFAST"`` reads with the declared types and fails on the first misfit.
    """
    strict = mode == "FAILFAST"
    reader = spark.read.option("mode", mode)
    raw = schema if strict else _as_text(schema)
    if day:
        folders = day_folders(spark, root, day)
        reader = reader.schema(_dated(raw)).option("basePath", root)
        df = reader.json(folders) if folders else spark.createDataFrame([], _dated(raw))
    else:
        df = reader.schema(raw).json(root)
    if strict:
        return df
    return df.select(*_typed_fields(schema), *(["dt"] if day else []))


def _typed_fields(schema: T.StructType, prefix: str = "") -> list[Column]:
    return [_typed(f, f"{prefix}{f.name}") for f in schema]


def _typed(field: T.StructField, name: str) -> Column:
    text = F.col(name)
    if isinstance(field.dataType, (T.ArrayType, T.StringType)):
        return text.alias(field.name)
    cast = text.try_cast(field.dataType)
    if isinstance(field.dataType, T.LongType) and field.name.endswith("timestamp"):
        # exports may carry the time as text instead of unix seconds
        cast = F.coalesce(cast, F.unix_seconds(F.try_to_timestamp(F.regexp_replace(text, " UTC$", ""))))
    return cast.alias(field.name)


def read_json_split(spark: SparkSession, root: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the raw text of lines that are no JSON or hold a value that does not fit ``schema``.

    What ``read_json`` accepts, quoted integers too, is good here. Either frame parses a line once: the parse sits behind
    a generator, above which filters and casts stay.
    """
    raw = T.StructType([*_as_text(schema).fields, T.StructField(CORRUPT, T.StringType())])
    body = F.from_json("value", raw, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    parsed = spark.read.text(root).select("value", F.explode(F.array(body)).alias("r"))
    misfit = [F.col(f"r.{f.name}").isNotNull() & _typed(f, f"r.{f.name}").isNull() for f in schema]
    is_bad = reduce(lambda a, b: a | b, misfit, F.col(f"r.{CORRUPT}").isNotNull())
    good = parsed.where(~is_bad).select(*_typed_fields(schema, "r."))
    return good, parsed.where(is_bad).select(F.col("value").alias("raw"))


def read_days(
    spark: SparkSession, root: str, schema: T.StructType, day: str | None = None, last: str | None = None
) -> DataFrame:
    """Day-partitioned Parquet; one day, or the days from ``day`` to ``last``, whose folders alone are listed."""
    if not day:
        return spark.read.schema(schema).parquet(root)
    folders = day_folders(spark, root, day, last)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders)


def _listing(spark: SparkSession, root: str) -> DataFrame:
    # only names and lengths are selected below, so no file is opened
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """One row per non-empty file under ``root``: path and bytes."""
    return _listing(spark, root).select("path", F.col("length").alias("bytes"))


def empty_files(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """Files of zero bytes under ``root``, or in one day's folder: listed, but without a row of their own.

    The names pass through the driver, so ask for a day at a time where a table has many.
    """
    folder = f"{root.rstrip('/')}/dt={day_of(day)}" if day else root
    listed = spark.createDataFrame([(p,) for p in _listing(spark, folder).inputFiles()], "path string")
    # a local path is written with one slash or with three
    same = F.regexp_replace("path", ":/+", ":/").alias("path")
    return listed.select(same).join(file_sizes(spark, folder).select(same), "path", "left_anti")
