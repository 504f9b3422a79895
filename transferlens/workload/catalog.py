"""Registry of the queries that run on the given tables, each with its check in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

_MODULES = ("batch", "serving", "quality", "dimensions", "storage", "streams")


def plain(df: DataFrame) -> DataFrame:
    """Output types both engines agree on: bigint, double, text."""

    def cast(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return column.cast("bigint").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return column

    return df.select(*[cast(f) for f in df.schema])


def query(check: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = lambda spark, folder: plain(run(spark, folder))
        if check is not None:
            CHECKS[key] = check.strip()
        return run

    return register


def load() -> None:
    for module in _MODULES:
        import_module(f"transferlens.workload.{module}")
