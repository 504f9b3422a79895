"""Small aggregate builders shared by the roll-ups and the quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def signed_flow(amount: Column | str, sender: str, receiver: str, category: str = "CEX") -> Column:
    """Sum of amounts into ``category`` minus amounts out of it; inside the category counts as in."""
    amount = _col(amount)
    signed = F.when(F.col(receiver) == category, amount).when(F.col(sender) == category, -amount)
    return F.sum(F.coalesce(signed, F.lit(0)))


def sum_where(condition: Column, amount: Column | str) -> Column:
    return F.sum(F.when(condition, _col(amount)).otherwise(F.lit(0)))


def rate(flag: Column | str) -> Column:
    """Share of true among the rows where the flag is known."""
    return F.avg(_col(flag).cast("int"))


def variation(value: Column | str) -> Column:
    """Sample standard deviation over mean; 0 where the mean is not positive."""
    value = _col(value)
    return F.coalesce(F.when(F.avg(value) > 0, F.stddev_samp(value) / F.avg(value)), F.lit(0.0))


def distinct_of(df: DataFrame, columns: Sequence[str], alias: str, count_null: bool = True) -> DataFrame:
    """Number of distinct values over several columns together, as one row.

    Distinct first, per column and map side, then one count: no task collects a value set.
    ``count_null`` counts a missing value as one more value.
    """
    values = df.select(F.explode(F.array(*columns)).alias("v")).distinct()
    counted = F.count(F.lit(1)) if count_null else F.count("v")
    return values.agg(counted.alias(alias))


def top(df: DataFrame, order: Sequence[Column], n: int, offset: int = 0) -> DataFrame:
    """First ``n`` rows by a total order; Spark plans this as a per-task top-n and one merge."""
    ordered = df.orderBy(*order)
    return (ordered.offset(offset) if offset else ordered).limit(n)


def share_of(df: DataFrame, by: str, share: str = "share_pct", count: str = "n") -> DataFrame:
    """Rows per value of ``by`` and their percentage of all rows, the total being taken over the few counts."""
    counts = df.groupBy(by).agg(F.count(F.lit(1)).alias(count))
    total = F.sum(count).over(Window.partitionBy())
    return counts.withColumn(share, F.round(F.col(count) * 100.0 / total, 2))
