"""Keyed writes: last-write-wins merge and insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.operators.labels import latest_per_key


def upsert(current: DataFrame | None, incoming: DataFrame, keys: Sequence[str], load_order: str) -> DataFrame:
    """``current`` overlaid with ``incoming``; per key the row with the highest ``load_order`` wins."""
    rows = incoming.withColumn("__new", F.lit(1))
    if current is not None:
        old = current.withColumn("__new", F.lit(0))
        if load_order not in old.columns:
            old = old.withColumn(load_order, F.lit(None).cast(incoming.schema[load_order].dataType))
        rows = old.unionByName(rows)
    return latest_per_key(rows, keys, ["__new", load_order]).drop("__new", load_order)


def insert_ignore(target: DataFrame | None, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``incoming`` whose key the target lacks, one per key."""
    fresh = incoming.dropDuplicates(list(keys))
    return fresh if target is None else fresh.join(target.select(*keys), list(keys), "left_anti")
