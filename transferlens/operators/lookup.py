"""Joins to tables that are small in truth but not by estimate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.session import stored

#: Rows of a few columns that every executor may hold.
SMALL_ROWS = 500_000


def counted_broadcast(df: DataFrame, name: str, limit: int = SMALL_ROWS) -> DataFrame:
    """``df`` written and read back, with a broadcast hint if it has at most ``limit`` rows.

    Raw JSON has no row count and an estimate by bytes of all its fields, so a day's few thousand blocks would make
    a join shuffle the day's transfers. The count comes from the written table's footers. Beyond the limit there is no
    hint, and the join is Catalyst's to plan.
    """
    kept = stored(df, name)
    return F.broadcast(kept) if kept.count() <= limit else kept
