"""Running totals whose groups may be far larger than one task can hold.

A window partitioned by a hot key (an exchange wallet with a third of all rows) sorts that key's
rows in a single task. Here every group is cut into slots along its order, whatever its size. Slot
sums are pre-aggregated, turned into one opening balance per slot, and the window then runs per
slot behind its opening balance.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLOT, _ROW = "__slot", "__is_row"


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    slot: Column,
    sums: Mapping[str, Column],
    group_sums: Mapping[str, Column] | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """``df`` plus one running total per entry of ``sums`` (this row included).

    ``slot`` must never decrease along ``order_by`` and must be a function of its first column,
    so that rows that tie there share a slot; null means the row's group is not cut.
    ``group_sums`` adds totals over the whole group. A null input counts as zero.

    Slot sums are read from ``source``, a cheaper frame of the same rows: where ``df`` already
    carries running totals, the frame they were taken on.
    """
    group_sums = dict(group_sums or {})
    measures = {**sums, **group_sums}
    hidden = {name: f"__m_{name}" for name in measures}
    columns = list(df.columns)

    source = df if source is None else source

    def measured(frame: DataFrame) -> DataFrame:
        return frame.withColumns({_SLOT: slot, **{hidden[n]: F.coalesce(c, F.lit(0)) for n, c in measures.items()}})

    rows = measured(df)
    cut = measured(source).where(F.col(_SLOT).isNotNull())
    slots = cut.groupBy(*keys, _SLOT).agg(*[F.sum(hidden[n]).alias(hidden[n]) for n in measures])
    earlier = Window.partitionBy(*keys).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    opening = slots.select(
        *keys,
        _SLOT,
        *[F.coalesce(F.sum(hidden[n]).over(earlier), F.lit(0)).alias(hidden[n]) for n in sums],
        *[F.sum(hidden[n]).over(whole).alias(hidden[n]) for n in group_sums],
        F.lit(False).alias(_ROW),
    )

    both = rows.withColumn(_ROW, F.lit(True)).unionByName(opening, allowMissingColumns=True)
    per_slot = Window.partitionBy(*keys, _SLOT)
    upto = per_slot.orderBy(_ROW, *order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def group_total(name: str) -> Column:
        # the opening row of a cut group carries the total; otherwise the slot is the group
        carried = F.max(F.when(~F.col(_ROW), F.col(hidden[name]))).over(per_slot)
        return F.coalesce(carried, F.sum(hidden[name]).over(per_slot))

    return (
        both.select(
            *columns,
            _ROW,
            *[F.sum(hidden[n]).over(upto).alias(n) for n in sums],
            *[group_total(n).alias(n) for n in group_sums],
        )
        .where(F.col(_ROW))
        .drop(_ROW)
    )
