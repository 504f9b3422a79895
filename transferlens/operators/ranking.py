"""``rank()`` over groups too large for one sort task.

A rank only depends on how many rows carry a smaller (or larger) value. Rows are first counted
per distinct value, so ties collapse before any shuffle of rows; the counts are accumulated
with :func:`running_totals`, cut by the size of the value; the rank of each value is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.operators.running import running_totals


#: Slots for each doubling of a value, and the smallest value that is told from zero.
SLOTS_PER_OCTAVE = 4096
FINEST = 1e-6


def value_slot(value: str) -> Column:
    """A slot that never decreases with the value: its sign and its logarithm in fine steps."""
    number = F.col(value).cast("double")
    return (F.signum(number) * F.floor(F.log2(1 + F.abs(number) / FINEST) * SLOTS_PER_OCTAVE)).cast("long")


def value_ranks(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    ascending: str | None = None,
    descending: str | None = None,
    cut: bool = False,
) -> DataFrame:
    """Distinct ``(group, value)`` rows with their rank(s), gaps as in SQL ``rank``.

    ``cut`` splits a group's values into slots of equal relative width, so that no task sorts a whole
    group. Without it the group's distinct values are accumulated in one window; that fits
    values with few distinct forms per group (counts, scores rounded to four places).
    """
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("__n"))
    slot = value_slot(value) if cut else F.lit(None).cast("long")
    done = running_totals(
        counts,
        keys=group,
        order_by=[value],
        slot=slot,
        sums={"__upto": F.col("__n")},
        group_sums={"__all": F.col("__n")},
    )
    out = [*group, value]
    if ascending:
        out.append((F.col("__upto") - F.col("__n") + 1).cast("long").alias(ascending))
    if descending:
        out.append((F.col("__all") - F.col("__upto") + 1).cast("long").alias(descending))
    return done.select(*out)


def with_rank(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    ascending: str | None = None,
    descending: str | None = None,
    cut: bool = False,
) -> DataFrame:
    """``df`` plus the ranks of ``value`` within ``group``. Null values get no rank.

    The ranks are unique per (group, value), so a value held by very many rows only makes the
    row side of the join heavy, which adaptive skew-join handling splits.
    """
    named = df.where(F.col(value).isNotNull())
    ranks = value_ranks(named, group, value, ascending, descending, cut)
    renamed = ranks.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
        F.col(value).alias("__v"),
        *[c for c in (ascending, descending) if c],
    )
    on = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)]
    joined = df.join(renamed, [*on, F.col(value) == F.col("__v")], "left")
    return joined.drop("__v", *[f"__g{i}" for i in range(len(group))])
