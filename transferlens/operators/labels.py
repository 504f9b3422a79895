"""Address labels: joining them to both sides of a transfer, and merging label sets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.functions.classify import UNKNOWN

# Addresses that no label file carries.
BURN_LABELS = (
    ("0x000000000000000000000000000000000000dead", "Dead Address", "Burn"),
    ("0x0000000000000000000000000000000000000000", "Null Address", "Burn"),
)


def with_labels(
    df: DataFrame,
    labels: DataFrame,
    sides: Sequence[str] = ("from", "to"),
    missing: str | None = UNKNOWN,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """Adds ``{side}_label`` and ``{side}_category`` for each ``{side}_address``.

    ``labels`` is (address, label_name, label_category), one row per address; ``extra`` carries
    more of its columns over, as ``{side}_{name}``. The join has no broadcast hint on purpose: a
    label set below the session's broadcast threshold is broadcast by its statistics, a larger
    one is shuffled with adaptive skew splitting.
    """
    carried = {"label_name": "label", "label_category": "category", **(extra or {})}
    for side in sides:
        names = {column: f"{side}_{name}" for column, name in carried.items()}
        dim = labels.select(
            F.col("address").alias(f"{side}_address"), *[F.col(c).alias(n) for c, n in names.items()]
        )
        df = df.join(dim, f"{side}_address", "left")
        if missing is not None:
            df = df.fillna(missing, list(names.values()))
    return df


def merge_labels(file_labels: DataFrame | None, spark=None) -> DataFrame:
    """File rows plus the fixed burn addresses; the file wins where both name an address."""
    spark = spark or file_labels.sparkSession
    fixed = spark.createDataFrame(BURN_LABELS, "address string, label_name string, label_category string")
    if file_labels is None:
        return fixed
    known = file_labels.select("address", "label_name", "label_category")
    return latest_per_key(
        known.withColumn("__at", F.lit(1)).unionByName(fixed.withColumn("__at", F.lit(0))), ["address"], ["__at"]
    ).drop("__at")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the one that is last by ``order``, then by its own content.

    An aggregate rather than a window, so copies of a hot key fold before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order], *rest)
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("__row"))
    return picked.select(*keys, "__row.*").select(*df.columns)


def dominant(df: DataFrame, keys: Sequence[str], value: Sequence[str], unwanted: Column) -> DataFrame:
    """Most frequent ``value`` per key; ``unwanted`` values only where there is nothing else.

    Ties go to the value that sorts first, so the result does not depend on row order.
    """
    votes = df.groupBy(*keys, *value).agg(F.count(F.lit(1)).alias("__n"))
    best = votes.groupBy(*keys).agg(elected(value, "__n", unwanted).alias("__best"))
    return best.select(*keys, "__best.*")


def elected(value: Sequence[str], votes: str, unwanted: Column) -> Column:
    """The ``value`` with most ``votes`` as an aggregate over rows that count votes already, one per value."""
    # min_by over (unwanted, -count, value) is the vote order written as one comparable struct
    return F.min_by(F.struct(*value), F.struct(unwanted.alias("u"), (-F.col(votes)).alias("n"), *value))
