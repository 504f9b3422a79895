"""Compaction of aged day folders: many small files become few, sorted by one column, and readers skip files by its range.

All days to do are rewritten by one job into a hidden folder beside the table. Then each day is swapped by renames: the old folder is set aside, the
new one takes its name and is marked, the old one goes. A day carries a mark file (hidden from readers) named after the files that it
was made of; a day that got files since is compacted again. A run that is broken off at any point is ended by the next one: a rewrite
that is not complete is thrown away, a day whose old folder is aside and whose name is free gets the new folder, or else its old one back.
Between the two renames of a day a reader does not see it.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens.sources.folders import children, delete, exists, move, system_of, touch
from transferlens.sources.sinks import write_clustered

#: Hidden folders beside the days: new forms, and old ones on their way out.
FRESH, ASIDE = "_compacting", "_aside"
MARK, COMPLETE = "_compacted", "_complete"


def _days(spark: SparkSession, root: str) -> list[str]:
    return [name for name in children(spark, root) if name.startswith("dt=")]


def _data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Data files of one folder and when they were written."""
    system, path = system_of(spark, folder)
    found = [(s.getPath().getName(), s.getModificationTime()) for s in system.listStatus(path)] if system.exists(path) else []
    return sorted((n, t) for n, t in found if not n.startswith(("_", ".")))


def is_compacted(spark: SparkSession, root: str, day: str) -> bool:
    """Whether the day's folder is marked and has got no file since."""
    folder = f"{root}/{day}"
    return exists(spark, f"{folder}/{MARK}-{len(_data_files(spark, folder))}")


def aged_days(spark: SparkSession, root: str, as_of: date, age_days: int = 7) -> list[str]:
    """Day folders older than ``age_days`` that are not compacted."""
    oldest = f"dt={(as_of - timedelta(days=age_days)).isoformat()}"
    return [day for day in _days(spark, root) if day < oldest and not is_compacted(spark, root, day)]


def set_aside(spark: SparkSession, root: str, day: str) -> None:
    """First half of a swap: the day's old folder leaves its place."""
    move(spark, f"{root}/{day}", f"{root}/{ASIDE}/{day}")


def put_in_place(spark: SparkSession, root: str, day: str) -> None:
    """Second half: the new folder takes the place, marked, and the old one goes."""
    fresh = f"{root}/{FRESH}/{day}"
    touch(spark, f"{fresh}/{MARK}-{len(_data_files(spark, fresh))}")
    move(spark, fresh, f"{root}/{day}")
    delete(spark, f"{root}/{ASIDE}/{day}")


def recover(spark: SparkSession, root: str) -> None:
    """Ends the swaps of a run that was broken off, and drops what it left."""
    complete = exists(spark, f"{root}/{FRESH}/{COMPLETE}")
    for day in children(spark, f"{root}/{ASIDE}"):
        if exists(spark, f"{root}/{day}"):
            delete(spark, f"{root}/{ASIDE}/{day}")  # the new folder is in place
        elif complete and exists(spark, f"{root}/{FRESH}/{day}"):
            put_in_place(spark, root, day)
        else:
            move(spark, f"{root}/{ASIDE}/{day}", f"{root}/{day}")
    delete(spark, f"{root}/{ASIDE}")
    # what is left of it was not swapped and may be older than the days are now
    delete(spark, f"{root}/{FRESH}")


def rewrite(spark: SparkSession, root: str, days: list[str], schema: T.StructType, segment_by: str, order_by: str) -> None:
    """The new form of these days, by one job into the hidden folder."""
    rows = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{day}" for day in days])
    write_clustered(rows, f"{root}/{FRESH}", segment_by, order_by, ("dt",))
    new = spark.read.schema(schema).parquet(f"{root}/{FRESH}").where(F.col("dt").isNotNull())
    if new.count() != rows.count():  # footers only
        raise RuntimeError(f"the new form of {root} has other rows than the days it was made of")
    touch(spark, f"{root}/{FRESH}/{COMPLETE}")


def compact(spark: SparkSession, root: str, schema: T.StructType, as_of: date, segment_by: str, order_by: str, age_days: int = 7) -> list[str]:
    """Compacts the aged days of a table; returns them. ``schema`` includes ``dt``. Running it again does nothing more."""
    recover(spark, root)
    days = aged_days(spark, root, as_of, age_days)
    if not days:
        return []
    before = {day: _data_files(spark, f"{root}/{day}") for day in days}
    rewrite(spark, root, days, schema, segment_by, order_by)
    done = []
    for day in days:
        if before[day] != _data_files(spark, f"{root}/{day}"):
            continue  # written to meanwhile: the next run takes it
        if not exists(spark, f"{root}/{FRESH}/{day}"):
            continue  # a day without rows has no new form
        set_aside(spark, root, day)
        put_in_place(spark, root, day)
        done.append(day)
    recover(spark, root)
    return done
