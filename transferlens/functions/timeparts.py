"""Calendar parts of unix seconds by arithmetic, so no session time zone can shift them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unix_date(seconds: Column | str) -> Column:
    return F.date_from_unix_date(F.floor(_col(seconds) / DAY).cast("int"))


def unix_hour(seconds: Column | str) -> Column:
    return F.floor(F.pmod(_col(seconds), F.lit(DAY)) / 3600).cast("int")


def unix_slot(seconds: Column | str, width: int) -> Column:
    """Number of the ``width``-second slot; a width that divides a day never straddles midnight."""
    return F.floor(_col(seconds) / width).cast("long")


def to_unix(ts: Column | str) -> Column:
    return F.unix_seconds(_col(ts).cast("timestamp"))
