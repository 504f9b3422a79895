"""Text forms for people: volumes, short addresses, ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit steps of the volume text.
VOLUME_UNITS = ((1e9, " B"), (1e6, " M"), (1e3, " K"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def volume_text(value: Column | str) -> Column:
    """1234.5 -> '1.23 K'; zero and missing -> '0'."""
    value = _col(value).cast("double")
    out = F.format_string("%.2f", value)
    for size, unit in reversed(VOLUME_UNITS):
        out = F.when(value >= size, F.concat(F.format_string("%.2f", value / size), F.lit(unit))).otherwise(out)
    return F.when(value.isNull() | (value == 0), "0").otherwise(out)


def eth_text(value: Column | str) -> Column:
    """1500 -> '1.5K', below a thousand two places."""
    value = _col(value).cast("double")
    return F.when(value >= 1000, F.concat(F.format_string("%.1f", value / 1000), F.lit("K"))).otherwise(
        F.format_string("%.2f", value)
    )


def short_address(address: Column | str) -> Column:
    """First six and last four characters; text under 12 characters stays whole."""
    address = _col(address)
    short = F.concat(F.substring(address, 1, 6), F.lit("…"), F.substring(address, -4, 4))
    return F.when(F.length(address) >= 12, short).otherwise(address)


def age_text(seconds: Column | str, as_of: Column | int) -> Column:
    """Age of a unix time at ``as_of``: 'Just now', '5m ago', '2h ago'."""
    now = F.lit(as_of) if isinstance(as_of, int) else as_of
    age = F.greatest(F.lit(0), now - _col(seconds))
    return (
        F.when(age < 60, "Just now")
        .when(age < 3600, F.concat(F.floor(age / 60).cast("string"), F.lit("m ago")))
        .otherwise(F.concat(F.floor(age / 3600).cast("string"), F.lit("h ago")))
    )


def valid_address(address: Column | str) -> Column:
    return F.coalesce(_col(address).rlike("^0x[0-9a-fA-F]{40}$"), F.lit(False))
