"""Exact money: raw integer amounts (up to 78 digits, as text) to decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ETH = "decimal(38,18)"

# Base units per coin and per gwei, as powers of ten.
WEI_DIGITS = 18
GWEI_DIGITS = 9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wei_to_eth(value: Column | str, exact: bool = True) -> Column:
    """Raw base units to coins.

    ``exact`` shifts the decimal point in the text, so all 18 places survive; amounts that need
    more than 20 whole digits, and text that is no whole number, become null.
    ``exact=False`` divides, which keeps six places only (99.9999996 becomes 100).
    """
    text = _col(value).cast("string")
    if not exact:
        return (text.try_cast("decimal(38,0)") / F.lit(10**WEI_DIGITS)).cast(ETH)
    return F.when(text.rlike("^0*[0-9]{1,38}$"), _shifted(text))


def _shifted(digits: Column) -> Column:
    """Digits as text, read with the decimal point 18 places from the right."""
    padded = F.right(F.concat(F.lit("0" * 38), digits), F.lit(38))
    return F.concat(padded.substr(1, 20), F.lit("."), padded.substr(21, WEI_DIGITS)).try_cast(ETH)


def fee_eth(gas_used: Column | str, gas_price: Column | str) -> Column:
    """gas x price in coins; both factors are widened first because the product leaves bigint."""
    product = _col(gas_used).cast("decimal(19,0)") * _col(gas_price).cast("decimal(19,0)")
    return _shifted(product.cast("decimal(38,0)").cast("string"))


def token_amount(value: Column | str, decimals: Column | str) -> Column:
    """Raw token units to a double. Decimals of 0 stay 0; only a missing value is missing."""
    return _col(value).cast("string").try_cast("double") / F.pow(F.lit(10.0), _col(decimals).cast("double"))


def wei_to_gwei(value: Column | str) -> Column:
    return _col(value).cast("double") / F.lit(float(10**GWEI_DIGITS))


def at_least_eth(value: Column | str, coins: int | float | str) -> Column:
    """``value`` (raw text) >= ``coins``; a missing value counts as zero.

    Compared as digit strings, so 78-digit amounts neither overflow nor lose places.
    """
    from decimal import Decimal

    limit = str(int(Decimal(str(coins)) * 10**WEI_DIGITS))
    raw = F.coalesce(_col(value).cast("string"), F.lit("0"))
    digits = F.regexp_extract(raw, r"^0*([0-9]+)$", 1)
    size = F.length(digits)
    return (size > len(limit)) | ((size == len(limit)) & (digits >= F.lit(limit)))
