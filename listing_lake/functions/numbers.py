"""Locale numbers, yes/no flags, charges and currency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The answers and currency symbols the source site uses, and the charge limits.
YES_WORDS = ("sí", "si")
NO_WORD = "no"
UF_SYMBOLS = ("uf",)
DOLLAR_SYMBOLS = ("us$", "usd", "usd$")
CHARGE_PLACEHOLDER_BELOW = 1_000.0
CHARGE_IMPLAUSIBLE_FROM = 500_000.0

_PLAIN_NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def try_double(text: Column) -> Column:
    """Number in plain notation, else NULL.

    The shape is checked first because a cast alone also takes ``5d``, ``NaN`` and ``Infinity``.
    """
    return F.when(text.rlike(_PLAIN_NUMBER), text.try_cast("double"))


def parse_cl_number(text: Column) -> Column:
    """``1.234,5`` -> 1234.5: dots group thousands, the comma is the decimal mark."""
    return try_double(F.translate(text, ",.", "."))


def parse_cl_price(text: Column, decimal_comma: bool = False) -> Column:
    """Price with dots as thousands marks.

    By default a decimal comma makes the price unreadable (NULL), as the published prices are whole
    numbers; ``decimal_comma=True`` reads it.
    """
    if decimal_comma:
        return parse_cl_number(text)
    return try_double(F.translate(text, ".", ""))


def parse_yes_no(text: Column) -> Column:
    """1 for yes, 0 for no, NULL for anything else."""
    word = F.lower(text)
    return F.when(word.isin(*YES_WORDS), F.lit(1)).when(word == NO_WORD, F.lit(0)).cast("int")


def parse_common_charges(text: Column) -> Column:
    """Monthly common charges.

    A dot marks real thousands.  Without one, a value below 1,000 stands for "included in the rent"
    and becomes 0, and a value of 500,000 or more is implausible and becomes NULL.
    """
    plain = try_double(text)
    return (
        F.when(text.contains("."), try_double(F.translate(text, ".", "")))
        .when(plain < CHARGE_PLACEHOLDER_BELOW, F.lit(0.0))
        .when(plain >= CHARGE_IMPLAUSIBLE_FROM, F.lit(None).cast("double"))
        .otherwise(plain)
    )


def to_clp(price: Column, currency: Column, uf_rate: Column, dollar_rate: Column) -> Column:
    """Price in pesos.  An unknown or missing currency is taken as pesos; a missing rate gives NULL."""
    symbol = F.lower(currency)
    return (
        F.when(symbol.isin(*UF_SYMBOLS), price * uf_rate)
        .when(symbol.isin(*DOLLAR_SYMBOLS), price * dollar_rate)
        .otherwise(price)
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio for a positive denominator, else NULL."""
    return F.when(denominator > 0, numerator / denominator)


def whole_or_zero(value: Column) -> Column:
    """Count as INT, truncated; missing or unreadable counts are 0."""
    return F.coalesce(value.try_cast("double").try_cast("int"), F.lit(0))
