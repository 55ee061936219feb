"""Lenient numbers and report formats as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from botiquin.functions.text import strip_ws

# A plain decimal number. Spark's casts also take Java suffixes ('1d') and 'nan', so texts are
# checked first.
_NUMBER = r"^[+-]?+(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+\z"


def to_number(c: Column, dtype: str = "decimal(18,2)") -> Column:
    """The text as a number, null where it is none. (FN-7)"""
    return read_number(strip_ws(c), dtype)


def read_number(stripped: Column, dtype: str) -> Column:
    return F.when(stripped.rlike(_NUMBER), stripped.try_cast(dtype))


def to_number_or_zero(c: Column, dtype: str = "decimal(18,2)") -> Column:
    """The text as a number, zero where it is none. (FN-6)"""
    return F.coalesce(to_number(c, dtype), F.lit(0).cast(dtype))


def to_number_lenient(c: Column, default: float | None = None) -> Column:
    """Drop everything but digits, points, commas and dashes, read commas as points. (FN-8)"""
    kept = F.replace(F.regexp_replace(c, r"[^\d.,-]", ""), F.lit(","), F.lit("."))
    return F.coalesce(
        F.when(kept.rlike(_NUMBER), kept.try_cast("double")), F.lit(default).cast("double")
    )


def normalize_id(c: Column, dtype: str = "bigint") -> Column:
    """An id from text: read as a number, decimals cut off, null where it is none. (FN-23)"""
    text = strip_ws(c.cast("string"))
    # Whole texts go straight to the integer type: a double would blur ids above 2^53.
    return F.when(text.rlike(r"^[+-]?+\d++\z"), text.try_cast(dtype)).when(
        text.rlike(_NUMBER), text.try_cast("double").try_cast(dtype)
    )


def format_number(
    c: Column, percent: bool = False, currency: bool = False, decimal_comma: bool = False
) -> Column:
    """Report text of a number; null and not-a-number give a dash. (FN-13)

    Whole numbers carry thousands points; others keep up to two decimals. By default the decimal
    sign is a point as well, as the reports have always shown it; ``decimal_comma`` tells the
    two apart.
    """
    x = c.cast("double") + F.lit(0.0)
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    whole = x == F.floor(x).cast("double")
    if percent:
        # One decimal, none for whole numbers.
        text = F.replace(F.format_number(x, 1), F.lit(","))
        text = F.when(whole, F.substring_index(text, ".", 1)).otherwise(text)
        return F.when(finite, F.concat(text, F.lit("%"))).otherwise("-")
    decimals = F.regexp_replace(F.format_number(x, 2), r"\.?0+$", "")
    text = F.translate(decimals, ",.", ".," if decimal_comma else "..")
    if currency:
        text = F.concat(F.lit("$"), text)
    return F.when(finite, text).otherwise("-")

