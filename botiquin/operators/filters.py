"""Row filters of the reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botiquin.contracts import CLOSED_STATES, CRITICAL_LEVELS, NO_EXPIRY_YEAR


def unexpired(c: Column, as_of: dt.date) -> Column:
    """Not expired on the day; no date and the no-expiry year count as unexpired. (FIL-3)"""
    return (c >= F.lit(as_of)) | c.isNull() | (F.year(c) == NO_EXPIRY_YEAR)


def open_order(state: Column) -> Column:
    """Still to be delivered, at least in part. (FIL-4)"""
    return state.isNull() | ~F.lower(F.trim(state)).isin(*CLOSED_STATES)


def choose(df: DataFrame, column: str, value: object | None) -> DataFrame:
    """Rows with the value, or all rows when none is chosen. (FIL-5)"""
    return df if value is None else df.where(F.col(column) == F.lit(value))


def critical(level: Column) -> Column:
    """Levels of the critical list. (FIL-6)"""
    return level.isin(*CRITICAL_LEVELS)


def mentions(c: Column, text: str = "pendiente") -> Column:
    """Holds the text in any case; null does not. (FIL-7)"""
    return F.coalesce(F.lower(c).contains(text.lower()), F.lit(False))


def low_coverage(c: Column) -> Column:
    """Under one month; unknown coverage is not low. (FIL-8)"""
    return F.coalesce(c, F.lit(999)) < 1


def positive(c: Column) -> Column:
    """Above zero; null is not. (FIL-9)"""
    return F.coalesce(c, F.lit(0)) > 0


def grid_contains(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose cell, number or text, holds the typed text in any case. (FIL-10)"""
    return df.where(F.lower(F.col(column).cast("string")).contains(text.lower()))


def grid_date(df: DataFrame, column: str, day: dt.date) -> DataFrame:
    """Rows with the day in a date column. (FIL-10)"""
    return df.where(F.col(column) == F.lit(day))
