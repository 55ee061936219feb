"""Dates from mixed texts, report formats and date alerts."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botiquin.contracts import OPEN_ENDED_PHRASE
from botiquin.functions.text import strip_ws, tokens_to_null

# Formats in order of preference, for columns and for single values.
COLUMN_FORMATS = (
    "d/M/yyyy", "d-M-yyyy", "d/M/yyyy HH:mm:ss", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss",
)
# Shapes a general reader takes as well: day first, also with two-digit years (this century up to
# 68), or year first, with one kind of separator, and any of them with a time of day.
_TIME = r"(?:[T ]+\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?: ?(?:Z|[+-]\d{2}:?\d{2}))?)?"
_SHAPES = (
    (r"(\d{1,2})([/.-])(\d{1,2})\2(\d{4})", "$4-$3-$1"),
    (r"(\d{1,2})([/.-])(\d{1,2})\2([0-5]\d|6[0-8])", "20$4-$3-$1"),
    (r"(\d{1,2})([/.-])(\d{1,2})\2(69|[7-9]\d)", "19$4-$3-$1"),
    (r"(\d{4})([/.-])(\d{1,2})\2(\d{1,2})", "$1-$3-$4"),
)
VALUE_FORMATS = ("d/M/yyyy", "d-M-yyyy", "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")



def _shape(fmt: str) -> str:
    """A regular expression for the digits and separators of a format."""
    return re.sub(
        r"([a-zA-Z])\1*",
        lambda part: r"\d{1,2}" if len(part[0]) == 1 else rf"\d{{{len(part[0])}}}",
        fmt,
    )


def parse_date(c: Column, formats: tuple[str, ...] = COLUMN_FORMATS) -> Column:
    """The date in whichever format fits each value, null when none does. (FN-9)

    The formats are optional sections of one pattern, so a value is read once. Texts of another
    shape are not tried, as a failed read costs many times a look at the shape.
    """
    return read_date(strip_ws(c), formats)


def read_date(stripped: Column, formats: tuple[str, ...] = COLUMN_FORMATS) -> Column:
    if formats == COLUMN_FORMATS:
        return _read_any(stripped)
    # A longer format has to come before the one it starts with.
    sections = "".join(f"[{fmt}]" for fmt in sorted(formats, key=len, reverse=True))
    shapes = "|".join(_shape(fmt) for fmt in formats)
    dated = stripped.rlike(rf"^(?:{shapes})\z")
    return F.when(dated, F.try_to_date(stripped, sections))


def _read_any(stripped: Column) -> Column:
    """Every shape in one look: the parts are put in order and read as year, month and day."""
    ordered = stripped
    for shape, order in _SHAPES:
        ordered = F.regexp_replace(ordered, rf"^{shape}{_TIME}\z", order)
    return F.when(ordered.rlike(r"^\d{4}-\d{1,2}-\d{1,2}\z"), F.try_to_date(ordered, "yyyy-M-d"))


def first_values(df: DataFrame, columns: list[str], order: Column) -> dict[str, str | None]:
    """For each column its first text that is not blank, in one pass; one row reaches the driver."""
    texts = {c: tokens_to_null(strip_ws(F.col(c))) for c in columns}
    firsts = [
        F.min_by(text, F.when(text.isNotNull(), order)).alias(f"v{i}") for i, text in enumerate(texts.values())
    ]
    found = df.agg(*firsts).first()
    return {c: found[f"v{i}"] for i, c in enumerate(columns)}


def shape_of(value: str) -> str:
    """A regular expression for texts with the separators of this one and as wide numbers.

    Days, months and hours may have one digit or two.
    """
    def digits(number: re.Match) -> str:
        width = len(number[0])
        return r"\d{1,2}" if width < 3 else rf"\d{{{width}}}" if width == 4 else r"\d+"

    return "".join(
        digits(part) if part[0].isdigit() else re.escape(part[0]) for part in re.finditer(r"\d+|\D+", value)
    )


def parse_dates(
    df: DataFrame, columns: list[str], strict_first_format: bool = False, order: Column | None = None
) -> DataFrame:
    """Parse the columns in place. (FN-9)

    By default every value is read in whichever format it has. ``strict_first_format`` goes by the
    column's first value in the given order (by default the place in the extract): the others are
    read only if they have its shape, so a column that begins with year first keeps no day first
    dates. If the first value is no date, every value is read by itself.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return df
    firsts: dict[str, str | None] = {}
    if strict_first_format:
        firsts = first_values(df, columns, F.col("_row") if order is None else order)
        # One row: which of the first values are dates.
        texts = [F.lit(firsts[c]).cast("string") for c in columns]
        dated = df.sparkSession.range(1).select(*[_read_any(t).isNotNull() for t in texts]).first()
        firsts = {c: firsts[c] if ok else None for c, ok in zip(columns, dated)}
    df = df.withColumns({c: strip_ws(F.col(c)) for c in columns})

    def read(c: str) -> Column:
        value = read_date(F.col(c))
        return F.when(F.col(c).rlike(f"^{shape_of(firsts[c])}\\z"), value) if firsts.get(c) else value

    return df.withColumns({c: read(c) for c in columns})


def parse_date_or_phrase(c: Column) -> tuple[Column, Column]:
    """A single value's date, and the text of an open-ended due date. (FN-10)"""
    phrase = F.when(F.upper(c).contains(OPEN_ENDED_PHRASE), c)
    return F.when(phrase.isNull(), parse_date(c, VALUE_FORMATS)), phrase


def date_text(c: Column) -> Column:
    """dd/mm/yyyy, null stays null. (FN-11)"""
    return F.date_format(c, "dd/MM/yyyy")


def report_date(c: Column, pattern: str = "dd/MM/yyyy") -> Column:
    """Report text of a date, a dash for none. (FN-12)"""
    return F.coalesce(F.date_format(c, pattern), F.lit("-"))


def date_alert(c: Column, as_of: dt.date, soon_days: int = 15) -> Column:
    """sin fecha / vencida / próxima / en plazo. (FN-19)"""
    days = F.datediff(c, F.lit(as_of))
    return (
        F.when(c.isNull(), "sin fecha")
        .when(days < 0, "vencida")
        .when(days <= soon_days, "próxima")
        .otherwise("en plazo")
    )
