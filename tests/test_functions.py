"""Column functions on hand-made cells."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from botiquin.functions import dates, numbers, stock, text


def values(spark, cells, fn, dtype="string"):
    """fn over one column, in the order of the cells."""
    rows = [(i, c) for i, c in enumerate(cells)]
    df = spark.createDataFrame(rows, f"i int, c {dtype}")
    return [r.v for r in df.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


TOKENS = ["nan", " NaT ", "None", "NaN", "NAN", "", "  ", "\t x ", "#N/A", None, "n/a"]


def test_blank_tokens(spark):
    assert values(spark, TOKENS, text.blank_to_null) == [
        None, None, None, None, "NAN", None, None, "x", "#N/A", None, "n/a",
    ]
    assert values(spark, TOKENS, text.blank_to_empty) == [
        "", "", "", "", "NAN", "", "", "x", "#N/A", "", "n/a",
    ]
    assert values(spark, TOKENS, text.null_words_to_null) == [
        None, None, None, None, None, None, None, "x", "#N/A", None, None,
    ]


def test_cell_tokens_are_exact(spark):
    cells = ["", " ", "  ", "NULL", "Null", "#REF!", " None", "x"]
    assert values(spark, cells, text.cell_tokens_to_null) == [
        None, None, "  ", None, "Null", None, " None", "x",
    ]


def test_sanitize_order(spark):
    """Quotes are doubled before the cut, and the cut comes before the trim."""
    assert values(spark, ["it's", " abcdef", None], lambda c: text.sanitize(c, 4)) == [
        "it''", "abc", None,
    ]


NUMBERS = ["12", " 12.5 ", "1e5", "1.234,50", "1,5", "-3", "2-2.2", "1d", "nan", "", None, "+.5"]


def test_numbers(spark):
    d = decimal.Decimal
    assert values(spark, NUMBERS, numbers.to_number) == [
        d("12.00"), d("12.50"), d("100000.00"), None, None, d("-3.00"), None, None, None, None,
        None, d("0.50"),
    ]
    assert values(spark, NUMBERS, numbers.to_number_or_zero)[3:5] == [d("0.00"), d("0.00")]


def test_lenient_numbers(spark):
    cells = ["Gs. 1,5", "1.234,5", "2-2.2", "abc", None, "-7", "5."]
    assert values(spark, cells, lambda c: numbers.to_number_lenient(c, 0.0)) == [
        # the first point belongs to the word before the number
        0.0, 0.0, 0.0, 0.0, 0.0, -7.0, 5.0,
    ]


def test_ids(spark):
    cells = ["123", " 123.9 ", "-4.7", "1e3", "LL-2", "", None, "9007199254740993", "1d"]
    assert values(spark, cells, numbers.normalize_id) == [
        123, 123, -4, 1000, None, None, None, 9007199254740993, None,
    ]


def python_format(value, percent=False, currency=False):
    """The report format, spelled out in plain Python."""
    if value is None or value != value or value in (float("inf"), float("-inf")):
        return "-"
    if percent:
        return f"{int(value)}%" if value == int(value) else f"{value:.1f}%"
    if value == int(value):
        out = f"{int(value):,}".replace(",", ".")
    else:
        out = f"{value:,.2f}".rstrip("0").rstrip(".").replace(",", ".")
    return f"${out}" if currency else out


FORMATS = [
    0.0, -0.0, 5.0, 999.0, 1000.0, -1234567.0, 1234.56, 0.125, 2.675, 1200.004, 0.004, -0.001,
    100.1, -1234.5, 1e15, 999.999, None, float("nan"), float("inf"),
]


@pytest.mark.parametrize("kind", [{}, {"percent": True}, {"currency": True}])
def test_number_format(spark, kind):
    got = values(spark, FORMATS, lambda c: numbers.format_number(c, **kind), "double")
    assert got == [python_format(x, **kind) for x in FORMATS]


def test_number_format_decimal_comma(spark):
    got = values(spark, [1234.56, 1234.0], lambda c: numbers.format_number(c, decimal_comma=True),
                 "double")
    assert got == ["1.234,56", "1.234"]


DATES = [
    "05/03/2024", "5/3/2024", "05-03-2024", "2024-03-05", "05/03/2024 10:11:12", "31/02/2024",
    "31/12/5000", "x", " NaT ", None, "2024-03-05 00:00:00",
]
DAY = dt.date(2024, 3, 5)


def test_dates(spark):
    assert values(spark, DATES, dates.parse_date) == [
        DAY, DAY, DAY, DAY, DAY, None, dt.date(5000, 12, 31), None, None, None, DAY,
    ]
    assert values(spark, ["5/3/2024", "x"], lambda c: dates.report_date(dates.parse_date(c))) == [
        "05/03/2024", "-",
    ]


def test_one_format_per_column(spark):
    """The first value that is not blank gives the format, whatever stands behind it."""
    rows = [
        (3, "5/3/2024", "y", "2024-03-05 00:00:00", "2024-03-05", "2024-03-05"),
        (2, "05-03-2024", "x", "2024-03-05", "05/03/2024", "5/3/24"),
        (1, " nan", None, "", "no date", None),
        (4, "5-3-2024", "NaT", "2024-3-5", "5-3-2024", "2024-03-05"),
    ]
    df = spark.createDataFrame(rows, "_row int, a string, b string, c string, d string, e string")
    got = dates.parse_dates(df, ["a", "b", "c", "d", "e", "no"], strict_first_format=True)
    assert [tuple(r)[1:] for r in got.orderBy("_row").collect()] == [
        (None, None, None, None, None),
        (DAY, None, DAY, DAY, DAY),
        (None, None, None, DAY, None),
        (DAY, None, DAY, DAY, None),
    ]
    iso = spark.createDataFrame([(2, "05/03/2024"), (1, "2024-03-05"), (3, "2024-03-05 10:00:00")], "n int, a string")
    got = dates.parse_dates(iso, ["a"], strict_first_format=True, order=F.col("n")).orderBy("n").collect()
    assert [r.a for r in got] == [DAY, None, None]


def test_open_ended_phrase(spark):
    cells = ["Cumplimiento Total de las Obligaciones.", "5/3/2024", None]
    assert values(spark, cells, lambda c: dates.parse_date_or_phrase(c)[0]) == [None, DAY, None]
    assert values(spark, cells, lambda c: dates.parse_date_or_phrase(c)[1]) == [
        cells[0], None, None,
    ]


def test_date_alerts(spark):
    days = [DAY + dt.timedelta(n) for n in (-1, 0, 15, 16)] + [None]
    assert values(spark, days, lambda c: dates.date_alert(c, DAY), "date") == [
        "vencida", "próxima", "próxima", "en plazo", "sin fecha",
    ]


HEADERS = [
    "Código", " Fec. Últ. Recep. ", "1º Pedido", "select", "2024", "¿?", None, "Año\tÑandú",
    "ﬁn Ⅳ", "ＡＢ", "straße", "a  b", "№ 5", "Table!", "_x",
]


def test_column_names_as_headers_and_as_values(spark):
    plain = [text.clean_column_name(h) for h in HEADERS]
    assert plain[:8] == [
        "codigo", "fec_ult_recep", "o_pedido", "col_select", "unnamed", "unnamed", "unnamed",
        "ano_nandu",
    ]
    assert values(spark, HEADERS, text.clean_name) == plain


def test_traffic_light_order(spark):
    cells = ["Requiere y Normal", "Normal, Atención", "Atención", "Sin DMP", "Óptimo", "otro", None]
    assert values(spark, cells, stock.traffic_light) == [
        "rojo", "verde", "amarillo", "amarillo", "verde", None, None,
    ]
    assert values(spark, cells, lambda c: stock.traffic_light(c, extended=False))[3:5] == [
        None, None,
    ]


def test_display_key_round_trip(spark):
    cells = ["12 - a - b", "12", "x - y", "7 - ", None]
    assert values(spark, cells, lambda c: text.parse_display_key(c)[0]) == [12, 12, None, 7, None]
    assert values(spark, cells, lambda c: text.parse_display_key(c)[1]) == [
        "a - b", "", "y", "", None,
    ]


def test_defaults(spark):
    assert values(spark, [None, "", "NO"], lambda c: text.or_default(c, "SI")) == ["SI", "SI", "NO"]
    assert values(spark, [None, True, False], text.yes_no, "boolean") == ["NO", "SI", "NO"]
