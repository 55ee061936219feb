"""Dedupe, filters, paging, merge and quality on small frames."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botiquin.operators import dedupe, filters, merge, paging, quality


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


ITEMS = [
    (1, 10, "L", " A ", "1"),
    (2, 10, "L", "A", "1 "),
    (3, 10, "L", "A", None),
    (4, 10, "L", "A", None),
    (5, 10, "L", "  ", "1"),
    (6, 10, "L", None, "1"),
    (7, 10, "L ", "A", "1"),
    (8, None, "L", "A", "1"),
    (9, None, "L", "A", "1"),
]


@pytest.fixture
def items(spark):
    schema = "id int, id_llamado int, licitacion string, codigo string, item string"
    return spark.createDataFrame(ITEMS, schema).repartition(4)


def test_latest_item(items):
    """Codes and items compare trimmed, names as they are, and nulls are one key."""
    assert [r[0] for r in rows(dedupe.latest_items(items), "id")] == [2, 4, 7, 9]


def test_delete_older_keeps_rows_without_code(items):
    keys = ("id_llamado", "licitacion", "codigo", "item")
    once = dedupe.delete_older(items, keys)
    assert [r[0] for r in rows(once, "id")] == [2, 4, 5, 6, 7, 9]
    assert rows(dedupe.delete_older(once, keys), "id") == rows(once, "id")


def test_audit_counts_keys_with_nulls(items):
    got = dedupe.duplicate_audit(items, "ejecucion", ("id_llamado", "licitacion", "codigo", "item"))
    assert rows(got) == [("ejecucion", 7, 4)]


def test_newest_date(spark):
    day = dt.date(2024, 3, 5)
    df = spark.createDataFrame(
        [
            (1, "a", "1", None), (2, "a", "1", day), (3, "a", "1", day),
            (4, "b", "1", None), (5, "b", "1", None), (6, None, "1", day), (7, None, "1", None),
        ],
        "_row int, oc string, item string, f date",
    ).repartition(3)
    got = dedupe.keep_newest_date(df, ("oc", "item", "codigo"), F.col("f"))
    assert [r[0] for r in rows(got, "_row")] == [2, 4, 6]
    # one key column is not enough
    assert dedupe.keep_newest_date(df.drop("item"), ("oc", "item"), F.col("f")).count() == 7


def test_first_by_input_order(spark):
    data = [(i, random.Random(i).choice("abc"), str(i % 2)) for i in range(200)]
    df = spark.createDataFrame(data, "_row int, k string, n string").repartition(5)
    first = {}
    for row in data:
        first.setdefault(row[1:], row)
    assert rows(dedupe.keep_first(df, ("k", "n", "no")), "_row") == sorted(first.values())
    assert dedupe.keep_first(df, ("no",)).count() == 200


def test_most_complete(spark):
    df = spark.createDataFrame(
        [(1, None, "x", None), (1, "a", None, "z"), (2, None, "q", None), (2, None, "p", None)],
        "id_llamado int, a string, b string, c string",
    )
    assert rows(dedupe.keep_most_complete(df, ("id_llamado", "item")), "id_llamado") == [
        (1, "a", None, "z"), (2, None, "p", None),
    ]


def test_copies_are_cut_before_the_shuffle(spark, items):
    """A key with very many copies sends one row per task."""
    text = plan(dedupe.latest_items(items))
    assert "Partial" in text and text.index("Final") < text.index("Partial")
    hot = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id")).alias("k"), "id"
    )
    got = dedupe.keep_latest(hot, ["k"])
    assert got.where("k = 7").first().id == 89_999
    assert got.count() == 30_000 + 1


def test_filters(spark):
    as_of = dt.date(2024, 3, 5)
    days = [as_of, as_of - dt.timedelta(1), None, dt.date(5000, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    kept = df.where(filters.unexpired(F.col("d"), as_of))
    assert {r.d for r in kept.collect()} == {days[0], None, days[3]}
    states = [
        "entregado", " FINALIZADO ", "Completado", "completada", "Entrega Parcial",
        "entrega total", None, "Pendiente", "entregado en parte",
    ]
    df = spark.createDataFrame([(s,) for s in states], "s string")
    assert [r.s for r in df.where(filters.open_order(F.col("s"))).collect()] == states[6:]
    words = [("Pendiente",), ("PENDIENTE de firma",), (None,), ("x",)]
    df = spark.createDataFrame(words, "s string")
    assert df.where(filters.mentions(F.col("s"))).count() == 2
    df = spark.createDataFrame([(0.9,), (1.0,), (None,), (-1.0,)], "x double")
    assert df.where(filters.low_coverage(F.col("x"))).count() == 2
    assert df.where(filters.positive(F.col("x"))).count() == 2
    assert filters.grid_contains(df, "x", "1").count() == 2
    assert filters.choose(df, "x", None).count() == 4
    assert filters.choose(df, "x", 1.0).count() == 1


def test_order_puts_nulls_last(spark):
    df = spark.createDataFrame([(None,), (1,), (2,)], "n int")
    assert [r.n for r in paging.sort_board(df, ["n"]).collect()] == [1, 2, None]
    assert [r.n for r in paging.sort_by(df, "n").collect()] == [2, 1, None]
    assert paging.sort_by(df, "no") is df


def test_pages_cover_everything_once(spark):
    data = [(i // 7, i % 7) for i in range(95)]
    df = spark.createDataFrame(random.Random(1).sample(data, len(data)), "a int, b int")
    pages = [rows(paging.page(df, ["a", "b"], p, 30)) for p in (1, 2, 3, 4, 5)]
    assert sum(pages, []) == data
    assert rows(paging.page_after(df, ["a", "b"], pages[0][-1], 30)) == pages[1]
    assert rows(paging.page_after(df, ["a", "b"], data[-1], 30)) == []


def test_asked_rows(spark):
    assert paging.capped(spark.range(20_000), 18_000).count() == 18_000
    assert paging.capped(spark.range(20_000), 10).count() == 10


def test_key_paging_covers_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a"), (None, "b"), (None, None)], "k int, s string")
    seen = [tuple(r) for r in paging.sort_board(df, ["k", "s"]).limit(1).collect()]
    while len(seen) < 9:
        after = [tuple(r) for r in paging.page_after(df, ["k", "s"], seen[-1], 1).collect()]
        if not after:
            break
        seen += after
    assert seen == [(1, "a"), (1, None), (2, "a"), (None, "b"), (None, None)]


REQUESTED = "id_llamado int, licitacion string, codigo string, item string, cantidad int, nota string"
KEY = ["id_llamado", "licitacion", "codigo", "item"]


def test_upsert(spark):
    base = spark.createDataFrame(
        [(1, "L", "A", "1", 5, "queda"), (2, "L", "A", "1", 6, None)], REQUESTED
    )
    updates = spark.createDataFrame(
        [(1, "L", "A", "1", 7, 1), (1, "L", "A", "1", None, 2), (3, "L", "A", "", 9, 1)],
        "id_llamado int, licitacion string, codigo string, item string, cantidad int, t int",
    )
    got = merge.upsert(base, updates, KEY, newest=("t",))
    want = [
        (1, "L", "A", "1", None, "queda"), (2, "L", "A", "1", 6, None), (3, "L", "A", "", 9, None),
    ]
    assert rows(got, "id_llamado") == want
    assert rows(merge.upsert(got, updates, KEY, newest=("t",)), "id_llamado") == want
    assert got.schema == base.schema


def test_edit_rows(spark):
    edits = spark.createDataFrame(
        [
            ("12.0", " L ", " A", None, "7.5", "5/3/2024"),
            (None, "L", "A", "1", "1", None),
            ("1", "L", None, "1", "1", None),
            ("x", "L", "A", "1", "1", None),
            ("2", None, "A", " 2-2.2 ", "mucho", "nunca"),
        ],
        "id_llamado string, licitacion string, codigo string, item string, "
        "cantidad_solicitada string, ver_en_fecha string",
    )
    got = rows(merge.edit_rows(edits), "id_llamado")
    assert [(*r[:4], float(r[4]), r[5]) for r in got] == [
        (2, "", "A", "2-2.2", 0.0, None), (12, "L", "A", "", 7.5, dt.date(2024, 3, 5)),
    ]


def test_changed_rows(spark):
    schema = "k int, item string, n int, f date"
    old = spark.createDataFrame([(1, "a", 1, None), (2, None, 1, None), (3, "c", 1, None)], schema)
    new = spark.createDataFrame(
        [(3, "c", 1, None), (2, None, 2, None), (1, "a", 1, dt.date(2024, 1, 1))], schema
    )
    assert [r[0] for r in rows(merge.changed_rows(new, old, ["k", "item"]), "k")] == [1, 2]
    # Without null-safe keys the row with a missing item counts as new.
    assert [r[0] for r in rows(merge.changed_rows(new, old, ["k", "item"], False), "k")] == [1, 2]
    added = spark.createDataFrame([(9, "z", 1, None)], schema)
    assert [r[0] for r in merge.changed_rows(added, old, ["k", "item"]).collect()] == [9]
    assert merge.changed_rows(old, old, ["k", "item"]).count() == 0


def test_quality(spark):
    df = spark.createDataFrame([("1", None), ("LL", "x"), (None, None)], "id_llamado string, c string")
    assert {tuple(r) for r in quality.quality_report(df, ["c", "z"]).collect()} == {
        ("error", "vacia", "", 0), ("error", "falta", "c", 0), ("error", "falta", "z", 1),
        ("aviso", "no_numerico", "id_llamado", 1), ("aviso", "nulos", "c", 2),
    }
    result = quality.validate(df, "t", ["c", "z"])
    assert not result.ok
    assert result.errors == ["t: faltan columnas z"]
    assert result.warnings == ["t: 1 valores no numéricos en id_llamado", "t: 2 valores nulos en c"]
    assert quality.validate(df.limit(0), "t", ["c"]).errors == ["t: sin filas"]
    assert quality.validate(df, "t", ["id_llamado"]).ok


def test_schema_contract(spark):
    df = spark.createDataFrame([(1, "abc"), (None, "abcd")], "a int, b string")
    contract = T.StructType().add("a", T.IntegerType(), False).add("b", T.StringType())
    contract = contract.add("c", T.DateType())
    assert rows(quality.schema_contract(df, contract, {"b": 3})) == [
        ("a", "int", True, True, False, 1, 0),
        ("b", "string", True, True, True, 0, 1),
        ("c", "date", False, False, True, 0, 0),
    ]


def test_text_columns(spark):
    df = spark.createDataFrame([(1, "x")], "item int, codigo string")
    assert dict(quality.to_text_columns(df, ["item", "codigo"]).dtypes)["item"] == "string"
    assert quality.to_text_columns(df, ["codigo"]) is df


def test_counts(spark):
    got = quality.table_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(got, "tabla") == [("TOTAL", 3, "OK"), ("a", 3, "OK"), ("b", 0, "WARN")]
    got = quality.reconcile({"a": spark.range(3)}, {"a": spark.range(5)})
    assert rows(got) == [("a", 3, 5, False, 2)]
