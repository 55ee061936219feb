"""Contents compared by digest, pages by place, drifted files, headers and encodings of extracts."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botiquin.operators import drift, merge, paging, reconcile
from botiquin.plans import loads, sync
from botiquin.plans.board import BoardInputs, board
from botiquin.sources import csv
from botiquin.sources.store import TableStore
from tests.test_plans import TODAY, line, table

SCHEMA = "k int, j string, a string, b double, c decimal(18,2)"


def numbered(n):
    return [(i, f"j{i % 3}" if i % 7 else None, f"a{i}", i / 2, None) for i in range(n)]


def differences(source, target, **options):
    got = reconcile.content_differences(source, target, ["k", "j"], **options)
    return {(r.k, r.j): (r.diferencia, r.columnas) for r in got.collect()}


def test_one_changed_cell_is_found(spark):
    rows = numbered(500)
    source = spark.createDataFrame(rows, SCHEMA)
    changed = [(*r[:2], "x" if r[0] == 77 else r[2], *r[3:]) for r in rows]
    target = spark.createDataFrame(random.Random(1).sample(changed, 500), SCHEMA).repartition(7)
    assert differences(source, target) == {(77, None): ("cambiada", "a")}
    assert len(reconcile.differing_buckets(source, target, ["k", "j"], 1024)) == 1
    assert differences(source, source.repartition(5)) == {}


def test_equal_counts_with_other_rows(spark):
    rows = numbered(50)
    other = [*rows[1:], (99, "new", None, None, None)]
    source, target = (spark.createDataFrame(r, SCHEMA) for r in (rows, other))
    assert differences(source, target) == {(0, None): ("falta", ""), (99, "new"): ("sobra", "")}


def test_cells_that_swap_or_move_to_another_column(spark):
    schema = "k int, j string, a string, b string"
    source = spark.createDataFrame([(1, "x", None, "v"), (2, "x", "p", "q"), (3, "x", "s", "t")], schema)
    target = spark.createDataFrame([(1, "x", "v", None), (2, "x", "q", "p"), (3, "x", "s", "t")], schema)
    assert differences(source, target) == {(1, "x"): ("cambiada", "a,b"), (2, "x"): ("cambiada", "a,b")}


def test_repeated_keys_types_and_skipped_columns(spark):
    source = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (2, "y", 3)], "k int, j string, n int").withColumn("id", F.lit(1))
    target = spark.createDataFrame([(1, "x", 2), (1, "x", 2), (2, "y", 3)], "k long, j string, n long").withColumn("id", F.lit(9))
    assert differences(source, target) == {(1, "x"): ("cambiada", "n")}
    assert differences(source.limit(0), target.limit(0)) == {}
    zeros = [spark.createDataFrame([(1, "x", z)], "k int, j string, b double") for z in (0.0, -0.0)]
    assert differences(*zeros) == {}


def test_stores_are_compared_by_table(spark, tmp_path):
    source, target = TableStore(spark, str(tmp_path / "a")), TableStore(spark, str(tmp_path / "b"))
    rows = spark.createDataFrame([("A", 1), (None, 2)], "codigo string, n int")
    source.refresh("stock_critico", rows)
    target.refresh("stock_critico", rows.withColumn("n", F.lit(2)))
    got = sync.verify_content(source, target).collect()
    assert [tuple(r) for r in got] == [("stock_critico", '{"codigo":"A"}', "cambiada", "n")]


def test_digest_diff_equals_the_plain_one(spark):
    draw = random.Random(4)
    rows = numbered(300)
    original = spark.createDataFrame(rows, SCHEMA)
    edited = [(*r[:2], draw.choice([r[2], r[2], None, "e"]), draw.choice([r[3], r[3], -0.0]), r[4]) for r in rows]
    edited = spark.createDataFrame([*edited, (None, "new", None, None, None)], SCHEMA)
    plain = merge.changed_rows(edited, original, ["k", "j"])
    by_digest = reconcile.changed_rows_by_digest(edited, original, ["k", "j"])
    assert sorted(map(str, by_digest.collect())) == sorted(map(str, plain.collect()))
    assert reconcile.changed_rows_by_digest(original, original, ["k", "j"]).count() == 0


@pytest.mark.parametrize("ranges", [1, 7])
def test_every_page_by_place(spark, tmp_path, ranges):
    draw = random.Random(ranges)
    rows = [(draw.choice([None, *range(40)]), f"{draw.randrange(10**6)}") for _ in range(503)]
    df = spark.createDataFrame(rows, "k int, j string")
    index = paging.PageIndex.build(df, ["k", "j"], str(tmp_path / "pages"), ranges)
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert index.total == 503
    for number in (1, 2, 5, 10, 11, 12):
        assert [tuple(r) for r in index.page(number, 50).collect()] == want[(number - 1) * 50 : number * 50]
    again = paging.PageIndex.open(spark, df.schema, ["k", "j"], str(tmp_path / "pages"))
    assert [tuple(r) for r in again.page(3, 100).collect()] == want[200:300]
    plan = index.page(5, 50)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_tramo" in plan


def test_only_drifted_files_are_written_again(spark, tmp_path):
    contract = T.StructType().add("id", T.LongType()).add("item", T.StringType())
    files = []
    for n in range(9):
        kind = {4: "int", 7: "bigint"}.get(n, "string")
        df = spark.range(n * 10, n * 10 + 10).select("id", F.col("id").cast(kind).alias("item"))
        df = df.withColumn("extra", F.lit(1)) if n == 8 else df
        df.coalesce(1).write.parquet(str(tmp_path / f"f{n}"))
        files += csv.data_files(spark, str(tmp_path / f"f{n}"))
    kept, drifts = drift.rewrite_drifted(spark, files, contract, str(tmp_path / "text"))
    assert sorted((len(d.files), *d.columns.items()) for d in drifts) == [
        (1, ("extra", "int")), (1, ("item", "bigint")), (1, ("item", "int"))]
    assert len(kept) == 7 and kept[:6] == [f for f in files if f not in {p for d in drifts for p in d.files}]
    rows = spark.read.schema(contract).parquet(*kept).collect()
    assert sorted((r.id, r.item) for r in rows) == [(n, str(n)) for n in range(90)]
    report = drift.drift_report(spark, drifts, contract).collect()
    assert {(r.columna, r.tipo, r.esperado) for r in report} == {
        ("item", "int", "string"), ("item", "bigint", "string"), ("extra", "int", None)}
    assert drift.rewrite_drifted(spark, kept[:3], contract, str(tmp_path / "none")) == (kept[:3], [])


def test_headers_of_many_files_in_one_job(spark, tmp_path):
    long_body = "x;" * 3 + "\n"
    for n in range(30):
        break_in = '"Id\nLlamado"' if n % 10 == 0 else "Id Llamado"
        (tmp_path / f"stock_{n}.csv").write_bytes(
            (f"{break_in};Año;c{n % 2}\n" + long_body * 3000).encode("utf-8" if n % 3 else "latin-1"))
    files = csv.find_files(spark, str(tmp_path), "stock")
    found = csv.first_records(spark, files)
    assert len(found) == 30 and {r.count(b"\n") for r in found.values()} == {0, 1}
    groups = csv._header_groups(spark, files, None)
    assert {headers for _, headers, _ in groups} == {("Id Llamado", "Año", "c0"), ("Id Llamado", "Año", "c1")}
    assert sum(map(len, groups.values())) == 30
    assert csv.read_extract(spark, files).count() == 30 * 3000


def test_names_with_blanks_and_an_empty_file(spark, tmp_path):
    (tmp_path / "Año 1 + stock%20.csv").write_text("a,b\n1,2\n")
    files = csv.find_files(spark, str(tmp_path), "stock")
    assert csv.read_extract(spark, files).columns == ["a", "b", csv.ROW]
    (tmp_path / "z stock.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        csv.read_extract(spark, csv.find_files(spark, str(tmp_path), "stock"))


def test_bytes_that_only_windows_knows(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Código,precio\nñ “uno” – 5 €,1\n".encode("cp1252"))
    (tmp_path / "b.csv").write_bytes("Código,precio\nñ “uno” – 5 €,1\n".encode("utf-8"))
    df = csv.read_extract(spark, str(tmp_path))
    assert [r[0] for r in df.collect()] == ["ñ “uno” – 5 €"] * 2


def test_files_hidden_by_an_exact_name_are_named(spark, tmp_path):
    for name in ("pedidos.csv", "pedidos_2.csv", "mis pedidos.csv", "stock 1.csv"):
        (tmp_path / name).write_text("Nro. Pedido,Código\n1,A\n")
    store = TableStore(spark, str(tmp_path / "store"))
    got = {r.name: r for r in loads.load_folder(spark, str(tmp_path), store)}
    assert got["pedidos"].hidden == ("mis pedidos.csv", "pedidos_2.csv") and got["pedidos"].rows == 1
    assert got["stock"].hidden == ()


def test_hot_code_is_split(spark):
    """One code holds most lines: the join to its stock is split over tasks, and rows stay whole."""
    n = 40_000
    lines = spark.range(n).select(
        F.col("id").cast("int").alias("id_llamado"), F.lit("L").alias("licitacion"), F.lit("P").alias("proveedor"),
        F.when(F.col("id") % 10 > 0, "HOT").otherwise(F.concat(F.lit("C"), "id")).alias("codigo"),
        F.lit("1").alias("item"), F.lit(1).cast("decimal(18,2)").alias("cantidad_maxima"),
    )
    execution = table(spark, "ejecucion", [line(1, "A")]).limit(0).unionByName(lines, allowMissingColumns=True)
    stock = table(spark, "stock_critico", [{"codigo": "HOT"}, {"codigo": "C10"}])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        df = board(BoardInputs(execution=execution, stock=stock), TODAY, ("id_llamado", "codigo", "dmp_actual"))
        assert df.count() == n
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
