"""Cases in which rows or values used to be lost, doubled or hidden."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from botiquin.functions.dates import parse_date
from botiquin.functions.text import sanitize
from botiquin.operators import merge
from botiquin.plans import editing, loads, sync
from botiquin.plans.board import BoardInputs, board
from botiquin.sources import csv
from botiquin.sources.headers import quoted
from botiquin.sources.store import TableStore
from botiquin.streaming.incremental import follow
from tests.test_plans import TODAY, line, stores, table  # noqa: F401


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def cells(df):
    return sorted(map(str, [tuple(r) for r in df.select(*[quoted(c) for c in df.columns if c != csv.ROW]).collect()]))


def test_every_file_under_its_own_header(spark, tmp_path):
    write(tmp_path / "stock_1.csv", "codigo,parque\nA,uno\n")
    write(tmp_path / "stock_2.csv", "parque;codigo;Otra\ndos;B;x\n")
    files = csv.find_files(spark, str(tmp_path), "stock")
    df = csv.read_extract(spark, files)
    assert df.columns == ["codigo", "parque", "Otra", csv.ROW]
    assert cells(df) == ["('A', 'uno', None)", "('B', 'dos', 'x')"]


def test_rows_with_too_many_cells_are_set_aside(spark, tmp_path):
    path = write(tmp_path / "x.csv", 'a,b\n1,2,3\n4,5\n6\n7,8,,\n"9,0",x\n1,2,,3\n')
    assert cells(csv.read_extract(spark, path)) == [
        "('4', '5')", "('6', None)", "('7', '8')", "('9,0', 'x')"]
    assert sorted(r.registro for r in csv.excess_rows(spark, path).collect()) == ["1,2,,3", "1,2,3"]


def test_line_break_in_a_header(spark, tmp_path):
    path = write(tmp_path / "x.csv", '"Id\nLlamado",b,c\n1,2,3\n')
    df = csv.read_extract(spark, path)
    assert df.columns == ["Id Llamado", "b", "c", csv.ROW] and cells(df) == ["('1', '2', '3')"]


def test_two_blank_headers(spark):
    df = spark.createDataFrame([("1", "x", "y")], ["a", " ", "  "])
    assert csv.repair_extract(df).columns == ["a", "columna_2", "columna_3"]


def test_load_takes_all_files_and_forgets_old_rejects(spark, tmp_path, stores):  # noqa: F811
    store, folder = stores[0], tmp_path / "in"
    folder.mkdir()
    head = "Id. Llamado,Licitación,Codigo,Item,Cantidad Máxima\n"
    write(folder / "ejecucion_1.csv", head + "1,L,A,1,5\nx,L,B,1,5\n")
    write(folder / "ejecucion_2.csv", head + "2,L,C,1,100000000000000000\n3,L,D,1,5,9\n")
    loaded = loads.load_folder(spark, str(folder), store, ["ejecucion"])[0]
    assert (loaded.status, loaded.rows, loaded.set_aside) == ("OK", 2, 2)
    assert "proveedor" in loaded.omitted
    assert store.count("ejecucion_apartados") == store.count("ejecucion_sobrantes") == 1
    write(folder / "ejecucion_1.csv", head + "1,L,A,1,5\n")
    write(folder / "ejecucion_2.csv", head + "2,L,C,1,5\n")
    assert loads.load_folder(spark, str(folder), store, ["ejecucion"])[0].set_aside == 0
    assert store.count("ejecucion_apartados") == store.count("ejecucion_sobrantes") == 0


def test_no_cut_by_default(spark):
    text = "x" * 20_000
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(F.length(sanitize(F.col("t")))).first()[0] == 20_000
    assert df.select(F.length(sanitize(F.col("t"), 10))).first()[0] == 10


@pytest.mark.parametrize("text", ["05/03/2024 0:00", "2024-03-05T10:00:00", "5/3/24", "2024/03/05",
                                  "2024-03-05 10:11:12.123", "05.03.2024", "5-3-2024", "05/03/2024 10:11"])
def test_date_shapes(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(parse_date(F.col("t"))).first()
    assert row[0] == dt.date(2024, 3, 5)


@pytest.mark.parametrize("text", ["31/02/2024", "24-3-5", "05/03-2024", "2024-13-01", "hoy", "1/2/3"])
def test_no_dates(spark, text):
    assert spark.createDataFrame([(text,)], "t string").select(parse_date(F.col("t"))).first()[0] is None


def test_upsert_with_null_keys_can_be_repeated(spark):
    base = spark.createDataFrame([(1, None, 5), (2, "a", 6)], "k int, item string, n int")
    update = spark.createDataFrame([(1, None, 7), (None, None, 8)], "k int, item string, n int")
    once = merge.upsert(base, update, ["k", "item"])
    twice = merge.upsert(once, update, ["k", "item"])
    want = sorted(map(str, [(1, None, 7), (2, "a", 6), (None, None, 8)]))
    assert sorted(str(tuple(r)) for r in once.collect()) == want
    assert sorted(str(tuple(r)) for r in twice.collect()) == want


def test_late_rows_do_not_win(spark):
    schema = "k int, actualizado_en int, v string"
    base = spark.createDataFrame([(1, 10, "new"), (2, None, "untimed"), (3, 7, "same")], schema)
    late = spark.createDataFrame([(1, 5, "old"), (2, 1, "timed"), (3, 7, "again")], schema)
    got = {r.k: r.v for r in merge.upsert(base, late, ["k"]).collect()}
    assert got == {1: "new", 2: "timed", 3: "again"}


def test_stream_with_a_late_file(spark, tmp_path, stores):  # noqa: F811
    schema = "k int, actualizado_en int, v string"
    for day, text in ((10, "new"), (5, "old")):
        rows = spark.createDataFrame([(1, day, text)], schema)
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        follow(spark, str(tmp_path / "in"), rows.schema, stores[0], "t", ["k"]).awaitTermination()
    assert [r.v for r in stores[0].read("t").collect()] == ["new"]
    follow(spark, str(tmp_path / "in"), rows.schema, stores[1], "t", ["k"]).awaitTermination()
    assert stores[1].count("t") == 1            # progress is the store's own


def test_incremental_without_a_time_column(spark, stores):  # noqa: F811
    source, target = stores
    source.refresh("stock_critico", spark.createDataFrame([("A", 1), ("B", 2)], "codigo string, n int"))
    for _ in range(3):
        sync.sync_incremental(source, target, "stock_critico")
    assert target.count("stock_critico") == 2


def test_bad_contract_ids_are_refused(spark, stores):  # noqa: F811
    row = {c: None for c in ("licitacion", "vigente", "dirigido_a", "lugares", "observaciones")}
    schema = "id_llamado string, licitacion string, vigente string, dirigido_a string, lugares string, observaciones string"
    edits = spark.createDataFrame([("x", *row.values())], schema)
    with pytest.raises(ValueError, match="'x'"):
        editing.save_contract(stores[0], edits)


def test_board_rows_do_not_depend_on_columns(spark):
    contract = {"id_llamado": 1, "licitacion": "L"}
    inputs = BoardInputs(
        execution=table(spark, "ejecucion", [line(1, "A")]),
        contracts=table(spark, "datosejecucion", [
            {**contract, "vigente": "NO", "actualizado_en": dt.datetime(2024, 1, 1)},
            {**contract, "vigente": "SI", "actualizado_en": dt.datetime(2024, 2, 1)}]),
        requested=table(spark, "cantidad_solicitada", [
            {"id_llamado": 1, "licitacion": "L", "codigo": code, "item": "1"} for code in ("A", " A")]),
    )
    assert board(inputs, TODAY, ("codigo",)).count() == 1
    got = board(inputs, TODAY, ("codigo", "vigente", "cantidad_solicitada")).collect()
    assert [r.vigente for r in got] == ["SI"]


def test_verification_shows_what_is_missing(spark, stores):  # noqa: F811
    source, target = stores
    source.refresh("pedidos", spark.range(2))
    target.refresh("ordenes", spark.range(3))
    got = {r.tabla: (r.origen, r.destino, r.coincide) for r in sync.verify(
        source, target, ["pedidos", "ordenes", "ejecucion"]).collect()}
    assert got == {"pedidos": (2, None, False), "ordenes": (None, 3, False), "ejecucion": (None, None, False)}
    assert sync.smoke_run(*stores, "pedidos").count() == 4
    empty = TableStore(spark, source.root + "-x")
    assert sync.smoke_run(empty, empty).count() == 4
