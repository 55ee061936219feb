"""Extracts, headers and the table store, on temporary folders."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botiquin import contracts
from botiquin.sources import csv, headers, jdbc
from botiquin.sources.store import TableStore, fit_to, stamp_defaults


def write(path, content, encoding="utf-8"):
    path.write_bytes(content.encode(encoding))
    return str(path)


def cells(df):
    return [tuple(r)[:-1] for r in df.orderBy(csv.ROW).collect()]


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
@pytest.mark.parametrize("encoding", ["utf-8", "latin-1", "utf-8-sig"])
@pytest.mark.parametrize("per_file", [False, True])
def test_separator_and_encoding(spark, tmp_path, sep, encoding, per_file):
    lines = [["Código", " Descripción  larga "], ["1", "Ibuprofeno añejo"], ["2", "x"], ["", "N/A"]]
    path = write(tmp_path / "a.csv", "\n".join(sep.join(r) for r in lines) + "\n", encoding)
    df = csv.read_extract(spark, path, encoding_per_file=per_file)
    assert df.columns == ["Código", "Descripción larga", csv.ROW]
    assert cells(df) == [("1", "Ibuprofeno añejo"), ("2", "x"), (None, None)]


def test_mixed_encodings_in_one_folder(spark, tmp_path):
    write(tmp_path / "a.csv", "Año;b\nñ1;1\n", "latin-1")
    write(tmp_path / "b.csv", "Año;b\nñ2;2\n", "utf-8")
    for per_file in (False, True):
        df = csv.read_extract(spark, str(tmp_path), encoding_per_file=per_file)
        assert cells(df) == [("ñ1", "1"), ("ñ2", "2")]


def test_given_encoding(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Año;b\nñ;1\n")
    assert cells(csv.read_extract(spark, path, encoding="utf-8")) == [("ñ", "1")]
    path = write(tmp_path / "b.csv", "x;b\nñ;1\n", "latin-1")
    assert cells(csv.read_extract(spark, path, encoding="latin-1")) == [("ñ", "1")]


def test_quotes_and_doubled_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", '"a;b",c\n"x, ""y""",2\n')
    df = csv.read_extract(spark, path)
    assert df.columns[:2] == ["a;b", "c"]
    assert cells(df) == [('x, "y"', "2")]


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b\n"x\ny",2\nz,3\n')
    assert cells(csv.read_extract(spark, path, multiline=True)) == [("x\ny", "2"), ("z", "3")]


def test_repeated_and_nameless_headers(spark, tmp_path):
    path = write(tmp_path / "a.csv", "Codigo,Codigo,,x\n1,2,3,4\nCODIGO,codigo,,X\n")
    df = csv.read_extract(spark, path)
    assert df.columns == ["Codigo", "columna_3", "x", csv.ROW]
    assert cells(df) == [("1", "3", "4")]


def test_row_order_survives_many_splits(spark, tmp_path):
    n = 20_000
    body = "\n".join(f"{i},{'x' * 40}" for i in range(n))
    path = write(tmp_path / "a.csv", "i,t\n" + body + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = csv.read_extract(spark, path)
        assert df.rdd.getNumPartitions() > 4
        got = [int(r.i) for r in df.repartition(7).orderBy(csv.ROW).select("i").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == list(range(n))


def test_only_needed_columns_reach_the_output(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b\n1,2\n")
    assert csv.read_extract(spark, path).select("b").collect()[0].b == "2"


def test_no_header(spark, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        csv.read_extract(spark, write(tmp_path / "a.csv", ""))


def test_find_files(spark, tmp_path):
    for name in ("ordenes.csv", "Stock_2024 stock.csv", "otros.csv"):
        write(tmp_path / name, "a,b\n")
    find = lambda name: [p.split("/")[-1] for p in csv.find_files(spark, str(tmp_path), name)]
    assert find("ordenes") == ["ordenes.csv"]
    assert find("stock") == ["Stock_2024 stock.csv"]
    assert find("pedidos") == []


def test_repair(spark):
    rows = [(None, None, None), ("ID", "A  B", None), ("1", "NULL", None), ("2", "x", None)]
    df = spark.createDataFrame(rows, "id string, ` A \n B ` string, `vacía` string")
    assert [tuple(r) for r in csv.repair_extract(df).collect()] == [("1", None), ("2", "x")]
    assert csv.repair_extract(df).columns == ["id", "A B"]


def test_clean_headers():
    assert headers.clean_headers([" a\n b ", None, "  ", "Ítem"]) == [
        "a b", "unnamed_1", "columna_3", "Ítem",
    ]


def test_first_synonym_wins(spark):
    df = spark.createDataFrame([("1", "2", "3", "4")], ["Código", "Codigo", "x", "stock"])
    got = headers.select_mapped(df, contracts.STOCK_HEADERS)
    assert (got.columns, tuple(got.first())) == (["codigo"], ("1",))
    got = headers.select_mapped(df, contracts.EXPIRY_HEADERS)
    assert got.columns == ["codigo", "stock_disponible"]


def test_lower_and_display_headers(spark):
    df = spark.createDataFrame([(1, "x")], ["ID_Llamado", "otra"])
    assert headers.lower_headers(df).columns == ["id_llamado", "otra"]
    lower = headers.lower_headers(df)
    assert headers.rename_to(lower, contracts.BOARD_TITLES).columns == ["ID Llamado", "otra"]
    assert headers.existing(lower, ["otra", "no"]).columns == ["otra"]


def test_match_headers():
    mapping = {"Id.Llamado": "id_llamado", "Cantidad Emitida": "cantidad_emitida"}
    assert headers.match_headers(["ID_LLAMADO", "Emitida", "x1"], mapping) == {
        "id_llamado": "ID_LLAMADO", "cantidad_emitida": "Emitida",
    }
    # containment works both ways, and the later header overwrites
    assert headers.match_headers(["id llamado nuevo", "Id.Llamado"], mapping) == {
        "id_llamado": "Id.Llamado"
    }


def test_header_tables_have_the_expected_size():
    sizes = [len(m) for m in (
        contracts.ORDERS_HEADERS, contracts.EXECUTION_HEADERS, contracts.STOCK_HEADERS,
        contracts.REQUESTS_HEADERS, contracts.EXPIRY_HEADERS, contracts.BOARD_TITLES,
    )]
    assert sizes == [32, 28, 20, 19, 22, 23]
    assert len(contracts.BOARD_COLUMNS) == 23


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def test_refresh_reads_what_it_replaces(spark, store):
    assert store.refresh("t", spark.range(5).select(F.col("id").alias("n"))) == 5
    assert store.refresh("t", store.read("t").where("n > 1")) == 3
    assert store.count("t") == 3


def test_empty_refresh_keeps_the_table(spark, store):
    store.refresh("t", spark.range(5))
    assert store.refresh("t", spark.range(0)) == 0
    assert store.count("t") == 5


def test_unfinished_refresh_is_not_read(spark, store):
    store.refresh("t", spark.range(5))
    # a job that died before its folder was marked
    spark.range(9).write.parquet(f"{store.root}/t/v0000000002/t/_lote=2")
    assert store.count("t") == 5
    assert store.refresh("t", spark.range(7)) == 7
    assert store.count("t") == 7


def test_missing_table(store):
    assert not store.exists("t")
    with pytest.raises(ValueError, match="no table"):
        store.read("t")


def test_append_and_create(spark, store):
    schema = T.StructType().add("id", T.LongType())
    store.create("t", schema)
    assert store.exists("t") and store.count("t") == 0
    store.append("t", spark.range(3))
    store.create("t", schema)
    assert store.count("t") == 3


def test_fit_to_target(spark):
    df = spark.createDataFrame([("1", "x", "2-2")], "id string, nombre string, dmp string")
    target = T.StructType().add("id", T.IntegerType()).add("dmp", T.DecimalType(18, 2))
    target = target.add("oc", T.StringType())
    fitted, omitted = fit_to(df, target)
    assert (fitted.columns, omitted, fitted.first().dmp) == (["dmp"], ["oc"], None)
    full = stamp_defaults(fitted, target.add("creado_en", T.TimestampType()))
    assert full.columns == ["id", "dmp", "oc", "creado_en"]
    assert full.first().creado_en is not None
    with pytest.raises(ValueError, match="no column"):
        fit_to(df.select("nombre"), target)


def test_jdbc_split_options():
    assert "numPartitions" not in jdbc.scan_options("u", "t")
    got = jdbc.scan_options("u", "t", "id", 0, 100, 8)
    assert (got["partitionColumn"], got["numPartitions"]) == ("id", "8")
