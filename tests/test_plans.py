"""Board, reports, loads, edits, synchronisation and streaming on small tables."""

import datetime as dt
import decimal
import random
import re

import pytest
from pyspark.sql import functions as F

from botiquin import contracts
from botiquin.contracts import SCHEMAS
from botiquin.plans import editing, kpis, loads, sync
from botiquin.plans.board import BoardInputs, board, pending_delivery
from botiquin.sources.csv import ROW
from botiquin.sources.store import TableStore
from botiquin.streaming.incremental import follow

D = decimal.Decimal
TODAY = dt.date(2024, 6, 1)
PAST, FUTURE = dt.date(2024, 5, 31), dt.date(2024, 6, 1)


def table(spark, name, rows):
    """A frame of the table's columns from dicts; the columns not named are null."""
    schema = SCHEMAS[name]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def line(i, code, maximum="10", issued="0", item="1", **more):
    return {
        "id": i, "id_llamado": 1, "licitacion": "L", "proveedor": "P", "codigo": code,
        "item": item, "cantidad_maxima": D(maximum), "cantidad_emitida": D(issued), **more,
    }


def goods(code, available, dmp, actual=None):
    return {"codigo": code, "stock_disponible": None if available is None else D(available),
            "dmp": None if dmp is None else D(dmp), "stock_actual": actual and D(actual)}


def lot(code, stock, day, depot="a"):
    return {"codigo": code, "stock_disponible": D(stock), "fec_vencimiento": day, "parque": depot}


@pytest.fixture
def inputs(spark):
    return BoardInputs(
        execution=table(
            spark,
            "ejecucion",
            [
                line(1, "nodmp"), line(2, "zerodmp"), line(3, "nostock"),
                line(4, "one", "10", "10"), line(5, "three", "0"), line(6, "under", "0"),
                line(7, "above", "0"), line(8, "far", "0"), line(9, "minus", "0", "9.5"),
                line(10, "absent"), line(11, " two ", "0"), line(12, "two", "1", item=" 1"),
                line(13, "zerolots", "0"), line(14, " "), line(15, None),
                line(16, "nullitem", "0", item=None), line(17, "one", "10", "10", "2",
                                                           proveedor=None),
            ],
        ),
        contracts=table(
            spark, "datosejecucion",
            [{"id_llamado": 1, "descripcion_llamado": " Compra ", "dirigido_a": None,
              "lugares": "Central", "vigente": "SI", "precio_unitario": D("2.5")}],
        ),
        orders=table(
            spark, "ordenes",
            [
                {"id_llamado": 1, "llamado": " L", "proveedor": "P ", "codigo": "one ",
                 "saldo": D(3)},
                {"id_llamado": 1, "llamado": "L", "proveedor": "P", "codigo": "one",
                 "saldo": D(4), "estado": "Pendiente"},
                {"id_llamado": 1, "llamado": "L", "proveedor": "P", "codigo": "one",
                 "saldo": D(100), "estado": " ENTREGADO "},
                {"id_llamado": 1, "llamado": "L", "proveedor": None, "codigo": "one",
                 "saldo": D(50)},
            ],
        ),
        stock=table(
            spark, "stock_critico",
            [
                goods("nodmp", 5, None), goods("zerodmp", 5, 0), goods("nostock", 0, 5),
                goods(" one", 5, 5), goods("three", 15, 5), goods("under", 19, 20),
                goods("above", "30.4", 10), goods("far", "30.5", 10), goods("minus", 1, 10),
                goods("two", 5, 10), goods("zerolots", 7, 10, 99), goods("nullitem", 3, 10),
            ],
        ),
        lots=table(
            spark, "vencimientos_parques",
            [
                lot("two", 8, FUTURE, "a"), lot(" two", 4, None, "b"), lot("two", 100, PAST),
                lot("zerolots", 5, PAST), lot("zerolots", 0, FUTURE),
                lot("absent", 6, dt.date(5000, 12, 31)),
            ],
        ),
        requested=table(
            spark, "cantidad_solicitada",
            [
                {"id_llamado": 1, "licitacion": "L", "codigo": "two", "item": "1",
                 "cantidad_solicitada": D(2), "emitir_en": FUTURE, "comentario": "ojo"},
                {"id_llamado": 1, "licitacion": "L", "codigo": "nullitem", "item": "",
                 "cantidad_solicitada": D(9)},
            ],
        ),
    )


def by_code(df):
    return {(r.codigo, r.item and r.item.strip()): r for r in df.collect()}


def test_board(inputs):
    df = board(inputs, TODAY)
    assert tuple(df.columns) == contracts.BOARD_COLUMNS
    got = by_code(df)
    # one row per trimmed item, none without a code
    assert df.count() == len(got) == 14
    levels = {k[0]: (r.cobertura_meses, r.nivel_stock) for k, r in got.items() if k[1] != "2"}
    assert levels == {
        "nodmp": (None, "Sin DMP"),
        "zerodmp": (None, "Sin DMP"),
        "nostock": (D("2.0"), "Sin Stock"),
        "one": (D("1.0"), "Atención"),
        "three": (D("3.0"), "Atención"),
        "under": (D("1.0"), "Atención"),   # 0.95 rounds to 1.0 before the level is taken
        "above": (D("3.0"), "Atención"),   # so does 3.04
        "far": (D("3.1"), "Óptimo"),       # 3.05 rounds away from zero
        "minus": (D("-0.9"), "Crítico"),   # -0.85, away from zero as well
        "absent": (None, "Sin DMP"),
        "two": (D("1.5"), "Atención"),     # (8 + 4 + 1 + 2) / 10
        "zerolots": (D("0.7"), "Crítico"),  # unexpired sum 0 falls back to available
        "nullitem": (D("0.3"), "Crítico"),  # the request saved with an empty item is not found
    }
    two = got["two", "1"]
    assert (two.cantidad_maxima, two.stock_actual, two.comentario) == (D(1), D(12), "ojo")
    assert got["absent", "1"].stock_actual == D(6)
    one = got["one", "1"]
    # padded keys are merged, closed orders and other suppliers left out
    assert (one.pendiente_entrega, one.nombre_llamado, one.lugar) == (D(7), "Compra", "Central")
    assert (one.dirigido_a, one.precio_unitario) == ("", D("2.5"))
    assert got["one", "2"].pendiente_entrega == 0


def test_board_with_null_safe_keys(inputs):
    got = by_code(board(inputs, TODAY, null_safe_keys=True))
    assert got["nullitem", None].cantidad_solicitada == D(9)
    assert got["one", "2"].pendiente_entrega == D(50)


def test_board_columns_do_not_change_rows(inputs):
    whole = board(inputs, TODAY)
    for column in ("pendiente_entrega", "stock_actual", "comentario", "lugar", "nivel_stock"):
        some = ("id_llamado", "codigo", "item", *({column} - {"id_llamado", "codigo", "item"}))
        part = board(inputs, TODAY, columns=some)
        assert sorted(map(str, part.collect())) == sorted(map(str, whole.select(*some).collect()))


def test_legacy_board(inputs):
    got = board(inputs, TODAY, legacy=True)
    # without dedupe both lines of the code remain
    assert got.where("codigo = 'two'").count() == 2
    rows = {r.codigo: r for r in got.where("item <> '2'").collect()}
    assert rows["minus"].nivel_stock == "Crítico"     # 1 < 0.3 * 10
    assert rows["nullitem" if "nullitem" in rows else "far"].nivel_stock == "Óptimo"
    assert rows["zerolots"].nivel_stock == "Óptimo"   # 7 is not below 0.7 * 10
    assert rows["minus"].cobertura_meses == pytest.approx(-0.95)


def test_pending_delivery_merges_padded_keys(inputs):
    got = {(r.proveedor, r.codigo): r.pendiente_entrega
           for r in pending_delivery(inputs.orders).collect()}
    assert got == {("P", "one"): D(7), ("", "one"): D(50)}


def test_grid(inputs):
    rows = {r.codigo: r for r in kpis.grid(board(inputs, TODAY)).where("item <> '2'").collect()}
    assert rows["nodmp"].cobertura_grilla is None and not rows["nodmp"].fila_roja
    assert rows["two"].cobertura_grilla == pytest.approx(1.4)
    assert rows["under"].fila_roja and not rows["three"].fila_roja


def test_board_figures(inputs, spark):
    b = board(inputs, TODAY)
    k = kpis.board_kpis(b).first()
    assert (k.total_items, k.items_criticos) == (14, 4)
    assert k.porcentaje_criticos == pytest.approx(400 / 14)
    assert k.monto_estimado == pytest.approx(61 * 2.5)
    empty = kpis.board_kpis(b.limit(0)).first()
    assert (empty.total_items, empty.porcentaje_criticos, empty.monto_estimado) == (0, 0.0, 0.0)
    assert empty.cantidad_solicitada == 0
    top = kpis.consumption(b).first()
    assert (top.licitacion, top.cantidad_maxima) == ("L", D(61))


def test_figures_of_empty_tables(spark):
    assert tuple(kpis.orders_kpis(table(spark, "ordenes", [])).first()) == (0, 0, 0)
    assert tuple(kpis.requests_kpis(table(spark, "pedidos", [])).first()) == (0, 0, 0)
    assert tuple(kpis.execution_kpis(table(spark, "ejecucion", [])).first()) == (0, 0, 0)
    assert tuple(kpis.stock_kpis(table(spark, "stock_critico", [])).first()) == (0, 0, 0)


def test_choice_lists(spark):
    df = spark.createDataFrame([(x,) for x in ["b", None, "a", "b"]], "estado string")
    assert [r.estado for r in kpis.options(df, "estado", 1).collect()] == ["a"]
    assert kpis.options(df, "estado", keep_null=True).count() == 3


def raw(spark, headers, rows):
    data = [(*r, i) for i, r in enumerate(rows)]
    names = ", ".join(f"`{h}` string" for h in headers)
    return spark.createDataFrame(data, f"{names}, {ROW} int").repartition(3)


def test_orders_extract(spark):
    got = loads.clean_orders(
        raw(
            spark,
            [" OC", "Item", "Código", "Saldo", "Fecha OC", "Proveedor", "ajena"],
            [
                ("1", "2-2.2", "A", "x", "5/3/2024", " nan ", "z"),
                ("1", "2-2.2", "A ", "7", "6/3/2024", "P", "z"),
                ("2", None, "B", "1", "31/02/2024", None, "z"),
                ("2", "nan", "B", "2", None, None, "z"),
            ],
        )
    ).orderBy("oc")
    assert got.columns == ["oc", "item", "codigo", "saldo", "fecha_oc", "proveedor"]
    assert [tuple(r) for r in got.collect()] == [
        ("1", "2-2.2", "A", D(7), "06/03/2024", "P"),
        ("2", "", "B", D(1), None, ""),
    ]


def test_execution_extract(spark):
    got = loads.clean_execution(
        raw(
            spark,
            ["Id. Llamado", "Licitación", "Codigo", "Item", "Cantidad Máxima"],
            [("1", "L", "A", None, "5"), ("1 ", "L", " A", "nan", "6"), ("1", "L", "A", "1", "-")],
        )
    )
    # cleaned before the comparison, so the second row is a copy of the first
    assert sorted((r.item or "", r.cantidad_maxima) for r in got.collect()) == [
        ("", D(5)), ("1", D(0)),
    ]


def test_requests_extract_compares_before_cleaning(spark):
    got = loads.clean_requests(
        raw(spark, ["Nro Pedido", "Codigo", "Cantidad"],
            [(" 12", "A", "1"), ("12", "A", "x"), ("12", "A", "3")])
    )
    assert sorted((r.nro_pedido, r.cantidad) for r in got.collect() if r.cantidad) == [
        ("12", D(1)),
    ]
    assert got.count() == 2


def test_stock_extract(spark):
    got = loads.clean_stock(
        raw(spark, ["Código", "Producto", "DMP", "Meses en Movimiento"],
            [(" A", "", "1.5", "3.0"), ("A", "x", "2", "4"), (None, "y", "?", "")])
    ).orderBy("codigo")
    assert [tuple(r) for r in got.select("codigo", "producto", "dmp", "meses_en_movimiento",
                                         "stock_hosp", "oc").collect()] == [
        ("", "y", None, None, None, None), ("A", None, D("1.5"), 3, None, None),
    ]


def test_expiry_extract_wide_and_long(spark):
    wide = raw(spark, ["Codigo", "Parque", "Vencimiento", "Stock"],
               [("A", "p", "31/12/5000", "x"), ("A", "p", "31/12/5000", "9")])
    got = loads.clean_expiry(wide).collect()
    assert [(r.stock_disponible, r.fec_vencimiento) for r in got] == [(D(0), dt.date(5000, 12, 31))]
    long = raw(spark, ["codigo", "Nombres de medidas", "Valores de medidas"],
               [("A", " stock disponible", "4"), ("B", "Stock Reservado", "5")])
    got = loads.clean_expiry(long)
    assert [(r.codigo, r.stock_disponible) for r in got.collect()] == [("A", D(4))]


def test_folder_load(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "ordenes.csv").write_text("Id.Llamado;OC;Item;Codigo;Saldo\n1;a;1;A;5\nLL-2;b;1;B;6\n")
    (folder / "Ejecución y ejecucion 2024.csv").write_bytes(
        "Id. Llamado,Licitación,Codigo,Item\n1,Año,A,1\n".encode("latin-1")
    )
    (folder / "pedidos.csv").write_text("x,y\n1,2\n")
    store = TableStore(spark, str(tmp_path / "store"))
    got = {r.name: r for r in loads.load_folder(spark, str(folder), store)}
    assert list(got) == list(contracts.LOAD_ORDER)
    assert (got["ordenes"].status, got["ordenes"].rows, got["ordenes"].set_aside) == ("OK", 1, 1)
    assert got["ejecucion"].status == "OK"
    assert got["stock"].status == "OMITIDO"
    assert got["pedidos"].status.startswith("ERROR")
    row = store.read("ordenes").first()
    assert (row.id_llamado, row.saldo, row.fecha_orden) == (1, D(5), None)
    assert row.actualizado_en is not None
    assert store.read("ordenes").schema.names == SCHEMAS["ordenes"].names
    assert store.read("ejecucion").first().licitacion == "Año"
    assert store.read("ordenes_apartados").first().id_llamado == "LL-2"


@pytest.fixture
def stores(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "a")), TableStore(spark, str(tmp_path / "b"))


def test_sync(spark, stores):
    source, target = stores
    source.refresh("stock_critico", table(spark, "stock_critico", [goods("A", 1, 2)]))
    source.create("pedidos", SCHEMAS["pedidos"])
    source.refresh("ejecucion", table(spark, "ejecucion", [line(1, "A")]))
    target.refresh("pedidos", table(spark, "pedidos", [{"nro_pedido": "1"}]))
    target.refresh("stock_critico", table(spark, "stock_critico", [goods("X", 1, 2)] * 3))
    done = sync.sync_all(source, target)
    results = {r.table: r.success for r in done}
    messages = {r.table: r.message for r in done}
    assert "falta" in messages["ejecucion"] and "ordenes" in messages["ordenes"]
    assert list(results) == list(contracts.SYNC_ORDER)
    assert results["stock_critico"]
    assert results["pedidos"] and target.count("pedidos") == 1    # empty source, stale target
    assert not results["ejecucion"]                               # missing target
    assert not results["ordenes"]                                 # missing source
    assert [r.codigo for r in target.read("stock_critico").collect()] == ["A"]
    got = {r.tabla: (r.origen, r.destino, r.coincide, r.diferencia)
           for r in sync.verify(source, target).collect()}
    for name, counts in {
        "stock_critico": (1, 1, True, 0), "pedidos": (0, 1, False, 1),
        "ejecucion": (1, None, False, None), "ordenes": (None, None, False, None),
    }.items():
        assert got[name] == counts


def test_smoke_run(spark, stores):
    source, target = stores
    got = {r.paso: (r.ok, r.registros) for r in sync.smoke_run(source, target).collect()}
    assert got == {"datos de origen": (False, 0), "copia": (False, 0), "conteo": (False, 0),
                   "datos de destino": (False, 0)}
    source.refresh("ordenes", table(spark, "ordenes", [{"id_llamado": 1}]))
    target.create("ordenes", SCHEMAS["ordenes"])
    got = {r.paso: (r.ok, r.registros) for r in sync.smoke_run(source, target).collect()}
    assert set(got.values()) == {(True, 1)}


def test_incremental_sync(spark, stores):
    source, target = stores
    old, new = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    schema = "k int, v string, actualizado_en timestamp"
    source.refresh("t", spark.createDataFrame([(1, "a", old), (2, "b", old)], schema))
    sync.sync_incremental(source, target, "t")
    assert target.count("t") == 2
    source.refresh("t", spark.createDataFrame([(1, "a", old), (2, "c", new), (3, "d", old)], schema))
    sync.sync_incremental(source, target, "t")
    # strictly newer rows are appended; the one that shares the mark's time is missed
    assert sorted((r.k, r.v) for r in target.read("t").collect()) == [(1, "a"), (2, "b"), (2, "c")]
    sync.sync_incremental(source, target, "t")
    assert target.count("t") == 3


def test_incremental_sync_by_key_is_repeatable(spark, stores):
    source, target = stores
    now = dt.datetime(2024, 1, 1)
    schema = "k int, v string, actualizado_en timestamp"
    source.refresh("t", spark.createDataFrame([(1, "a", now)], schema))
    sync.sync_incremental(source, target, "t", keys=["k"])
    source.refresh("t", spark.createDataFrame([(1, "b", now), (2, "c", now)], schema))
    for _ in range(2):
        sync.sync_incremental(source, target, "t", keys=["k"])
        assert sorted((r.k, r.v) for r in target.read("t").collect()) == [(1, "b"), (2, "c")]


def test_mark_reaches_the_scan(spark, stores):
    source, _ = stores
    source.refresh("t", spark.range(5).select("id", F.lit(dt.datetime(2024, 1, 1)).alias("ts")))
    delta = sync.changes_since(source.read("t"), dt.datetime(2023, 1, 1), "ts")
    text = delta._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts" in text


def test_saving_edits(spark, stores):
    store, _ = stores
    store.refresh("cantidad_solicitada", table(
        spark, "cantidad_solicitada",
        [{"id_llamado": 1, "licitacion": "L", "codigo": "A", "item": "1",
          "cantidad_solicitada": D(1), "comentario": "queda"}]))
    schema = ("id_llamado int, licitacion string, codigo string, item string, "
              "cantidad_solicitada double, ver_en_fecha date")
    shown = spark.createDataFrame(
        [(1, "L", "A", "1", 1.0, None), (1, "L", "B", None, 0.0, None)], schema)
    edited = spark.createDataFrame(
        [(1, "L", "A", "1", 8.5, FUTURE), (1, "L", "B", None, 0.0, None)], schema)
    assert editing.save_requested(store, edited, shown) == 1
    row = store.read("cantidad_solicitada").first()
    assert (row.cantidad_solicitada, row.emitir_en, row.comentario) == (D("8.5"), FUTURE, "queda")
    assert row.actualizado_en is not None
    assert editing.save_requested(store, edited) == 2


def test_saving_contracts(spark, stores):
    store, _ = stores
    edits = spark.createDataFrame(
        [("5", None, "", None, "Central", None)],
        "id_llamado string, licitacion string, vigente string, dirigido_a string, "
        "lugares string, observaciones string")
    editing.save_contract(store, edits)
    editing.save_contract(store, edits)
    rows = editing.contract_of(store, 5).collect()
    assert [(r.vigente, r.dirigido_a, r.lugares) for r in rows] == [("SI", "", "Central")]


def test_stream_takes_new_files_once(spark, tmp_path, stores):
    store, _ = stores
    schema = "k int, v string, actualizado_en timestamp"
    folder, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    day = dt.datetime(2024, 1, 1)

    def run():
        follow(spark, folder, first.schema, store, "t", ["k"], checkpoint=progress).awaitTermination()
        return sorted((r.k, r.v) for r in store.read("t").collect())

    first = spark.createDataFrame([(1, "a", day), (2, "b", day)], schema)
    first.write.mode("append").parquet(folder)
    assert run() == [(1, "a"), (2, "b")]
    later = [(2, "c", day), (3, "d", day)]
    spark.createDataFrame(later, schema).write.mode("append").parquet(folder)
    assert run() == [(1, "a"), (2, "c"), (3, "d")]
    assert run() == [(1, "a"), (2, "c"), (3, "d")]


def test_hot_tender_is_split(spark):
    """One tender holds most lines: the join to its contract data is split over tasks."""
    n = 60_000
    lines = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).cast("int").alias("id_llamado"),
        F.lit("L").alias("licitacion"),
        F.sha2(F.col("id").cast("string"), 256).alias("codigo"),
        F.lit("1").alias("item"),
    )
    names = spark.range(n).select(
        F.col("id").cast("int").alias("id_llamado"),
        F.concat(F.lit("T"), "id").alias("descripcion_llamado"),
        *[F.lit(None).cast("string").alias(c) for c in ("dirigido_a", "lugares", "vigente")],
        F.lit(None).cast("decimal(18,4)").alias("precio_unitario"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = board(BoardInputs(execution=lines, contracts=names), TODAY,
                   ("id_llamado", "codigo", "nombre_llamado"))
        assert len(df.collect()) == n
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
        assert df.where("id_llamado = 7").select("nombre_llamado").distinct().count() == 1
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_board_against_a_loop(spark):
    """A random board against the definition written as a loop over rows."""
    rng = random.Random(5)
    codes = [f"c{i}" for i in range(12)]
    execution = [
        line(i, rng.choice(codes), str(rng.randint(0, 20)), str(rng.randint(0, 9)),
             rng.choice(["1", "2", None]), id_llamado=rng.randint(1, 3),
             licitacion=rng.choice(["L", "M", None]), proveedor=rng.choice(["P", "Q", None]))
        for i in range(150)
    ]
    orders = [
        {"id_llamado": rng.randint(1, 3), "llamado": rng.choice(["L", " M", None]),
         "proveedor": rng.choice(["P", "Q ", None]), "codigo": rng.choice(codes),
         "saldo": rng.choice([None, D(5), D("2.25")]),
         "estado": rng.choice([None, "Finalizado", "x"])}
        for _ in range(200)
    ]
    stock = [goods(c, rng.choice([None, 0, 5, 40]), rng.choice([None, 0, 3, 7])) for c in codes[:9]]
    lots = [lot(rng.choice(codes), rng.randint(0, 5), rng.choice([PAST, FUTURE, None]))
            for _ in range(30)]
    inputs = BoardInputs(
        execution=table(spark, "ejecucion", execution), orders=table(spark, "ordenes", orders),
        stock=table(spark, "stock_critico", stock), lots=table(spark, "vencimientos_parques", lots),
    )
    newest = {}
    for e in execution:
        newest[e["id_llamado"], e["licitacion"], e["codigo"], e["item"]] = e
    want = []
    for e in newest.values():
        pending = sum(
            o["saldo"] or 0 for o in orders
            if (o["estado"] or "").lower() != "finalizado"
            and o["id_llamado"] == e["id_llamado"] and o["codigo"] == e["codigo"]
            and (o["llamado"] or "").strip() == e["licitacion"]
            and (o["proveedor"] or "").strip() == e["proveedor"]
        )
        fresh = sum(x["stock_disponible"] for x in lots
                    if x["codigo"] == e["codigo"] and x["fec_vencimiento"] != PAST)
        s = next((s for s in stock if s["codigo"] == e["codigo"]), None)
        dmp = (s and s["dmp"]) or 0
        have = fresh or (s and s["stock_disponible"]) or 0
        months = None
        if dmp > 0:
            total = D(have) + e["cantidad_maxima"] - e["cantidad_emitida"]
            months = (total / dmp).quantize(D("0.1"), decimal.ROUND_HALF_UP)
        if dmp == 0:
            level = "Sin DMP"
        elif have == 0:
            level = "Sin Stock"
        else:
            level = "Crítico" if months < 1 else "Atención" if months <= 3 else "Óptimo"
        want.append((e["id"], D(pending), D(have), months, level))
    df = board(inputs, TODAY, (*contracts.ITEM_KEY, "pendiente_entrega", "stock_actual",
                               "cobertura_meses", "nivel_stock"))
    ids = {k: e["id"] for k, e in newest.items()}
    got = [(ids[tuple(r)[:4]], *tuple(r)[4:]) for r in df.collect()]
    assert sorted(got) == sorted(want)


def test_board_joins_by_call_reuse_the_partitioning(spark):
    """Pending deliveries and requests join within each call id: the execution lines, dealt out by
    id_llamado, are not shuffled again by their full keys, and missing keys still match nothing."""
    lines = table(spark, "ejecucion", [
        line(1, "c1", item="1", id_llamado=1, licitacion="L", proveedor="P"),
        line(2, "c1", item="2", id_llamado=1, licitacion=None, proveedor="P"),
        line(3, "c2", item="1", id_llamado=2, licitacion="L", proveedor="P"),
    ]).repartition(4, "id_llamado")
    orders = table(spark, "ordenes", [
        {"id_llamado": 1, "llamado": "L", "proveedor": "P", "codigo": "c1", "saldo": D(5), "estado": "x"},
        {"id_llamado": 1, "llamado": None, "proveedor": "P", "codigo": "c1", "saldo": D(7), "estado": "x"},
    ])
    requested = table(spark, "cantidad_solicitada", [
        {"id_llamado": 2, "licitacion": "L", "codigo": "c2", "item": "1", "cantidad_solicitada": D(3)},
    ])
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        df = board(BoardInputs(execution=lines, orders=orders, requested=requested), TODAY,
                   ("id_llamado", "item", "pendiente_entrega", "cantidad_solicitada"), legacy=True)
        got = sorted((r.id_llamado, r.item, r.pendiente_entrega, r.cantidad_solicitada) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
    assert got == [(1, "1", D(5), D(0)), (1, "2", D(0), D(0)), (2, "1", D(0), D(3))]
    # Only the requests' own dedupe deals rows out by a full key.
    assert len(set(re.findall(r"hashpartitioning\(id_llamado#\d+L?, _licitacion", plan))) == 1
    assert not re.search(r"hashpartitioning\([^)]*_proveedor", plan)


def test_null_safe_request_join_over_given_partitions(inputs):
    """The request join deals both sides out by call id and tender into the given partitions (F5),
    with requests saved under an empty item as in board_null_safe."""
    inputs = BoardInputs(execution=inputs.execution, requested=inputs.requested.withColumn("item", F.lit("")))
    whole = board(inputs, TODAY, null_safe_keys=True)
    spread = board(inputs, TODAY, null_safe_keys=True, partitions=23)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(id_llamado#\d+L?, _licitacion#\d+, 23\)", plan)
    assert sorted(map(str, spread.collect())) == sorted(map(str, whole.collect()))
    assert by_code(spread)["nullitem", None].cantidad_solicitada == D(9)
