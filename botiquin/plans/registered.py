"""Queries over the driver's tables, by name.

Each takes a session and a folder and reads the whole tables it needs. Results are made of plain
types: decimals as doubles, dates as text.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botiquin.contracts import BOARD_TITLES, ITEM_KEY, SCHEMAS
from botiquin.functions import dates, numbers, stock, text
from botiquin.operators import dedupe, drift, filters, merge, paging, quality, reconcile
from botiquin.plans import kpis, loads, roles, sync
from botiquin.plans.board import BoardInputs, board, pending_delivery, unexpired_stock
from botiquin.plans.roles import AS_OF, ITEM, Tables
from botiquin.session import partitions_for, work_dir
from botiquin.sources import csv, headers
from botiquin.sources.csv import ROW
from botiquin.sources.store import TableStore, fit_to, stamp_defaults
from botiquin.streaming.incremental import follow

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ALERT_DAY = dt.date(1998, 6, 15)
# Fixed value: bytes of a table's Parquet files per partition where a query deals the table out itself.
_TABLE_BYTES = 4 * 1024 * 1024


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text."""

    def one(f: T.StructField) -> Column:
        c = headers.quoted(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return c.alias(f.name)

    return df.select(*[one(f) for f in df.schema.fields])


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register under the function's name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(Tables(spark, folder)))

    QUERIES[build.__name__] = run
    return build


# --- board ----------------------------------------------------------------------------------


CORE = (
    "id_llamado", "licitacion", "codigo", "item", "cantidad_maxima", "cantidad_emitida",
    "saldo_contrato", "stock_actual", "dmp_actual", "cobertura_meses", "nivel_stock",
)


def whole_board(t: Tables, *columns: str) -> DataFrame:
    """The board, without the joins for names where no asked column needs them."""
    kwargs = {"columns": columns} if columns else {}
    named = not columns or bool({"producto", "proveedor", "pendiente_entrega"} & set(columns))
    inputs = roles.board_inputs(t, named)
    return board(inputs, AS_OF, dedupe_keys=ITEM, partitions=roles.spread(t), **kwargs)


@query
def board_core(t: Tables) -> DataFrame:
    inputs = BoardInputs(
        execution=roles.execution(t, names=False), stock=roles.stock(t), lots=roles.lots(t)
    )
    return board(inputs, AS_OF, CORE, dedupe_keys=ITEM)


@query
def board_full(t: Tables) -> DataFrame:
    return whole_board(t)


@query
def board_legacy(t: Tables) -> DataFrame:
    inputs = roles.board_inputs(t, by_code=True)
    return board(inputs, AS_OF, legacy=True, partitions=roles.spread(t))


@query
def board_null_safe(t: Tables) -> DataFrame:
    """Requests whose missing item is saved as empty text still find their execution line."""
    execution = roles.execution(t).withColumn(
        "item", F.when(F.col("cantidad_maxima") > 25, F.col("item"))
    )
    requested = (
        roles.requested(t)
        .groupBy("id_llamado", "licitacion", "codigo", F.lit("").alias("item"))
        .agg(
            F.sum("cantidad_solicitada").alias("cantidad_solicitada"),
            F.max("emitir_en").alias("emitir_en"),
            F.lit(None).cast("string").alias("comentario"),
        )
    )
    columns = ("id_llamado", "codigo", "item", "cantidad_solicitada", "ver_en_fecha")
    return board(
        BoardInputs(execution=execution, requested=requested),
        AS_OF,
        columns,
        null_safe_keys=True,
        dedupe_keys=("id_llamado", "licitacion", "codigo", "item"),
        partitions=roles.spread(t),
    )


@query
def coverage_grid(t: Tables) -> DataFrame:
    columns = ("id_llamado", "item", "stock_actual", "cantidad_solicitada", "dmp_actual")
    return kpis.grid(whole_board(t, *columns))


@query
def unexpired_stock_by_code(t: Tables) -> DataFrame:
    return unexpired_stock(roles.lots(t), AS_OF)


@query
def pending_delivery_by_item(t: Tables) -> DataFrame:
    return pending_delivery(roles.orders(t))


@query
def board_page(t: Tables) -> DataFrame:
    columns = ("id_llamado", "licitacion", "codigo", "item", "nivel_stock", "cobertura_meses")
    return paging.page(whole_board(t, *columns), ("id_llamado", "item"), number=3, size=200)


@query
def board_page_deep(t: Tables) -> DataFrame:
    """The last full page of 200 rows, read from a sorted copy by its place."""
    columns = ("id_llamado", "licitacion", "codigo", "item", "nivel_stock")
    path = work_dir(t.spark, "paginas")
    index = paging.PageIndex.build(whole_board(t, *columns), ("id_llamado", "item"), path, ranges=16)
    return index.page(index.total // 200, 200)


@query
def execution_capped(t: Tables) -> DataFrame:
    """As many of the largest execution lines as the caller asks for."""
    lines = roles.execution(t, names=False).select("id_llamado", "item", "codigo", "monto_total")
    order = ("monto_total", "id_llamado", "item", "codigo")
    return paging.capped(lines.orderBy(*[F.col(c).desc_nulls_last() for c in order]), 15_000)


@query
def board_page_after(t: Tables) -> DataFrame:
    columns = ("id_llamado", "licitacion", "codigo", "item", "nivel_stock")
    return paging.page_after(whole_board(t, *columns), ("id_llamado", "item"), [100, "3"], 500)


@query
def board_preview(t: Tables) -> DataFrame:
    return kpis.preview(whole_board(t), ("id_llamado", "item"), 1000)


@query
def board_titles(t: Tables) -> DataFrame:
    return headers.rename_to(plain(whole_board(t, *CORE)), BOARD_TITLES)


# --- dedupe ---------------------------------------------------------------------------------


@query
def dedupe_latest(t: Tables) -> DataFrame:
    """Newest per item among rows with a code."""
    return dedupe.latest_items(roles.execution(t, names=False, dirty=True), ITEM).drop("id")


@query
def dedupe_keep_blank(t: Tables) -> DataFrame:
    return dedupe.delete_older(roles.execution(t, names=False, dirty=True), ITEM).drop("id")


@query
def dedupe_orders(t: Tables) -> DataFrame:
    keys = ("llamado", "codigo", "item", "oc")
    return dedupe.delete_older(roles.orders(t), keys).drop("id")


@query
def dedupe_orders_five_keys(t: Tables) -> DataFrame:
    """The whole key over orders that came twice: an older copy with another balance beside each
    order of a closed line, with its padding."""
    orders = roles.orders(t)
    older = F.struct(F.lit(0).alias("vez"), F.col("id").alias("fila"))
    newer = F.struct(F.lit(1).alias("vez"), F.col("id").alias("fila"))
    again = orders.where(F.col("llamado").startswith(" ")).withColumns(
        {"id": older, "saldo": (F.col("saldo") + 1).cast("decimal(18,6)"),
         "codigo": F.concat(F.lit(" "), "codigo"), "item": F.concat("item", F.lit("  "))}
    )
    both = orders.withColumn("id", newer).unionByName(again)
    return dedupe.delete_older(both, ("id_llamado", "llamado", "codigo", "item", "oc")).drop("id")


@query
def append_newest_wins(t: Tables) -> DataFrame:
    """Execution loaded from accepted lines, then appended to twice: of each item the row of the
    newest batch counts, whatever is in it."""
    store = TableStore(t.spark, work_dir(t.spark, "lotes"))
    schema = SCHEMAS["ejecucion"]
    for nth, flag in enumerate("ANR"):
        part = Tables(t.spark, t.folder)
        part.lineitem = t.lineitem.where(F.col("l_returnflag") == flag)
        batch = roles.execution(part, names=False)
        rows = stamp_defaults(fit_to(dedupe.keep_latest(batch, ITEM), schema)[0], schema)
        if nth:
            store.append("ejecucion", rows)
        else:
            store.refresh("ejecucion", rows)
    return dedupe.latest_items(store.read("ejecucion"), ITEM).select(
        F.col("id_llamado").cast("bigint").alias("id_llamado"), "licitacion", "codigo", "item",
        "cantidad_maxima", "monto_total", "fecha_ejecucion",
    )


@query
def dedupe_by_date(t: Tables) -> DataFrame:
    """Newest order date per order, item and code, dateless last, then input order."""
    raw = t.lineitem.select(
        F.col("l_suppkey").alias("oc"),
        F.col("l_linenumber").alias("item"),
        F.col("l_quantity").alias("codigo"),
        F.when(F.col("l_returnflag") != "N", F.col("l_shipdate").cast("date")).alias("fecha_oc"),
        F.col("l_extendedprice").alias("monto_oc"),
        roles.line_order().alias(ROW),
    )
    return dedupe.keep_newest_date(raw, ("oc", "item", "codigo"), F.col("fecha_oc")).drop(ROW)


@query
def dedupe_first(t: Tables) -> DataFrame:
    """First row per tender and line in input order."""
    raw = t.lineitem.select(
        F.col("l_orderkey").alias("id_llamado"),
        F.col("l_linenumber").alias("item"),
        F.col("l_partkey").alias("codigo"),
        F.col("l_suppkey").alias("proveedor"),
        F.col("l_quantity").alias("cantidad"),
        roles.line_order().alias(ROW),
    )
    return dedupe.keep_first(raw, ("id_llamado", "item")).drop(ROW)


@query
def dedupe_complete(t: Tables) -> DataFrame:
    """Per tender and line the row with the most filled cells."""
    raw = t.lineitem.select(
        F.col("l_orderkey").alias("id_llamado"),
        F.col("l_linenumber").alias("item"),
        F.col("l_partkey").alias("codigo"),
        F.when(F.col("l_returnflag") != "N", F.col("l_suppkey")).alias("proveedor"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("cantidad"),
        F.when(F.col("l_tax") > 0, F.col("l_extendedprice")).alias("monto"),
    )
    ties = [F.col("codigo").asc(), F.col("proveedor").asc_nulls_last(),
            F.col("cantidad").asc_nulls_last(), F.col("monto").asc_nulls_last()]
    return dedupe.keep_most_complete(raw, ("id_llamado", "item"), ties)


@query
def dup_audit(t: Tables) -> DataFrame:
    execution = roles.execution(t, names=False, dirty=True).withColumn(
        "item", F.when(F.col("cantidad_maxima") > 5, F.col("item"))
    )
    return dedupe.duplicate_audit(execution, "ejecucion", ITEM).unionByName(
        dedupe.duplicate_audit(roles.orders(t), "ordenes", ("llamado", "codigo", "item", "oc"))
    )


# --- figures and lists ----------------------------------------------------------------------


@query
def board_kpis(t: Tables) -> DataFrame:
    return kpis.board_kpis(
        whole_board(t, "cantidad_maxima", "precio_unitario", "cantidad_solicitada", "nivel_stock")
    )


@query
def board_kpis_by_choice(t: Tables) -> DataFrame:
    """The same figures for one chosen tender name and level."""
    b = whole_board(
        t, "licitacion", "cantidad_maxima", "precio_unitario", "cantidad_solicitada",
        "nivel_stock",
    )
    b = filters.choose(filters.choose(b, "licitacion", "2-HIGH"), "nivel_stock", "Crítico")
    return kpis.board_kpis(b)


@query
def critical_items(t: Tables) -> DataFrame:
    return kpis.critical_items(whole_board(t))


@query
def low_coverage(t: Tables) -> DataFrame:
    return kpis.low_coverage_items(whole_board(t))


@query
def consumption_top10(t: Tables) -> DataFrame:
    return kpis.consumption(
        whole_board(t, "licitacion", "cantidad_maxima", "cantidad_emitida")
    )


@query
def level_distribution(t: Tables) -> DataFrame:
    return kpis.distribution(whole_board(t, "nivel_stock"), "nivel_stock")


@query
def stock_distribution(t: Tables) -> DataFrame:
    return kpis.distribution(roles.stock(t), "estado")


@query
def orders_kpis(t: Tables) -> DataFrame:
    return kpis.orders_kpis(roles.orders(t))


@query
def orders_pending(t: Tables) -> DataFrame:
    return kpis.pending_orders(roles.orders(t).drop("id"))


@query
def orders_sorted(t: Tables) -> DataFrame:
    return paging.sort_by(roles.orders(t).drop("id"), "fecha_orden")


@query
def requests_kpis(t: Tables) -> DataFrame:
    return kpis.requests_kpis(roles.requests(t))


@query
def requests_pending(t: Tables) -> DataFrame:
    return kpis.pending_requests(roles.requests(t))


@query
def execution_kpis(t: Tables) -> DataFrame:
    return kpis.execution_kpis(roles.execution(t, names=False))


@query
def execution_top100(t: Tables) -> DataFrame:
    ties = ("id_llamado", "item", "codigo", "fecha_ejecucion")
    top = kpis.largest_amounts(roles.execution(t).drop("id"), ties=ties)
    return top.select("id_llamado", "licitacion", "codigo", "item", "proveedor", "monto_total")


@query
def stock_kpis(t: Tables) -> DataFrame:
    return kpis.stock_kpis(roles.stock(t))


@query
def stock_critical(t: Tables) -> DataFrame:
    return kpis.critical_stock(roles.stock(t))


@query
def filter_options(t: Tables) -> DataFrame:
    """Every choice list in one relation: list and value."""
    lists = {
        "licitacion": kpis.options(roles.execution(t, names=False), "licitacion"),
        "producto": kpis.options(roles.stock(t), "producto"),
        "proveedor": kpis.options(roles.orders(t), "proveedor"),
        "estado": kpis.options(roles.orders(t), "estado", keep_null=True),
    }
    parts = [
        df.select(F.lit(name).alias("lista"), F.col(name).alias("valor"))
        for name, df in lists.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def tender_pairs(t: Tables) -> DataFrame:
    return kpis.tender_pairs(roles.execution(t, names=False))


@query
def tender_keys_parsed(t: Tables) -> DataFrame:
    """The display key and its parts; names may hold the separator themselves."""
    shown = t.orders.select(
        "o_orderkey",
        text.display_key(
            F.col("o_orderkey"), F.concat("o_orderpriority", F.lit(" - "), "o_orderstatus")
        ).alias("display"),
    )
    key, name = text.parse_display_key(F.col("display"))
    return shown.select(key.alias("id_llamado"), name.alias("licitacion"), "display")


@query
def grid_contains(t: Tables) -> DataFrame:
    b = whole_board(t, "id_llamado", "item", "producto", "cantidad_maxima", "nivel_stock")
    return filters.grid_contains(
        filters.grid_contains(filters.grid_contains(b, "producto", "WIDGET"), "id_llamado", "12"),
        "cantidad_maxima",
        "1",
    )


@query
def grid_date(t: Tables) -> DataFrame:
    b = whole_board(t, "id_llamado", "item", "ver_en_fecha", "cantidad_solicitada")
    return filters.grid_date(b, "ver_en_fecha", dt.date(1998, 6, 15))


@query
def contract_lookup(t: Tables) -> DataFrame:
    return roles.contracts(t).where(F.col("id_llamado") == 77)


# --- cleaning -------------------------------------------------------------------------------


def _variants(*texts: Column | str) -> Column:
    """A text per line number: the first for line 1, and so on, the last for all others."""
    values = [F.lit(v) for v in texts]
    out = F.when(F.col("l_linenumber") == 1, values[0])
    for i, value in enumerate(values[1:-1], start=2):
        out = out.when(F.col("l_linenumber") == i, value)
    return out.otherwise(values[-1])


@query
def clean_text_policies(t: Tables) -> DataFrame:
    raw = _variants(
        "nan", " NaT ", "\tNone\u00a0", "NAN", "  ",
        F.when(F.col("l_returnflag") == "A", "#N/A").when(F.col("l_returnflag") == "R", "NULL"),
        F.concat(F.lit(" "), "l_returnflag", F.lit("\t"), "l_linestatus", F.lit("\u00a0")),
    )
    c = F.col("crudo")
    return t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("crudo")).select(
        "l_orderkey",
        "l_linenumber",
        text.blank_to_null(c).alias("nulo"),
        text.blank_to_empty(c).alias("vacio"),
        text.null_words_to_null(c).alias("palabras"),
        text.cell_tokens_to_null(c).alias("celda"),
        text.reader_nulls_to_null(c).alias("lector"),
    )


@query
def coerce_numbers(t: Tables) -> DataFrame:
    amount = roles.money("l_extendedprice").cast("string")
    raw = _variants(
        F.concat(F.lit(" "), amount, F.lit("\t")),
        F.concat(F.lit("-"), amount),
        F.concat(F.lit("Gs. "), F.replace(amount, F.lit("."), F.lit(","))),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit("e2")),
        "2-2.2",
        F.when(F.col("l_returnflag") == "A", "1d").when(F.col("l_returnflag") == "R", "nan"),
        "1.234,50",
    )
    c = F.col("crudo")
    return t.lineitem.select("l_orderkey", "l_linenumber", raw.alias("crudo")).select(
        "l_orderkey",
        "l_linenumber",
        numbers.to_number_or_zero(c).alias("cero"),
        numbers.to_number(c).alias("nulo"),
        numbers.to_number_lenient(c, -1.0).alias("indulgente"),
    )


def _date_texts() -> Column:
    day = F.col("l_shipdate")
    return _variants(
        F.date_format(day, "dd/MM/yyyy"),
        F.date_format(day, "d/M/yyyy"),
        F.concat(F.lit(" "), F.date_format(day, "dd-MM-yyyy"), F.lit("\t")),
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "dd/MM/yyyy HH:mm:ss"),
        F.when(F.col("l_returnflag") == "A", "31/02/2024")
        .when(F.col("l_returnflag") == "R", "31/12/5000")
        .when(F.col("l_linestatus") == "F", "Cumplimiento total de las obligaciones"),
        "NaT",
    )


@query
def coerce_dates(t: Tables) -> DataFrame:
    df = t.lineitem.select("l_orderkey", "l_linenumber", _date_texts().alias("crudo"))
    day, phrase = dates.parse_date_or_phrase(F.col("crudo"))
    return df.select(
        "l_orderkey",
        "l_linenumber",
        dates.parse_date(F.col("crudo")).alias("fecha"),
        dates.date_text(dates.parse_date(F.col("crudo"))).alias("texto"),
        dates.report_date(dates.parse_date(F.col("crudo"))).alias("informe"),
        day.alias("valor"),
        phrase.alias("frase"),
    )


@query
def coerce_dates_strict(t: Tables) -> DataFrame:
    """One format per column, that of the first line: the mixed column keeps dates with slashes, the
    one that begins with the year first keeps those, the third is all dashes."""
    first_lines = F.struct("l_linenumber", roles.line_order())
    df = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        first_lines.alias("orden"),
        _date_texts().alias("mezclada"),
        F.when(F.col("l_linenumber") % 3 == 1, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("l_shipdate", "dd/MM/yyyy")).alias("iso_primero"),
        F.date_format("l_shipdate", "dd-MM-yyyy").alias("guiones"),
        F.lit("sin dato").alias("nada"),
    )
    columns = ["mezclada", "iso_primero", "guiones", "nada"]
    return dates.parse_dates(df, columns, strict_first_format=True, order=F.col("orden")).drop("orden")


@query
def format_numbers(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    ratio = price / 7
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        numbers.format_number(price).alias("monto"),
        numbers.format_number(F.col("l_quantity") * 1000, currency=True).alias("entero"),
        numbers.format_number(-ratio, decimal_comma=True).alias("coma"),
        numbers.format_number(F.col("l_discount") * 100, percent=True).alias("porcentaje"),
        numbers.format_number(
            F.when(F.col("l_returnflag") != "N", F.col("l_tax") / 3), currency=True
        ).alias("chico"),
    )


@query
def sanitize_text(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.sanitize(F.col("text")).alias("texto"))


@query
def clean_names(t: Tables) -> DataFrame:
    names = t.conversations.select(F.col("text").alias("nombre")).unionByName(
        t.part.select(F.concat(F.lit(" 1º "), "p_name", F.lit(" (Código) ")).alias("nombre"))
    ).unionByName(t.nation.select(F.when(F.col("n_nationkey") > 9, "¡Table!").alias("nombre")))
    return names.select(text.clean_name(F.col("nombre")).alias("limpio"))


@query
def normalize_ids(t: Tables) -> DataFrame:
    key = F.col("l_orderkey").cast("string")
    raw = _variants(
        key,
        F.concat(key, F.lit(".9")),
        F.concat(F.lit(" "), key, F.lit(" ")),
        F.concat(F.lit("-"), key, F.lit(".0")),
        F.concat(key, F.lit("-2")),
        F.lit(None).cast("string"),
        F.concat(key, F.lit("e1")),
    )
    return t.lineitem.select("l_linenumber", raw.alias("crudo")).select(
        "l_linenumber", "crudo", numbers.normalize_id(F.col("crudo")).alias("id")
    )


@query
def vigente_flags(t: Tables) -> DataFrame:
    open_flag = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "O")
    return t.orders.select("o_orderkey", text.yes_no(open_flag).alias("vigente"))


@query
def date_alerts(t: Tables) -> DataFrame:
    day = F.when(F.col("l_returnflag") != "N", F.col("l_shipdate").cast("date"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", dates.date_alert(day, ALERT_DAY).alias("alerta")
    )


@query
def traffic_light(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    state = (
        F.when(F.col("o_orderstatus") == "O", "Sin Stock")
        .when(priority == "1-URGENT", "Requiere compra")
        .when(priority == "2-HIGH", "Nivel Crítico, antes Normal")
        .when(priority == "3-MEDIUM", "En Precaución")
        .when(priority == "5-LOW", "Adecuado")
    )
    return t.orders.select(
        "o_orderkey",
        stock.traffic_light(state).alias("nivel"),
        stock.traffic_light(state, extended=False).alias("parque"),
    )


@query
def level_lights(t: Tables) -> DataFrame:
    b = whole_board(t, "id_llamado", "item", "nivel_stock")
    return b.withColumn("color", stock.traffic_light(F.col("nivel_stock")))


# --- extracts -------------------------------------------------------------------------------


def _orders_extract(t: Tables) -> DataFrame:
    amount = roles.money("l_extendedprice").cast("string")
    day = F.col("l_shipdate")
    return roles.lines_of_orders(t).select(
        F.col("l_orderkey").cast("string").alias(" Id.Llamado "),
        F.concat(F.lit(" "), "o_orderpriority", F.lit("\t")).alias("Llamado"),
        F.when(F.col("l_returnflag") == "N", "nan")
        .otherwise(F.concat(F.lit("OC-"), F.col("l_suppkey").cast("string")))
        .alias("OC"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("-2.2")).alias("Item"),
        F.concat(F.lit("Q"), F.col("l_quantity").cast("int").cast("string")).alias("Código"),
        F.lit("sobra").alias("Codigo"),
        F.when(F.col("l_linestatus") == "F", amount).otherwise("n/d").alias("P.Unit."),
        F.concat(F.lit(" "), F.col("l_quantity").cast("int").cast("string")).alias("Cant.  OC"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber").cast("string")).alias(
            "Dias de Atraso"
        ),
        F.when(F.col("l_returnflag") == "A", F.date_format(day, "d/M/yyyy"))
        .when(F.col("l_returnflag") == "R", F.date_format(day, "dd-MM-yyyy"))
        .when(F.col("l_tax") == 0, "31/02/2024")
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
        .alias("Fecha OC"),
        amount.alias("Saldo"),
        F.lit("x").alias("Columna ajena"),
        roles.line_order().alias(ROW),
    )


@query
def load_orders(t: Tables) -> DataFrame:
    return loads.clean_orders(_orders_extract(t))


@query
def load_execution(t: Tables) -> DataFrame:
    raw = roles.lines_of_orders(t).select(
        F.col("l_orderkey").cast("string").alias("Id. Llamado"),
        F.concat(F.lit(" "), "o_orderpriority").alias("Licitación"),
        F.when(F.col("l_returnflag") == "N", "None")
        .otherwise(F.concat(F.lit("P"), F.col("o_custkey").cast("string")))
        .alias("Codigo"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber").cast("string")).alias("Item"),
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" ")).alias(
            "Cantidad Máxima"
        ),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity").cast("int").cast("string"))
        .otherwise("s/d")
        .alias("Cantidad Emitida"),
        roles.money("l_extendedprice").cast("string").alias("Monto Adjudicado"),
        F.lit(" NaN ").alias("Observaciones"),
        roles.line_order().alias(ROW),
    )
    return loads.clean_execution(raw)


@query
def load_stock(t: Tables) -> DataFrame:
    """Several extract rows per product: the first one counts."""
    raw = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit("\t")).alias("Código"),
        F.concat("p_name", F.lit(" ")).alias("Producto"),
        F.when(F.col("p_size") < 10, "nan").otherwise(F.col("p_brand")).alias("Presentación"),
        roles.money("l_extendedprice").cast("string").alias("Stock Disponible"),
        F.when(F.col("l_returnflag") == "A", "-").otherwise(
            F.col("p_size").cast("string")
        ).alias("DMP"),
        F.col("l_linenumber").cast("string").alias("Meses en Movimiento"),
        roles.line_order().alias(ROW),
    )
    return loads.clean_stock(raw)


@query
def load_requests(t: Tables) -> DataFrame:
    """Request numbers with and without a leading blank are different before cleaning."""
    raw = roles.lines_of_orders(t).select(
        F.concat(
            F.when(F.col("l_linestatus") == "F", " ").otherwise(""),
            F.col("o_orderkey").cast("string"),
        ).alias("Nro. Pedido"),
        F.concat(F.lit("C"), F.col("l_linenumber").cast("string")).alias("Código"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("Prioridad"),
        F.when(F.col("o_orderstatus") == "P", "NaT").otherwise(F.col("o_orderstatus")).alias(
            "Estado"
        ),
        F.when(F.col("l_tax") > 0.02, F.col("l_quantity").cast("int").cast("string"))
        .otherwise("?")
        .alias("Cantidad"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Fecha Pedido"),
        roles.line_order().alias(ROW),
    )
    return loads.clean_requests(raw)


def _expiry_extract(t: Tables) -> DataFrame:
    return t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.concat(F.col("l_partkey").cast("string"), F.lit(" ")).alias("codigo_producto"),
        F.concat(F.lit("PNC "), F.col("s_nationkey").cast("string")).alias("nombre_sucursal"),
        F.when(F.col("l_tax") > 0, F.date_format(F.trunc("l_shipdate", "YEAR"), "dd/MM/yyyy"))
        .otherwise("31/12/5000")
        .alias("fecha_vencimiento"),
        F.when(F.col("l_linestatus") == "F", " Stock Disponible")
        .when(F.col("l_returnflag") == "N", "stock disponible\t")
        .otherwise("Stock Reservado")
        .alias("Nombres de medidas"),
        F.when(F.col("l_discount") > 0.01, roles.money("l_quantity").cast("string"))
        .otherwise("sin dato")
        .alias("Valores de medidas"),
        roles.line_order().alias(ROW),
    )


@query
def load_expiry(t: Tables) -> DataFrame:
    return loads.clean_expiry(_expiry_extract(t))


@query
def measure_filter(t: Tables) -> DataFrame:
    return loads.keep_measure(_expiry_extract(t)).drop(ROW)


@query
def repair_sheet(t: Tables) -> DataFrame:
    """Empty rows, an empty column, repeated headers and error cells."""
    gone = F.col("l_linenumber") == 1
    header = F.col("l_linenumber") == 2

    def cell(value: Column, title: str) -> Column:
        return F.when(gone, F.lit(None)).when(header, f" {title.upper()}").otherwise(value)

    raw = t.lineitem.select(
        cell(F.col("l_orderkey").cast("string"), "Id Llamado").alias("Id\n Llamado"),
        cell(F.when(F.col("l_returnflag") == "A", "#REF!").otherwise(F.col("l_linestatus")),
             "Estado").alias(" Estado "),
        F.lit(None).cast("string").alias("Nada"),
        cell(F.when(F.col("l_tax") == 0, " ").otherwise(F.col("l_returnflag")), "Obs").alias("Obs"),
    )
    return csv.repair_extract(raw)


@query
def match_headers(t: Tables) -> DataFrame:
    """Exact, squeezed and contained header names; a required column nobody brings."""
    raw = t.lineitem.select(
        F.col("l_orderkey").alias("ID_LLAMADO"),
        F.col("l_partkey").alias("Codigo"),
        F.col("l_linenumber").alias("Nro de Item"),
        F.col("l_tax").alias("zzz"),
    )
    mapping = {"Id.Llamado": "id_llamado", "Codigo": "codigo", "Item": "item"}
    return headers.select_matched(raw, mapping, ["id_llamado", "proveedor"])


@query
def csv_round_trip(t: Tables) -> DataFrame:
    """Orders written as semicolon Latin-1 files with accents, read back and cleaned."""
    folder = work_dir(t.spark, "csv-round-trip")
    t.orders.select(
        F.col("o_orderkey").cast("string").alias("Nro. Pedido"),
        F.concat(F.lit(" Código "), F.col("o_custkey").cast("string")).alias("Código"),
        F.concat("o_orderpriority", F.lit('; "Atención"')).alias("Prioridad"),
        F.when(F.col("o_orderstatus") == "P", "N/A").otherwise(F.col("o_orderstatus")).alias(
            "Estado"
        ),
        roles.money("o_totalprice").cast("string").alias("Cantidad"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Fecha Pedido"),
    ).write.csv(folder, sep=";", header=True, encoding="ISO-8859-1", escape='"')
    return loads.clean_requests(csv.read_extract(t.spark, folder))


# --- write-back and synchronisation ---------------------------------------------------------


def _edits(t: Tables) -> DataFrame:
    """Lines as edit rows; the customer stands for the code, so that keys meet."""
    return (
        roles.lines_of_orders(t)
        .select(
            "l_returnflag",
            F.col("l_orderkey").alias("id_llamado"),
            F.concat(F.lit(" "), "o_orderpriority").alias("licitacion"),
            F.when(F.col("l_discount") > 0, F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
            .alias("codigo"),
            F.when(F.col("l_linenumber") < 7, F.col("l_linenumber").cast("string")).alias("item"),
            F.when(F.col("l_tax") > 0.01, F.col("l_quantity").cast("int").cast("string"))
            .otherwise("?")
            .alias("cantidad_solicitada"),
            F.date_format("l_shipdate", "dd/MM/yyyy").alias("ver_en_fecha"),
            roles.age_order().alias("actualizado_en"),
        )
    )


@query
def edit_rows(t: Tables) -> DataFrame:
    return merge.edit_rows(_edits(t)).drop("actualizado_en")


@query
def upsert_edits(t: Tables) -> DataFrame:
    """Edits of accepted lines upon the rows of all others; comments survive, and so does a row
    that is newer than its edit."""
    keys, accepted = list(ITEM_KEY), F.col("l_returnflag") == "A"
    rows = _edits(t)
    base = dedupe.keep_latest(merge.edit_rows(rows.where(~accepted)), keys, ["actualizado_en"])
    base = base.withColumn("comentario", F.concat(F.lit("nota "), "codigo"))
    return merge.upsert(base, merge.edit_rows(rows.where(accepted)), keys).drop("actualizado_en")


@query
def upsert_contracts(t: Tables) -> DataFrame:
    """Contract data, then an edit for every tender that is not closed."""
    base = roles.contracts(t).select(
        "id_llamado", "licitacion", "vigente", "dirigido_a", "lugares",
        F.lit(None).cast("string").alias("observaciones_generales"), "descripcion_llamado",
    )
    edits = t.orders.where(F.col("o_orderstatus") != "F").select(
        (F.col("o_orderkey") + F.when(F.col("o_orderstatus") == "O", 0).otherwise(1)).cast(
            "string").alias("id_llamado"),
        F.col("o_orderpriority").alias("licitacion"),
        F.when(F.col("o_orderstatus") == "O", "").otherwise("NO").alias("vigente"),
        F.lit(None).cast("string").alias("dirigido_a"),
        F.lit("Depósito").alias("lugares"),
        F.concat(F.lit("obs "), "o_orderstatus").alias("observaciones"),
        F.col("o_orderkey").alias("actualizado_en"),
    )
    return merge.upsert(base, merge.contract_edits(edits), ["id_llamado"])


def _edited_requests(t: Tables) -> tuple[DataFrame, DataFrame]:
    original = roles.requested(t)
    edited = original.withColumns(
        {
            "cantidad_solicitada": F.when(
                F.col("cantidad_solicitada") > 40, F.col("cantidad_solicitada") + 1
            ).otherwise(F.col("cantidad_solicitada")),
            "emitir_en": F.when(F.col("cantidad_solicitada") >= 5, F.col("emitir_en")),
            "comentario": F.col("comentario"),
        }
    )
    return edited, original


@query
def changed_rows(t: Tables) -> DataFrame:
    """Requests whose quantity or date an edit changed."""
    return merge.changed_rows(*_edited_requests(t), list(ITEM_KEY))


@query
def changed_rows_by_digest(t: Tables) -> DataFrame:
    """The same found by keys and digests; cells travel for changed keys only."""
    return reconcile.changed_rows_by_digest(*_edited_requests(t), list(ITEM_KEY))


@query
def edit_log_latest(t: Tables) -> DataFrame:
    """The newest event per user and kind."""
    return dedupe.keep_latest(t.events, ["user_id", "event_type"], ["ts", "event_id"])


@query
def incremental_delta(t: Tables) -> DataFrame:
    """Events after the newest one the target holds; it was last copied on January 20."""
    target = t.events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return sync.changes_since(t.events, sync.high_water_mark(target, "ts"), "ts")


@query
def incremental_stream(t: Tables) -> DataFrame:
    """The event log as a stream of files that come out of time order, a third of it between runs,
    merged into a table of the newest per user and kind."""
    root = work_dir(t.spark, "stream")
    store = TableStore(t.spark, f"{root}/tablas")
    # Thirds of the log by hour of the day, so each run has rows older and newer than the last.
    for third in (2, 0, 1):
        part = t.events.where(F.floor(F.hour("ts") / 8) == third)
        part.write.mode("append").parquet(f"{root}/llegadas")
        follow(
            t.spark,
            f"{root}/llegadas",
            t.events.schema,
            store,
            "novedades",
            ["user_id", "event_type"],
            newest=("ts", "event_id"),
        ).awaitTermination()
    return store.read("novedades")


@query
def incremental_sync_twice(t: Tables) -> DataFrame:
    """Events copied by time and key up to a day, then twice over the whole log: each row once,
    also where a part of the key is missing."""
    root = work_dir(t.spark, "twice")
    source, target = TableStore(t.spark, f"{root}/origen"), TableStore(t.spark, f"{root}/destino")
    kind = F.when(F.col("event_id") % 3 > 0, F.col("event_type"))
    log = t.events.select("event_id", kind.alias("tipo"), "value", F.col("ts").alias("actualizado_en"))
    early = log.where(F.col("actualizado_en") < F.lit("2024-01-20").cast("timestamp_ntz"))
    for rows in (early, log, log):
        source.refresh("novedades", rows)
        sync.sync_incremental(source, target, "novedades", keys=["event_id", "tipo"])
    return target.read("novedades")


@query
def sync_appended(t: Tables) -> DataFrame:
    """Events appended to a store in two steps."""
    root = work_dir(t.spark, "append")
    source, target = TableStore(t.spark, f"{root}/origen"), TableStore(t.spark, f"{root}/destino")
    log = t.events.select("event_id", "value", F.col("ts").alias("actualizado_en"))
    day = F.lit("2024-01-20").cast("timestamp_ntz")
    for rows in (log.where(F.col("actualizado_en") < day), log):
        source.refresh("novedades", rows)
        sync.sync_incremental(source, target, "novedades")
    return target.read("novedades")


@query
def load_folder_many_files(t: Tables) -> DataFrame:
    """Requests that arrive as several files with their columns in different orders."""
    root = work_dir(t.spark, "carga")
    orders = t.orders.select(
        F.col("o_orderkey").cast("string").alias("Nro. Pedido"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("Código"),
        F.col("o_orderpriority").alias("Prioridad"),
        F.col("o_orderstatus").alias("Estado"),
        F.date_format("o_orderdate", "d/M/yyyy HH:mm").alias("Fecha Pedido"),
    )
    for status in ("F", "O", "P"):
        names = sorted(orders.columns, reverse=status == "O")
        orders.where(F.col("Estado") == status).select(*[headers.quoted(c) for c in names]).write.csv(
            f"{root}/llegadas/pedidos_{status}.csv", header=True, sep=";" if status == "P" else ","
        )
    store = TableStore(t.spark, f"{root}/tablas")
    loads.load_folder(t.spark, f"{root}/llegadas", store, ["pedidos"])
    return store.read("pedidos").select("nro_pedido", "codigo", "prioridad", "estado", "fecha_pedido")


@query
def load_folder_all_kinds(t: Tables) -> DataFrame:
    """One folder with an extract of each kind, all loaded at once: key and quantity of every row, and
    of those set aside."""
    root = work_dir(t.spark, "carpeta")
    # Dealt out by order into partitions that grow with the tables, so one task's share stays bounded.
    spread = partitions_for(t.spark, t.lineitem.inputFiles() + t.orders.inputFiles(), _TABLE_BYTES)
    items, orders = (t.lineitem, t.orders) if spread is None else (
        t.lineitem.repartition(spread, "l_orderkey"), t.orders.repartition(spread, "o_orderkey")
    )
    lines = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).dropDuplicates(
        ["l_orderkey", "l_linenumber"]
    ).select(
        F.col("l_orderkey").cast("string").alias("pedido"), F.col("l_linenumber").cast("string").alias("linea")
    )
    shipped = t.orders.select(
        F.concat(F.lit("OC-"), "o_orderkey").alias("OC"),
        F.when(F.col("o_orderstatus") == "P", "LL-").otherwise("").alias("marca"),
        F.col("o_orderkey"), F.lit("1").alias("Item"), F.col("o_custkey").cast("string").alias("Codigo"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("Saldo"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("Fecha OC"),
    )
    extracts = {
        "ordenes": shipped.select(
            F.concat("marca", F.col("o_orderkey").cast("string")).alias("Id.Llamado"),
            "OC", "Item", "Codigo", "Saldo", "Fecha OC",
        ),
        "ejecucion": lines.select(
            F.col("pedido").alias("Id. Llamado"), F.lit("L").alias("Licitación"),
            F.concat(F.lit("K"), "linea").alias("Codigo"), F.col("linea").alias("Item"),
            F.col("linea").alias("Cantidad Máxima"),
        ),
        "stock": t.part.select(
            F.col("p_partkey").cast("string").alias("Código"), F.col("p_name").alias("Producto"),
            F.col("p_size").cast("string").alias("DMP"),
        ),
        "pedidos": t.orders.select(
            F.col("o_orderkey").cast("string").alias("Nro. Pedido"),
            F.col("o_custkey").cast("string").alias("Código"), F.col("o_orderstatus").alias("Estado"),
            F.lit("3").alias("Cantidad"),
        ),
        "vencimientos_parques": t.part.select(
            F.col("p_partkey").cast("string").alias("codigo"), F.lit("Central").alias("parque"),
            F.lit("31/12/2030").alias("fec_vencimiento"), F.col("p_size").cast("string").alias("stock_disponible"),
        ),
    }
    for name, rows in extracts.items():
        rows.write.csv(f"{root}/{name}.csv", header=True)
    store = TableStore(t.spark, f"{root}/tablas")
    loads.load_folder(t.spark, root, store)
    wanted = {
        "ordenes": ("oc", "saldo"), "ordenes_apartados": ("oc", "saldo"), "ejecucion": ("codigo", "cantidad_maxima"),
        "stock_critico": ("codigo", "dmp"), "pedidos": ("nro_pedido", "cantidad"),
        "vencimientos_parques": ("codigo", "stock_disponible"),
    }
    parts = [
        store.read(name).select(
            F.lit(name).alias("tabla"), F.col(key).alias("clave"), F.col(value).cast("double").alias("valor")
        )
        for name, (key, value) in wanted.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def lower_headers(t: Tables) -> DataFrame:
    """Column names in capitals, brought to lower case."""
    return headers.lower_headers(t.orders.select(
        F.col("o_orderkey").alias("ID_Llamado"), F.col("o_orderpriority").alias("LICITACION"),
        F.col("o_orderstatus").alias("Estado"),
    ))


@query
def sync_verify(t: Tables) -> DataFrame:
    """Copy three tables between two stores and compare the counts."""
    root = work_dir(t.spark, "sync")
    source, target = TableStore(t.spark, f"{root}/origen"), TableStore(t.spark, f"{root}/destino")
    tables = {
        "pedidos": roles.requests(t),
        "stock_critico": roles.stock(t),
        "vencimientos_parques": roles.lots(t),
    }
    for name, df in tables.items():
        source.refresh(name, df)
        # The target knows one column less, and one the source does not have.
        target.create(name, df.drop("producto", "prioridad").withColumn("x", F.lit(1)).schema)
    sync.sync_all(source, target, list(tables))
    return sync.verify(source, target, list(tables))


@query
def sync_content_verify(t: Tables) -> DataFrame:
    """Requests and stock copied to a store where some cells then change and one kind of order is
    replaced by as many others: counts agree, contents do not."""
    root = work_dir(t.spark, "contenido")
    source, target = TableStore(t.spark, f"{root}/origen"), TableStore(t.spark, f"{root}/destino")
    requests, stock_rows = roles.requests(t), roles.stock(t)
    large, small = F.col("cantidad_solicitada") > 490_000, F.col("cantidad_solicitada") < 6_000
    copied = requests.withColumns({
        "prioridad": F.when(large, "X").otherwise(F.col("prioridad")),
        "cantidad_pendiente": F.when(large, F.coalesce("cantidad_pendiente", F.lit(0)) + 1)
        .otherwise(F.col("cantidad_pendiente")).cast("decimal(18,2)"),
        "nro_pedido": F.when(small, F.concat(F.lit("N"), "nro_pedido")).otherwise(F.col("nro_pedido")),
    })
    for store, rows in ((source, requests), (target, copied)):
        store.refresh("pedidos", rows)
        store.refresh("stock_critico", stock_rows)
    return sync.verify_content(
        source, target, {"pedidos": ("nro_pedido", "codigo"), "stock_critico": ("codigo",)}
    )


@query
def smoke_run(t: Tables) -> DataFrame:
    """Requests and lots in a fresh store, one of them copied to another."""
    root = work_dir(t.spark, "smoke")
    source, target = TableStore(t.spark, f"{root}/origen"), TableStore(t.spark, f"{root}/destino")
    requests = roles.requests(t)
    source.refresh("pedidos", requests)
    source.refresh("vencimientos_parques", roles.lots(t))
    target.create("pedidos", requests.schema)
    return sync.smoke_run(source, target, "pedidos")


@query
def sync_counts(t: Tables) -> DataFrame:
    """Execution lines and requests against their deduplicated copies."""
    execution, requests = roles.execution(t, names=False), roles.requests(t)
    return quality.reconcile(
        {"ejecucion": execution, "pedidos": requests},
        {"ejecucion": dedupe.latest_items(execution, ITEM), "pedidos": requests},
    )


# --- quality --------------------------------------------------------------------------------


@query
def quality_report(t: Tables) -> DataFrame:
    df = roles.lines_of_orders(t).select(
        F.when(F.col("l_returnflag") == "N", F.concat(F.lit("LL-"), "l_linestatus"))
        .otherwise(F.col("l_orderkey").cast("string"))
        .alias("id_llamado"),
        F.concat(F.col("l_linenumber").cast("string"),
                 F.when(F.col("l_tax") > 0, "-2.2").otherwise("")).alias("item"),
        F.when(F.col("l_discount") > 0, F.col("l_partkey")).alias("codigo"),
    )
    return quality.quality_report(df, ["id_llamado", "codigo", "proveedor"])


@query
def schema_contract(t: Tables) -> DataFrame:
    df = roles.requests(t).select(
        F.col("nro_pedido").cast("bigint").alias("nro_pedido"),
        "codigo", "medicamento", "cantidad_solicitada", "cantidad_pendiente", "fecha_solicitud",
    )
    contract = (
        T.StructType()
        .add("nro_pedido", T.StringType(), False)
        .add("codigo", T.StringType(), False)
        .add("medicamento", T.StringType())
        .add("cantidad_solicitada", T.DecimalType(18, 2), False)
        .add("cantidad_pendiente", T.DecimalType(18, 2), False)
        .add("fecha_solicitud", T.DateType())
        .add("observaciones", T.StringType())
    )
    return quality.schema_contract(df, contract, {"codigo": 4, "medicamento": 255})


@query
def text_migration(t: Tables) -> DataFrame:
    """Item and code columns that an older table holds as numbers, turned to text."""
    df = t.lineitem.select(
        F.col("l_orderkey").alias("id_llamado"),
        F.col("l_linenumber").alias("item"),
        F.col("l_partkey").alias("codigo"),
    )
    return quality.to_text_columns(df, ["item", "codigo", "observaciones"])


@query
def schema_drift(t: Tables) -> DataFrame:
    """A table whose files came over time: items and codes as numbers in some, as text in others.
    Only the drifted files are written again, as text."""
    root = work_dir(t.spark, "deriva")
    contract = (
        T.StructType().add("id_llamado", T.LongType()).add("item", T.StringType()).add("codigo", T.StringType())
    )
    kinds = {"A": ("string", "string"), "N": ("int", "string"), "R": ("string", "bigint")}
    for flag, (item, code) in kinds.items():
        t.lineitem.where(F.col("l_returnflag") == flag).select(
            F.col("l_orderkey").cast("bigint").alias("id_llamado"),
            F.col("l_linenumber").cast(item).alias("item"), F.col("l_partkey").cast(code).alias("codigo"),
        ).write.parquet(f"{root}/{flag}")
    files = [path for flag in kinds for path in csv.data_files(t.spark, f"{root}/{flag}")]
    kept, _ = drift.rewrite_drifted(t.spark, files, contract, f"{root}/texto")
    return t.spark.read.schema(contract).parquet(*kept)


@query
def table_counts(t: Tables) -> DataFrame:
    return quality.table_counts(
        {
            "ordenes": roles.orders(t),
            "ejecucion": roles.execution(t, names=False),
            "stock_critico": t.part,
            "pedidos": t.orders,
            "vencimientos_parques": roles.lots(t),
        }
    )
