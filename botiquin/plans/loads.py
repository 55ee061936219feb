"""From raw text extracts to clean tables.

Each extract is one projection and one dedupe over an all-text frame whose ``_row`` column gives
the input order. The order of steps matters where keys are compared before or after cleaning, and
differs per extract.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botiquin.contracts import (
    EXECUTION_HEADERS,
    EXPIRY_HEADERS,
    KEYS,
    LOAD_ORDER,
    LOAD_ORDER_COLUMN,
    MEASURE,
    MEASURE_NAME_HEADERS,
    MEASURE_VALUE_HEADERS,
    ORDERS_HEADERS,
    REQUESTS_HEADERS,
    SCHEMAS,
    SELF_FILLED,
    STOCK_HEADERS,
)
from botiquin.functions.dates import date_text, parse_dates
from botiquin.functions.numbers import normalize_id, read_number
from botiquin.functions.text import strip_ws, tokens_to_null
from botiquin.operators.dedupe import keep_first, keep_newest_date
from botiquin.operators.quality import Watched
from botiquin.session import partitions_for, remove_dir, work_dir
from botiquin.sources.csv import (
    ROW,
    excess_rows,
    find_files,
    hidden_files,
    read_extract,
    with_clean_headers,
)
from botiquin.sources.headers import add_missing, quoted, select_mapped
from botiquin.sources.store import TableStore, fit_to, misfits, stamp_defaults

# Columns by the way they are cleaned.
_ORDERS_TEXT = (
    "item", "codigo", "oc", "llamado", "producto", "estado", "stock", "referencia",
    "proveedor", "lugar_entrega_oc", "plazo_entrega", "tipo_vigencia", "vigencia",
    "det_recep", "id_llamado",
)
_ORDERS_NUMBERS = (
    "cant_oc", "monto_oc", "saldo", "p_unit", "cant_recep", "monto_recepcion",
    "monto_saldo", "dias_de_atraso",
)
_ORDERS_DATES = ("fecha_oc", "fec_contrato", "fec_ult_recep", "fecha_recibido_proveedor")
_EXECUTION_TEXT = (
    "item", "codigo", "id_llamado", "licitacion", "proveedor", "medicamento",
    "estado_stock", "estado_contrato", "ejecucion_mayor_al_50", "obs",
)
_EXECUTION_NUMBERS = (
    "cantidad_maxima", "cantidad_emitida", "cantidad_recepcionada",
    "cantidad_distribuida", "monto_adjudicado", "monto_emitido", "saldo",
    "porcentaje_emitido", "cantidad_ampliacion", "porcentaje_ampliado",
    "porcentaje_ampliacion_emitido",
)
_STOCK_TEXT = (
    "producto", "concentracion", "forma_farmaceutica", "presentacion", "clasificacion",
    "estado_stock", "oc",
)
_STOCK_NUMBERS = (
    "meses_en_movimiento", "cantidad_distribuida", "stock_actual", "stock_reservado",
    "stock_disponible", "dmp", "stock_hosp",
)
_REQUESTS_TEXT = (
    "nro_pedido", "simese", "codigo", "medicamento", "estado", "prioridad", "nro_oc",
    "opciones",
)
_REQUESTS_NUMBERS = ("stock", "dmp", "cantidad", "meses_cantidad", "dias_transcurridos")
_EXPIRY_TEXT = ("codigo", "descripcion", "parque", "observaciones")


def _type(table: str, column: str) -> str:
    return SCHEMAS[table][column].dataType.simpleString()


def _apply(df: DataFrame, columns: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: fn(F.col(c)) for c in present}) if present else df


def _texts(
    df: DataFrame, columns: Sequence[str], but: Sequence[str] = (), empty: bool = False
) -> DataFrame:
    """Blank to null, or to empty text. Stripping is a step of its own, so it is done once."""
    columns = [c for c in columns if c not in but]
    df = _apply(_apply(df, columns, strip_ws), columns, tokens_to_null)
    return _apply(df, columns, lambda c: F.coalesce(c, F.lit(""))) if empty else df


def _numbers(df: DataFrame, table: str, columns: Sequence[str], zero: bool) -> DataFrame:
    """Numbers of the table's types; what is none becomes zero or null."""
    df = _apply(df, columns, strip_ws)

    def number(name: str) -> Column:
        dtype = _type(table, name)
        # Whole-number columns: read as a number first, then cut to the column's type.
        wide = dtype if "decimal" in dtype else "decimal(38,6)"
        c = read_number(F.col(name), wide)
        c = c if wide == dtype else c.try_cast(dtype)
        return F.coalesce(c, F.lit(0).cast(dtype)) if zero else c

    return df.withColumns({c: number(c) for c in columns if c in df.columns})


def _done(df: DataFrame, keep_row: bool) -> DataFrame:
    """Without the place of the rows, unless it is asked for."""
    return df if keep_row else df.drop(ROW)


def clean_orders(
    raw: DataFrame, strict_first_format: bool = False, keep_row: bool = False, partitions: int | None = None
) -> DataFrame:
    """Texts never null, numbers never null, dates as dd/mm/yyyy text, newest order date kept.
    (FN-2, FN-6, FN-9, FN-11, WIN-4)

    Only keys and order date are cleaned ahead of the dedupe; the other cells wait until their
    row is known to stay.
    """
    keys = KEYS["ordenes"]
    df = select_mapped(with_clean_headers(raw), ORDERS_HEADERS, ROW)
    dates = [c for c in _ORDERS_DATES if c in df.columns]
    # A column's format shows in all its rows, so the strict rule looks at them before the dedupe.
    early = dates if strict_first_format else [c for c in dates if c == "fecha_oc"]
    df = _texts(df, keys, empty=True)
    df = parse_dates(df, early, strict_first_format)
    df = keep_newest_date(df, keys, F.col("fecha_oc") if "fecha_oc" in dates else None, ROW, partitions)
    df = _texts(_done(df, keep_row), _ORDERS_TEXT, but=keys, empty=True)
    df = _numbers(df, "ordenes", _ORDERS_NUMBERS, zero=True)
    df = parse_dates(df, [c for c in dates if c not in early])
    return _apply(df, dates, date_text)


def clean_execution(raw: DataFrame, keep_row: bool = False, partitions: int | None = None) -> DataFrame:
    """Texts blank to null, then the first row per item, numbers never null.
    (FN-1, WIN-5, FN-6)"""
    keys = KEYS["ejecucion"]
    df = select_mapped(with_clean_headers(raw), EXECUTION_HEADERS, ROW)
    df = _done(keep_first(_texts(df, keys), keys, ROW, partitions), keep_row)
    df = _texts(df, _EXECUTION_TEXT, but=keys)
    return _numbers(df, "ejecucion", _EXECUTION_NUMBERS, zero=True)


def clean_stock(raw: DataFrame, keep_row: bool = False, partitions: int | None = None) -> DataFrame:
    """Code never null, first row per code, missing columns added, the rest blank to null.
    (FN-2, WIN-6, PRJ-5, FN-3, FN-7)"""
    keys = KEYS["stock_critico"]
    df = select_mapped(with_clean_headers(raw), STOCK_HEADERS, ROW)
    df = _done(keep_first(_texts(df, keys, empty=True), keys, ROW, partitions), keep_row)
    df = add_missing(df, {"stock_hosp": "string", "oc": "string"})
    df = _texts(df, _STOCK_TEXT)
    return _numbers(df, "stock_critico", _STOCK_NUMBERS, zero=False)


def clean_requests(
    raw: DataFrame, strict_first_format: bool = False, keep_row: bool = False, partitions: int | None = None
) -> DataFrame:
    """First row per request and code as written, then blank to null throughout.
    (WIN-7, FN-1, FN-7, FN-9)"""
    df = select_mapped(with_clean_headers(raw), REQUESTS_HEADERS, ROW)
    if {"nro_pedido", "codigo"} <= set(df.columns):
        df = keep_first(df, KEYS["pedidos"], ROW, partitions)
    df = _numbers(_texts(df, _REQUESTS_TEXT), "pedidos", _REQUESTS_NUMBERS, zero=False)
    return _done(parse_dates(df, ["fecha_pedido", "fecha_oc"], strict_first_format), keep_row)


def keep_measure(raw: DataFrame) -> DataFrame:
    """Long extracts: keep the rows of the stock measure, its value becomes the stock. (FIL-1)"""
    name = next((c for c in MEASURE_NAME_HEADERS if c in raw.columns), None)
    value = next((c for c in MEASURE_VALUE_HEADERS if c in raw.columns), None)
    if name is None or value is None:
        return raw
    kept = raw.where(F.upper(strip_ws(quoted(name))) == MEASURE)
    return kept.withColumnRenamed(value, "stock_disponible")


def clean_expiry(
    raw: DataFrame, strict_first_format: bool = False, keep_row: bool = False, partitions: int | None = None
) -> DataFrame:
    """First lot per code, depot and date as written, then texts blank to null, stock never
    null. (FIL-1, WIN-8, FN-1, FN-6, FN-9)"""
    df = keep_measure(with_clean_headers(raw))
    df = select_mapped(df, EXPIRY_HEADERS, ROW)
    df = _texts(keep_first(df, KEYS["vencimientos_parques"], ROW, partitions), _EXPIRY_TEXT)
    df = _numbers(df, "vencimientos_parques", ["stock_disponible"], zero=True)
    return _done(parse_dates(df, ["fec_vencimiento"], strict_first_format), keep_row)


@dataclass(frozen=True)
class Extract:
    """A kind of extract: its target table and its cleaning."""

    table: str
    clean: Callable[[DataFrame], DataFrame]


EXTRACTS: Mapping[str, Extract] = {
    "ordenes": Extract("ordenes", clean_orders),
    "ejecucion": Extract("ejecucion", clean_execution),
    "stock": Extract("stock_critico", clean_stock),
    "pedidos": Extract("pedidos", clean_requests),
    "vencimientos_parques": Extract("vencimientos_parques", clean_expiry),
}


def unusable_id(dtype: str = "bigint") -> Column:
    """Whether a row's id_llamado is neither a number of the type nor blank. (FN-23)"""
    return normalize_id(F.col("id_llamado"), dtype).isNull() & (
        F.coalesce(F.trim("id_llamado"), F.lit("")) != ""
    )


@dataclass(frozen=True)
class Loaded:
    """What became of one extract.

    ``set_aside`` counts rows with an unusable id and rows with too many cells, ``misfits`` cells
    that do not fit their column's type, ``omitted`` the target columns the extract does not bring,
    ``hidden`` names the files that a file of exactly the extract's name keeps from being read.
    """

    name: str
    table: str
    status: str
    rows: int
    set_aside: int
    misfits: int = 0
    omitted: tuple[str, ...] = ()
    findings: tuple[str, ...] = ()
    hidden: tuple[str, ...] = ()


_ASIDE = "_aparte"
# Fixed value: bytes of an extract's files per partition of its dedupe, so that the memory of one
# task stays bounded as the extracts grow.
_DEDUPE_BYTES = 4 * 1024 * 1024


def _load_order() -> Column:
    """A row's place as the loaded tables keep it; the store adds the number of the batch."""
    row = F.col(ROW)
    place = {"carga": F.lit(None).cast("bigint"), "archivo": row["file"], "bloque": row["block"], "fila": row["n"]}
    return F.struct(*[c.alias(name) for name, c in place.items()])


def load_extract(
    store: TableStore,
    name: str,
    raw: DataFrame,
    target: T.StructType | None = None,
    excess: DataFrame | None = None,
    partitions: int | None = None,
) -> Loaded:
    """Clean an extract and replace its table; rows with an unusable id go to
    ``<table>_apartados``, rows with more cells than the header to ``<table>_sobrantes``.
    (SNK-1, SNK-2, DQ-1 to DQ-3)

    The tables become visible together or not at all; a load without rows changes none of them.
    Findings and misfits are counted while the cleaned rows are staged, and the staged copy is read
    once: the rows of the table and those set aside lie in partitions of their own. ``partitions``
    is the number of partitions of the dedupe's shuffle where the session's number is too few.
    """
    extract = EXTRACTS[name]
    target = target or SCHEMAS[extract.table]
    cleaned = extract.clean(raw, keep_row=True, partitions=partitions)
    has_id = "id_llamado" in cleaned.columns
    kind = target["id_llamado"].dataType.simpleString() if has_id else ""
    aside = unusable_id(kind) if has_id else F.lit(False)
    own = cleaned.drop(ROW)
    # Fails before anything is written if the extract has no column of the target.
    fit_to(own, target)
    lost = F.sum(F.when(~aside, misfits(own.drop("id_llamado"), target)).otherwise(0))
    watched = Watched(
        cleaned, extract.table, [c for c in KEYS[extract.table] if c in cleaned.columns], {"misfits": lost}
    )
    staged = work_dir(store.spark, f"load-{name}")
    watched.frame.withColumn(_ASIDE, aside).write.partitionBy(_ASIDE).parquet(staged)
    schema = T.StructType([*cleaned.schema.fields, T.StructField(_ASIDE, T.BooleanType())])
    df = store.spark.read.schema(schema).parquet(staged)
    staged_rows = df.count()
    good, bad = df.where(~F.col(_ASIDE)), df.where(F.col(_ASIDE))
    if has_id:
        good = good.withColumn("id_llamado", normalize_id(F.col("id_llamado"), kind))
    ordered = LOAD_ORDER_COLUMN in target.names and ROW in cleaned.columns
    if ordered:
        good = good.withColumn(LOAD_ORDER_COLUMN, _load_order())
    fitted, omitted = fit_to(good, target)
    load = store.load(extract.table)
    rows = load.write(extract.table, stamp_defaults(fitted, target))
    set_aside = 0
    if has_id:
        # May be empty: a clean load leaves nothing of an earlier one's rejects.
        set_aside += load.write(f"{extract.table}_apartados", bad.drop(_ASIDE, ROW))
    if excess is not None:
        set_aside += load.write(f"{extract.table}_sobrantes", excess)
    if rows:
        load.commit()
    remove_dir(store.spark, staged)
    findings = watched.findings(staged_rows)
    return Loaded(
        name, extract.table, "OK" if rows else "VACIO", rows, set_aside,
        watched.figures(staged_rows)["misfits"], tuple(omitted), (*findings.errors, *findings.warnings),
    )


def _load_one(spark: SparkSession, folder: str, store: TableStore, name: str) -> Loaded:
    files, table = find_files(spark, folder, name), EXTRACTS[name].table
    hidden = tuple(hidden_files(spark, folder, name))
    if not files:
        return Loaded(name, table, "OMITIDO", 0, 0)
    try:
        raw, excess = read_extract(spark, files), excess_rows(spark, files)
        spread = partitions_for(spark, files, _DEDUPE_BYTES)
        return replace(load_extract(store, name, raw, excess=excess, partitions=spread), hidden=hidden)
    except Exception as error:  # noqa: BLE001 - reported per extract, as the others go on
        return Loaded(name, table, f"ERROR: {error}", 0, 0, hidden=hidden)


def load_folder(
    spark: SparkSession,
    folder: str,
    store: TableStore,
    names: Sequence[str] = LOAD_ORDER,
    at_once: int = len(LOAD_ORDER),
) -> list[Loaded]:
    """Load the extracts found in a folder, each from all its files, and report them in their fixed
    order; missing extracts are skipped and a failing one does not stop the rest. (SRC-7, SRC-8)

    The extracts fill tables of their own, so ``at_once`` of them share the cluster.
    """
    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return list(pool.map(lambda name: _load_one(spark, folder, store, name), names))
