"""The driver's tables in the roles of the supply tables.

Whole tables throughout. Some texts get blanks, padding or nulls by rule, so that the cleaning and
matching rules have something to work on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from botiquin.contracts import CLOSED_STATES
from botiquin.operators.dedupe import keep_latest
from botiquin.plans.board import BoardInputs
from botiquin.session import partitions_for

# The day that counts as today for expiry and alerts: inside the ship dates, near their end.
AS_OF = dt.date(2001, 6, 1)
# Items repeat per tender and line; the product code alone would make nearly all unique.
ITEM = ("id_llamado", "licitacion", "item")
# Fixed value: bytes of lineitem's and orders' Parquet files per partition of their join.
_TABLE_BYTES = 4 * 1024 * 1024
# Of lines with their suppliers, the columns that execution and orders are made of.
_SUPPLIED = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_returnflag", "l_linestatus", "l_shipdate", "s_name",
)


class Tables:
    """Lazy readers of the Parquet tables below a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def money(name: str, dtype: str = "decimal(18,2)") -> Column:
    return F.col(name).cast(dtype)


def age_order() -> Column:
    """Total order of line items that stands for a load order."""
    return F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def line_order() -> Column:
    """Total order of line items that stands for the order of rows in a file."""
    return F.struct(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax",
    )


def lines_of_orders(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """Lines with their orders, dealt out by order into partitions that grow with the tables where
    the session's number is too few. Windows and joins keyed by the order reuse that partitioning,
    so one task's share stays bounded. ``lines``: lineitem with what was joined to it before."""
    items, orders, parts = t.lineitem if lines is None else lines, t.orders, spread(t)
    if parts is not None:
        items, orders = items.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")
    return _of_orders(items, orders)


def _of_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def with_suppliers(t: Tables, lines: DataFrame) -> DataFrame:
    return lines.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))


def supplied_lines_of_orders(t: Tables) -> DataFrame:
    """Lines with their suppliers and orders, as several roles of one query read them.

    The lines are dealt out by order with the other columns in one, so that no reader's choice of
    columns or filter changes that exchange: Spark makes it, and the join below it, once for all."""
    lines, parts = with_suppliers(t, t.lineitem), spread(t)
    rest = [c for c in _SUPPLIED if c != "l_orderkey"]
    lines = lines.select("l_orderkey", F.array(F.struct(*rest)).alias("_line"))
    lines = lines.repartition(*([parts] if parts else []), "l_orderkey")
    orders = t.orders.repartition(parts, "o_orderkey") if parts else t.orders
    return _of_orders(lines.select("l_orderkey", F.inline("_line")), orders)


def spread(t: Tables) -> int | None:
    """Partitions for lineitem and orders and what derives from them, by the size of their files;
    None where the session's number already suffices."""
    return partitions_for(t.spark, t.lineitem.inputFiles() + t.orders.inputFiles(), _TABLE_BYTES)


def execution(
    t: Tables, names: bool = True, dirty: bool = False, supplied: DataFrame | None = None
) -> DataFrame:
    """Execution lines. ``dirty`` pads some codes and blanks others.

    The join that comes last says by what the lines are dealt out: by order, which is the call id,
    or, with the ``supplied`` lines of orders given, by the trimmed code, whose text then is the key
    of the join with part."""
    code = F.col("l_partkey").cast("string")
    if supplied is not None:
        df = supplied.join(t.part, F.trim(code) == F.trim(F.col("p_partkey").cast("string")))
    elif names:
        named = with_suppliers(t, t.lineitem).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        df = lines_of_orders(t, named)
    else:
        df = lines_of_orders(t)
    if dirty:
        code = (
            F.when((F.col("l_discount") == 0.1) & (F.col("l_linestatus") == "F"), "  ")
            .when(F.col("l_discount") == 0.1, F.lit(None))
            .when(F.col("l_linestatus") == "O", F.concat(F.lit(" "), code, F.lit(" ")))
            .otherwise(code)
        )
    closed = F.col("l_linestatus") == "F"
    units = F.col("l_quantity").cast("int")
    quantity = units.cast("decimal(18,2)")
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    price = (cents - cents % units) / units / 100
    return df.select(
        age_order().alias("id"),
        F.col("l_orderkey").alias("id_llamado"),
        F.col("o_orderpriority").alias("licitacion"),
        code.alias("codigo"),
        F.col("l_linenumber").cast("string").alias("item"),
        *([F.col("s_name").alias("proveedor"), F.col("p_name").alias("medicamento")] if names
          else []),
        quantity.alias("cantidad_maxima"),
        F.when(closed, quantity).otherwise(0).alias("cantidad_emitida"),
        F.when(closed, 100).otherwise(0).cast("decimal(18,2)").alias("porcentaje_emitido"),
        F.when(F.col("l_returnflag") != "N", price.cast("decimal(18,4)")).alias("precio_unitario"),
        F.when(closed, quantity).alias("cantidad_ejecutada"),
        money("l_extendedprice").alias("monto_total"),
        F.col("l_shipdate").cast("date").alias("fecha_ejecucion"),
    )


def stock(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    return t.part.select(
        key.cast("string").alias("codigo"),
        F.col("p_name").alias("producto"),
        F.when(key % 3 == 0, 0).otherwise(key % 10 * 10).cast("decimal(18,2)").alias(
            "stock_disponible"
        ),
        F.lit(0).cast("decimal(18,2)").alias("stock_actual"),
        ((F.col("p_size") - 1) * 2).cast("decimal(18,2)").alias("dmp"),
        F.when(F.col("p_size") < 10, "critico")
        .when(F.col("p_size") < 25, "bajo")
        .when(F.col("p_size") < 45, "normal")
        .alias("estado"),
    )


def lots(t: Tables) -> DataFrame:
    """A lot per line; only those of accepted lines hold stock."""
    df = with_suppliers(t, t.lineitem)
    held = F.when(F.col("l_returnflag") == "A", F.col("l_quantity")).otherwise(0)
    return df.select(
        F.col("l_partkey").cast("string").alias("codigo"),
        F.col("l_shipdate").cast("date").alias("fec_vencimiento"),
        held.cast("decimal(18,2)").alias("stock_disponible"),
        F.col("s_nationkey").cast("string").alias("parque"),
    )


def orders(t: Tables, supplied: DataFrame | None = None) -> DataFrame:
    """Order lines; closed ones in all six states, padded and in mixed case, and some suppliers
    padded or missing."""
    if supplied is None:
        supplied = lines_of_orders(t, with_suppliers(t, t.lineitem))
    closed = F.array(*[F.lit(state) for state in CLOSED_STATES])
    closed = F.get(closed, (F.col("l_linenumber") - 1) % len(CLOSED_STATES))
    state = (
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), F.upper(closed), F.lit(" ")))
        .when((F.col("o_orderstatus") == "O") & (F.col("l_linenumber") == 2), F.initcap(closed))
        .when(F.col("o_orderstatus") == "P", "Pendiente")
    )
    supplier = (
        F.when(F.col("l_linenumber") == 3, F.concat(F.lit("  "), "s_name", F.lit(" ")))
        .when(F.col("l_linenumber") != 5, F.col("s_name"))
    )
    name = F.when(
        F.col("l_linestatus") == "O", F.concat(F.lit(" "), "o_orderpriority", F.lit("  "))
    ).otherwise(F.col("o_orderpriority"))
    return supplied.select(
        age_order().alias("id"),
        F.col("l_orderkey").alias("id_llamado"),
        name.alias("llamado"),
        supplier.alias("proveedor"),
        F.col("l_partkey").cast("string").alias("codigo"),
        F.col("l_linenumber").cast("string").alias("item"),
        F.concat(F.lit("OC-"), F.col("l_suppkey").cast("string")).alias("oc"),
        state.alias("estado"),
        money("l_extendedprice", "decimal(18,6)").alias("saldo"),
        F.col("l_shipdate").cast("date").alias("fecha_orden"),
    )


def contracts(t: Tables) -> DataFrame:
    df = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    segment = F.col("c_mktsegment")
    return df.select(
        F.col("o_orderkey").alias("id_llamado"),
        F.col("o_orderpriority").alias("licitacion"),
        F.when(segment == "BUILDING", "  ")
        .otherwise(F.concat(F.lit(" "), "c_name"))
        .alias("descripcion_llamado"),
        F.when(segment != "FURNITURE", segment).alias("dirigido_a"),
        F.concat(F.lit("Parque "), F.col("c_nationkey").cast("string")).alias("lugares"),
        F.when(F.col("o_orderstatus") == "F", "NO")
        .when(F.col("o_orderstatus") == "P", "SI")
        .alias("vigente"),
        money("o_totalprice", "decimal(18,4)").alias("precio_unitario"),
    )


def requested(t: Tables) -> DataFrame:
    """One request per item, from its newest line; only returned lines ask for a quantity."""
    asked = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0)
    df = lines_of_orders(t).select(
        age_order().alias("id"),
        F.col("l_orderkey").alias("id_llamado"),
        F.col("o_orderpriority").alias("licitacion"),
        F.col("l_partkey").cast("string").alias("codigo"),
        F.col("l_linenumber").cast("string").alias("item"),
        asked.cast("decimal(18,2)").alias("cantidad_solicitada"),
        F.col("l_shipdate").cast("date").alias("emitir_en"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("OC "), "o_orderstatus")).alias(
            "comentario"
        ),
    )
    return keep_latest(df, ["id_llamado", "licitacion", "codigo", "item"]).drop("id")


def requests(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").cast("string").alias("nro_pedido"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("codigo"),
        F.col("c_name").alias("medicamento"),
        F.col("o_orderstatus").alias("estado"),
        F.col("o_orderpriority").alias("prioridad"),
        money("o_totalprice").alias("cantidad_solicitada"),
        F.when(F.col("o_orderstatus") == "P", money("o_totalprice"))
        .when(F.col("o_orderstatus") == "O", 0)
        .alias("cantidad_pendiente"),
        F.col("o_orderdate").cast("date").alias("fecha_solicitud"),
    )


def board_inputs(t: Tables, names: bool = True, by_code: bool = False) -> BoardInputs:
    """``by_code``: the execution lines come with names and dealt out by code, not by call id."""
    supplied = supplied_lines_of_orders(t) if by_code else None
    return BoardInputs(
        execution=execution(t, names, supplied=supplied),
        contracts=contracts(t),
        orders=orders(t, supplied),
        stock=stock(t),
        lots=lots(t),
        requested=requested(t),
    )
