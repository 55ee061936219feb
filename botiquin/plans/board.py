"""The per-item board: execution joined with contracts, orders, stock, lots and requests.

Shape of the plan. Every right side is reduced to one row per join key first, with partial
aggregation on the map side, so no join multiplies rows and no hot key survives to the shuffle on
that side. Stock and unexpired lots, which share the code as key, become one side. Sides are not
hinted: a small one is broadcast by its measured size, a large one is sort-merged. The joins by
call share a stage, so the wide lines go to their calls once. A join that has a stage of its own,
as contracts without other sides by call have, lets adaptive skew handling split a hot key of the
execution side there, which a left join allows on its left side.

Only the joins that the asked columns need are made, which is safe because each right side has
one row per key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botiquin.contracts import BOARD_COLUMNS, ITEM_KEY
from botiquin.functions.stock import (
    coverage_exact,
    coverage_months,
    or_zero,
    stock_level,
    stock_level_legacy,
    stock_on_hand,
)
from botiquin.functions.text import name_or
from botiquin.operators.dedupe import (
    has_code,
    keep_first,
    keep_latest,
    keep_top,
    latest_items,
    trimmed,
)
from botiquin.operators.filters import open_order, unexpired

_STOCK = {"stock_actual", "dmp_actual", "cobertura_meses", "nivel_stock"}
_CONTRACT = {"nombre_llamado", "precio_unitario", "dirigido_a", "lugar", "vigente"}
_REQUEST = {"cantidad_solicitada", "ver_en_fecha", "comentario", "cobertura_meses", "nivel_stock"}


@dataclass
class BoardInputs:
    """The tables behind the board. Columns as in contracts.SCHEMAS."""

    execution: DataFrame
    contracts: DataFrame | None = None
    orders: DataFrame | None = None
    stock: DataFrame | None = None
    lots: DataFrame | None = None
    requested: DataFrame | None = None


def unexpired_stock(lots: DataFrame, as_of: dt.date) -> DataFrame:
    """Unexpired stock per code. (FIL-3, AGG-1)"""
    return (
        lots.where(F.col("codigo").isNotNull() & unexpired(F.col("fec_vencimiento"), as_of))
        .groupBy(trimmed("codigo").alias("codigo"))
        .agg(F.sum(or_zero(F.col("stock_disponible"))).alias("stock_sin_vencidos"))
    )


def pending_delivery(orders: DataFrame) -> DataFrame:
    """Open balance per tender, name, supplier and code, all trimmed. (FIL-4, AGG-2)

    Grouping by the trimmed texts merges keys that differ only in outer spaces, which would
    otherwise double board rows.
    """
    return (
        orders.where(has_code() & open_order(F.col("estado")))
        .groupBy(
            "id_llamado",
            F.coalesce(trimmed("llamado"), F.lit("")).alias("licitacion"),
            F.coalesce(trimmed("proveedor"), F.lit("")).alias("proveedor"),
            trimmed("codigo").alias("codigo"),
        )
        .agg(F.sum(or_zero(F.col("saldo"))).alias("pendiente_entrega"))
    )


def stock_by_code(
    stock: DataFrame | None, lots: DataFrame | None, as_of: dt.date, row: str | None = None
) -> DataFrame | None:
    """Stock, demand and unexpired lots in one row per code.

    Both kinds of rows go through one aggregation by code, whose partitions the board join can
    use as they are. ``row`` names the input order that says which stock row of a code counts;
    without it the one with the most stock does, as a second row would double board rows.
    """
    if stock is None:
        return None if lots is None else unexpired_stock(lots, as_of)
    coded = stock.where(has_code()).select(
        trimmed("codigo").alias("codigo"),
        or_zero(F.col("stock_disponible")).alias("stock_disponible"),
        (F.col("stock_actual") if "stock_actual" in stock.columns else F.lit(None))
        .cast("decimal(18,2)")
        .alias("stock_fisico"),
        or_zero(F.col("dmp")).alias("dmp"),
        *([row] if row else []),
    )
    if row:
        single = keep_first(coded, ["codigo"], row).drop(row)
    else:
        single = keep_latest(coded, ["codigo"], ["stock_disponible", "stock_fisico", "dmp"])
    single = single.withColumn("stock_fisico", or_zero(F.col("stock_fisico")))
    if lots is None:
        return single
    fresh = lots.where(F.col("codigo").isNotNull() & unexpired(F.col("fec_vencimiento"), as_of))
    fresh = fresh.select(
        trimmed("codigo").alias("codigo"), or_zero(F.col("stock_disponible")).alias("_lote")
    )
    # At most one stock row per code is left, so its maximum is that row.
    return (
        single.unionByName(fresh, allowMissingColumns=True)
        .groupBy("codigo")
        .agg(
            *[F.max(c).alias(c) for c in ("stock_disponible", "stock_fisico", "dmp")],
            F.sum("_lote").alias("stock_sin_vencidos"),
        )
    )


def _by_call(
    df: DataFrame,
    right: DataFrame,
    keys: Mapping[str, Column],
    dealt: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Left join of the ``right`` columns named in ``keys`` with the left side's expressions given
    there, of which only the first ``dealt``, id_llamado first, deal rows out; the others are checked
    within them. ``partitions``, if given, deals both sides out by those keys into that many
    partitions first.

    The execution side is dealt out by id_llamado, so the right sides keyed by call reuse that
    partitioning instead of each shuffling the wide lines again. Plain equality throughout: a missing
    key matches nothing. With one right row per key no row is multiplied.
    """
    right = right.select(*[F.col(c).alias(f"_r{c}") if c in keys else F.col(c) for c in right.columns])
    same = [c == F.col(f"_r{k}") for k, c in keys.items()]
    on = reduce(
        Column.__and__, [*same[:dealt], *[F.coalesce(c, F.lit(False)) for c in same[dealt:]]]
    )
    if partitions:
        df = df.repartition(partitions, *[*keys.values()][:dealt])
        right = right.repartition(partitions, *[f"_r{k}" for k in [*keys][:dealt]])
    return df.join(right, on, "left").drop(*[f"_r{k}" for k in keys])


def _newest_first(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """A total order by time of change, then by the other columns."""
    rest = [c for c in df.columns if c not in keys and c != "actualizado_en"]
    return [*(["actualizado_en"] if "actualizado_en" in df.columns else []), *rest]


def board(
    inputs: BoardInputs,
    as_of: dt.date,
    columns: Sequence[str] = BOARD_COLUMNS,
    legacy: bool = False,
    null_safe_keys: bool = False,
    dedupe_keys: Sequence[str] = ITEM_KEY,
    newest: Sequence[str] | None = None,
    stock_row: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One row per contract item. (JN-1 to JN-5, PRJ-12, FN-14 to FN-18)

    ``as_of`` is the day that counts as today. ``legacy`` gives the older definition: no item
    dedupe, coverage without stock and unrounded, levels by share of a month's demand.
    ``null_safe_keys`` lets a missing item, supplier or name match a missing one, which plain
    SQL equality does not. ``partitions``, if given, is the number of partitions into which the
    contracts are dealt out by call id and, with null-safe keys, both sides of the request join by
    call id and tender; those keys are then never null and compared plainly, so the join deals rows
    out by them.

    The lines go to their calls once. Where items are deduped they are there already, so the code
    join comes last; the legacy board, which keeps all lines, joins by code first, while the lines
    are narrow and may be dealt out by code as they come.
    """
    wanted = set(columns)
    execution = inputs.execution
    items = execution.where(has_code()) if legacy else latest_items(execution, dedupe_keys, newest)

    def key(c: Column) -> Column:
        return F.coalesce(c, F.lit("")) if null_safe_keys else c

    quantity = "decimal(18,2)"

    def col(df: DataFrame, name: str, dtype: str) -> Column:
        return F.col(name) if name in df.columns else F.lit(None).cast(dtype)

    def with_stock(df: DataFrame) -> DataFrame:
        """The only join by code; stock on hand and demand are all that goes on from it."""
        goods = stock_by_code(inputs.stock, inputs.lots, as_of, stock_row) if wanted & _STOCK else None
        if goods is not None:
            df = df.join(goods, "codigo", "left")
        stock = stock_on_hand(
            col(df, "stock_sin_vencidos", quantity),
            col(df, "stock_disponible", quantity),
            None if legacy else col(df, "stock_fisico", quantity),
        )
        return df.withColumns({"_dmp": or_zero(col(df, "dmp", quantity)), "_stock": stock})

    df = items.withColumn("codigo", trimmed("codigo"))
    if null_safe_keys:
        df = df.withColumn("_licitacion", key(trimmed("licitacion")))
    if legacy:
        df = with_stock(df)
    line_key = {
        "id_llamado": F.col("id_llamado"),
        "_licitacion": F.col("_licitacion") if null_safe_keys else trimmed("licitacion"),
        "_proveedor": key(trimmed("proveedor")) if "proveedor" in items.columns else F.lit(""),
        "codigo": F.col("codigo"),
        "_item": key(trimmed("item")),
    }
    by_pending = inputs.orders is not None and "pendiente_entrega" in wanted
    by_request = inputs.requested is not None and bool(wanted & _REQUEST)
    if by_pending:
        pending = pending_delivery(inputs.orders).select(
            "id_llamado",
            F.col("licitacion").alias("_licitacion"),
            F.col("proveedor").alias("_proveedor"),
            "codigo",
            "pendiente_entrega",
        )
        pending_key = ("id_llamado", "_licitacion", "_proveedor", "codigo")
        df = _by_call(df, pending, {k: line_key[k] for k in pending_key})
    contract = inputs.contracts is not None and bool(wanted & _CONTRACT)
    if contract:
        # As the only join by call, deduped under the id's text form, so that the join deals both
        # sides out anew and adaptive execution may split a hot id there. Beside others it is part of
        # their stage, which is not split, and the contracts are dealt out by the id once.
        among = by_pending or by_request
        newest_first = _newest_first(inputs.contracts, ["id_llamado"])
        contracts = keep_top(
            inputs.contracts.where(F.col("id_llamado").isNotNull()),
            [F.col("id_llamado") if among else F.col("id_llamado").cast("string")],
            [F.col(c).desc_nulls_last() for c in newest_first],
            partitions if among else None,
        )
        d = contracts.select(
            "id_llamado",
            "descripcion_llamado",
            "dirigido_a",
            "lugares",
            "vigente",
            F.col("precio_unitario").alias("_precio_contrato"),
        )
        df = df.join(d, "id_llamado", "left")
    if by_request:
        r = inputs.requested.select(
            "id_llamado",
            key(trimmed("licitacion")).alias("_licitacion"),
            trimmed("codigo").alias("codigo"),
            key(trimmed("item")).alias("_item"),
            F.col("cantidad_solicitada").alias("_solicitada"),
            "emitir_en",
            "comentario",
            (F.col("actualizado_en") if "actualizado_en" in inputs.requested.columns
             else F.lit(None).cast("timestamp")).alias("_cambio"),
        )
        request_key = ["id_llamado", "_licitacion", "codigo", "_item"]
        r = keep_latest(r, request_key, ["_cambio", "_solicitada", "emitir_en", "comentario"])
        request_key = {k: line_key[k] for k in request_key}
        if null_safe_keys:
            df = _by_call(df, r.drop("_cambio"), request_key, 2, partitions)
        else:
            df = _by_call(df, r.drop("_cambio"), request_key)
    if not legacy:
        df = with_stock(df)

    df = df.withColumns(
        {
            "_maxima": or_zero(col(df, "cantidad_maxima", quantity)),
            "_emitida": or_zero(col(df, "cantidad_emitida", quantity)),
            "_pedida": or_zero(col(df, "_solicitada", quantity)),
        }
    )
    saldo = F.col("_maxima") - F.col("_emitida")
    if legacy:
        coverage = coverage_exact(saldo + F.col("_pedida"), F.col("_dmp"))
        level = stock_level_legacy(F.col("_stock"), F.col("_dmp"))
    else:
        coverage = coverage_months(F.col("_stock") + saldo + F.col("_pedida"), F.col("_dmp"))
        level = stock_level(F.col("_stock"), F.col("_dmp"), F.col("cobertura_meses"))
    df = df.withColumn("cobertura_meses", coverage)
    price = col(df, "precio_unitario", "decimal(18,4)")
    output = {
        "id_llamado": F.col("id_llamado"),
        "licitacion": F.col("licitacion"),
        "nombre_llamado": (
            name_or(F.col("descripcion_llamado"), F.col("licitacion"))
            if contract
            else F.col("licitacion")
        ),
        "codigo": F.col("codigo"),
        "producto": col(df, "medicamento", "string"),
        "proveedor": col(df, "proveedor", "string"),
        "cantidad_maxima": F.col("_maxima"),
        "cantidad_emitida": F.col("_emitida"),
        "saldo_contrato": saldo,
        "porcentaje_emitido": or_zero(col(df, "porcentaje_emitido", quantity)),
        "precio_unitario": F.coalesce(price, F.col("_precio_contrato")) if contract else price,
        "item": F.col("item"),
        "dirigido_a": F.coalesce(col(df, "dirigido_a", "string"), F.lit("")),
        "lugar": F.coalesce(col(df, "lugares", "string"), F.lit("")),
        "vigente": F.coalesce(col(df, "vigente", "string"), F.lit("")),
        "pendiente_entrega": or_zero(col(df, "pendiente_entrega", "decimal(18,6)")),
        "stock_actual": F.col("_stock"),
        "dmp_actual": F.col("_dmp"),
        "cantidad_solicitada": F.col("_pedida"),
        "ver_en_fecha": col(df, "emitir_en", "date"),
        "comentario": col(df, "comentario", "string"),
        "cobertura_meses": F.col("cobertura_meses"),
        "nivel_stock": level,
    }
    return df.select(*[output[c].alias(c) for c in columns])
