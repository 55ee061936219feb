"""Figures, rankings and choice lists of the reports.

Each set of figures is one aggregation pass. Null groups are dropped and empty sums are zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botiquin.contracts import CRITICAL_COLUMNS, LOW_COVERAGE_COLUMNS, SUMMARY_COLUMNS
from botiquin.functions.stock import coverage_grid
from botiquin.functions.text import display_key
from botiquin.operators.filters import critical, low_coverage, mentions, positive
from botiquin.operators.paging import sort_board, top
from botiquin.sources.headers import existing


def _rows() -> Column:
    return F.count(F.lit(1))


def _total(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)) if column in df.columns else F.lit(0)


def board_kpis(board: DataFrame) -> DataFrame:
    """Items, critical items and share, estimated amount, requested quantity. (AGG-3)

    The amount is the total quantity times the mean price, missing prices counted as zero.
    """
    totals = board.agg(
        _rows().alias("total_items"),
        F.count_if(critical(F.col("nivel_stock"))).alias("items_criticos"),
        _total(board, "cantidad_maxima").alias("_quantity"),
        F.sum(F.coalesce("precio_unitario", F.lit(0))).alias("_prices"),
        _total(board, "cantidad_solicitada").alias("cantidad_solicitada"),
    )
    mean_price = F.try_divide(F.col("_prices").cast("double"), F.col("total_items").cast("double"))
    share = F.try_divide(F.col("items_criticos") * F.lit(100.0), F.col("total_items"))
    return totals.select(
        "total_items",
        "items_criticos",
        F.coalesce(share, F.lit(0.0)).alias("porcentaje_criticos"),
        F.when(mean_price > 0, F.col("_quantity").cast("double") * mean_price)
        .otherwise(0.0)
        .alias("monto_estimado"),
        "cantidad_solicitada",
    )


def critical_items(board: DataFrame) -> DataFrame:
    return existing(board.where(critical(F.col("nivel_stock"))), CRITICAL_COLUMNS)


def low_coverage_items(board: DataFrame) -> DataFrame:
    return existing(board.where(low_coverage(F.col("cobertura_meses"))), LOW_COVERAGE_COLUMNS)


def consumption(board: DataFrame, n: int = 10) -> DataFrame:
    """The tenders with the largest quantities. (AGG-4, TOP-1)"""
    sums = (
        board.where(F.col("licitacion").isNotNull())
        .groupBy("licitacion")
        .agg(
            F.coalesce(F.sum("cantidad_maxima"), F.lit(0)).alias("cantidad_maxima"),
            F.coalesce(F.sum("cantidad_emitida"), F.lit(0)).alias("cantidad_emitida"),
        )
    )
    return top(sums, "cantidad_maxima", n, ties=["licitacion"])


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, nulls left out. (AGG-5)"""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(_rows().alias("cantidad"))
        .orderBy(F.col("cantidad").desc(), column)
    )


def orders_kpis(orders: DataFrame) -> DataFrame:
    """(AGG-6)"""
    return orders.agg(
        _rows().alias("total_ordenes"),
        _total(orders, "saldo").alias("saldo_total"),
        F.count_if(mentions(F.col("estado"))).alias("pendientes"),
    )


def pending_orders(orders: DataFrame) -> DataFrame:
    return orders.where(mentions(F.col("estado")))


def requests_kpis(requests: DataFrame) -> DataFrame:
    """(AGG-7)"""
    return requests.agg(
        _rows().alias("total_pedidos"),
        _total(requests, "cantidad_solicitada").alias("solicitada_total"),
        _total(requests, "cantidad_pendiente").alias("pendiente_total"),
    )


def pending_requests(requests: DataFrame) -> DataFrame:
    return requests.where(positive(F.col("cantidad_pendiente")))


def execution_kpis(execution: DataFrame) -> DataFrame:
    """(AGG-8)"""
    return execution.agg(
        _rows().alias("total_items"),
        _total(execution, "cantidad_ejecutada").alias("cantidad_total"),
        _total(execution, "monto_total").alias("monto_total"),
    )


def largest_amounts(execution: DataFrame, n: int = 100, ties: Sequence[str] = ()) -> DataFrame:
    """(TOP-2)"""
    return top(execution, "monto_total", n, ties)


def stock_kpis(stock: DataFrame) -> DataFrame:
    """(AGG-9)"""
    return stock.agg(
        _rows().alias("total_productos"),
        F.count_if(F.col("estado") == "critico").alias("criticos"),
        _total(stock, "stock_disponible").alias("stock_total"),
    )


def critical_stock(stock: DataFrame) -> DataFrame:
    return stock.where(F.col("estado") == "critico")


def options(
    df: DataFrame, column: str, limit: int | None = None, keep_null: bool = False
) -> DataFrame:
    """Distinct values for a choice list, sorted and cut when a limit is given. (AGG-12)"""
    values = df.select(column).distinct()
    if not keep_null:
        values = values.where(F.col(column).isNotNull())
    return values.orderBy(column).limit(limit) if limit else values


def tender_pairs(execution: DataFrame) -> DataFrame:
    """Distinct tenders with their display key, newest id first. (AGG-14, FN-25)"""
    return (
        execution.select("id_llamado", "licitacion")
        .distinct()
        .withColumn("display", display_key(F.col("id_llamado"), F.col("licitacion")))
        .orderBy(F.col("id_llamado").desc_nulls_last(), F.col("licitacion").asc_nulls_last())
    )


def preview(board: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The first rows of the summary table. (PRJ-11, LIM-1)"""
    return existing(sort_board(board, keys).limit(n), SUMMARY_COLUMNS)


def grid(board: DataFrame) -> DataFrame:
    """Coverage as recomputed in the edit grid, and the flag of its red rows. (FN-16c)"""
    months = coverage_grid(
        F.col("stock_actual"), F.col("cantidad_solicitada"), F.col("dmp_actual")
    )
    return board.withColumn("cobertura_grilla", months).withColumn(
        "fila_roja", F.coalesce(F.col("cobertura_grilla") < 1, F.lit(False))
    )
