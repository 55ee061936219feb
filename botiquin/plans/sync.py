"""Copying tables from one store to another, in full or by time of change."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botiquin.contracts import KEYS, SYNC_ORDER
from botiquin.operators.quality import reconcile, table_counts
from botiquin.operators.reconcile import content_differences
from botiquin.sources.store import TableStore, fit_to, misfits, stamp_defaults


@dataclass(frozen=True)
class Synced:
    table: str
    success: bool
    rows: int
    synced_at: str
    message: str = ""


def sync_table(source: TableStore, target: TableStore, table: str) -> tuple[bool, int, str]:
    """Replace the target table by the source rows, in the target's columns. (SNK-6)

    An empty source counts as done and leaves the target as it was; a missing target fails. The
    message says why a copy failed, or which columns it left out and which cells did not fit.
    """
    df = source.read(table)
    if df.isEmpty():
        return True, 0, "origen vacío"
    if not target.exists(table):
        return False, 0, f"falta la tabla {table} en el destino"
    schema = target.read(table).schema
    try:
        fitted, omitted = fit_to(df, schema)
    except ValueError as error:
        return False, 0, str(error)
    notes = [f"sin columnas {', '.join(omitted)}"] if omitted else []
    lost = df.agg(F.sum(misfits(df, schema)).alias("n")).first()["n"]
    if lost:
        notes.append(f"{lost} valores no caben en su tipo")
    return True, target.refresh(table, stamp_defaults(fitted, schema)), "; ".join(notes)


def sync_all(
    source: TableStore, target: TableStore, tables: Sequence[str] = SYNC_ORDER, at_once: int = len(SYNC_ORDER)
) -> list[Synced]:
    """Every table with its result, in the fixed order; ``at_once`` of them share the cluster. (SNK-8)"""

    def one(table: str) -> Synced:
        try:
            success, rows, message = sync_table(source, target, table)
        except Exception as error:  # noqa: BLE001 - one table's failure is its result
            success, rows, message = False, 0, str(error)
        return Synced(table, success, rows, dt.datetime.now(dt.UTC).isoformat(), message)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return list(pool.map(one, tables))


def high_water_mark(target: DataFrame, column: str = "actualizado_en") -> object | None:
    """The newest time of change in the target: one value. (AGG-10)"""
    if column not in target.columns:
        return None
    return target.agg(F.max(column).alias("m")).first()["m"]


def changes_since(
    source: DataFrame, mark: object | None, column: str = "actualizado_en", inclusive: bool = False
) -> DataFrame:
    """Source rows after the mark, all rows without one. (SNK-7)

    The mark is a literal here, so the filter reaches the Parquet scan. Rows that share the mark's
    time are left out unless ``inclusive``; then the write must go by key.
    """
    if mark is None:
        return source
    c = F.col(column)
    return source.where(c >= F.lit(mark) if inclusive else c > F.lit(mark))


def sync_incremental(
    source: TableStore,
    target: TableStore,
    table: str,
    column: str = "actualizado_en",
    keys: Sequence[str] = (),
) -> bool:
    """Copy the changed rows: appended, or merged by key where keys are given. (SNK-7)

    A table without the time column on either side has no mark to go by: it is merged whole by key,
    or replaced where there are no keys.
    """
    have = target.read(table) if target.exists(table) else None
    if have is not None and not (column in have.columns and column in source.read(table).columns):
        rows = source.read(table)
        if keys:
            target.merge(table, rows, keys, newest=())
        else:
            target.refresh(table, rows)
        return True
    mark = None if have is None else high_water_mark(have, column)
    delta = changes_since(source.read(table), mark, column, inclusive=bool(keys))
    if have is None:
        target.refresh(table, delta)
    elif keys:
        target.merge(table, delta, keys, newest=(column,))
    elif not delta.isEmpty():
        target.append(table, delta.select(*have.columns))
    return True


def verify(
    source: TableStore, target: TableStore, tables: Sequence[str] = SYNC_ORDER
) -> DataFrame:
    """Row counts of both stores side by side. (JN-7, DQ-4)

    A table that one side lacks has no count there and does not agree.
    """
    return reconcile(
        {t: source.read(t) for t in tables if source.exists(t)},
        {t: target.read(t) for t in tables if target.exists(t)},
        tables,
    )


def verify_content(
    source: TableStore, target: TableStore, tables: Mapping[str, Sequence[str]] = KEYS
) -> DataFrame:
    """Rows that differ between two stores by table and key, though the counts may agree. (DQ-4)

    The key is a JSON object. Tables that one side lacks are what ``verify`` reports.
    """
    found = [
        content_differences(source.read(table), target.read(table), keys).select(
            F.lit(table).alias("tabla"),
            F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("clave"),
            "diferencia", "columnas",
        )
        for table, keys in tables.items()
        if source.exists(table) and target.exists(table)
    ]
    none = source.spark.createDataFrame([], "tabla string, clave string, diferencia string, columnas string")
    return reduce(DataFrame.unionByName, found, none)


# Fixed value: tables a smoke run looks for, and the one it copies.
SMOKE_TABLES = ("ordenes", "ejecucion", "stock_critico", "pedidos", "vencimientos_parques")


def smoke_run(source: TableStore, target: TableStore, table: str = SMOKE_TABLES[0]) -> DataFrame:
    """Is there data, does one table copy, do the counts agree, is there data on the other side:
    one row per step. (DQ-7)"""

    def rows(store: TableStore) -> int:
        have = {t: store.read(t) for t in SMOKE_TABLES if store.exists(t)}
        return table_counts(have).where("tabla = 'TOTAL'").first().registros if have else 0

    local = rows(source)
    copied = source.exists(table) and sync_table(source, target, table)[0]
    agrees = bool(copied) and target.exists(table) and bool(
        verify(source, target, [table]).first().coincide
    )
    remote = rows(target)
    steps = [
        ("datos de origen", local > 0, local),
        ("copia", bool(copied), source.count(table) if copied else 0),
        ("conteo", agrees, target.count(table) if agrees else 0),
        ("datos de destino", remote > 0, remote),
    ]
    return source.spark.createDataFrame(steps, "paso string, ok boolean, registros bigint")
