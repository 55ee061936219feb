"""Write-back of user edits into their tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botiquin.contracts import KEYS, SCHEMAS
from botiquin.operators.merge import contract_edits, edit_rows, stamp, unusable_ids
from botiquin.operators.reconcile import changed_rows_by_digest
from botiquin.sources.store import TableStore


def save_requested(
    store: TableStore, edits: DataFrame, original: DataFrame | None = None, at: Column | None = None
) -> int:
    """Upsert edited grid rows into cantidad_solicitada; comments survive. (SNK-4)

    With the frame as it was shown only changed rows are written. (JN-6)
    """
    table = "cantidad_solicitada"
    if original is not None:
        edits = changed_rows_by_digest(edits, original, KEYS[table])
    store.create(table, SCHEMAS[table])
    rows = stamp(edit_rows(edits), at=at)
    return store.merge(table, rows, KEYS[table])


def save_contract(store: TableStore, edits: DataFrame, at: Column | None = None) -> int:
    """Upsert contract data by tender id, with defaults; an id that is no number is an error.
    (SNK-5)"""
    table = "datosejecucion"
    store.create(table, SCHEMAS[table])
    rejected = unusable_ids(edits).limit(5).collect()
    if rejected:
        ids = ", ".join(repr(row["id_llamado"]) for row in rejected)
        raise ValueError(f"id_llamado is no number: {ids}")
    rows = stamp(contract_edits(edits), at=at)
    return store.merge(table, rows, KEYS[table])


def contract_of(store: TableStore, id_llamado: int) -> DataFrame:
    """The contract data of one tender. (SRC-6)"""
    return store.read("datosejecucion").where(F.col("id_llamado") == id_llamado)
