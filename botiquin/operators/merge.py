"""Keyed writes: upserts, row differences, edit rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botiquin.functions.dates import parse_date
from botiquin.functions.numbers import normalize_id, to_number_or_zero
from botiquin.functions.text import or_default, strip_ws
from botiquin.operators.dedupe import keep_latest


def upsert(
    base: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    newest: Sequence[str] = ("actualizado_en",),
) -> DataFrame:
    """The table after inserting or updating by key. (SNK-4)

    Only the columns the updates bring are set on matched rows, so others such as a comment
    survive. Several updates of one key count as one, the newest, and an update that is older than
    the table's row by the ``newest`` columns both have leaves that row as it is; at the same time
    the update wins. Null key parts match each other, so a replayed batch changes nothing.
    """
    order = [c for c in newest if c in updates.columns]
    rest = [c for c in updates.columns if c not in keys and c not in order]
    latest = keep_latest(updates, keys, [*order, *rest])
    extra = [c for c in updates.columns if c not in keys and c in base.columns]
    new = latest.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.col(c).alias(f"_new_{c}") for c in extra],
        F.lit(True).alias("_updated"),
    )
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    joined = base.withColumn("_based", F.lit(True)).join(new, same, "full_outer")
    times = [c for c in order if c in extra]
    wins = F.col("_updated") & ~(F.coalesce("_based", F.lit(False)) & _older(times))

    def merged(c: str) -> Column:
        if c in keys:
            value = F.when(F.col("_based"), F.col(c)).otherwise(F.col(f"_key_{c}"))
        elif c in extra:
            value = F.when(wins, F.col(f"_new_{c}")).otherwise(F.col(c))
        else:
            return F.col(c)
        return value.cast(base.schema[c].dataType).alias(c)

    return joined.select(*[merged(c) for c in base.columns])


def _older(times: Sequence[str]) -> Column:
    """Whether the update comes before the table's row; a missing time comes before any other."""
    if not times:
        return F.lit(False)
    mine, theirs = (F.struct(*[F.col(prefix + c).alias(c) for c in times]) for prefix in ("_new_", ""))
    return mine < theirs


def stamp(df: DataFrame, column: str = "actualizado_en", at: Column | None = None) -> DataFrame:
    """Set the time of change."""
    return df.withColumn(column, F.current_timestamp() if at is None else at)


def contract_edits(edits: DataFrame) -> DataFrame:
    """Contract edits with their defaults, ready for an upsert on id_llamado. (SNK-5)

    Rows whose id is no number are dropped; ``unusable_ids`` gives them for a report.
    """
    number = normalize_id(F.col("id_llamado"), "int")
    return edits.where(number.isNotNull()).select(
        number.alias("id_llamado"),
        or_default(F.col("licitacion"), "").alias("licitacion"),
        or_default(F.col("vigente"), "SI").alias("vigente"),
        or_default(F.col("dirigido_a"), "").alias("dirigido_a"),
        or_default(F.col("lugares"), "").alias("lugares"),
        or_default(F.col("observaciones"), "").alias("observaciones_generales"),
        *[c for c in ("actualizado_en",) if c in edits.columns],
    )


def unusable_ids(edits: DataFrame, dtype: str = "int") -> DataFrame:
    """Edits whose id_llamado is no number."""
    return edits.where(normalize_id(F.col("id_llamado"), dtype).isNull())


def edit_rows(edits: DataFrame) -> DataFrame:
    """Edited grid rows as rows of cantidad_solicitada. (FN-26, FIL-11)

    Rows without id or code are dropped; the quantity is a number or zero, the date a date or
    null, the key texts are trimmed and never null.
    """
    key = {c: F.coalesce(strip_ws(F.col(c).cast("string")), F.lit("")) for c in
           ("licitacion", "codigo", "item")}
    kept = edits.na.drop(subset=["id_llamado", "codigo"])
    id_llamado = normalize_id(F.col("id_llamado"))
    return kept.where(id_llamado.isNotNull()).select(
        id_llamado.alias("id_llamado"),
        *[c.alias(name) for name, c in key.items()],
        to_number_or_zero(F.col("cantidad_solicitada").cast("string")).alias("cantidad_solicitada"),
        parse_date(F.col("ver_en_fecha").cast("string")).alias("emitir_en"),
        *[c for c in ("actualizado_en",) if c in edits.columns],
    )


def changed_rows(
    edited: DataFrame, original: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Edited rows with a new key, or any cell different from the original row. (JN-6)

    Two nulls are equal, in cells and, unless ``null_safe`` is off, in keys.
    """
    columns = [c for c in edited.columns if c not in keys and c in original.columns]
    old = original.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        *[F.col(c).alias(f"_old_{c}") for c in columns],
        F.lit(True).alias("_shown"),
    )

    def same(k: str) -> Column:
        mine, theirs = F.col(k), F.col(f"_key_{k}")
        return mine.eqNullSafe(theirs) if null_safe else mine == theirs

    on = reduce(Column.__and__, [same(k) for k in keys])
    changed = reduce(
        Column.__or__, [~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in columns], F.lit(False)
    )
    new = F.col("_shown").isNull()
    return edited.join(old, on, "left").where(new | changed).select(*edited.columns)
