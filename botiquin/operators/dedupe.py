"""Keep one row per key under an explicit order.

All rules are "row number one of the key". Spark turns that filter into a group limit that runs
on every map task before the shuffle, so a key that holds a third of the rows sends one row per
task instead of all its copies to one reducer. The orders are total, so the kept row does not
depend on task timing; null keys form one group, as in the row dedupe being matched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from botiquin.contracts import LOAD_ORDER_COLUMN

_RN = "_rn"


def keep_top(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column], partitions: int | None = None
) -> DataFrame:
    """The first row of each key in the given order; ``partitions``, if given, deals the rows out by
    key into that many partitions first, so that each reducer of a large input holds a bounded share."""
    if partitions:
        df = df.repartition(partitions, *keys)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(window)).where(F.col(_RN) == 1).drop(_RN)


def trimmed(name: str) -> Column:
    return F.trim(F.col(name).cast("string"))


def has_code(name: str = "codigo") -> Column:
    """Not null and not blank. (FIL-2)"""
    return trimmed(name) != ""


def load_order(df: DataFrame) -> list[str]:
    """The columns that tell which of two rows was loaded later: the place that loads keep with a row,
    then the id, whichever the frame has."""
    return [c for c in (LOAD_ORDER_COLUMN, "id") if c in df.columns]


def keep_latest(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str] | None = None, trim: Sequence[str] = ()
) -> DataFrame:
    """The row with the highest value of the ``newest`` columns per key, by default the one that was
    loaded last. (WIN-1)"""
    parts = [trimmed(k) if k in trim else F.col(k) for k in keys]
    order = load_order(df) if newest is None else newest
    return keep_top(df, parts, [F.col(c).desc_nulls_last() for c in order])


def latest_items(
    execution: DataFrame,
    keys: Sequence[str] = ("id_llamado", "licitacion", "codigo", "item"),
    newest: Sequence[str] | None = None,
) -> DataFrame:
    """Execution lines with a code, the newest of each item. (WIN-1)"""
    return keep_latest(execution.where(has_code()), keys, newest, trim=("codigo", "item"))


def delete_older(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str] | None = None
) -> DataFrame:
    """Drop all but the newest of each key; rows without a code stay untouched. (WIN-2, WIN-3)

    One pass: each row without a code gets a key part of its own, so it is the first of its key
    and such rows spread over all partitions.
    """
    alone = F.when(~F.coalesce(has_code(), F.lit(False)), F.monotonically_increasing_id())
    parts = [trimmed(k) if k in ("codigo", "item") else F.col(k) for k in keys]
    order = load_order(df) if newest is None else newest
    kept = keep_top(
        df.withColumn("_alone", alone), ["_alone", *parts], [F.col(c).desc_nulls_last() for c in order]
    )
    return kept.drop("_alone")


def keep_first(
    df: DataFrame, keys: Sequence[str], row: str = "_row", partitions: int | None = None
) -> DataFrame:
    """The first row of each key as it stands in the input; without keys all rows.
    (WIN-5 to WIN-8)"""
    present = [k for k in keys if k in df.columns]
    return keep_top(df, present, [F.col(row).asc()], partitions) if present else df


def keep_newest_date(
    df: DataFrame, keys: Sequence[str], date: Column | None, row: str = "_row", partitions: int | None = None
) -> DataFrame:
    """The row of each key with the newest date, dateless rows last, then input order. (WIN-4)

    Needs at least two of the keys; with fewer the rows stay as they are.
    """
    present = [k for k in keys if k in df.columns]
    if len(present) < 2:
        return df
    order = [] if date is None else [date.desc_nulls_last()]
    return keep_top(df, present, [*order, F.col(row).asc()], partitions)


def filled_cells(df: DataFrame) -> Column:
    """Number of non-null cells of a row."""
    return reduce(Column.__add__, [F.col(c).isNotNull().cast("int") for c in df.columns])


def keep_most_complete(
    df: DataFrame, keys: Sequence[str], tiebreak: Sequence[Column] = ()
) -> DataFrame:
    """The row of each key with the most filled cells. (WIN-9)

    Ties go by ``tiebreak``; without one by the remaining columns, so the result is defined.
    """
    present = [k for k in keys if k in df.columns]
    if not present:
        return df
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in present]
    return keep_top(df, present, [filled_cells(df).desc(), *(tiebreak or rest)])


def duplicate_audit(
    df: DataFrame, table: str, keys: Sequence[str], trim: Sequence[str] = ("codigo", "item")
) -> DataFrame:
    """One row: table, rows and distinct keys among rows with a code. (AGG-13)

    Counting the distinct struct keeps keys with a null part in the count.
    """
    parts = [(trimmed(k) if k in trim else F.col(k)).alias(k) for k in keys]
    return df.where(has_code()).agg(
        F.lit(table).alias("tabla"),
        F.count(F.lit(1)).alias("total_registros"),
        F.countDistinct(F.struct(*parts)).alias("registros_unicos"),
    )
