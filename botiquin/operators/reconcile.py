"""Comparing the contents of two tables by digests instead of moving them whole."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botiquin.contracts import SELF_FILLED
from botiquin.operators.merge import changed_rows
from botiquin.session import work_dir

_BUCKET, _HIGH, _LOW = "_cubo", "_alto", "_bajo"


def digests(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """96 bits of a row's cells. A hash passes over nulls, so where they stand goes in as well."""
    if not columns:
        return [F.lit(0).cast("bigint").alias(_HIGH), F.lit(0).alias(_LOW)]
    cells = [
        # Both zeros are one number.
        F.col(c) + F.lit(0.0) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c)
        for c in columns
    ]
    gaps = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return [F.xxhash64(gaps, *cells).alias(_HIGH), F.hash(gaps, *cells).alias(_LOW)]


def bucket_sums(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Per hash bucket of the key the rows and two sums of their digests that no order changes.

    One row per bucket, summed ahead of the shuffle.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(_BUCKET)
    return (
        df.select(bucket, *digests(df, df.columns)).groupBy(_BUCKET)
        .agg(
            F.count(F.lit(1)).alias("filas"),
            F.sum(F.col(_HIGH).cast("decimal(38,0)")).alias("suma"),
            F.bit_xor(F.col(_HIGH)).alias("cruce"),
            F.sum(F.col(_LOW).cast("bigint")).alias("suma_baja"),
        )
    )


def differing_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], buckets: int) -> list[int]:
    """Numbers of the buckets whose sums differ; the driver gets ``buckets`` of them at most."""
    one, other = (
        bucket_sums(df, keys, buckets).select(_BUCKET, F.struct("filas", "suma", "cruce", "suma_baja").alias(side))
        for df, side in ((left, "a"), (right, "b"))
    )
    both = one.join(other, _BUCKET, "full").where(~F.col("a").eqNullSafe(F.col("b")))
    return [row[0] for row in both.select(_BUCKET).collect()]


def content_differences(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    skip: Sequence[str] = SELF_FILLED,
    buckets: int = 1024,
) -> DataFrame:
    """Keys whose rows differ: ``diferencia`` is falta, sobra or cambiada, ``columnas`` names the
    columns of a changed row. (DQ-4, JN-7)

    Both sides are summed by bucket first; where the sums agree nothing is looked at again. In the
    other buckets keys and digests are counted, and cells are fetched for changed keys alone. Cells
    are compared as the target holds them, columns that only one side has are not. Null keys are
    keys, and a key may have several rows; of these the columns are not told apart.
    """
    keys = list(keys)
    columns = [c for c in target.columns if c in source.columns and c not in skip]
    left = source.select(*[F.col(c).try_cast(target.schema[c].dataType).alias(c) for c in columns])
    right = target.select(*columns)
    wrong = differing_buckets(left, right, keys, buckets)
    inside = F.pmod(F.xxhash64(*keys), F.lit(buckets)).isin(wrong) if wrong else F.lit(False)
    left, right = left.where(inside), right.where(inside)
    rest = [c for c in columns if c not in keys]

    def counted(df: DataFrame, sign: int) -> DataFrame:
        return df.select(*keys, *digests(df, rest), F.lit(sign).alias("n"))

    unequal = (
        counted(left, 1).union(counted(right, -1)).groupBy(*keys, _HIGH, _LOW)
        .agg(F.sum("n").alias("n")).where("n <> 0").groupBy(*keys)
        .agg(F.sum(F.greatest("n", F.lit(0))).alias("mas"), F.sum(F.greatest(-F.col("n"), F.lit(0))).alias("menos"))
    )
    kind = F.when(F.col("menos") == 0, "falta").when(F.col("mas") == 0, "sobra").otherwise("cambiada")
    found = unequal.select(*keys, kind.alias("diferencia"), (F.col("mas") + F.col("menos") == 2).alias("_una"))
    names = _changed_columns(left, right, found.where("diferencia = 'cambiada' and _una"), keys, rest)
    return found.join(names, _same(found, names, keys), "left").select(
        *[found[k] for k in keys], "diferencia", F.coalesce("columnas", F.lit("")).alias("columnas")
    )


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [left[k].eqNullSafe(right[f"_k_{k}"]) for k in keys])


def _changed_columns(
    left: DataFrame, right: DataFrame, changed: DataFrame, keys: Sequence[str], rest: Sequence[str]
) -> DataFrame:
    """Keys (as ``_k_<name>``) and the names of the columns that differ between their two rows."""
    wanted = changed.select(*[F.col(k).alias(f"_k_{k}") for k in keys])

    def cells(df: DataFrame, prefix: str) -> DataFrame:
        kept = df.join(wanted, _same(df, wanted, keys), "left_semi")
        return kept.select(
            *[F.col(k).alias(f"_k_{k}" if prefix == "_a_" else f"_j_{k}") for k in keys],
            *[F.col(c).alias(prefix + c) for c in rest],
        )

    one, other = cells(left, "_a_"), cells(right, "_b_")
    on = reduce(Column.__and__, [F.col(f"_k_{k}").eqNullSafe(F.col(f"_j_{k}")) for k in keys])
    names = [F.when(~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")), F.lit(c)) for c in rest]
    joined = F.concat_ws(",", *names) if names else F.lit("")
    return one.join(other, on).select(*[f"_k_{k}" for k in keys], joined.alias("columnas"))


def changed_rows_by_digest(edited: DataFrame, original: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``changed_rows`` for wide tables of which little has changed. (JN-6)

    Keys and digests are compared first, the keys that differ are written to the shared folder, and
    cells travel for these keys only. ``original`` has one row per key; null keys are keys.
    """
    keys = list(keys)
    columns = [c for c in edited.columns if c not in keys and c in original.columns]
    typed = original.select(*keys, *[F.col(c).cast(edited.schema[c].dataType).alias(c) for c in columns])

    def counted(df: DataFrame, shown: bool) -> DataFrame:
        return df.select(*keys, *digests(df, columns), F.lit(shown).alias("shown"))

    apart = (
        counted(edited, False).union(counted(typed, True)).groupBy(*keys, _HIGH, _LOW)
        .agg(F.max("shown").alias("shown")).where("not shown").select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        .distinct()
    )
    spark = edited.sparkSession
    path = work_dir(spark, "cambiadas")
    apart.write.parquet(path)
    apart = spark.read.schema(apart.schema).parquet(path)
    mine, theirs = (df.join(apart, _same(df, apart, keys), "left_semi") for df in (edited, original))
    return changed_rows(mine, theirs, keys)
