"""Sorted, capped and paged reads."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sort_board(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ascending by all keys, nulls last. (SRT-1)"""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def sort_by(df: DataFrame, column: str, descending: bool = True) -> DataFrame:
    """By one column if the frame has it, nulls last. (SRT-2)"""
    if column not in df.columns:
        return df
    c = F.col(column)
    return df.orderBy(c.desc_nulls_last() if descending else c.asc_nulls_last())


def capped(df: DataFrame, limit: int) -> DataFrame:
    """As many rows as the caller asks for. (SRC-5)"""
    return df.limit(limit)


def top(df: DataFrame, column: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the highest values, null values last. (TOP-1, TOP-2)

    Spark keeps n rows per task and merges those. ``ties`` settles equal values.
    """
    return df.orderBy(
        F.col(column).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]
    ).limit(n)


def page(df: DataFrame, keys: Sequence[str], number: int, size: int = 100) -> DataFrame:
    """Page ``number`` (from 1) in key order. (LIM-2)

    Every task keeps the rows up to the end of the page, so this suits the pages people turn to.
    Reading on from a known row is page_after.
    """
    ordered = sort_board(df, keys)
    return ordered.offset((number - 1) * size).limit(size)


def page_after(
    df: DataFrame, keys: Sequence[str], last: Sequence[object], size: int = 100
) -> DataFrame:
    """The page that follows the row with the given key; its cost does not grow with depth.
    (SRC-4, LIM-2)

    Nulls count as the last value of a key column, as in the sorted frame.
    """
    later: list[Column] = []
    for i, k in enumerate(keys):
        if last[i] is None:
            continue
        same = [F.col(keys[j]).eqNullSafe(F.lit(last[j])) for j in range(i)]
        beyond = F.col(k).isNull() | (F.col(k) > F.lit(last[i]))
        later.append(reduce(Column.__and__, [*same, beyond]))
    following = reduce(Column.__or__, later, F.lit(False))
    return sort_board(df.where(following), keys).limit(size)


_RANGE, _PLACE = "_tramo", "_lugar"


class PageIndex:
    """A sorted copy of a frame from which any page is read alone, however deep. (LIM-2, SRC-4)

    The copy is dealt into ranges of the keys, and each row knows its place in its range. The rows
    of each range are counted once; a page is found by adding them up and read by range folder and
    place, so only the files that hold it are opened. Nulls come last, as in the sorted frame; rows
    that agree in all keys are in the order of the copy.
    """

    def __init__(self, copy: DataFrame, keys: Sequence[str], rows: Sequence[tuple[int, int]]):
        self._copy, self._keys, self._rows = copy, list(keys), list(rows)

    @classmethod
    def build(cls, df: DataFrame, keys: Sequence[str], path: str, ranges: int | None = None) -> PageIndex:
        order = [F.col(k).asc_nulls_last() for k in keys]
        dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
        # The running number counts rows as they come, from 0 in each partition's part of the numbers.
        place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        placed = dealt.sortWithinPartitions(*order).select(
            "*", F.spark_partition_id().alias(_RANGE), place.alias(_PLACE)
        )
        placed.write.partitionBy(_RANGE).parquet(path)
        return cls.open(df.sparkSession, df.schema, keys, path)

    @classmethod
    def open(cls, spark: SparkSession, schema: T.StructType, keys: Sequence[str], path: str) -> PageIndex:
        full = T.StructType([*schema.fields, T.StructField(_PLACE, T.LongType()), T.StructField(_RANGE, T.IntegerType())])
        copy = spark.read.schema(full).parquet(path)
        # One row per range.
        counts = copy.groupBy(_RANGE).count().orderBy(_RANGE).collect()
        return cls(copy, keys, [(row[_RANGE], row["count"]) for row in counts])

    @property
    def total(self) -> int:
        return sum(rows for _, rows in self._rows)

    def page(self, number: int, size: int = 100) -> DataFrame:
        """Page ``number`` from 1, in key order; empty behind the last one."""
        start, end = (number - 1) * size, number * size
        wanted, before = [], 0
        for part, rows in self._rows:
            first, last = max(start - before, 0), min(end - before, rows)
            if first < last:
                wanted.append((F.col(_RANGE) == part) & F.col(_PLACE).between(first, last - 1))
            before += rows
        kept = self._copy.where(reduce(Column.__or__, wanted, F.lit(False)))
        return kept.orderBy(_RANGE, _PLACE).drop(_RANGE, _PLACE)
