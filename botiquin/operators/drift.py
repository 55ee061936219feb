"""Parquet files of one table whose columns have drifted from the contract, file by file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Drift:
    """Files that Spark can read together, and how they differ: column to type found (None: missing)."""

    files: tuple[str, ...]
    schema: T.StructType
    columns: Mapping[str, str | None]


def drifted_files(spark: SparkSession, files: Sequence[str], contract: T.StructType) -> list[Drift]:
    """Groups of files with columns of another type than the contract's, or that it does not know.
    (DQ-5)

    Spark merges the schemas of many files by a job over their footers. If what comes out is the
    contract's, none of them has drifted; otherwise each half is looked at, down to single files, so
    the jobs grow with the number of drifted files and the logarithm of all. A column that is missing
    counts where every file of a group lacks it; Spark reads it as null.
    """
    files = list(files)
    if not files:
        return []
    schema = _merged(spark, files)
    differing = None if schema is None else _differing(schema, contract)
    if differing == {}:
        return []
    if len(files) == 1:
        return [Drift((files[0],), schema, differing)]
    half = len(files) // 2
    found = drifted_files(spark, files[:half], contract) + drifted_files(spark, files[half:], contract)
    together: dict[str, Drift] = {}
    for drift in found:
        known = together.get(drift.schema.json())
        together[drift.schema.json()] = Drift((*(known.files if known else ()), *drift.files), drift.schema, drift.columns)
    return list(together.values())


def _merged(spark: SparkSession, files: list[str]) -> T.StructType | None:
    """What the files' schemas make together, None where a column has two types."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*files).schema
    except (PySparkException, Py4JJavaError) as error:
        if "merg" in str(error).lower():
            return None
        raise


def _differing(schema: T.StructType, contract: T.StructType) -> dict[str, str | None]:
    have = {f.name: f.dataType for f in schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    out = {name: kind.simpleString() for name, kind in have.items() if want.get(name) != kind}
    return out | {name: None for name in want if name not in have}


def drift_report(spark: SparkSession, drifts: Sequence[Drift], contract: T.StructType) -> DataFrame:
    """A row per drifted file and column: archivo, columna, tipo, esperado."""
    want = {f.name: f.dataType.simpleString() for f in contract.fields}
    rows = [
        (path, column, kind, want.get(column))
        for drift in drifts for path in drift.files for column, kind in drift.columns.items()
    ]
    return spark.createDataFrame(rows, "archivo string, columna string, tipo string, esperado string")


def rewrite_drifted(
    spark: SparkSession, files: Sequence[str], contract: T.StructType, folder: str
) -> tuple[list[str], list[Drift]]:
    """Write the rows of drifted files under the contract to ``folder``; the other files stay where
    they are. Returns the files that are now the table's, and what had drifted. (DQ-6)

    Values are cast to the contract's types, to text above all; a value that does not fit becomes
    null, columns the contract does not know are left out.
    """
    drifts = drifted_files(spark, files, contract)
    gone = {path for drift in drifts for path in drift.files}
    parts = [
        spark.read.schema(drift.schema).parquet(*drift.files).select(
            *[
                (F.col(f.name).try_cast(f.dataType) if f.name in drift.schema.names else F.lit(None).cast(f.dataType))
                .alias(f.name)
                for f in contract.fields
            ]
        )
        for drift in drifts
    ]
    kept = [path for path in files if path not in gone]
    if parts:
        reduce(DataFrame.unionByName, parts).write.parquet(folder)
        kept.append(folder)
    return kept, drifts
