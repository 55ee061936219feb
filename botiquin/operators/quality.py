"""Data-quality reports as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botiquin.functions.numbers import to_number
from botiquin.sources.headers import quoted

NUMERIC_COLUMNS = ("id_llamado", "item")


def _unpivot(df: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """One aggregated row to one row per entry."""
    entries = [F.struct(*[c.alias(n) for c, n in zip(row, names, strict=True)]) for row in rows]
    return df.select(F.inline(F.array(*entries)))


def _checks(
    df: DataFrame, required: Sequence[str], numeric: Sequence[str]
) -> list[tuple[str, str, str, Column]]:
    """Kind, check, column and count of each finding."""
    have = [c for c in required if c in df.columns]
    numbers = [c for c in numeric if c in df.columns]
    checks: list[tuple[str, str, str, Column]] = [
        ("error", "vacia", "", (F.count(F.lit(1)) == 0).cast("bigint"))
    ]
    for c in required:
        checks.append(("error", "falta", c, F.lit(int(c not in have)).cast("bigint")))
    for c in numbers:
        text = quoted(c).cast("string")
        bad = F.count_if(text.isNotNull() & to_number(text, "double").isNull())
        checks.append(("aviso", "no_numerico", c, bad))
    for c in have:
        checks.append(("aviso", "nulos", c, F.count_if(quoted(c).isNull())))
    return checks


def quality_report(
    df: DataFrame, required: Sequence[str], numeric: Sequence[str] = NUMERIC_COLUMNS
) -> DataFrame:
    """Counts per check and column, all from one pass. (DQ-1, DQ-2, DQ-3)

    ``vacia`` is 1 for an empty frame, ``falta`` 1 for a missing required column, ``no_numerico``
    counts values that are not numbers, ``nulos`` counts nulls. The first two are errors, the
    others warnings; a column without findings shows 0.
    """
    checks = _checks(df, required, numeric)
    totals = df.agg(*[count.alias(f"n{i}") for i, (*_, count) in enumerate(checks)])
    rows = [
        [F.lit(kind), F.lit(check), F.lit(column), F.col(f"n{i}")]
        for i, (kind, check, column, _) in enumerate(checks)
    ]
    return _unpivot(totals, rows, ["tipo", "control", "columna", "cantidad"])


@dataclass
class Validation:
    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.errors


def validate(
    df: DataFrame, table: str, required: Sequence[str], numeric: Sequence[str] = NUMERIC_COLUMNS
) -> Validation:
    """The report as messages; errors mean the frame must not be loaded. (DQ-1 to DQ-3)"""
    found = [(r.control, r.columna, r.cantidad) for r in quality_report(df, required, numeric).collect()]
    return _messages(table, found)


def _messages(table: str, found: Sequence[tuple[str, str, int]]) -> Validation:
    out = Validation()
    findings = [finding for finding in found if finding[2]]
    if any(check == "vacia" for check, _, _ in findings):
        out.errors.append(f"{table}: sin filas")
        return out
    missing = [column for check, column, _ in findings if check == "falta"]
    if missing:
        out.errors.append(f"{table}: faltan columnas {', '.join(missing)}")
    words = {"no_numerico": "valores no numéricos", "nulos": "valores nulos"}
    out.warnings += [
        f"{table}: {count} {words[check]} en {column}" for check, column, count in findings if check in words
    ]
    return out


class Watched:
    """The checks of ``validate`` and further counts, taken while the frame is written.

    ``frame`` is to be written once, without a shuffle behind it; then ``figures`` and ``findings``
    hold. An observation of no rows gives none, so the number of written rows is asked for.
    """

    def __init__(
        self, df: DataFrame, table: str, required: Sequence[str],
        counts: Mapping[str, Column] | None = None, numeric: Sequence[str] = NUMERIC_COLUMNS,
    ):
        self._table = table
        self._checks = _checks(df, required, numeric)
        self._counts = dict(counts or {})
        self._seen = Observation()
        self.frame = df.observe(
            self._seen,
            *[count.alias(f"n{i}") for i, (*_, count) in enumerate(self._checks)],
            *[F.coalesce(count, F.lit(0)).alias(name) for name, count in self._counts.items()],
        )

    def figures(self, rows: int) -> dict[str, int]:
        return {name: self._seen.get[name] for name in self._counts} if rows else dict.fromkeys(self._counts, 0)

    def findings(self, rows: int) -> Validation:
        if not rows:
            return _messages(self._table, [("vacia", "", 1)])
        seen = self._seen.get
        return _messages(
            self._table, [(check, column, seen[f"n{i}"]) for i, (_, check, column, _) in enumerate(self._checks)]
        )


def schema_contract(
    df: DataFrame, contract: T.StructType, max_lengths: Mapping[str, int] | None = None
) -> DataFrame:
    """One row per contract column: expected type, presence, type match, nulls, and texts over
    the allowed length. (DQ-5)"""
    max_lengths = max_lengths or {}
    have = {f.name: f for f in df.schema.fields}
    zero = F.lit(0).cast("bigint")
    counts: list[Column] = [F.count(F.lit(1)).alias("rows")]
    rows = []
    for i, want in enumerate(contract.fields):
        present = want.name in have
        c = quoted(want.name)
        limit = max_lengths.get(want.name)
        counts.append((F.count_if(c.isNull()) if present else zero).alias(f"nulls{i}"))
        counts.append(
            (F.count_if(F.length(c) > limit) if present and limit else zero).alias(f"long{i}")
        )
        matches = present and have[want.name].dataType == want.dataType
        rows.append(
            [
                F.lit(want.name),
                F.lit(want.dataType.simpleString()),
                F.lit(present),
                F.lit(matches),
                F.lit(want.nullable) | (F.col(f"nulls{i}") == 0),
                F.col(f"nulls{i}"),
                F.col(f"long{i}"),
            ]
        )
    return _unpivot(
        df.agg(*counts),
        rows,
        ["columna", "tipo", "presente", "tipo_ok", "nulos_ok", "nulos", "largos"],
    )


def to_text_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that must be text, cast when they are not. (DQ-6)"""
    wrong = [c for c in columns if c in df.columns and df.schema[c].dataType != T.StringType()]
    return df.withColumns({c: F.col(c).cast("string") for c in wrong}) if wrong else df


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table with OK or WARN for an empty one, and the total. (AGG-11, SET-1)"""
    if not tables:
        total = "'TOTAL' AS tabla, 0L AS registros, 'WARN' AS estado"
        return SparkSession.active().sql(f"SELECT {total}")
    counts = [
        df.agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("n"))
        for name, df in tables.items()
    ]
    # A roll-up over one row per table: the tables are counted once.
    return (
        reduce(DataFrame.unionByName, counts)
        .rollup("tabla")
        .agg(F.sum("n").alias("registros"))
        .select(
            F.coalesce("tabla", F.lit("TOTAL")).alias("tabla"),
            "registros",
            F.when(F.col("registros") > 0, "OK").otherwise("WARN").alias("estado"),
        )
    )


def reconcile(
    source: Mapping[str, DataFrame],
    target: Mapping[str, DataFrame],
    tables: Sequence[str] | None = None,
) -> DataFrame:
    """Row counts of both sides per table, match flag and difference. (JN-7, DQ-4)

    ``tables`` names what must be on both sides, by default whatever is on one of them. Where a
    side lacks a table its count is null and the two do not agree.
    """
    tables = list(dict.fromkeys(tables if tables is not None else [*source, *target]))
    counted = [
        df.agg(F.lit(name).alias("tabla"), F.lit(side).alias("lado"), F.count(F.lit(1)).alias("n"))
        for side, frames in (("origen", source), ("destino", target))
        for name, df in frames.items()
        if name in tables
    ]
    spark = SparkSession.active()
    # One row per table and side.
    none = spark.createDataFrame([], "tabla string, lado string, n bigint")
    counts = reduce(DataFrame.unionByName, counted, none)
    names = spark.createDataFrame([(name,) for name in tables], "tabla string")

    def of(side: str) -> Column:
        return F.max(F.when(F.col("lado") == side, F.col("n"))).alias(side)

    both = names.join(counts, "tabla", "left").groupBy("tabla").agg(of("origen"), of("destino"))
    return both.withColumn(
        "coincide", F.coalesce(F.col("origen") == F.col("destino"), F.lit(False))
    ).withColumn("diferencia", F.abs(F.col("origen") - F.col("destino")))
