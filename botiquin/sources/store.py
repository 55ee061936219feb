"""Tables as Parquet folders whose files Spark lays out and replaces.

A load writes all its tables into one new folder and makes them visible together by one marker, so a
job may read a table and replace it, and a load that is lost half way leaves the last one in force,
with its rejects and all. Inside a load's folder a table is partitioned, by Spark's own folders: by
the number of the batch that brought the rows (a refresh is the first batch, appends follow) or,
once rows have been merged by key, by a hash bucket of the key. Appends and merges write partitions
by Spark's dynamic partition overwrite, which moves a finished folder into place, and touch no other.

There is one writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botiquin.contracts import LOAD_ORDER_COLUMN, SELF_FILLED
from botiquin.operators.merge import upsert
from botiquin.session import work_dir

_READY = "_READY"
_BATCH = "_lote"
_BUCKET = "_cubo"


def bucket_column(keys: Sequence[str], buckets: int) -> str:
    """The partition column of a merged table; its name says by what rows are dealt."""
    return "__".join([_BUCKET, str(buckets), *keys])


def _dealt_by(column: str) -> tuple[list[str], int]:
    _, buckets, *keys = column.split("__")
    return keys, int(buckets)


def _bucket(column: str) -> Column:
    keys, buckets = _dealt_by(column)
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(column)


class TableStore:
    """Tables below one root path on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _found(self, pattern: str) -> list[str]:
        statuses = self._fs.globStatus(self._path(f"{self.root}/{pattern}")) or []
        return sorted(status.getPath().toString() for status in statuses)

    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _loads(self, group: str, complete: bool = True) -> list[str]:
        """Folders of a group's loads, the oldest first."""
        found = self._found(f"{group}/v*/{_READY}" if complete else f"{group}/v*")
        return [path.removesuffix(f"/{_READY}") for path in found]

    def path(self, table: str) -> str | None:
        """Folder of a table in the newest complete load of its group.

        A table's group has its name, unless it came beside another table.
        """
        groups = sorted({path.rsplit("/", 3)[1] for path in self._found(f"*/v*/{table}")})
        for group in sorted(groups, key=lambda g: g != table):
            newest = self._loads(group)[-1:]
            if newest and self._exists(f"{newest[0]}/{table}"):
                return f"{newest[0]}/{table}"
        return None

    def exists(self, table: str) -> bool:
        return self.path(table) is not None

    def _partitions(self, folder: str) -> tuple[str, list[str]]:
        """The partition column of a table and its values."""
        names = [path.rsplit("/", 1)[1] for path in self._found(folder.removeprefix(f"{self._base()}/") + "/_*=*")]
        column = names[0].split("=")[0] if names else _BATCH
        return column, [name.split("=")[1] for name in names]

    def _base(self) -> str:
        """The root as the file system spells it."""
        return self._fs.makeQualified(self._path(self.root)).toString()

    def _rows(self, folder: str) -> tuple[DataFrame, str]:
        """A table's rows with its partition column, and that column."""
        self._finish(folder)
        return self.spark.read.parquet(folder), self._partitions(folder)[0]

    def read(self, table: str) -> DataFrame:
        """The whole table. (SRC-3, SRC-4)"""
        folder = self.path(table)
        if folder is None:
            raise ValueError(f"no table {table} below {self.root}")
        rows, column = self._rows(folder)
        return rows.drop(column)

    def count(self, table: str) -> int:
        return self.read(table).count()

    def load(self, group: str) -> Load:
        """A new load of a table and those that come beside it."""
        return Load(self, group)

    def refresh(self, table: str, df: DataFrame, allow_empty: bool = False) -> int:
        """Replace the table by the frame and return its row count. (SNK-1)

        An empty frame leaves the table as it was. Rows are counted from the written files'
        footers, so the frame is computed once and the number is that of the committed files.
        """
        load = self.load(table)
        rows = load.write(table, df)
        if rows or allow_empty:
            load.commit()
        return rows

    def create(self, table: str, schema: T.StructType) -> None:
        """An empty table with the given columns, if there is none yet."""
        if not self.exists(table):
            self.refresh(table, self.spark.createDataFrame([], schema), allow_empty=True)

    def append(self, table: str, df: DataFrame) -> None:
        """Add rows as the table's next batch. (SNK-3)

        Spark's partitions are the batches of the write. The new folder is moved into place when it
        is complete, so a job that is lost half way leaves the table as it was. Columns that the
        frame lacks are null. Rows of a table laid out by key go to its buckets.
        """
        folder = self.path(table)
        if folder is None:
            self.refresh(table, df)
            return
        have, column = self._rows(folder)
        rows = df.select(
            *[
                (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in have.schema.fields if f.name != column
            ]
        )
        if column == _BATCH:
            batch = max((int(value) for value in self._partitions(folder)[1]), default=0) + 1
            self._overwrite(folder, in_load_order(rows, batch).withColumn(_BATCH, F.lit(batch)), _BATCH)
            return
        new = self._staged(rows.withColumn(column, _bucket(column)))
        self._replace(folder, self._touched(have, new, column).unionByName(new), column)

    def merge(
        self,
        table: str,
        updates: DataFrame,
        keys: Sequence[str],
        newest: Sequence[str] = ("actualizado_en",),
        buckets: int = 64,
    ) -> int:
        """Insert or update by key, rewriting only the buckets that the updates touch. (SNK-4)

        The first merge of a table, or one by other keys, lays the whole table out in a new load.
        Returns the rows of the table, counted from the files' footers.
        """
        if any("__" in key for key in keys):
            raise ValueError("names of key columns may not hold two underscores in a row")
        folder = self.path(table)
        if folder is None:
            raise ValueError(f"no table {table} below {self.root}")
        have, dealt = self._rows(folder)
        column = bucket_column(keys, buckets)
        schema = have.schema
        typed = updates.withColumns({k: F.col(k).cast(schema[k].dataType) for k in keys})
        if dealt != column:
            return self._lay_out(table, folder, upsert(have.drop(dealt), typed, keys, newest), column)
        new = self._staged(typed.withColumn(column, _bucket(column)))
        base = self._touched(have, new, column).drop(column)
        merged = upsert(base, new.drop(column), keys, newest)
        self._replace(folder, merged.withColumn(column, _bucket(column)), column)
        return self.count(table)

    def _staged(self, rows: DataFrame) -> DataFrame:
        """Rows written beside the tables: they may derive from the very table that changes."""
        path = work_dir(self.spark, "cambios")
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _touched(self, have: DataFrame, new: DataFrame, column: str) -> DataFrame:
        """The table's rows in the buckets of the new ones; there are as few numbers as buckets."""
        numbers = [row[0] for row in new.select(column).distinct().collect()]
        return have.where(F.col(column).isin(numbers))

    def _replace(self, folder: str, rows: DataFrame, column: str) -> None:
        """Put new contents into a merged table's buckets.

        They are complete beside the table first. A job that is lost while Spark moves them into
        place is finished by whoever reads or writes the table next.
        """
        waiting = self._waiting(folder)
        rows.hint("rebalance", F.col(column)).write.mode("overwrite").partitionBy(column).parquet(waiting)
        self._finish(folder)

    def _waiting(self, folder: str) -> str:
        load, table = folder.rsplit("/", 1)
        return f"{load}/_pendiente-{table}"

    def _finish(self, folder: str) -> None:
        """Move complete new contents into place; Spark's own marker says that they are."""
        waiting = self._waiting(folder)
        if not self._exists(f"{waiting}/_SUCCESS"):
            return
        if self._fs.globStatus(self._path(f"{waiting}/{_BUCKET}*")):
            rows = self.spark.read.parquet(waiting)
            self._overwrite(folder, rows.hint("rebalance", F.col(rows.columns[-1])), rows.columns[-1])
        self._fs.delete(self._path(waiting), True)

    def _overwrite(self, folder: str, rows: DataFrame, column: str) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(folder)

    def _lay_out(self, table: str, folder: str, rows: DataFrame, column: str) -> int:
        """A new load of the table's group with the table in buckets and the others as they are."""
        old = folder.rsplit("/", 1)[0]
        group = old.rsplit("/", 2)[1]
        load = self.load(group)
        others = [path.rsplit("/", 1)[1] for path in self._found(f"{group}/{old.rsplit('/', 1)[1]}/*")]
        for other in others:
            if other != table and not other.startswith("_"):
                load.write(other, self.read(other))
        written = load.write(table, rows, by=column)
        load.commit()
        return written

    def clean(self, group: str, keep: int = 2) -> list[str]:
        """Remove all but the newest ``keep`` complete loads of a group, and what incomplete ones
        before them left behind. Returns the removed folders.

        Nothing may read the older ones any more when this is called.
        """
        ready = self._loads(group)
        if len(ready) < keep or keep < 1:
            return []
        removed = [path for path in self._loads(group, complete=False) if path < ready[-keep]]
        for path in removed:
            self._fs.delete(self._path(path), True)
        return removed


class Load:
    """New contents of a table and of those that come beside it, visible together once committed."""

    def __init__(self, store: TableStore, group: str):
        self.store, self.group = store, group
        folders = store._loads(group, complete=False)
        numbers = [int(path.rsplit("/v", 1)[1]) for path in folders]
        # Batches appended to the last load count on from its number.
        for path in store._loads(group)[-1:]:
            for table in store._found(f"{group}/{path.rsplit('/', 1)[1]}/*/{_BATCH}=*"):
                numbers.append(int(table.rsplit("=", 1)[1]))
        self.number = max(numbers, default=0) + 1
        self.folder = f"{store._base()}/{group}/v{self.number:010d}"

    def write(self, table: str, df: DataFrame, by: str | None = None) -> int:
        """A table of this load, laid out by bucket if ``by`` names its column; returns its rows."""
        folder = f"{self.folder}/{table}"
        rows = in_load_order(df, self.number)
        if by is not None:
            rows.withColumn(by, _bucket(by)).hint("rebalance", F.col(by)).write.partitionBy(by).parquet(folder)
            if self.store._found(f"{self.group}/v{self.number:010d}/{table}/{by}=*"):
                return self.store.spark.read.parquet(folder).count()
            rows = rows.limit(0)
        # One batch, which has its columns even without rows.
        rows.write.parquet(f"{folder}/{_BATCH}={self.number}")
        return self.store.spark.read.parquet(folder).count()

    def commit(self) -> None:
        """Make all tables of the load visible at once."""
        self.store._fs.create(self.store._path(f"{self.folder}/{_READY}"), True).close()


def in_load_order(df: DataFrame, batch: int) -> DataFrame:
    """Complete the column that orders rows by load where the frame has it. (WIN-1)

    Rows that come without a batch number get this one; where they do not know their place in the
    files either, the order in which they are written counts.
    """
    if LOAD_ORDER_COLUMN not in df.columns:
        return df
    at = F.col(LOAD_ORDER_COLUMN)
    place = F.struct(
        F.coalesce(at["carga"], F.lit(batch).cast("bigint")).alias("carga"),
        at["archivo"].alias("archivo"),
        at["bloque"].alias("bloque"),
        F.coalesce(at["fila"], F.monotonically_increasing_id()).alias("fila"),
    )
    return df.withColumn(LOAD_ORDER_COLUMN, place)


def fit_to(
    df: DataFrame, target: T.StructType, skip: Iterable[str] = SELF_FILLED
) -> tuple[DataFrame, list[str]]:
    """Keep the columns the target has, minus those it fills itself. (SNK-2)

    Returns the projection, cast to the target's types, and the target columns left out. Values
    that do not fit their type become null; ``misfits`` counts them.
    """
    skip = set(skip)
    fields = {f.name: f for f in target.fields if f.name not in skip}
    valid = [c for c in df.columns if c in fields]
    if not valid:
        raise ValueError("no column of the frame exists in the target")
    omitted = [c for c in fields if c not in valid]
    typed = df.select(*[_fit(df.schema[c], fields[c]) for c in valid])
    return typed, omitted


def misfits(df: DataFrame, target: T.StructType) -> Column:
    """Number of cells of a row that ``fit_to`` turns into null."""
    kept = {f.name: f for f in target.fields if f.name in df.columns}
    lost = [
        (F.col(name).isNotNull() & F.col(name).try_cast(want.dataType).isNull()).cast("int")
        for name, want in kept.items()
        if df.schema[name].dataType != want.dataType
    ]
    return reduce(Column.__add__, lost, F.lit(0))


def _fit(have: T.StructField, want: T.StructField):
    c = F.col(have.name)
    return c if have.dataType == want.dataType else c.try_cast(want.dataType).alias(have.name)


def stamp_defaults(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns the target fills itself: audit times now, everything else null. (SNK-2)"""
    missing = [f for f in target.fields if f.name not in df.columns]
    return df.withColumns(
        {
            f.name: (
                F.current_timestamp()
                if f.name in ("creado_en", "actualizado_en")
                else F.lit(None).cast(f.dataType)
            )
            for f in missing
        }
    ).select(*target.names)
