"""Reading the given tables and keeping intermediate ones in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from botiquin.session import remove_dir, work_dir

# Folders that stored() has written in this session and nobody has removed.
_written: dict[str, SparkSession] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows go to Python in batches of ``rows`` at most, some megabytes of texts instead of 64.

    A worker holds a batch, what it makes of it, and both again on the JVM's side.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    What follows then starts from files that outlive any executor instead of from a long lineage.
    ``discard`` or ``intermediates`` removes the files.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    _written[path] = spark
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def discard(*frames: DataFrame) -> None:
    """Remove what ``stored`` wrote for these frames; nothing that is still to run may need it."""
    for frame in frames:
        _remove(frame.stored_at)


def _remove(path: str) -> None:
    spark = _written.pop(path, None)
    if spark is not None:
        remove_dir(spark, path)


@contextmanager
def intermediates() -> Iterator[None]:
    """Remove at the end whatever was stored inside; results must have been written by then."""
    before = set(_written)
    try:
        yield
    finally:
        for path in [path for path in _written if path not in before]:
            _remove(path)


def worked_out(rows: DataFrame, carried: list[str], **columns: Column) -> DataFrame:
    """Columns that are worked out once per row, whoever reads them.

    They come out of a generator of one element. A filter on a plain column moves below it with the
    column's whole expression in place of its name, into every reader's loop.
    """
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.select(*carried, F.inline(F.array(made)))


def slices(
    batches: Iterator[pa.RecordBatch],
    column: str | Callable[[pa.RecordBatch], pa.Array],
    most_bytes: int = 8_000_000,
) -> Iterator[pa.RecordBatch]:
    """Cut batches by rows so that a text column holds about ``most_bytes`` in each part.

    A single longer text makes a part of its own, whole. The column may be taken by a function.
    """
    for batch in batches:
        texts = column(batch) if callable(column) else batch.column(column)
        if texts.nbytes <= most_bytes:
            yield batch
            continue
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        first, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > most_bytes:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        yield batch.slice(first)
