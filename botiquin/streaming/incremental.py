"""Incremental copy as a file stream: each run takes the files that came since the last one."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from botiquin.sources.store import TableStore


def follow(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    store: TableStore,
    table: str,
    keys: Sequence[str],
    newest: Sequence[str] = ("actualizado_en",),
    checkpoint: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Merge new Parquet files into a table by key, then stop. (SNK-7 with SNK-4)

    Progress lives in the checkpoint, so unlike a high-water mark it cannot miss rows that share
    a time. By default it is kept below the store's own root, for the table and the followed
    folder. A batch that is replayed after a failure, or a file that comes late with older rows,
    merges to the same table: the newest row of a key stays.
    """
    store.create(table, schema)

    def merge(batch: DataFrame, _: int) -> None:
        store.merge(table, batch, keys, newest)

    followed = hashlib.sha256(folder.encode()).hexdigest()[:16]
    progress = checkpoint or f"{store.root}/_progress/{table}-{followed}"
    return (
        spark.readStream.schema(schema)
        .options(**({"maxFilesPerTrigger": files_per_batch} if files_per_batch else {}))
        .parquet(folder)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
