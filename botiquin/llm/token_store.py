"""Token ids as Parquet list columns in document order, for reads of parts and of metadata alone.

A store is a folder with two tables. ``tokens`` has one row per document in ascending order of its
id, in files whose names and row groups follow that order; ``parts`` has one row per file with the
number of ids before it. The ids are delta encoded by default (or dictionary encoded), row groups
and pages have set sizes, and the writer leaves column and offset indexes for the pages, so a read
of some documents fetches the pages that hold them and a read of metadata no ids at all.

Defined cases: a null text counts as empty and has the end id only. Documents without id come
first. Rows with the same id are ordered by their texts; repeated rows stay. An empty table gives
an empty store. Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from botiquin.llm.encoding import encoder
from botiquin.llm.tables import slices

ROW_GROUP_BYTES = 32 * 1024 * 1024
PAGE_BYTES = 256 * 1024
PAGE_ROWS = 500

_ENCODED = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


def writer_options(
    encoding: str = "delta",
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    page_rows: int = PAGE_ROWS,
) -> dict[str, str]:
    """Options of Spark's Parquet writer for a token store."""
    if encoding not in ("delta", "dictionary"):
        raise ValueError("encoding is 'delta' or 'dictionary'")
    return {
        # Pages of version 2 hold integers in delta encoding where there is no dictionary.
        "parquet.writer.version": "PARQUET_2_0" if encoding == "delta" else "PARQUET_1_0",
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.size": str(page_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "compression": "zstd",
    }


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    **options,
) -> None:
    """Encode all texts and write them as a token store. ``tokenizer`` is a file all workers have.

    The texts are dealt out by ranges of the id, then encoded where they lie, so the shuffle
    carries texts and not the wider ids, and no task holds more than one batch.
    """
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .withColumn("part", F.spark_partition_id())
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, start = encoder(tokenizer), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, "text", 4_000_000):
            if not batch.num_rows:
                continue
            texts = [text or "" for text in batch.column("text").to_pylist()]
            coded = [ids + end for ids in work.encode(texts)]
            counts = np.array([len(ids) // 4 for ids in coded], dtype=np.int64)
            starts = start + np.concatenate([[0], np.cumsum(counts)])
            start = int(starts[-1])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    pa.array(starts[:-1]),
                    pa.array(counts),
                    _lists(coded, counts),
                ],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"],
            )

    encoded = ordered.mapInArrow(encode, _ENCODED)
    encoded.write.options(**writer_options(**options)).parquet(f"{path}/tokens")
    # One row per written file, whatever the number of documents.
    sizes = (
        docs.sparkSession.read.schema(_ENCODED).parquet(f"{path}/tokens")
        .groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select(
        "part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first")
    ).write.parquet(f"{path}/parts")


def _lists(coded: list[bytes], counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))
    )


def _read(spark: SparkSession, path: str, columns: list[str], low, high) -> DataFrame:
    rows = spark.read.schema(_ENCODED).parquet(f"{path}/tokens")
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    parts = spark.read.schema("part int, first long").parquet(f"{path}/parts")
    return rows.join(parts, "part").select(
        "doc_id", (F.col("first") + F.col("part_start")).alias("start"), *columns
    )


def read_metadata(
    spark: SparkSession, path: str, low: int | None = None, high: int | None = None
) -> DataFrame:
    """Id, place of the first token id in the whole store, and number of ids; no ids are read."""
    return _read(spark, path, ["n_tokens"], low, high)


def read_tokens(
    spark: SparkSession, path: str, low: int | None = None, high: int | None = None
) -> DataFrame:
    """Documents with their ids, all or those with ids from ``low`` to ``high``."""
    return _read(spark, path, ["n_tokens", "ids"], low, high)


def checksums(tokens: DataFrame) -> DataFrame:
    """Replace the ids by the CRC-32 of their little-endian unsigned 32-bit form."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            cuts = lists.offsets.to_numpy().tolist()
            sums = [zlib.crc32(values[a:b]) for a, b in zip(cuts, cuts[1:])]
            kept = [batch.column(name) for name in ("doc_id", "start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
