"""Delimited extracts of unknown separator and encoding."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from botiquin.functions.text import cell_tokens_to_null, reader_nulls_to_null, strip_ws
from botiquin.sources.headers import clean_headers, quoted

# Fixed value: separators in the order they are tried.
SEPARATORS = (",", ";", "\t", "|")
# What Windows-1252 writes as the bytes 128 to 159, which Latin-1 has no text for;
# five of them stand for nothing and stay.
_WINDOWS = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
_CONTROLS = "".join(map(chr, range(128, 160)))
# Lines of a file's beginning that are looked at for its header at a time.
_HEADER_LINES = 64
# Position of a row in its extract; see read_extract.
ROW = "_row"


def find_files(spark: SparkSession, folder: str, name: str, suffix: str = ".csv") -> list[str]:
    """``folder/name.csv`` if there, else all files with the name inside theirs. (SRC-7)"""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    exact = path(f"{folder}/{name}{suffix}")
    if fs.exists(exact):
        return [exact.toString()]
    found = fs.globStatus(path(f"{folder}/*{name}*{suffix}")) or []
    return sorted(status.getPath().toString() for status in found)


def hidden_files(spark: SparkSession, folder: str, name: str, suffix: str = ".csv") -> list[str]:
    """Files with the name inside theirs that are not read, as one of exactly that name is there. (SRC-7)"""
    chosen = find_files(spark, folder, name, suffix)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(path(f"{folder}/*{name}*{suffix}")) or []
    names = sorted(status.getPath().getName() for status in found)
    return [n for n in names if n not in {c.rsplit("/", 1)[-1] for c in chosen}]


def sniff_separator(header: str) -> str:
    """The first separator that splits the header line into more than one name. (SRC-2)"""
    bare = re.sub(r'"[^"]*"', "", header)
    return next((sep for sep in SEPARATORS if sep in bare), ",")


def _decoded(c: Column, is_utf8: Column) -> Column:
    """Text whose bytes were read as Latin-1, put right where they are UTF-8 or Windows-1252."""
    as_utf8 = F.decode(F.encode(c, "ISO-8859-1"), "UTF-8")
    return F.when(is_utf8, as_utf8).otherwise(F.translate(c, _CONTROLS, _WINDOWS))


def _has_valid_utf8(c: Column) -> Column:
    return F.is_valid_utf8(F.encode(c, "ISO-8859-1").cast("string"))


def _decoded_text(raw: bytes) -> str:
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return raw.decode("latin-1").translate(str.maketrans(_CONTROLS, _WINDOWS))


def first_records(spark: SparkSession, paths: list[str]) -> dict[str, bytes]:
    """The header record of each file, with line breaks inside quotes. (SRC-2)

    One job reads the files, each in a task of its own that stops behind the record; a row per
    file reaches the driver, which has the files' names anyway.
    """

    def record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: list[bytes] = []
        where = None
        for batch in batches:
            for path, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                where = path
                lines.append(line)
                if b"".join(lines).count(b'"') % 2 == 0:
                    yield pa.RecordBatch.from_pydict(
                        {"path": pa.array([path]), "record": pa.array([b"\n".join(lines)], pa.binary())}
                    )
                    return
        if lines:
            yield pa.RecordBatch.from_pydict(
                {"path": pa.array([where]), "record": pa.array([b"\n".join(lines)], pa.binary())}
            )

    # A session of its own, so that other reads keep their settings: here a file is one split and a
    # split one task, whatever its size, and few lines go to Python at once.
    probe = spark.newSession()
    for name, value in {
        "spark.sql.files.maxPartitionBytes": 1 << 50,
        "spark.sql.files.openCostInBytes": 1 << 50,
        "spark.sql.execution.arrow.maxRecordsPerBatch": _HEADER_LINES,
    }.items():
        probe.conf.set(name, str(value))
    texts = probe.read.text(paths).select(F.col("_metadata.file_path"), F.col("value").cast("binary"))
    found = texts.mapInArrow(record, "path string, record binary").collect()
    return {row["path"]: bytes(row["record"]) for row in found}


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files below a folder, or the file itself; names that start with . or _ do not count."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.getFileStatus(where).isDirectory():
        return [path]
    found = [status for status in fs.listStatus(where) if status.isFile()]
    names = sorted(status.getPath().toString() for status in found)
    return [name for name in names if name.rsplit("/", 1)[-1][0] not in "._"]


def _header_groups(
    spark: SparkSession, paths: list[str], sep: str | None
) -> dict[tuple[str, tuple[str, ...], bool], list[str]]:
    """Files by separator, headers and whether the header takes several lines."""
    groups: dict[tuple[str, tuple[str, ...], bool], list[str]] = {}
    # Spark gives the names of files back with escapes.
    records = {_plain(unquote(path)): record for path, record in first_records(spark, paths).items()}
    for path in paths:
        found = records.get(_plain(path))
        if not found or not found.strip(b"\xef\xbb\xbf\r"):
            raise ValueError(f"no header line in {path}")
        record = _decoded_text(found.removeprefix(b"\xef\xbb\xbf")).rstrip("\r")
        own = sep or sniff_separator(record)
        headers = tuple(clean_headers(next(csv.reader([record], delimiter=own))))
        groups.setdefault((own, headers, "\n" in record), []).append(path)
    return groups


def _plain(path: str) -> str:
    """A path without its file system."""
    return re.sub(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?(?=/)", "", path)


def read_extract(
    spark: SparkSession,
    path: str | list[str],
    sep: str | None = None,
    multiline: bool = False,
    encoding: str | None = None,
    encoding_per_file: bool = False,
) -> DataFrame:
    """All columns as text under cleaned headers, plus the row's place in the extract. (SRC-1)

    Every file is read under its own header, and files are put together by column name; a column
    that a file lacks is null there. A header with line breaks inside quotes makes its files
    unsplittable. Rows with more cells than their header are left out here and are what
    ``excess_rows`` returns.

    The bytes are read once as Latin-1, which never fails and keeps them all. Cells of a row are
    then decoded as UTF-8 when the whole row is valid UTF-8 and left as Latin-1 otherwise, so a
    stray file or row in the other encoding needs no second read. ``encoding_per_file`` decides
    per file instead, at the price of one more scan. A known ``encoding`` (UTF-8 or Latin-1) is
    taken as given, and then only the columns a job uses are looked at.

    ``_row`` orders rows as they stand in the files: file, start of the split, then the running
    number inside the split. Its values are relative to the split only, so unlike a bare running
    number they do not depend on how splits are packed into partitions.
    """
    parts = []
    for raw, headers in _raw_parts(spark, path, sep, multiline):
        names = [f"c{i}" for i in range(len(headers))]
        raw = raw.where(~F.col("_excess")).drop("_excess", "_record")
        row_valid = _has_valid_utf8(F.concat_ws("\x1f", *names))
        if encoding is not None:
            raw = raw.withColumn("_utf8", F.lit(encoding.lower() in ("utf-8", "utf8")))
        elif encoding_per_file:
            verdict = raw.groupBy("_file").agg(F.every(row_valid).alias("_utf8"))
            raw = raw.join(verdict, "_file")
        else:
            raw = raw.withColumn("_utf8", row_valid)
        cells = [reader_nulls_to_null(_decoded(F.col(c), F.col("_utf8"))).alias(c) for c in names]
        df = raw.select(*cells, ROW)
        # The header line comes back as a row of each file.
        df = df.where(~_same_as_header(names, headers))
        keep = [i for i, name in enumerate(headers) if name not in headers[:i]]
        parts.append(df.select(*[F.col(f"c{i}").alias(headers[i]) for i in keep], ROW))
    if len(parts) == 1:
        return parts[0]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.select(*[quoted(c) for c in whole.columns if c != ROW], ROW)


def excess_rows(
    spark: SparkSession, path: str | list[str], sep: str | None = None, multiline: bool = False
) -> DataFrame:
    """``archivo``, ``registro`` (its text) and first cell of rows with more cells than the header."""
    found = [
        raw.where("_excess").select(
            F.col("_file").alias("archivo"),
            _decoded(F.col("_record"), _has_valid_utf8(F.col("_record"))).alias("registro"),
            # The reader hands out the record beside a parsed cell only.
            F.col("c0").alias("primera_celda"),
        )
        for raw, _ in _raw_parts(spark, path, sep, multiline)
    ]
    return reduce(DataFrame.unionByName, found)


def _raw_parts(
    spark: SparkSession, path: str | list[str], sep: str | None, multiline: bool
) -> list[tuple[DataFrame, list[str]]]:
    """Cells c0, c1 ... of the files of each header, with file, row place, record and excess."""
    paths = [f for p in ([path] if isinstance(path, str) else path) for f in data_files(spark, p)]
    if not paths:
        raise ValueError(f"no files in {path}")
    parts = []
    for (own, headers, broken), files in _header_groups(spark, paths, sep).items():
        names = [f"c{i}" for i in range(len(headers))]
        # Without pruning, or the number of cells would be that of the columns a job asks for.
        raw = spark.read.option("columnPruning", "false").csv(
            files,
            schema=", ".join(f"{c} string" for c in [*names, "_record"]),
            sep=own,
            encoding="ISO-8859-1",
            escape='"',
            multiLine=multiline or broken,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord="_record",
        )
        # The reader hands over the record of rows whose number of cells differs from the header's.
        mark = re.escape(own)
        bare = F.regexp_replace(F.col("_record"), '"[^"]*"', "x")
        bare = F.regexp_replace(bare, rf"(?:{mark}|\s)+\z", "")
        cells = F.length(bare) - F.length(F.replace(bare, F.lit(own))) + 1
        raw = raw.select(
            *names,
            F.coalesce(cells > len(headers), F.lit(False)).alias("_excess"),
            "_record",
            F.col("_metadata.file_path").alias("_file"),
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("n"),
            ).alias(ROW),
        )
        parts.append((raw, list(headers)))
    return parts


def _same_as_header(columns: list[str], headers: list[str]) -> Column:
    same = F.lit(True)
    for c, name in zip(columns, headers, strict=True):
        text = F.lower(strip_ws(F.regexp_replace(F.coalesce(quoted(c), F.lit("")), r"[\s\x{FEFF}]+", " ")))
        generated = name.startswith(("columna_", "unnamed_"))
        same &= (text == "") if generated else (text == F.lit(name.lower()))
    return same


def drop_repeated_headers(df: DataFrame) -> DataFrame:
    """Drop rows that repeat the header, wherever they stand. (PRJ-8)"""
    names = [c for c in df.columns if c != ROW]
    return df.where(~_same_as_header(names, names))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows without any value. (PRJ-6)"""
    return df.na.drop(how="all", subset=[quoted_name(c) for c in df.columns if c != ROW])


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value, found in one pass that returns one row. (PRJ-7)"""
    names = [c for c in df.columns if c != ROW]
    counts = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(names)]).first()
    empty = {c for i, c in enumerate(names) if counts[f"n{i}"] == 0}
    return df.select(*[quoted(c) for c in df.columns if c not in empty])


def with_clean_headers(df: DataFrame) -> DataFrame:
    """Cleaned headers, the nameless numbered by place; of two equal ones the first stays. (PRJ-1)"""
    names = [c for c in df.columns if c != ROW]
    cleaned = clean_headers(names)
    kept = [i for i, name in enumerate(cleaned) if name not in cleaned[:i]]
    carried = [F.col(ROW)] if ROW in df.columns else []
    return df.select(*[quoted(names[i]).alias(cleaned[i]) for i in kept], *carried)


def repair_extract(df: DataFrame) -> DataFrame:
    """The whole repair of a downloaded sheet: empty rows and columns, headers, tokens.
    (PRJ-1, PRJ-6, PRJ-7, PRJ-8, FN-5)"""
    df = drop_empty_columns(drop_empty_rows(df))
    df = drop_repeated_headers(with_clean_headers(df))
    return df.select(
        *[
            (F.col(ROW) if c == ROW else cell_tokens_to_null(quoted(c)).alias(c))
            for c in df.columns
        ]
    )
