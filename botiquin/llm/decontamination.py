"""Finding and removing passages of benchmark items in documents.

Text is lower-cased (A-Z), words are runs of letters and digits (and of anything beyond ASCII). A
window is ``size`` consecutive words of an item, or the whole item if it has fewer. The windows of
all items go to every task as a set of hashes over word numbers; a task slides over the words of
each whole document, looks the hashes up, compares the words of every hit, and marks the words that
any occurrence covers.

The set is sent whole only up to ``MOST_WORDS`` words of items, which is checked before it is
built. A larger benchmark is dealt into blocks of about that size by a hash of the item, and the
documents pass the blocks one after the other, each pass written to the shared folder.

Defined cases: a null or empty text has no words and no hits; a null or empty item has no windows.
Items with the same id count as one; an item without id marks words but is not listed. Repeated
documents are treated alike. An empty table on either side gives no hits. Columns of the documents
other than id and text are passed through whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botiquin.llm.tables import slices, stored

# Words of items that one broadcast set may hold: below 100 MB in a worker.
MOST_WORDS = 1_000_000

_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")
_FACTORS = np.random.default_rng(20).integers(1, 2**63, size=4096, dtype=np.uint64) * 2 + 1


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_TO_WORDS).split() if text else []


class Windows:
    """The windows of some items: word numbers, and per length a sorted array of hashes."""

    def __init__(self, items: list[tuple[str | None, str | None]], size: int):
        self.numbers: dict[bytes, int] = {}
        self.items: list[str | None] = []
        places: dict[str | None, int] = {}
        by_length: dict[int, dict[int, list]] = {}
        for item_id, text in items:
            number = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words(text)]
            if not number:
                continue
            if item_id not in places:
                places[item_id] = len(self.items)
                self.items.append(item_id)
            length = min(size, len(number))
            row = np.array(number, dtype=np.int64)
            for start, code in enumerate(_hashes(row, length).tolist()):
                window = tuple(number[start : start + length])
                known = by_length.setdefault(length, {}).setdefault(code, [])
                known.append((window, places[item_id]))
        self.lengths = {
            length: (np.sort(np.fromiter(codes, dtype=np.uint64, count=len(codes))), codes)
            for length, codes in by_length.items()
        }

    def scan(self, text_words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """The covered words as a mask, and the places of the items found."""
        get = self.numbers.get
        number = np.array([get(word, 0) for word in text_words], dtype=np.int64)
        hit, found = np.zeros(len(number), dtype=bool), set()
        unknown = np.concatenate([[0], np.cumsum(number == 0)])
        for length, (codes, by_code) in self.lengths.items():
            if len(number) < length:
                continue
            starts = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not len(starts):
                continue
            seen = _hashes(number, length)[starts]
            where = np.searchsorted(codes, seen)
            where[where == len(codes)] = 0
            for start, code in zip(*(x[codes[where] == seen].tolist() for x in (starts, seen))):
                window = tuple(number[start : start + length].tolist())
                same = [item for known, item in by_code[code] if known == window]
                if same:
                    hit[start : start + length] = True
                    found.update(same)
        return hit, found


def _hashes(number: np.ndarray, length: int) -> np.ndarray:
    """Multilinear hashes of all windows; equal windows have equal hashes, hits are compared."""
    factors = _FACTORS
    if length > len(factors):
        factors = np.random.default_rng(20).integers(1, 2**63, size=length, dtype=np.uint64) * 2 + 1
    total = np.zeros(len(number) - length + 1, dtype=np.uint64)
    for k in range(length):
        total += number[k : len(number) - length + 1 + k].astype(np.uint64) * factors[k]
    return total


class _Blocks:
    """Items dealt into parts within the bound on average, of which the driver takes one at a time."""

    def __init__(self, benchmark: DataFrame, id_col: str, text_col: str, most_words: int):
        self.items = benchmark.select(
            F.col(id_col).cast("string").alias("item_id"), F.col(text_col).alias("text")
        )
        size = self.items.select(F.sum(F.length("text")).alias("chars")).first()["chars"] or 0
        # A word and its separator take two characters at least.
        self.count = max(1, -(-size // (2 * most_words)))

    def take(self, number: int) -> list[tuple]:
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.count))
        rows = self.items.where(block == number).toLocalIterator()
        return [(row["item_id"], row["text"]) for row in rows]


_SPAN = "array<struct<first:int,last:int>>"


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    columns: tuple[str, ...] = ("doc_id",),
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """Per document: ``columns``, text, n_words, hit spans of words, and ids of the items found."""
    rows = docs.select(
        *columns,
        F.col(text_col).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.lit(None).cast(_SPAN).alias("spans"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    blocks = _Blocks(benchmark, item_id_col, item_text_col, most_words)
    for k in range(blocks.count):
        rows = rows.mapInArrow(_scanner(blocks.take(k), size, columns), rows.schema)
        if k + 1 < blocks.count:
            rows = stored(rows, "decontamination")
    return rows


def _scanner(block: list[tuple], size: int, columns: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(block, size)
        for batch in slices(batches, "text"):
            counts, spans, items = [], [], []
            before = zip(*(batch.column(name).to_pylist() for name in ("text", "spans", "items")))
            for text, old_spans, old_items in before:
                found = words(text)
                hit, seen = windows.scan(found)
                for span in old_spans or []:
                    hit[span["first"] : span["last"] + 1] = True
                counts.append(len(found))
                spans.append(_spans(hit))
                names = {windows.items[k] for k in seen} - {None}
                items.append(sorted(names.union(old_items or [])))
            arrays = [batch.column(name) for name in (*columns, "text")]
            arrays += [
                pa.array(counts, pa.int64()),
                pa.array(spans, _SPANS),
                pa.array(items, pa.list_(pa.string())),
            ]
            names = [*columns, "text", "n_words", "spans", "items"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def _spans(hit: np.ndarray) -> list[dict[str, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"first": a, "last": b - 1} for a, b in edge.reshape(-1, 2).tolist()]


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, **names) -> DataFrame:
    """One row per document with its words, the words hit and the items found."""
    found = find_windows(docs, benchmark, size, **names)
    n_hit = F.aggregate(
        "spans", F.lit(0).cast("long"), lambda n, s: n + (s["last"] - s["first"] + 1)
    )
    kept = [c for c in found.columns if c not in ("text", "spans", "items")]
    return found.select(
        *kept,
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def remove_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 10,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    most_words: int = MOST_WORDS,
) -> DataFrame:
    """The documents with every covered span of words cut out, also those that form by cutting.

    Documents that are left without words by it are dropped; all others and all columns stay. With
    several blocks of items the documents pass all of them, which mark their spans, before the marked
    words are cut; those that were cut pass them again until a round marks nothing. So the result
    does not depend on the number of blocks.
    """
    blocks = _Blocks(benchmark, item_id_col, item_text_col, most_words)
    rows = docs.select(F.struct("*").alias("row"), F.lit(True).alias("open"), F.lit(None).cast(_SPAN).alias("spans"))
    at = docs.columns.index(text_col)
    more = True
    while more:
        for k in range(blocks.count):
            last = k + 1 == blocks.count
            rows = rows.mapInArrow(_remover(blocks.take(k), size, at, last, blocks.count == 1), rows.schema)
            if blocks.count > 1:
                rows = stored(rows, "decontamination")
        more = blocks.count > 1 and not rows.where("open").isEmpty()
    return rows.select("row.*")


def cut_spans(text: str, hit: np.ndarray) -> str:
    """Cut from the first byte of each covered span to its last, leaving one blank."""
    data = text.encode()
    places = [match.span() for match in _WORD.finditer(data.translate(_TO_WORDS))]
    kept, first = [], 0
    for span in _spans(hit):
        kept.append(data[first : places[span["first"]][0]])
        first = places[span["last"]][1]
    return b" ".join([*kept, data[first:]]).decode()


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _remover(block: list[tuple], size: int, at: int, last: bool, alone: bool):
    """Marks the hits of a block; the last block's pass cuts, and goes on by itself if ``alone``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(block, size)
        for batch in batches:
            row = batch.column("row")
            fields = row.flatten()
            texts, still_open, spans, keep = [], [], [], []
            marked = zip(fields[at].to_pylist(), batch.column("open").to_pylist(), batch.column("spans").to_pylist())
            for text, is_open, before in marked:
                found = words(text) if is_open else []
                hit = _hits(windows, found, before)
                cut = last and bool(hit.any())
                while last and hit.any():
                    text = cut_spans(text, hit)
                    found = words(text)
                    hit = _hits(windows, found, None) if alone else np.zeros(len(found), dtype=bool)
                texts.append(text)
                still_open.append(cut and not alone if last else is_open)
                spans.append(None if last else _spans(hit))
                keep.append(not cut or bool(found))
            fields[at] = pa.array(texts, fields[at].type)
            names = [row.type.field(i).name for i in range(row.type.num_fields)]
            out = pa.RecordBatch.from_arrays(
                [pa.StructArray.from_arrays(fields, names=names), pa.array(still_open, pa.bool_()),
                 pa.array(spans, _SPANS)],
                names=["row", "open", "spans"],
            )
            yield out.filter(pa.array(keep, pa.bool_()))

    return run


def _hits(windows: Windows, found: list[bytes], before: list[dict[str, int]] | None) -> np.ndarray:
    hit, _ = windows.scan(found)
    for span in before or []:
        hit[span["first"] : span["last"] + 1] = True
    return hit
