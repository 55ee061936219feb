"""Removing repeated word sequences by relative Lempel-Ziv parsing against reference blocks.

A window is ``size`` consecutive words of a document. A word goes if a window that covers it also
starts in a document with a smaller id. The work is done by factoring documents against reference
blocks, in which the first document of every repeated passage stands:

1. Every window has an anchor, its ``anchor`` neighbouring words of smallest hash, so equal windows
   have equal anchors and one in five words starts one. Anchors are counted over all documents; those
   of several ids have a reference place, their first document's first place.
2. A reference block holds the windows of ``block`` words of such a document. Runs of neighbouring
   anchors of a document whose references lie in one block make a stretch that is sent to that block,
   so a document meets every block that can hold a window of it, and no other.
3. A stretch is parsed greedily: the longest factor that the block's index has at a word, then on
   behind it. Factors of ``size`` words and more are duplicate spans. Windows that reach over the end
   of a factor, which the parse passes by, are looked up in the block one by one.
4. Windows that their block does not have may still repeat among later documents (the same anchor in
   other company). They are compared with each other by two 64-bit hashes.

A block is one row, stretches meet it in a join by key that splits hot blocks, and counts are summed
ahead of the shuffle, so no task holds a group of copies. Words are compared by 64-bit hashes of
their unchanged bytes.

Defined cases: null and empty texts have no words. A document without id neither loses words nor
takes them from others. Rows of the same id are not smaller than each other; rows that share id and
text lose the same. Texts of fewer words than a window stay whole. Columns other than id and text are
passed through whatever their names. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botiquin.llm.tables import discard, slices, stored
from botiquin.llm.words import BLANK_SEPARATED, joined, mixed, token_hashes

SIZE = 13
ANCHOR = 5
BLOCK = 128

_PLACE = "struct<id bigint, key bigint, seg int>"


def window_anchors(hashes: np.ndarray, size: int, anchor: int) -> np.ndarray:
    """Per window of a text's word hashes the place of its anchor; of equal ones the first."""
    grams = joined(hashes, anchor)
    width = size - anchor + 1
    if len(grams) < width:
        return np.empty(0, dtype=np.int64)
    return np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1) + np.arange(
        len(grams) - width + 1
    )


def anchors(docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR) -> DataFrame:
    """anchor, id, key, at: every anchor of documents given as id, key and text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text", 2_000_000):
                hashes, cuts = token_hashes(batch.column("text"), BLANK_SEPARATED, exact=True)
                grams, first = joined(hashes, anchor), window_anchors(hashes, size, anchor)
                # Windows that reach into the next text are none.
                text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
                inside = text[: len(first)] == text[size - 1 :][: len(first)]
                places = np.unique(first[inside])
                rows = pa.array(text[places])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams[places].view(np.int64)),
                        batch.column("id").take(rows),
                        batch.column("key").take(rows),
                        pa.array((places - cuts[text[places]]).astype(np.int32)),
                    ],
                    names=["anchor", "id", "key", "at"],
                )

    return docs.select("id", "key", "text").mapInArrow(find, "anchor long, id long, key long, at int")


def routes(found: DataFrame, block: int = BLOCK) -> DataFrame:
    """id, key and ``needs``: per document the blocks of its anchors, as structs of place and block.

    An anchor counts if several ids have it; at its reference itself the place is null. Grouped
    sides are stored before they are joined, so that the join can split a hot anchor.
    """
    repeated = stored(
        found.groupBy("anchor").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
        .where("first_id < last_id").select("anchor", "first_id"),
        "lz-repeated",
    )
    hits = stored(found.join(repeated, "anchor"), "lz-hits")
    discard(repeated)
    first = stored(
        hits.where("id = first_id").groupBy("anchor").agg(F.min(F.struct("id", "key", "at")).alias("ref")),
        "lz-first",
    )
    own = F.struct("id", "key", "at") == F.col("ref")
    seg = F.floor(F.col("ref.at") / block).cast("int")
    ref = F.struct("ref.id", "ref.key", seg.alias("seg")).cast(_PLACE).alias("ref")
    placed = hits.join(first, "anchor").where(~own).select("id", "key", "at", ref)
    wanted = first.select(ref).distinct().select("ref.id", "ref.key", F.lit(None).cast("int").alias("at"), "ref")
    needs = stored(
        placed.union(wanted).groupBy("id", "key").agg(F.collect_set(F.struct("at", "ref")).alias("needs")),
        "lz-needs",
    )
    discard(hits, first)
    return needs


def stretches(
    docs: DataFrame, needs: DataFrame, size: int = SIZE, anchor: int = ANCHOR, block: int = BLOCK
) -> DataFrame:
    """Blocks (``first`` null) and the stretches sent to them: ref, id, key, first, words (hashes)."""
    rows = docs.join(needs, ["id", "key"]).select(
        "id", "key", "text",
        F.col("needs.at").alias("at"), F.col("needs.ref.id").alias("ref_id"),
        F.col("needs.ref.key").alias("ref_key"), F.col("needs.ref.seg").alias("ref_seg"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text", 2_000_000):
                hashes, cuts = token_hashes(batch.column("text"), BLANK_SEPARATED, exact=True)
                out = _Parts()
                ids, keys = batch.column("id").to_pylist(), batch.column("key").to_pylist()
                needs = [_lists(batch.column(name)) for name in ("at", "ref_id", "ref_key", "ref_seg")]
                for row, (doc, key) in enumerate(zip(ids, keys)):
                    words = hashes[cuts[row] : cuts[row + 1]]
                    of_window = window_anchors(words, size, anchor)
                    at, *ref = (values[row] for values in needs)
                    own = np.isnan(at)
                    for seg in ref[2][own].tolist():
                        first, last = np.searchsorted(of_window, [seg * block, (seg + 1) * block])
                        out.add((doc, key, seg), doc, key, None, words[first : last - 1 + size])
                    for first, last, place in _runs(of_window, at[~own], [r[~own] for r in ref]):
                        out.add(place, doc, key, first, words[first : last - 1 + size])
                    if out.held > 500_000:
                        yield out.batch()
                        out = _Parts()
                yield out.batch()

    return rows.mapInArrow(
        cut, f"ref {_PLACE}, id bigint, key bigint, first int, words array<bigint>"
    )


class _Parts:
    """Rows of blocks and stretches on their way into one batch."""

    def __init__(self):
        self.places, self.ids, self.keys, self.firsts, self.words = [], [], [], [], []
        self.held = 0

    def add(self, place, doc, key, first, words) -> None:
        self.places.append(place)
        self.ids.append(doc)
        self.keys.append(key)
        self.firsts.append(first)
        self.words.append(words.view(np.int64))
        self.held += len(words)

    def batch(self) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32())
        columns = list(zip(*self.places)) or [(), (), ()]
        place = pa.StructArray.from_arrays(
            [pa.array(values, kind) for values, kind in zip(columns, kinds)], names=["id", "key", "seg"]
        )
        ends = np.cumsum([0, *map(len, self.words)]).astype(np.int32)
        values = np.concatenate(self.words) if self.words else np.empty(0, dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [
                place, pa.array(self.ids, pa.int64()), pa.array(self.keys, pa.int64()),
                pa.array(self.firsts, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
            ],
            names=["ref", "id", "key", "first", "words"],
        )


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The rows of a list column; integers with nulls come as floats with NaN, others as integers."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    if column.type.value_type == pa.int32():
        values = values.astype(np.float64)
    ends = np.cumsum([0, *np.diff(column.offsets.to_numpy())])
    return [values[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]


def _runs(of_window: np.ndarray, at: np.ndarray, ref: list[np.ndarray]):
    """First and last + 1 window, and block, of neighbouring anchors that go to one block."""
    order = np.argsort(at)
    at, ref = at[order].astype(np.int64), [values[order] for values in ref]
    first = np.searchsorted(of_window, at)
    last = np.searchsorted(of_window, at, side="right")
    new = np.ones(len(at), dtype=bool)
    new[1:] = first[1:] != last[:-1]
    for values in ref:
        new[1:] |= values[1:] != values[:-1]
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1
    for a, b in zip(begin.tolist(), end[: len(begin)].tolist()):
        yield int(first[a]), int(last[b]), (int(ref[0][a]), int(ref[1][a]), int(ref[2][a]))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    return joined(words, size)


class Block:
    """The index of a reference block: where each of its windows stands."""

    def __init__(self, words: np.ndarray, size: int):
        self.words, self.size = words, size
        self.places: dict[int, list[int]] = {}
        for place, window in enumerate(window_hashes(words, size).tolist()):
            self.places.setdefault(window, []).append(place)

    def longest(self, words: np.ndarray, start: int, places: list[int]) -> int:
        """Length of the longest factor of ``words`` from ``start`` that begins at one of the places."""
        best = 0
        for place in places:
            length = min(len(words) - start, len(self.words) - place)
            differ = words[start : start + length] != self.words[place : place + length]
            best = max(best, int(differ.argmax()) if differ.any() else length)
        return best

    def factors(self, words: np.ndarray, windows: list[int]) -> Iterator[tuple[int, int]]:
        """First and last + 1 word of what the block covers: long factors, and windows at their ends."""
        start, size, places = 0, self.size, self.places
        while start < len(windows):
            at = places.get(windows[start])
            if at is None:
                start += 1
                continue
            end = start + self.longest(words, start, at)
            yield start, end
            for window in range(max(start, end - size) + 1, min(end, len(windows))):
                if windows[window] in places:
                    yield window, window + size
            start = end


def parse(asked: DataFrame, blocks: DataFrame, size: int = SIZE) -> DataFrame:
    """Stretches factored against their blocks: id, key, first, last, and ``high``, ``low`` if open.

    Rows without hashes are duplicate spans; the others are windows that their block does not have.
    """
    schema = "id long, key long, first int, last int, high long, low long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, block = None, None
        for batch in batches:
            refs = batch.column("ref").to_pylist()
            rows = zip(
                refs, batch.column("id").to_pylist(), batch.column("key").to_pylist(),
                batch.column("first").to_pylist(), _lists(batch.column("words")),
                _lists(batch.column("block")),
            )
            spans, open_at, open_hashes = [], [], []
            for ref, doc, key, first, words, reference in rows:
                words = words.view(np.uint64)
                if ref != known:
                    known, block = ref, Block(reference.view(np.uint64), size)
                hashes = window_hashes(words, size)
                windows = hashes.tolist()
                if ref["id"] < doc:
                    spans.extend((doc, key, first + a, first + b) for a, b in block.factors(words, windows))
                missing = [k for k, window in enumerate(windows) if window not in block.places]
                if missing:
                    open_at.extend((doc, key, first + k, first + k + size) for k in missing)
                    second = joined(mixed(words), size)[missing]
                    open_hashes.append(np.stack([hashes[missing], second]).view(np.int64))
            high, low = np.concatenate(open_hashes, axis=1) if open_hashes else np.empty((2, 0), dtype=np.int64)
            columns = list(zip(*spans, *open_at)) or [()] * 4
            none = pa.nulls(len(spans), pa.int64())
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
            arrays += [pa.concat_arrays([none, pa.array(values)]) for values in (high, low)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "key", "first", "last", "high", "low"])

    return asked.join(blocks, "ref").select("ref", "id", "key", "first", "words", "block").mapInArrow(run, schema)


def duplicate_spans(
    docs: DataFrame, size: int = SIZE, anchor: int = ANCHOR, block: int = BLOCK
) -> DataFrame:
    """id, key and the merged ``spans`` of documents given as id, key (of the text) and text."""
    present = docs.where("id is not null")
    found = stored(anchors(present, size, anchor), "lz-anchors")
    needs = routes(found, block)
    discard(found)
    parts = stored(stretches(present, needs, size, anchor, block), "lz-parts")
    discard(needs)
    blocks = stored(
        parts.where("first is null").select("ref", F.col("words").alias("block")).dropDuplicates(["ref"]),
        "lz-blocks",
    )
    parsed = stored(parse(parts.where("first is not null"), blocks, size), "lz-parsed")
    discard(parts, blocks)
    open_windows = parsed.where("high is not null")
    repeated = stored(
        open_windows.groupBy("high", "low").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
        .where("first_id < last_id").select("high", "low", "first_id"),
        "lz-open",
    )
    later = open_windows.join(repeated, ["high", "low"]).where("id > first_id")
    spans = parsed.where("high is null").select("id", "key", "first", "last").union(
        later.select("id", "key", "first", "last")
    )
    merged = stored(
        spans.groupBy("id", "key").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("spans")),
        "lz-spans",
    )
    discard(parsed, repeated)
    return merged


def covered(spans: list[dict], n_words: int) -> np.ndarray:
    """Which words lie in a span."""
    change = np.zeros(n_words + 1, dtype=np.int64)
    for span in spans:
        change[span["first"]] += 1
        change[span["last"]] -= 1
    return np.cumsum(change[:-1]) > 0


def remove_repeats(
    docs: DataFrame,
    size: int = SIZE,
    anchor: int = ANCHOR,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All rows as a struct ``row`` with n_words, n_removed and ``kept``, the words left, one blank apart."""
    if not 1 < anchor <= size:
        raise ValueError("an anchor has 2 words to as many as a window")
    key = F.xxhash64(text_col).alias("key")
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), key, F.col(text_col).alias("text"))
    spans = duplicate_spans(keyed, size, anchor, block)
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), key, F.col(text_col).alias("text")
    )
    both = rows.join(spans, ["id", "key"], "left").select("row", "text", "spans")
    row_type = both.schema["row"].dataType.simpleString()

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices([whole], "text", 8_000_000):
                n_words, n_removed, kept = [], [], []
                for text, cover in zip(batch.column("text"), batch.column("spans").to_pylist()):
                    words = (text.as_py() or "").encode().split()
                    n_words.append(len(words))
                    if cover:
                        gone = covered(cover, len(words))
                        words = [word for word, out in zip(words, gone.tolist()) if not out]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(kept, pa.string())],
                    names=["row", "n_words", "n_removed", "kept"],
                )

    return both.mapInArrow(clean, f"row {row_type}, n_words long, n_removed long, kept string")
