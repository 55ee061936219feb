"""Packing token sequences under several limits at once by the dot-product heuristic.

Every example has a size in three dimensions: tokens, segments (one) and loss-bearing tokens. A
sequence has a limit in each. Sequences are filled one at a time: of the examples that still fit,
the one whose size has the largest weighted dot product with what is left comes next, each
dimension counted as a share of its limit and weighted by the mean demand for it. Where none fits,
the best is cut so that its first part fills what is left; an example longer than a sequence gives
whole sequences first.

Examples are packed where they lie: a task packs what it has read in buffers of about a million
tokens, carries the last, unfilled sequence on into the next buffer, and so needs no shuffle and a
bounded memory beyond one text. What is left at the end of a task, and a sequence that a limit
closes early, is divided into sequences with a power of two tokens, so that these need no padding.

Defined cases: a null or empty text has the end id only. Rows without id, with the same id or
repeated are packed like any other. A null mask means that every token bears loss. An empty table
gives no pieces. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botiquin.llm.encoding import encoder
from botiquin.llm.tables import slices

BUFFER_TOKENS = 1 << 20


@dataclass(frozen=True)
class Limits:
    """What one sequence may hold."""

    tokens: int = 2048
    segments: int = 128
    loss: int = 2048

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("every limit is at least 1")


@dataclass
class Example:
    """Token ids that are still to be placed, from ``start`` on."""

    key: int | None
    ids: np.ndarray
    loss: np.ndarray | None  # number of loss-bearing tokens before each place, or None for all
    start: int = 0
    total: int = 0  # of the whole document, also where only a part of it is left here

    def __post_init__(self) -> None:
        self.total = self.total or len(self.ids)

    @property
    def tokens(self) -> int:
        return len(self.ids) - self.start

    @property
    def losses(self) -> int:
        return self.tokens if self.loss is None else int(self.loss[-1] - self.loss[self.start])

    def prefix(self, tokens: int, loss: int) -> int:
        """The most tokens from ``start`` on within both limits."""
        most = min(tokens, self.tokens)
        if self.loss is None:
            return min(most, loss)
        reach = self.loss[self.start : self.start + most + 1] - self.loss[self.start]
        return int(np.searchsorted(reach, loss, side="right")) - 1


Piece = tuple[Example, int, int]  # example, start, length


def pack(examples: Iterable[Example], limits: Limits) -> Iterator[list[Piece]]:
    """Sequences as lists of pieces, from a stream of examples."""
    held, waiting = [], 0
    for example in examples:
        if not example.tokens:
            continue
        yield from _whole(example, limits)
        if example.tokens:
            held.append(example)
            waiting += example.tokens
        if waiting >= BUFFER_TOKENS:
            last = yield from _fill(held, limits)
            held = [_part(e, s, n) for e, s, n in last]
            waiting = sum(example.tokens for example in held)
    last = yield from _fill(held, limits)
    yield from powers_of_two(last)


def _part(example: Example, start: int, length: int) -> Example:
    end = start + length
    loss = None if example.loss is None else example.loss[: end + 1]
    return Example(example.key, example.ids[:end], loss, start, example.total)


def _whole(example: Example, limits: Limits) -> Iterator[list[Piece]]:
    """Sequences that one long example fills alone."""
    while example.tokens >= limits.tokens and (
        example.prefix(limits.tokens, limits.loss) == limits.tokens
    ):
        yield [(example, example.start, limits.tokens)]
        example.start += limits.tokens


def _fill(held: list[Example], limits: Limits) -> Iterator[list[Piece]]:
    """Fill sequences from the examples; returns the pieces of the last one if it has room."""
    sizes: dict[tuple[int, int], list[Example]] = {}
    for example in held:
        sizes.setdefault((example.tokens, example.losses), []).append(example)
    limit = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
    table = np.array([(t, 1, l) for t, l in sizes], dtype=float).reshape(-1, 3)
    stacks = list(sizes.values())
    count = np.array([len(stack) for stack in stacks])
    share = table / limit
    mean = (share * count[:, None]).sum(axis=0) / max(count.sum(), 1)
    left_over = int(count.sum())
    pieces: list[Piece] = []
    room = limit.copy()
    while left_over:
        score = share @ (mean * room / limit)
        fits = (table <= room).all(axis=1) & (count > 0)
        if fits.any():
            best = int(np.argmax(np.where(fits, score, -1.0)))
            example = stacks[best].pop()
            length = example.tokens
            used = table[best]
        elif room[1] >= 1:
            best = int(np.argmax(np.where(count > 0, score, -1.0)))
            example = stacks[best][-1]
            length = example.prefix(int(room[0]), int(room[2]))
            if not length:
                yield from powers_of_two(pieces)
                pieces, room = [], limit.copy()
                continue
            stacks[best].pop()
            used = np.array([length, 1, _losses(example, length)])
        else:
            yield from powers_of_two(pieces)
            pieces, room = [], limit.copy()
            continue
        count[best] -= 1
        left_over -= 1
        pieces.append((example, example.start, length))
        room = room - used
        if length < example.tokens:
            rest = Example(
                example.key, example.ids, example.loss, example.start + length, example.total
            )
            size = np.array([rest.tokens, 1, rest.losses], dtype=float)
            same = np.flatnonzero((table == size).all(axis=1))
            if len(same):
                stacks[same[0]].append(rest)
                count[same[0]] += 1
            else:
                table = np.vstack([table, size])
                share = table / limit
                stacks.append([rest])
                count = np.append(count, 1)
            left_over += 1
        if room[0] == 0:
            yield pieces
            pieces, room = [], limit.copy()
    return pieces


def _losses(example: Example, length: int) -> int:
    if example.loss is None:
        return length
    return int(example.loss[example.start + length] - example.loss[example.start])


def powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    """Divide an unfilled sequence into ones with a power of two tokens, the longest first."""
    total = sum(length for _, _, length in pieces)
    queue = list(reversed(pieces))
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        sequence = []
        while room:
            example, start, length = queue.pop()
            taken = min(length, room)
            sequence.append((example, start, taken))
            room -= taken
            if taken < length:
                queue.append((example, start + taken, length - taken))
        yield sequence


_PIECES = (
    "{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_ARROW = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _rows(
    sequences: Iterator[list[Piece]], key_col: str, key_type: pa.DataType, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    # Places in a task below the task's own number, so ids are distinct without a shuffle.
    base = (context.partitionId() if context else 0) << 40
    keys, columns, ids = [], [[] for _ in _ARROW], []

    def batch() -> pa.RecordBatch:
        arrays = [pa.array(keys, key_type), *(pa.array(c, pa.int64()) for c in columns)]
        names = [key_col, *_ARROW]
        if with_ids:
            arrays.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for number, sequence in enumerate(sequences):
        offset = 0
        for example, start, length in sequence:
            part = example.ids[start : start + length]
            values = (start, length, zlib.crc32(part), example.total, base + number, offset)
            keys.append(example.key)
            for column, value in zip(columns, values):
                column.append(value)
            if with_ids:
                ids.append(part.astype(np.int32))
            offset += length
        if len(keys) >= 2000:
            yield batch()
            keys, columns, ids = [], [[] for _ in _ARROW], []
    if keys:
        yield batch()


def pack_texts(
    docs: DataFrame,
    tokenizer: str,
    limits: Limits = Limits(),
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encode whole texts and pack them; one row per piece, with its token ids if asked for."""
    texts = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()

        def examples() -> Iterator[Example]:
            for batch in slices(batches, "text", 4_000_000):
                found = work.encode([text or "" for text in batch.column("text").to_pylist()])
                for key, ids in zip(batch.column(id_col).to_pylist(), found):
                    yield Example(key, np.frombuffer(ids + end, dtype="<u4"), None)

        yield from _rows(pack(examples(), limits), id_col, pa.int64(), with_ids)

    schema = _PIECES.format(key=f"`{id_col}`", kind="long") + ", ids array<int>" * with_ids
    return texts.mapInArrow(run, schema)


def pack_examples(
    examples: DataFrame,
    limits: Limits = Limits(),
    key_col: str = "example_id",
    ids_col: str = "ids",
    mask_col: str | None = None,
) -> DataFrame:
    """Pack examples that are already token ids; the mask says which tokens bear loss."""
    mask = F.col(mask_col) if mask_col else F.lit(None)
    rows = examples.select(
        F.col(key_col).cast("long").alias(key_col),
        F.col(ids_col).cast("array<int>").alias("ids"),
        mask.cast("array<boolean>").alias("mask"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[Example]:
            for batch in batches:
                for row in batch.to_pylist():
                    ids = np.array(row["ids"] or [], dtype="<u4")
                    loss = None
                    if row["mask"] is not None:
                        bears = np.zeros(len(ids), dtype=np.int64)
                        given = np.array([bool(x) for x in row["mask"]], dtype=np.int64)
                        bears[: len(given)] = given[: len(ids)]
                        loss = np.concatenate([[0], np.cumsum(bears)])
                    yield Example(row[key_col], ids, loss)

        yield from _rows(pack(read(), limits), key_col, pa.int64(), True)

    schema = _PIECES.format(key=f"`{key_col}`", kind="long") + ", ids array<int>"
    return rows.mapInArrow(run, schema)


def pack_conversations(
    turns: DataFrame,
    tokenizer: str,
    limits: Limits = Limits(),
    end_id: int = 1,
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """Instruction data: one example per conversation, loss on the answers and their end ids.

    A conversation's turns are ordered by turn, then role and text. Rows without conversation id
    form one conversation.
    """
    rows = turns.select("conv_id", "turn", "role", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in slices(batches, "text", 4_000_000):
            found = work.encode([text or "" for text in batch.column("text").to_pylist()])
            ids = [np.frombuffer(part + end, dtype="<i4") for part in found]
            kept = [batch.column(name) for name in ("conv_id", "turn", "role", "text")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(ids, pa.list_(pa.int32()))],
                names=["conv_id", "turn", "role", "text", "ids"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items()) + ", ids array<int>"
    coded = rows.mapInArrow(encode, schema).withColumn(
        "mask", F.transform("ids", lambda _: F.coalesce(F.col("role").isin(*loss_roles), F.lit(False)))
    )
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.xxhash64("text"), "ids", "mask")))
    examples = coded.groupBy("conv_id").agg(ordered.alias("turns")).select(
        "conv_id",
        F.flatten("turns.ids").alias("ids"),
        F.flatten("turns.mask").alias("mask"),
    )
    return pack_examples(examples, limits, "conv_id", "ids", "mask")
