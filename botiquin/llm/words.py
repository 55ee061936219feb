"""Hashes of the words and word shingles of whole texts, straight from Arrow's text buffers.

A table gives every byte a class; a token is a run of bytes of one class, class 0 separates. A-Z
count as a-z unless ``exact``. Hashes are 64 bits, multilinear over the bytes of a token and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SAME = np.arange(256, dtype=np.uint8)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(64)
_BYTES = _RANDOM.integers(1, 2**63, size=256, dtype=np.uint64)
_PLACES = _RANDOM.integers(1, 2**63, size=64, dtype=np.uint64) * 2 + 1

# Words are what stands between ASCII blanks.
BLANK_SEPARATED = np.ones(256, dtype=np.uint8)
BLANK_SEPARATED[[9, 10, 11, 12, 13, 32]] = 0
# Words of letters, digits and anything beyond ASCII, and runs of marks between them.
WORDS_AND_MARKS = np.full(256, 2, dtype=np.uint8)
WORDS_AND_MARKS[[9, 10, 11, 12, 13, 32]] = 0
WORDS_AND_MARKS[48:58] = WORDS_AND_MARKS[65:91] = WORDS_AND_MARKS[97:123] = 1
WORDS_AND_MARKS[128:] = 1

# Bytes hashed at once; bounds memory for very long texts.
_AT_ONCE = 2_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the places between them."""
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    if data is None or offsets[0] == offsets[-1]:
        return np.empty(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _run_starts(kinds: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where runs of one class begin; a text's end ends a run."""
    edge = np.empty(len(kinds), dtype=bool)
    edge[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=edge[1:])
    edge[offsets[:-1][offsets[:-1] < len(kinds)]] = True
    return np.flatnonzero(edge)


def token_spans(texts: pa.Array, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each token begins and ends there, in the order of its hash."""
    data, offsets = _bytes_of(pc.fill_null(texts, ""))
    if not len(data):
        return data, offsets[:0], offsets[:0]
    kinds = classes[data]
    starts = _run_starts(kinds, offsets)
    tokens = kinds[starts] != 0
    return data, starts[tokens], np.append(starts[1:], len(data))[tokens]


def token_hashes(
    texts: pa.Array, classes: np.ndarray, exact: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens in order, and the cuts between texts: text i has cuts[i]:cuts[i+1]."""
    data, offsets = _bytes_of(pc.fill_null(texts, ""))
    if not len(data):
        return np.empty(0, dtype=np.uint64), offsets
    kinds = classes[data]
    starts = _run_starts(kinds, offsets)
    hashes = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(starts, starts[first] + _AT_ONCE, side="right")) - 1
        last = max(last, first + 1) if last < len(starts) - 1 else len(starts)
        end = starts[last] if last < len(starts) else len(data)
        hashes[first:last] = _run_hashes(
            data[starts[first] : end], starts[first:last] - starts[first], _SAME if exact else _LOWER
        )
        first = last
    tokens = kinds[starts] != 0
    cuts = np.concatenate([[0], np.cumsum(tokens)])[np.searchsorted(starts, offsets)]
    return hashes[tokens], cuts


def _run_hashes(data: np.ndarray, starts: np.ndarray, letters: np.ndarray) -> np.ndarray:
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
    weights = mixed(np.arange(1, int(lengths.max()) + 1, dtype=np.uint64)) | np.uint64(1)
    return mixed(np.add.reduceat(_BYTES[letters[data]] * weights[place], starts))


def joined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of every ``width`` neighbouring tokens."""
    count = max(0, len(hashes) - width + 1)
    total = np.zeros(count, dtype=np.uint64)
    for k in range(width):
        total += hashes[k : k + count] * _PLACES[k]
    return mixed(total)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles of blank-separated words.

    A text of fewer words has its whole sequence as its only shingle, one without words none.
    """
    hashes, cuts = token_hashes(texts, BLANK_SEPARATED)
    shingles = joined(hashes, width)
    cuts = cuts.tolist()
    for first, last in zip(cuts, cuts[1:]):
        if last - first >= width:
            yield np.unique(shingles[first : last - width + 1])
        elif last > first:
            yield joined(hashes[first:last], last - first)
        else:
            yield shingles[:0]
