"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# A text longer than this is encoded in parts that end at a blank.
PART = 1_000_000
# Pieces whose ids a worker keeps in each of two generations; of the older one only those that
# are met again go on. It bounds memory only.
KEPT_WORDS = 300_000

# How the tokenizer cuts text of Latin-1 characters in lower case. Its own pattern,
# with the classes of letters, digits and blanks written out for Latin-1.
_PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]"
    r"|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+"
)


class WordwiseEncoder:
    """Encodes whole texts piece by piece, each distinct piece by the tokenizer once.

    Holds for tokenizers that drop white space, cut by the pattern above and let no token reach
    across a cut: the ids of a text are then those of its pieces in order. Texts beyond Latin-1 are
    cut at blanks only. A test compares it with encoding whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(t.content) for t in added) or r"(?!)")
        # Letters beyond ASCII as the byte-level step of the tokenizer writes them.
        letters = [c for c in map(chr, range(128, 256)) if c.isalpha() and c.islower()]
        spelled = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.byte_level = str.maketrans({c: "".join(part for part, _ in spelled(c)) for c in letters})

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text the ids as little-endian unsigned 32-bit integers."""
        if len(self.known) > KEPT_WORDS:
            self.older, self.known = self.known, {"": b""}
        rows = [[self._cut(part) for part in _parts(text)] for text in texts]
        known, missing = self.known, set()
        for row in rows:
            for pieces in row:
                missing.update([piece for piece in pieces if piece not in known])
        again = {piece: self.older[piece] for piece in missing if piece in self.older}
        known.update(again)
        self._learn(missing.difference(again))
        return [b"".join([known[piece] for pieces in row for piece in pieces]) for row in rows]

    def _cut(self, part: str) -> list[str]:
        """What the tokenizer encodes independently of each other, in order."""
        if _latin(part) and not self.special.search(part):
            return _PIECES.findall(part.lower())
        return part.replace("\n", " ").split(" ")

    def _learn(self, pieces: set[str]) -> None:
        """Words of letters go straight to the model, all else through the whole tokenizer."""
        known, others, model = self.known, [], self.tokenizer.model
        for piece in pieces:
            if piece.isalpha() and piece.islower() and _latin(piece):
                found = model.tokenize(piece.translate(self.byte_level))
                known[piece] = np.array([token.id for token in found], dtype="<u4").tobytes()
            else:
                others.append(piece)
        for piece, found in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            known[piece] = np.array(found.ids, dtype="<u4").tobytes()


def _latin(text: str) -> bool:
    """Whether all characters are Latin-1; normalisation and lower case act on each alone there."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _parts(text: str) -> list[str]:
    if len(text) <= PART:
        return [text]
    parts, first = [], 0
    while len(text) - first > PART:
        cut = text.rfind(" ", first, first + PART)
        if cut <= first:
            cut = text.find(" ", first + PART)
            if cut < 0:
                break
        parts.append(text[first:cut])
        first = cut + 1
    parts.append(text[first:])
    return parts


@lru_cache(maxsize=2)
def encoder(path: str) -> WordwiseEncoder:
    """One per worker process and tokenizer file."""
    return WordwiseEncoder(path)
