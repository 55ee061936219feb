"""Text cleaning as built-in column expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from botiquin.contracts import (
    BLANK_TOKENS,
    CELL_TOKENS,
    NULL_WORDS,
    READER_NULLS,
    RESERVED_WORDS,
)

# All characters a Unicode-aware strip removes, from the rule instead of a list. Spark's plain
# trim only removes spaces.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def strip_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    """Trimmed text; the missing-value tokens and empty text become null. (FN-1, FN-3)"""
    return tokens_to_null(strip_ws(c))


def tokens_to_null(stripped: Column) -> Column:
    return F.when(~stripped.isin(*BLANK_TOKENS, ""), stripped)


def blank_to_empty(c: Column) -> Column:
    """Trimmed text; the missing-value tokens and null become empty text. (FN-2)"""
    return F.coalesce(blank_to_null(c), F.lit(""))


def null_words_to_null(c: Column) -> Column:
    """Like blank_to_null, comparing without case and with more words. (FN-4)"""
    text = strip_ws(c)
    return F.when(~F.lower(text).isin(*NULL_WORDS), text)


def cell_tokens_to_null(c: Column) -> Column:
    """Exact cell texts that stand for nothing become null, others stay as they are. (FN-5)"""
    return F.when(~c.isin(*CELL_TOKENS), c)


def reader_nulls_to_null(c: Column) -> Column:
    """Exact cell texts that a delimited file reader takes as missing become null. (SRC-1)"""
    return F.when(~c.isin(*READER_NULLS), c)


def sanitize(c: Column, max_length: int | None = None) -> Column:
    """Double single quotes, cut to a length where one is given, trim, in that order. (FN-22)"""
    doubled = F.replace(c, F.lit("'"), F.lit("''"))
    return strip_ws(doubled if max_length is None else F.substring(doubled, 1, max_length))


def name_or(c: Column, fallback: Column) -> Column:
    """The trimmed text, or the fallback when there is none. (FN-18)"""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), fallback)


def or_default(c: Column, default: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def yes_no(c: Column) -> Column:
    """Boolean to SI/NO; null counts as NO. (FN-24)"""
    return F.when(c, "SI").otherwise("NO")


def display_key(key: Column, name: Column) -> Column:
    """``id - name`` as a choice list shows it. (FN-25)"""
    return F.concat(key.cast("string"), F.lit(" - "), name)


def parse_display_key(c: Column) -> tuple[Column, Column]:
    """Back from ``id - name``: the first part as a number, the rest as it was. (FN-25)"""
    return (
        F.substring_index(c, " - ", 1).try_cast("bigint"),
        F.when(c.contains(" - "), F.substring(c, F.instr(c, " - ") + F.lit(3), F.length(c)))
        .when(c.isNotNull(), ""),
    )


def clean_column_name(name: str | None) -> str:
    """A column name from any header text, at plan time. (FN-21)"""
    if name is None:
        return "unnamed"
    plain = unicodedata.normalize("NFKD", name.strip()).encode("ascii", "ignore").decode()
    words = re.sub(r"[^\w\s]", "", plain.lower())
    out = re.sub(r"^\d+", "", re.sub(r"\s+", "_", words))
    if not out:
        return "unnamed"
    return f"col_{out}" if out in RESERVED_WORDS else out


@cache
def _ascii_folds() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that decompose to one ASCII character, and to several, by the Unicode tables."""
    one, several = {}, {}
    for code in range(0x80, 0x20000):
        char = chr(code)
        plain = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        if plain:
            (one if len(plain) == 1 else several)[char] = plain
    return one, several


def clean_name(c: Column) -> Column:
    """FN-21 over values of a column, with translations built from the Unicode tables."""
    one, several = _ascii_folds()
    text = strip_ws(c)
    # Few texts hold characters such as ligatures; only those are taken apart.
    table = F.create_map(*[F.lit(x) for pair in several.items() for x in pair])
    spelled = F.array_join(
        F.transform(F.split(text, ""), lambda char: F.coalesce(table[char], char)), ""
    )
    rare = F.translate(text, "".join(several), "") != text
    text = F.when(rare, spelled).otherwise(text)
    source, target = "".join(one), "".join(one.values())
    plain = F.lower(F.regexp_replace(F.translate(text, source, target), r"[^\x00-\x7F]", ""))
    words = F.regexp_replace(plain, r"[^\w\s\x1c-\x1f]", "")
    out = F.regexp_replace(F.regexp_replace(words, r"[\s\x1c-\x1f]+", "_"), r"^\d+", "")
    return (
        F.when(c.isNull() | (out == ""), "unnamed")
        .when(out.isin(*RESERVED_WORDS), F.concat(F.lit("col_"), out))
        .otherwise(out)
    )
