"""Header repair and mapping. Headers are plan-time data: nothing here touches rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_headers(names: Sequence[str | None]) -> list[str]:
    """Trim, collapse inner white space, name the nameless; accents stay. (PRJ-1)"""
    out = []
    for i, name in enumerate(names):
        if name is None:
            out.append(f"unnamed_{i}")
        else:
            out.append(" ".join(name.split()) or f"columna_{i + 1}")
    return out


def lower_headers(df: DataFrame) -> DataFrame:
    """All column names in lower case. (PRJ-9)"""
    return df.toDF(*[c.lower() for c in df.columns])


def rename_to(df: DataFrame, titles: Mapping[str, str]) -> DataFrame:
    """Display titles for the columns that have one. (PRJ-10)"""
    return df.withColumnsRenamed({k: v for k, v in titles.items() if k in df.columns})


def first_per_target(names: Sequence[str], mapping: Mapping[str, str]) -> dict[str, str]:
    """Target column -> header; of two synonyms in one file the first wins. (PRJ-2)"""
    chosen: dict[str, str] = {}
    for name in names:
        target = mapping.get(name)
        # A header that already has the target's name counts as mapped too.
        if target is None and name in mapping.values():
            target = name
        if target is not None:
            chosen.setdefault(target, name)
    return chosen


def select_mapped(df: DataFrame, mapping: Mapping[str, str], *keep: str) -> DataFrame:
    """Rename by synonyms and keep only mapped columns. (PRJ-2, PRJ-4)

    ``keep`` names helper columns to carry along.
    """
    chosen = first_per_target(df.columns, mapping)
    return df.select(
        *[quoted(header).alias(target) for target, header in chosen.items()],
        *[F.col(c) for c in keep],
    )


def _squeezed(name: str) -> str:
    return name.lower().replace(" ", "").replace(".", "").replace("_", "")


def match_headers(names: Sequence[str], mapping: Mapping[str, str]) -> dict[str, str]:
    """Target -> header by exact name, then squeezed name, then containment either way. (PRJ-3)

    Where several headers reach one target, the last one stays, as each overwrites the one before.
    """
    squeezed = {_squeezed(key): target for key, target in mapping.items()}
    chosen: dict[str, str] = {}
    for name in names:
        small = _squeezed(name)
        target = mapping.get(name) or squeezed.get(small)
        if target is None:
            target = next((t for key, t in squeezed.items() if small in key or key in small), None)
        if target is not None:
            chosen[target] = name
    return chosen


def select_matched(
    df: DataFrame, mapping: Mapping[str, str], required: Sequence[str] = ()
) -> DataFrame:
    """Apply match_headers; required columns that found no header come as nulls. (PRJ-3, PRJ-5)"""
    chosen = match_headers(df.columns, mapping)
    found = df.select(*[quoted(header).alias(target) for target, header in chosen.items()])
    return add_missing(found, {c: "string" for c in required})


def add_missing(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add the columns the frame lacks as typed nulls. (PRJ-5)"""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order. (PRJ-11)"""
    return df.select(*[quoted(c) for c in columns if c in df.columns])


def quoted(name: str) -> Column:
    """A column by its literal name; headers such as ``P.Unit.`` hold points."""
    return F.col("`" + name.replace("`", "``") + "`")
