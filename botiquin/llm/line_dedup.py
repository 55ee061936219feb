"""Removing text that repeats over three neighbouring lines, anywhere in the documents.

Every three consecutive lines of a text make a window, windows overlap, and lines are compared
without the blanks around them. Of each window that occurs more than once only the first occurrence
stays, in the order of document id, text hash and line; later ones cover their three lines, and the
lines that any of them covers are cut out. All steps are DataFrame functions: windows are hashed to
96 bits, counted with map-side sums, and joined back by hash, so a window with a third of all
occurrences sends one row per task to the count and is split by the adaptive join.

Windows with fewer than ``least_chars`` characters other than blanks never count as repeated, so
that empty lines and rules stay. Texts of fewer than three lines have no window and stay as they
are. ``remove_repeated_lines`` is this form, which the SQL twin has as well.

``remove_repeated_passages`` breaks lines at sentence ends (. ! ? and a blank) too, so that three
sentences within a line make a window, and leaves only windows without a letter or digit alone,
however short the others are.

Defined cases: null and empty texts stay. Documents without id come first in the order. Rows with
the same id and the same text are treated alike: each loses what one of them would lose. Columns
other than id and text are passed through whatever their names. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botiquin.llm.tables import stored, worked_out

SIZE = 3
LEAST_CHARS = 30

_BLANKS = "[ \\t\\r\\n]"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _sentences(text: Column) -> Column:
    """Lines broken at sentence ends; each begins with the line break or blank that parts it."""
    return F.split(F.concat(F.lit("\n"), text), "(?=\n)|(?<=[.!?])(?=[ \\t])", -1)


def windows(
    docs: DataFrame, size: int = SIZE, least_chars: int | None = LEAST_CHARS, sentences: bool = False
) -> DataFrame:
    """One row per window of documents given as id and text: id, hash of the text, line, hashes.

    With ``least_chars`` None all windows with a letter or digit.
    """
    if sentences:
        lines = F.transform(_sentences(F.col("text")), lambda line: F.btrim(line, F.lit(" \t\r\n")))
        broken = F.col("text").rlike("\n|[.!?][ \\t]")
    else:
        lines = F.transform(_lines(F.col("text")), lambda line: F.trim(line))
        broken = F.col("text").contains("\n")
    hashed = docs.where(broken).withColumn("text_hash", F.xxhash64("text"))
    rows = worked_out(hashed, ["id", "text_hash"], lines=lines).where(F.size("lines") >= size)
    window = F.concat_ws("\n", F.slice("lines", F.col("line") + 1, size))
    if least_chars is None:
        counts = F.col("window").rlike("[\\p{L}\\p{N}]")
    else:
        counts = F.length(F.regexp_replace("window", _BLANKS, "")) >= least_chars
    placed = rows.select(
        "id", "text_hash", "lines",
        F.explode(F.sequence(F.lit(0), F.size("lines") - size)).alias("line"),
    ).select("id", "text_hash", "line", window.alias("window"))
    return placed.where(counts).select(
        "id", "text_hash", "line",
        F.xxhash64("window").alias("high"), F.hash("window").alias("low"),
    )


def later_windows(found: DataFrame) -> DataFrame:
    """Windows that have an earlier occurrence: id, text_hash, line.

    The repeated ones are stored before they are joined, so that the join can split a hot window.
    """
    place = F.struct("id", "text_hash", "line")
    repeated = stored(
        found.groupBy("high", "low")
        .agg(F.min(place).alias("first"), F.count("*").alias("times"))
        .where("times > 1").select("high", "low", "first"),
        "repeated-windows",
    )
    return found.join(repeated, ["high", "low"]).where(~place.eqNullSafe(F.col("first"))).select(
        "id", "text_hash", "line"
    )


def _kept(lines: Column, covered: Column, size: int) -> Column:
    """Lines outside the windows that begin at the sorted places ``covered``.

    The stretches before the first, between neighbours and after the last are sliced out, so the
    work is in proportion to the text however many windows overlap.
    """
    before = F.slice(lines, 1, F.get(covered, 0))

    def between(start: Column, i: Column) -> Column:
        end = F.get(covered, i - 1) + size
        return F.when(i == 0, before).otherwise(
            F.slice(lines, end + 1, F.greatest(start - end, F.lit(0)))
        )

    last = F.get(covered, F.size(covered) - 1) + size
    after = F.slice(lines, last + 1, F.greatest(F.size(lines) - last, F.lit(0)))
    return F.concat(F.flatten(F.transform(covered, between)), after)


def remove_repeated_lines(
    docs: DataFrame,
    size: int = SIZE,
    least_chars: int = LEAST_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All rows as a struct ``row`` with the cleaned ``text``, ``n_lines`` and ``n_removed``."""
    return _removed(docs, size, least_chars, False, id_col, text_col)


def remove_repeated_passages(
    docs: DataFrame,
    size: int = SIZE,
    least_chars: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The same over lines broken at sentence ends; ``n_lines`` and ``n_removed`` count their parts."""
    return _removed(docs, size, least_chars, True, id_col, text_col)


def _removed(
    docs: DataFrame, size: int, least_chars: int | None, sentences: bool, id_col: str, text_col: str
) -> DataFrame:
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    covered = (
        later_windows(windows(keyed, size, least_chars, sentences))
        .groupBy("id", "text_hash")
        .agg(F.array_sort(F.collect_set("line")).alias("covered"))
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    )
    same = rows["id"].eqNullSafe(covered["id"]) & (rows["text_hash"] == covered["text_hash"])
    with_cover = worked_out(
        rows.join(covered, same, "left").select("row", rows["text"], "covered"),
        ["row", "text", "covered"],
        lines=_sentences(F.col("text")) if sentences else _lines(F.col("text")),
    )
    # Sentences carry what parts them; the first one left loses it, as it parts it from nothing.
    joined = F.substr(F.array_join("kept", ""), F.lit(2)) if sentences else F.array_join("kept", "\n")
    kept = F.when(F.col("covered").isNotNull(), _kept(F.col("lines"), F.col("covered"), size))
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size("lines")).cast("long")
    left = worked_out(with_cover.withColumn("n_lines", n_lines), ["row", "text", "n_lines"], kept=kept)
    return worked_out(
        left, ["row", "n_lines"],
        text=F.when(F.col("kept").isNull(), F.col("text")).otherwise(joined),
        n_removed=F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("long"),
    ).select("row", "text", "n_lines", "n_removed")
