"""How far sources of a language diverge in their words, from in-mapper stripes.

Every task folds whole documents into stripes, one per language and term: the number of documents
that hold the term and its occurrences by source. Terms are told apart by 64-bit hashes within a task.
What a task holds is bounded; beyond ``most_held`` entries it spills its stripes as rows and starts
anew. Stripes are dealt and sorted by their key and
merged as they stream by, one key at a time. Merged stripes emit divergences directly: of each term
they give every source its share, and each pair of sources its squared difference.

A language keeps the V terms that at least ``least_docs`` of its documents hold. A group (a source of
a language, or the language as a whole) gives a kept term with ``count`` occurrences among its N the
share p = 1 + floor(10^9 * (count + 2) / (N + 2 V)). Two groups with shares p and q differ in a term by
floor((p - q)^2 / (p + q)). All of it is whole numbers; p is divided digit by digit, so counts may
reach 10^15.

Pairs of sources are summed in tiles of ``tile`` by ``tile`` sources, so that memory does not grow with
their number; a stripe goes to the tiles that one of its sources is in, and the rest of the terms, equal
for all, is added by their number. Its result has a row per ordered pair of a language's sources, as asked.

Defined cases: null text, language and source count as ''. Documents without terms count as a group
of their source. Rows with the same id are documents of their own. A language without kept terms has
pairs of value 0 and no terms. Other columns may have any name. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from botiquin.llm.tables import discard, slices, stored
from botiquin.llm.words import token_hashes, token_spans

SCALE = 1_000_000_000
LEAST_DOCS = 10
# Entries of term and source, some 40 bytes each, that a task holds before it spills.
MOST_HELD = 2_000_000
TILE = 64
# Terms whose shares are laid out side by side for one tile.
_TERMS_AT_ONCE = 128
# Stripes of a batch.
_ROWS = 20_000

# Letters of ASCII and every byte beyond it; in UTF-8 all bytes of other characters are.
_TERMS = np.zeros(256, dtype=np.uint8)
_TERMS[65:91] = _TERMS[97:123] = _TERMS[128:] = 1
_SMALL = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

STRIPE = "lang string, term string, docs long, places array<int>, counts array<long>"


def shares(counts: np.ndarray, total: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / (total + 2 * terms)) in 64-bit steps of three decimal digits."""
    over, under = counts + 2, total + 2 * terms
    whole, rest = over // under, over % under
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, under)
        whole = whole * 1000 + digits
    return whole + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class _Names:
    """Numbers for the names that a task meets."""

    def __init__(self):
        self.numbers: dict[str, int] = {}

    def of(self, column: pa.Array) -> np.ndarray:
        coded = pc.dictionary_encode(column)
        known = [self.numbers.setdefault(name, len(self.numbers)) for name in coded.dictionary.to_pylist()]
        return np.array(known, dtype=np.int64)[coded.indices.to_numpy()]

    def names(self, numbers: np.ndarray) -> pa.Array:
        return pa.array(list(self.numbers), pa.string()).take(pa.array(numbers))


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The distinct keys, sorted by the first and on, and the sums of their values."""
    order = np.lexsort(keys[::-1])
    keys = [key[order] for key in keys]
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    sums = [np.add.reduceat(value[order], first) if len(first) else value[:0] for value in values]
    return [key[first] for key in keys], sums


class _Stripes:
    """The stripes that one task holds: hash of the term, language, place of the source, documents,
    occurrences."""

    def __init__(self):
        self.langs = _Names()
        self.parts: list[list[np.ndarray]] = []
        self.held = 0
        self.hashes = np.empty(0, dtype=np.uint64)
        self.terms = pa.array([], pa.string())

    def fold(self, batch: pa.RecordBatch) -> None:
        """Take in whole documents."""
        texts = pc.fill_null(batch.column("text"), "")
        hashes, cuts = token_hashes(texts, _TERMS)
        if not len(hashes):
            return
        doc = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        self._learn(texts, hashes)
        (hashes, doc), (occurrences,) = _summed([hashes, doc], [np.ones(len(hashes), dtype=np.int64)])
        lang = self.langs.of(batch.column("lang"))[doc]
        place = batch.column("place").to_numpy().astype(np.int64)[doc]
        keys, sums = _summed([hashes, lang, place], [np.ones(len(hashes), dtype=np.int64), occurrences])
        self.parts.append([*keys, *sums])
        self.held += len(keys[0])

    def _learn(self, texts: pa.Array, hashes: np.ndarray) -> None:
        """Keep the words of hashes that were not met before."""
        found, at = np.unique(hashes, return_index=True)
        fresh = ~np.isin(found, self.hashes, assume_unique=True)
        if not fresh.any():
            return
        data, starts, ends = token_spans(texts, _TERMS)
        data = data.tobytes()
        words = [data[a:b].translate(_SMALL) for a, b in zip(starts[at[fresh]].tolist(), ends[at[fresh]].tolist())]
        known = np.concatenate([self.hashes, found[fresh]])
        order = np.argsort(known)
        words = pa.array(words, pa.binary()).cast(pa.string())
        self.terms = pa.concat_arrays([self.terms, words]).take(pa.array(order))
        self.hashes = known[order]

    def merge(self) -> int:
        """Bring equal entries together; gives the number that is left."""
        if len(self.parts) > 1:
            keys, sums = _summed(*(
                [np.concatenate([part[k] for part in self.parts]) for k in ks] for ks in ((0, 1, 2), (3, 4))
            ))
            self.parts = [[*keys, *sums]]
        self.held = len(self.parts[0][0]) if self.parts else 0
        return self.held

    def spill(self) -> Iterator[pa.RecordBatch]:
        if not self.merge():
            return
        hashes, lang, place, docs, counts = self.parts[0]
        order = np.lexsort((place, hashes, lang))
        hashes, lang, place, docs, counts = (x[order] for x in (hashes, lang, place, docs, counts))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (lang[1:] != lang[:-1])
        first = np.flatnonzero(new)
        ends = np.append(first, len(order))
        docs = np.add.reduceat(docs, first)
        terms = self.terms.take(pa.array(np.searchsorted(self.hashes, hashes[first])))
        yield from _stripe_batches(self.langs.names(lang[first]), terms, docs, ends, place, counts)


def _stripe_batches(
    langs: pa.Array, terms: pa.Array, docs: np.ndarray, ends: np.ndarray, places: np.ndarray, counts: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """Stripe k has the places and counts from ends[k] to ends[k + 1]."""
    for a in range(0, len(docs), _ROWS):
        b = min(a + _ROWS, len(docs))
        offsets = pa.array((ends[a : b + 1] - ends[a]).astype(np.int32))
        cells = slice(int(ends[a]), int(ends[b]))
        yield pa.RecordBatch.from_arrays(
            [
                langs[a:b], terms[a:b], pa.array(docs[a:b]),
                pa.ListArray.from_arrays(offsets, pa.array(places[cells].astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array(counts[cells])),
            ],
            names=["lang", "term", "docs", "places", "counts"],
        )


def fold(docs: DataFrame, most_held: int = MOST_HELD) -> DataFrame:
    """Stripes of documents given as lang, place (of the source) and text, as many per term as tasks and
    spills."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Stripes()
        for batch in slices(batches, "text", 4_000_000):
            held.fold(batch)
            # Mostly the entries were there already: spill only if they are not.
            if held.held > most_held and held.merge() > most_held // 2:
                yield from held.spill()
                held = _Stripes()
        yield from held.spill()

    return docs.select("lang", "place", "text").mapInArrow(run, STRIPE)


def _lengths(lists: pa.Array) -> np.ndarray:
    return np.diff(lists.offsets.to_numpy()).astype(np.int64)


def _merged(batch: pa.RecordBatch) -> list[pa.RecordBatch]:
    """Neighbouring stripes of one key as one."""
    n = batch.num_rows
    lang, term = batch.column("lang"), batch.column("term")
    new = np.ones(n, dtype=bool)
    for column in (lang, term):
        differ = pc.not_equal(column.slice(1), column.slice(0, n - 1))
        new[1:] = differ.to_numpy(zero_copy_only=False) | (new[1:] if column is term else False)
    first = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    row = np.repeat(group, _lengths(batch.column("places")))
    places, counts = (batch.column(name).flatten().to_numpy() for name in ("places", "counts"))
    (row, places), (counts,) = _summed([row, places], [counts])
    ends = np.searchsorted(row, np.arange(len(first) + 1))
    docs = np.add.reduceat(batch.column("docs").to_numpy(), first)
    keys = pa.array(first)
    return list(_stripe_batches(lang.take(keys), term.take(keys), docs, ends, places, counts))


def merge(stripes: DataFrame) -> DataFrame:
    """One stripe per language and term, with a total of its counts as ``occurrences``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            *ready, whole = _merged(batch)
            yield from ready
            # The last key may go on in the next batch.
            yield whole.slice(0, whole.num_rows - 1)
            last = whole.slice(whole.num_rows - 1)
        if last is not None:
            yield last

    dealt = stripes.repartition("lang", "term").sortWithinPartitions("lang", "term")
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda n, c: n + c)
    return dealt.mapInArrow(run, STRIPE).withColumn("occurrences", total)


_SUMS = "lang string, a_block int, b_block int, a int, b int, value long, n_terms long"
# Tiles whose sums a task holds before it hands them on.
_TILES_HELD = 256


def _tile_value(part: pa.RecordBatch) -> np.ndarray:
    """The sums over the rows of one tile."""
    totals = [part.column(name)[0].values.to_numpy() for name in ("a_totals", "b_totals")]
    terms = part.column("terms").to_numpy()[0]
    value = np.zeros((len(totals[0]), len(totals[1])), dtype=np.int64)
    for first in range(0, part.num_rows, _TERMS_AT_ONCE):
        rows = part.slice(first, _TERMS_AT_ONCE)
        sides = []
        for name, total in zip(("a_side", "b_side"), totals):
            lists = rows.column(name)
            counts = np.zeros((rows.num_rows, len(total)), dtype=np.int64)
            cells = lists.flatten()
            at = np.repeat(np.arange(rows.num_rows), _lengths(lists)), cells.field("places").to_numpy()
            counts[at] = cells.field("counts").to_numpy()
            sides.append(shares(counts, total, terms))
        value += divergence(sides[0][:, :, None], sides[1][:, None, :]).sum(axis=0)
    return value


def _tile_sums(cells: DataFrame) -> DataFrame:
    """lang, a_block, b_block, a, b, value, n_terms: sums over the terms that a tile's sources have.

    ``cells`` has a row per tile and kept term with the places and counts of its sources, and of the
    tile the totals of its rows and columns and the kept terms of its language.
    """

    def sums(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, a_block, b_block), (value, n) in held.items():
            a, b = np.indices(value.shape, dtype=np.int32).reshape(2, -1)
            size = value.size
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * size, pa.string()), pa.array(np.full(size, a_block, dtype=np.int32)),
                    pa.array(np.full(size, b_block, dtype=np.int32)), pa.array(a), pa.array(b),
                    pa.array(value.reshape(-1)), pa.array(np.full(size, n, dtype=np.int64)),
                ],
                names=["lang", "a_block", "b_block", "a", "b", "value", "n_terms"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[np.ndarray, int]] = {}
        for batch in batches:
            coded = pc.dictionary_encode(batch.column("lang"))
            keys = [coded.indices.to_numpy()] + [batch.column(n).to_numpy() for n in ("a_block", "b_block")]
            order = np.lexsort(keys[::-1])
            new = np.ones(len(order), dtype=bool)
            new[1:] = False
            for key in keys:
                new[1:] |= key[order][1:] != key[order][:-1]
            cuts = np.append(np.flatnonzero(new), len(order)).tolist() if len(order) else []
            for first, last in zip(cuts, cuts[1:]):
                part = batch.take(pa.array(order[first:last]))
                tile = tuple(part.column(name)[0].as_py() for name in ("lang", "a_block", "b_block"))
                value, n = held.get(tile, (0, 0))
                held[tile] = (value + _tile_value(part), n + part.num_rows)
            if len(held) > _TILES_HELD:
                yield from sums(held)
                held = {}
        yield from sums(held)

    keys = ["lang", "a_block", "b_block", "a", "b"]
    return cells.mapInArrow(run, _SUMS).groupBy(*keys).agg(
        F.sum("value").alias("value"), F.sum("n_terms").alias("n_terms")
    )


def divergences(
    docs: DataFrame,
    least_docs: int = LEAST_DOCS,
    top_terms: int = 10,
    most_held: int = MOST_HELD,
    tile: int = TILE,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank within group and part."""

    def text(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    rows = docs.select(
        text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text")
    )
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    sources = stored(rows.select("lang", "source").distinct().withColumn("place", nth), "stripes-sources")
    placed = rows.join(sources, ["lang", "source"]).select("lang", "place", "text")
    spilled = stored(fold(placed, most_held), "stripes-spilled")
    kept = stored(
        merge(spilled).where(F.col("docs") >= least_docs).drop("docs"), "stripes-kept"
    )
    discard(spilled)
    of_lang = kept.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("occurrences").alias("lang_total")
    )
    flat = kept.select("lang", "term", "occurrences", F.explode(F.arrays_zip("places", "counts")).alias("cell")).select(
        "lang", "term", "occurrences", F.col("cell.places").alias("place"), F.col("cell.counts").alias("count")
    )
    of_group = flat.groupBy("lang", "place").agg(F.sum("count").alias("total"))
    groups = stored(
        sources.join(of_group, ["lang", "place"], "left").join(of_lang, "lang", "left")
        .na.fill(0, ["total", "terms", "lang_total"]),
        "stripes-groups",
    )
    return _pairs(kept, groups, tile).unionByName(_terms(flat.join(groups, ["lang", "place"]), top_terms))


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value").withColumn(
        "rank", F.row_number().over(order)
    )


def _pairs(kept: DataFrame, groups: DataFrame, tile: int) -> DataFrame:
    def block(place: Column) -> Column:
        return F.floor(place / tile).cast("int")

    blocks = groups.groupBy("lang", block(F.col("place")).alias("block")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "total"))), lambda c: c["total"]).alias("totals"),
        F.first("terms").alias("terms"),
    )
    a, b = (blocks.select("lang", F.col("block").alias(f"{s}_block"), F.col("totals").alias(f"{s}_totals"), "terms")
            for s in ("a", "b"))
    tiles = stored(a.join(b.drop("terms"), "lang").where("a_block <= b_block"), "stripes-tiles")

    def side(name: str) -> Column:
        """The cells of a stripe in a block, by their place there."""
        inside = F.filter(F.arrays_zip("places", "counts"), lambda c: block(c["places"]) == F.col(f"{name}_block"))
        return F.transform(
            inside, lambda c: F.struct((c["places"] % tile).alias("places"), c["counts"].alias("counts"))
        ).alias(f"{name}_side")

    # A stripe goes to the tiles of which it has a row or a column.
    own = F.array_distinct(F.transform("places", block))
    cells = (
        kept.select("lang", "places", "counts", own.alias("own")).join(tiles, "lang")
        .where(F.arrays_overlap("own", F.array("a_block", "b_block")))
        .select("lang", "a_block", "b_block", side("a"), side("b"), "a_totals", "b_totals", "terms")
    )
    sums = _tile_sums(cells).withColumns(
        {"a_place": F.col("a_block") * tile + F.col("a"), "b_place": F.col("b_block") * tile + F.col("b")}
    ).select("lang", "a_place", "b_place", "value", "n_terms")

    def named(prefix: str) -> DataFrame:
        return groups.select(
            "lang", "terms", *[F.col(n).alias(f"{prefix}_{n}") for n in ("source", "place", "total")]
        )

    both = named("a").join(named("b").drop("terms"), "lang").where("a_place < b_place")
    known = both.join(sums, ["lang", "a_place", "b_place"], "left")
    p, q = (_share_of_none(f"{side}_total") for side in ("a", "b"))
    absent = F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q}))")
    rest = F.col("terms") - F.coalesce("n_terms", F.lit(0))
    value = F.when(F.col("terms") == 0, F.lit(0)).otherwise(F.coalesce("value", F.lit(0)) + rest * absent)
    once = known.select("lang", "a_source", "b_source", value.cast("long").alias("value"))
    return _ranked(
        once.select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), "value").union(
            once.select("lang", "b_source", "a_source", "value")
        ),
        "pair",
    )


def _share_of_none(total: str) -> str:
    """The share of a kept term that a group does not have."""
    return f"1 + {2 * SCALE} div greatest({total} + 2 * terms, 1)"


def _terms(placed: DataFrame, top_terms: int) -> DataFrame:
    names = ("count", "total", "occurrences", "lang_total", "terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, total, occurrences, lang_total, terms = (batch.column(n).to_numpy() for n in names)
            p, q = shares(count, total, terms), shares(occurrences, lang_total, terms)
            more = p > q
            part = batch.filter(pa.array(more))
            yield pa.RecordBatch.from_arrays(
                [part.column("lang"), part.column("source"), part.column("term"),
                 pa.array(divergence(p[more], q[more]))],
                names=["lang", "source", "item", "value"],
            )

    found = placed.select("lang", "source", "term", *names).mapInArrow(
        run, "lang string, source string, item string, value long"
    )
    return _ranked(found, "term").where(F.col("rank") <= top_terms)
