"""Joining texts whose sets of word shingles have a Jaccard similarity of at least a threshold.

Candidates come from token-combination prefixes. Shingles are ordered from rare to frequent. Of a
set of n shingles a linked set misses at most e = n - ceil(threshold * n), so it shares more than
nothing with any prefix that can lose e shingles and still keep a signature. Rare shingles are
signatures alone; frequent ones are dealt into classes by their hash, and pairs of one class in the
prefix are signatures. As one shingle of each class makes no pair, the prefix is extended by one
shingle per class that occurs in it. Two sets that share a signature are verified on whole sets.

Shingles with a single owner match nothing, so they only count as misses, and a pair is looked at
only if what is left can reach the threshold. Larger sets use more classes, in steps of size; a set
near a step has the signatures of both.

For components, each signature first pairs its members with one hub alone; only signatures whose
members are then in different components pair these across, in blocks, and only pairs come out that
a bit outline of both sets cannot rule out. So a group of copies costs its size, a group of sets
that are nearly but not quite similar enough costs comparisons of outlines and no rows, and no link
between components is lost. ``join`` gives all pairs of different sets.

Work on whole sets is confined to texts that can have a partner: a quarter of all shingles, chosen
by hash, is counted first, and a text goes on only if that quarter misses no more than e. Equal
sets are one row from then on.

Defined cases: a text with fewer words than a shingle has its whole sequence as its one shingle;
null texts and texts without words have an empty set and are linked with nothing. Rows without id
take part; they only lend their class an id if no other row has one. Rows with the same id or
repeated rows are linked by their texts. An empty table gives an empty result. Only id and text are
read, so other columns may have any name. Sets count as equal and shingles as shared by 64-bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botiquin.llm.components import components
from botiquin.llm.tables import slices, stored
from botiquin.llm.words import mixed, shingle_sets

# Shingles in at most so many sets are signatures alone.
RARE = 8
# Sets up to the first size have one class of frequent shingles; each step has four times the last.
FIRST_STEP = 128
CLASSES = 64
# Rows of a table of ids and hashes, 16 bytes each, up to which it is sent to all tasks.
MOST_SENT = 500_000
# Members of a signature that meet in one task at a time.
BLOCK = 4096
# Powers of two between which the bits of a set's outline lie.
LEAST_BITS, MOST_BITS = 9, 13

# Smallest signatures of a set that go with each, to tell whether two sets met before.
FIRSTS = 8

_DEALT = ["sig", "low", "high", "second", "key", "n", "m", "component", "outline", "firsts"]


@dataclass(frozen=True)
class Similarity:
    """Words of a shingle, and the least similarity as a fraction above one half."""

    words: int = 5
    over: int = 4
    under: int = 5

    def __post_init__(self) -> None:
        if not self.under < 2 * self.over <= 2 * self.under:
            raise ValueError("the threshold lies above 1/2 and up to 1")

    def least(self, n: Column) -> Column:
        """Shingles of n that a linked set shares at least."""
        return ((n * self.over + (self.under - 1)) / self.under).cast("long")

    def reached(self, shared: Column, n_a: Column, n_b: Column) -> Column:
        return shared * (self.over + self.under) >= (n_a + n_b) * self.over


def _set_key(shingles: np.ndarray) -> np.ndarray:
    total = np.array([mixed(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))])
    return mixed(total).view(np.int64)[0]


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    )


def _quarter(shingles: np.ndarray) -> np.ndarray:
    return shingles[: np.searchsorted(shingles, 1 << 62)]


def shingle_keys(docs: DataFrame, alike: Similarity, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, text_hash, n, size of the quarter of its shingles, and key of the set."""
    rows = _texts(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2_000_000):
            sets = list(shingle_sets(batch.column("text"), alike.words))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([len(_quarter(s)) for s in sets], pa.int64()),
                    pa.array([int(_set_key(s)) for s in sets], pa.int64()),
                ],
                names=["id", "text_hash", "n", "size", "key"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, text_hash long, n long, size long, key long")


def quarters(docs: DataFrame, alike: Similarity, text_col: str) -> DataFrame:
    """A quarter of the shingles of sets with several, chosen by hash: key, shingle.

    A set that the task has just shown is not shown again, so copies add little.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown: set[int] = set()
        for batch in slices(batches, "text", 2_000_000):
            keys, parts = [], []
            for shingles in shingle_sets(batch.column("text"), alike.words):
                key = int(_set_key(shingles))
                if len(shingles) > 1 and key not in shown:
                    if len(shown) > 200_000:
                        shown.clear()
                    shown.add(key)
                    part = _quarter(shingles)
                    keys.append(np.full(len(part), key, dtype=np.int64))
                    parts.append(part.view(np.int64))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(np.concatenate(parts))],
                    names=["key", "shingle"],
                )

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "key long, shingle long")


def promising(keys: DataFrame, seen: DataFrame, alike: Similarity) -> DataFrame:
    """Distinct sets that can have a partner: key, n, and the row that holds the text."""
    sets = keys.where("n > 1").groupBy("key").agg(
        F.max("n").alias("n"), F.max("size").alias("size"), F.min(F.struct("id", "text_hash")).alias("row")
    )
    # In two different sets: the least and the greatest owner differ, whatever the copies of each.
    shared = seen.groupBy("shingle").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b")
    hits = (
        seen.join(shared.select("shingle"), "shingle").repartition("key")
        .select("key", "shingle").distinct().groupBy("key").agg(F.count("*").alias("hits"))
    )
    misses = F.col("size") - F.coalesce("hits", F.lit(0))
    return sets.join(hits, "key", "left").where(misses <= F.col("n") - alike.least(F.col("n"))).select(
        "key", "n", "row"
    )


def _sent_if_small(table: DataFrame) -> DataFrame:
    """The table, to be sent to all tasks if its counted rows are few, else to be shuffled."""
    return F.broadcast(table) if table.count() <= MOST_SENT else table


def whole_sets(
    docs: DataFrame, wanted: DataFrame, alike: Similarity, id_col: str, text_col: str
) -> DataFrame:
    """key, n and all shingles of the wanted sets, from one text each."""
    rows = _texts(docs, id_col, text_col)
    wanted = wanted.select(F.col("row.id").alias("wid"), F.col("row.text_hash").alias("whash"))
    same = rows["id"].eqNullSafe(wanted["wid"]) & (rows["text_hash"] == wanted["whash"])
    texts = rows.join(_sent_if_small(wanted), same, "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2_000_000):
            sets = list(shingle_sets(batch.column("text"), alike.words))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(_set_key(s)) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["key", "n", "shingles"],
            )

    return texts.mapInArrow(run, "key long, n long, shingles array<long>").dropDuplicates(["key"])


def ranked(sets: DataFrame, alike: Similarity) -> DataFrame:
    """key, n and the shingles with several owners from rare to frequent, where enough have."""
    owned = sets.select("key", "n", F.explode("shingles").alias("shingle"))
    owners = owned.groupBy("shingle").agg(F.count("*").alias("owners")).where("owners > 1")
    shared = owned.join(owners, "shingle").groupBy("key", "n").agg(
        F.sort_array(F.collect_list(F.struct("owners", "shingle"))).alias("shared")
    )
    return shared.where(F.size("shared") >= alike.least(F.col("n"))).select(
        "key", "n", F.col("shared.owners").alias("owners"), F.col("shared.shingle").alias("shingles")
    )


def _step(n: int) -> int:
    """Number of the size step: 0 up to FIRST_STEP, each next up to four times the last."""
    step, bound = 0, FIRST_STEP
    while n > bound:
        step, bound = step + 1, bound * 4
    return step


def prefix_signatures(
    n: int, least: int, owners: np.ndarray, shingles: np.ndarray, step: int
) -> np.ndarray:
    """Signatures of one set for pairs whose smaller set is of the given step."""
    classes = 1 if step == 0 else CLASSES * 4 ** (step - 1)
    alone = owners <= RARE
    group = np.where(alone, -1, (shingles % np.uint64(classes)).astype(np.int64))
    _, first = np.unique(group, return_index=True)
    opens = np.zeros(len(group), dtype=bool)
    opens[first] = True
    gains = np.cumsum(alone | ~opens)
    # Misses that are sure, as these shingles have no other owner, need no signature.
    needed = n - least + 1 - (n - len(shingles))
    end = int(np.searchsorted(gains, needed)) + 1
    alone, group, shingles = alone[:end], group[:end], shingles[:end]
    tag = np.uint64(2 * step + 1)
    found = [mixed(shingles[alone] ^ mixed(np.array([tag]))[0])]
    order = np.argsort(group[~alone], kind="stable")
    frequent, group = shingles[~alone][order], group[~alone][order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(group)]])
    for a, b in zip(cuts, cuts[1:]):
        if b - a > 1:
            i, j = np.triu_indices(b - a, 1)
            members = frequent[a:b]
            found.append(mixed(mixed(members[i] + tag) * np.uint64(3) + mixed(members[j] + tag)))
    return np.concatenate(found).view(np.int64)


def signatures(sets: DataFrame, alike: Similarity) -> DataFrame:
    """sig, key, n, m (shingles with several owners) and the set's smallest signatures, from the
    ranked sets."""
    wide = sets.withColumn("least", alike.least(F.col("n")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key, n, least = (batch.column(c)[row].as_py() for c in ("key", "n", "least"))
                owners, shingles = (
                    batch.column(c)[row].values.to_numpy(zero_copy_only=False)
                    for c in ("owners", "shingles")
                )
                shingles = shingles.view(np.uint64)
                steps = sorted({_step(n), _step(least)})
                sigs = np.unique(
                    np.concatenate([prefix_signatures(n, least, owners, shingles, s) for s in steps])
                )
                for first in range(0, len(sigs), 100_000):
                    part = sigs[first : first + 100_000]
                    same = [np.full(len(part), x, dtype=np.int64) for x in (key, n, len(shingles))]
                    firsts = pa.array([sigs[:FIRSTS]] * len(part), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part), *map(pa.array, same), firsts],
                        names=["sig", "key", "n", "m", "firsts"],
                    )

    return wide.select("key", "n", "owners", "shingles", "least").mapInArrow(
        run, "sig long, key long, n long, m long, firsts array<long>"
    )


def _possible(alike: Similarity, a: str, b: str) -> Column:
    """What both sets share with any other can reach the threshold."""
    most = F.least(F.col(f"{a}.m"), F.col(f"{b}.m"))
    return alike.reached(most, F.col(f"{a}.n"), F.col(f"{b}.n"))


def hub_pairs(sigs: DataFrame, alike: Similarity) -> DataFrame:
    """Each signature's members paired with the one that has the fewest shingles of its own.

    A quarter of the signatures is enough for this step: linked sets share many, and what it does
    not join is left to the pairs across components, which look at every signature.
    """
    sigs = sigs.where(F.pmod(F.xxhash64("sig"), F.lit(4)) == 0)
    hub = F.struct(((F.col("n") - F.col("m")) / F.col("n")).alias("own"), "key", "n", "m")
    hubs = sigs.groupBy("sig").agg(F.min(hub).alias("hub"), F.count("*").alias("size"))
    met = sigs.alias("x").join(hubs.where("size > 1"), "sig").where(
        (F.col("x.key") != F.col("hub.key")) & _possible(alike, "x", "hub")
    )
    return met.select(
        F.least("x.key", "hub.key").alias("a"), F.greatest("x.key", "hub.key").alias("b")
    ).distinct()


def outlines(sets: DataFrame) -> DataFrame:
    """key and ``outline``: which of about 4 n places the set's shingles hash to, as bits.

    A place that one set fills and another does not is a shingle that the other lacks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, found = batch.column("shingles"), []
            for row in range(batch.num_rows):
                shingles = lists[row].values.to_numpy(zero_copy_only=False).view(np.uint64)
                size = 1 << min(max((4 * len(shingles) - 1).bit_length(), LEAST_BITS), MOST_BITS)
                filled = np.zeros(size, dtype=bool)
                filled[shingles & np.uint64(size - 1)] = True
                found.append(np.packbits(filled, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(found, pa.binary())], names=["key", "outline"]
            )

    return sets.select("key", "shingles").mapInArrow(run, "key long, outline binary")


def _folded(outlines_: list[bytes]) -> np.ndarray:
    """Outlines as rows of words, all as short as the shortest: halves laid over each other."""
    least = min(map(len, outlines_))
    rows = []
    for outline in outlines_:
        words = np.frombuffer(outline, dtype=np.uint64).reshape(-1, least // 8)
        rows.append(np.bitwise_or.reduce(words, axis=0))
    return np.stack(rows)


def block_pairs(group: dict[str, list], alike: Similarity) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one block, or of two, whose components differ and whose outlines allow a link.

    A pair that shares a smaller signature comes out there, so it is left out here where the first
    signatures of both sets show one.
    """
    n, m, component, key = (np.array(group[c], dtype=np.int64) for c in ("n", "m", "component", "key"))
    if (component == component[0]).all():
        return
    second, here = np.array(group["second"], dtype=bool), group["sig"][0]
    places = _folded(group["outline"])
    two = second.any()
    for i in np.flatnonzero(~second).tolist():
        rest = second.copy() if two else np.arange(len(n)) > i
        rest &= component != component[i]
        rest &= np.minimum(m, m[i]) * (alike.over + alike.under) >= (n + n[i]) * alike.over
        j = np.flatnonzero(rest)
        if not len(j):
            continue
        lacks = np.bitwise_count(places[i] & ~places[j]).sum(axis=1, dtype=np.int64)
        extra = np.bitwise_count(places[j] & ~places[i]).sum(axis=1, dtype=np.int64)
        most = np.minimum(n[i] - lacks, n[j] - extra)
        j = j[most * (alike.over + alike.under) >= (n[j] + n[i]) * alike.over]
        before = {sig for sig in group["firsts"][i] if sig < here}
        j = np.array([k for k in j.tolist() if before.isdisjoint(group["firsts"][k])], dtype=np.int64)
        if len(j):
            yield np.minimum(key[j], key[i]), np.maximum(key[j], key[i])


def cross_pairs(
    sigs: DataFrame, sets: DataFrame, alike: Similarity, labels: DataFrame | None
) -> DataFrame:
    """Pairs that share a signature and may link; with labels, only those of different components.

    The members of a signature are dealt into blocks, every two blocks meet in one place, and only
    pairs that the outlines cannot rule out come out.
    """
    labelled = sigs.withColumn("component", F.col("key"))
    if labels is not None:
        labelled = sigs.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn(
            "component", F.coalesce("component", "key")
        )
    open_ones = labelled.groupBy("sig").agg(
        F.min("component").alias("least"), F.max("component").alias("most"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"),
    ).where("least <> most").select("sig", "blocks")
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = (
        labelled.join(open_ones, "sig").join(outlines(sets), "key")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "sig", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            (F.col("own") > F.col("other")).alias("second"), "key", "n", "m", "component", "outline",
            "firsts",
        )
    )
    together = dealt.repartition("sig", "low", "high").sortWithinPartitions("sig", "low", "high")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in _DEALT)))
        for _, members in groupby(rows, key=lambda row: row[:3]):
            group = dict(zip(_DEALT, map(list, zip(*members))))
            for a, b in block_pairs(group, alike):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return together.select(*_DEALT).mapInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, alike: Similarity) -> DataFrame:
    """The pairs that reach the threshold on whole sets: a, b, shared, n_a, n_b."""
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("of_b"))
    shared = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", shared.alias("shared"), "n_a", "n_b")
        .where(alike.reached(F.col("shared"), F.col("n_a"), F.col("n_b")))
    )


@dataclass(frozen=True)
class Prepared:
    """Keys of all rows, whole sets of the promising ones, and their signatures."""

    keys: DataFrame
    sets: DataFrame
    sigs: DataFrame


def prepare(
    docs: DataFrame, alike: Similarity, id_col: str = "doc_id", text_col: str = "text"
) -> Prepared:
    keys = stored(shingle_keys(docs, alike, id_col, text_col), "jaccard-keys")
    wanted = stored(promising(keys, quarters(docs, alike, text_col), alike), "jaccard-promising")
    sets = stored(whole_sets(docs, wanted, alike, id_col, text_col), "jaccard-sets")
    sigs = stored(signatures(ranked(sets, alike), alike), "jaccard-signatures")
    return Prepared(keys, sets, sigs)


def join(
    docs: DataFrame, alike: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """All linked pairs of different sets (a, b, shared, n_a, n_b), and the rows of each set."""
    ready = prepare(docs, alike, id_col, text_col)
    links = verified(cross_pairs(ready.sigs, ready.sets, alike, None), ready.sets, alike)
    return links, ready.keys.select("id", "text_hash", "n", "key")


def classes(
    docs: DataFrame, alike: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: id, text_hash, n and the class ``key`` and ``component_id`` it belongs to.

    ``component_id`` is the smallest id that can be reached by links.
    """
    ready = prepare(docs, alike, id_col, text_col)
    pairs = stored(hub_pairs(ready.sigs, alike), "jaccard-hub-pairs")
    links = stored(verified(pairs, ready.sets, alike).select("a", "b"), "jaccard-hub-links")
    across = cross_pairs(ready.sigs, ready.sets, alike, components(links))
    across = across.join(pairs, ["a", "b"], "left_anti")
    more = verified(across, ready.sets, alike).select("a", "b")
    labels = components(links.union(more)).withColumnRenamed("node", "key")
    found = ready.keys.where("n > 0").groupBy("key").agg(F.min("id").alias("least"))
    group = F.coalesce("component", "key")
    found = found.join(labels, "key", "left").select("key", "least", group.alias("component"))
    smallest = found.groupBy("component").agg(F.min("least").alias("component_id"))
    named = found.join(smallest, "component").select("key", "component", "component_id")
    rows = ready.keys.select("id", "text_hash", "n", "key")
    full = rows.where("n > 0").join(named, "key").select("id", "text_hash", "n", "component", "component_id")
    empty = rows.where("n = 0").select(
        "id", "text_hash", "n", F.lit(None).cast("long").alias("component"), F.col("id").alias("component_id")
    )
    return full.union(empty)


def keep_one(
    docs: DataFrame, alike: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The row with the smallest id of every class (then of the smallest text hash), whole.

    Rows with an empty set are in no class and all stay. Of repeated rows of the kept text one stays.
    """
    found = stored(classes(docs, alike, id_col, text_col), "jaccard-classes")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    full = found.where("n > 0")
    chosen = full.groupBy("component").agg(F.min(place).alias("first"))
    others = full.select("component", "id", "text_hash", place.alias("place")).join(chosen, "component")
    removed = stored(
        others.where(~F.col("place").eqNullSafe(F.col("first")))
        .select(F.col("id").alias("rid"), F.col("text_hash").alias("rhash")).distinct(),
        "jaccard-removed",
    )
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash")
    )
    same = rows["id"].eqNullSafe(removed["rid"]) & (rows["text_hash"] == removed["rhash"])
    kept = rows.join(_sent_if_small(removed), same, "left_anti")
    repeated = full.groupBy("id", "text_hash").count().where("count > 1")
    if not repeated.isEmpty():
        empty = stored(found.where("n = 0").select("id", "text_hash").distinct(), "jaccard-empty")
        blank = rows["id"].eqNullSafe(empty["id"]) & (rows["text_hash"] == empty["text_hash"])
        whole = kept.join(empty, blank, "left_anti").dropDuplicates(["id", "text_hash"])
        kept = whole.union(rows.join(empty, blank, "left_semi"))
    return kept.select("row.*")
