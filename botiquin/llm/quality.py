"""Quality classification by importance resampling with hashed n-gram models.

Words, runs of marks and pairs of neighbouring tokens are hashed into buckets. Two generative
models are counted over whole texts: raw from all documents, target from those labelled good
(quality 1, not toxic). The log importance weight of a document is the sum over its n-grams of
log(target / raw), divided by the square root of their number so that long and short documents
compare. Documents are then drawn without replacement by Gumbel top-k: the k largest sums of log
weight and a Gumbel variate are kept, the others are rejected.

The target model is smoothed towards the raw one: in a bucket where the target sample would hold
``expected`` n-grams under the raw model and holds ``seen``, the ratio is (seen + smooth) /
(expected + smooth), and buckets with less than ``least`` expected say nothing. Rare words, which
a sample cannot judge, so do not count against a document.

k follows from the data: half of the labelled documents, which the target model does not see, give
the weight that parts quality 1 from 0 with the fewest errors, and k is the number of all documents
that reach it. The Gumbel variate counts ``temperature`` times: as set here, 0.05, a document within a
tenth or two of the cut is kept or rejected by chance and one farther off almost surely by its weight,
as the draw is meant to part sound text from unsound and not to thin either. Ratios and weights are whole numbers in units of 2^-16 and the variate is a function
of the document and the seed, so the result does not depend on how rows are dealt out. Documents
that tie with the k-th are kept as well.

Toxic wording is a word or two in a text that is sound otherwise, which a sum over all n-grams
drowns. It has a ratio of its own: per bucket of words, the share of toxic-labelled documents that
have it against the share of the others labelled, from the same half. Words of fewer than
``least_toxic`` toxic documents say nothing. The toxicity of a document is the sum of its
``strongest`` different positive log ratios, so length does not dilute it. The other half gives the
toxicity that parts toxic from not toxic with the fewest errors; a document is kept if it passes
this and the draw.

Limits: the labelled sample is bounded by ``most_labelled`` rows and the models by two to the
power of ``bits`` buckets per n-gram length and of ``toxic_bits`` buckets of words; these are
documented parameters and the only bounds. All documents are counted, weighed and ranked.
Toxicity sees single words, no phrases of harmless ones.

Defined cases: null and empty texts have weight 0. Rows with the same id and text are treated
alike. Labels that are null, or of documents that are not there, are ignored; of contradicting
labels the worse counts. Without good and bad labels to compare, the draw keeps every document,
without toxic and other labels no document counts as toxic. Columns other than id and text are
passed through whatever their names. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from botiquin.llm.tables import slices, stored
from botiquin.llm.words import WORDS_AND_MARKS, joined, token_hashes

UNIT = 1 << 16


@dataclass(frozen=True)
class Settings:
    """What the models and the draw depend on."""

    bits: int = 17
    smooth: float = 2.0
    least: float = 8.0
    most_labelled: int = 50_000
    temperature: float = 0.05
    seed: int = 1
    toxic_bits: int = 20
    toxic_smooth: float = 1.0
    least_toxic: int = 2
    strongest: int = 2


def labelled_sample(labels: DataFrame, settings: Settings, id_col: str) -> DataFrame:
    """At most ``most_labelled`` documents with ``good`` and ``fit`` (model or threshold)."""
    judged = (
        labels.select(
            F.col(id_col).alias("id"), F.col("quality").alias("quality"), F.col("toxic").alias("toxic")
        )
        .where("id is not null and quality is not null and toxic is not null")
        .groupBy("id")
        .agg((F.min("quality") == 1).alias("good"), (F.max("toxic") == 0).alias("clean"))
    )
    drawn = judged.withColumn("draw", F.xxhash64("id", F.lit(settings.seed)))
    return drawn.orderBy("draw", "id").limit(settings.most_labelled).select(
        "id", "good", "clean", (F.pmod(F.xxhash64("id", F.lit("half")), F.lit(2)) == 0).alias("fit")
    )


def buckets(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Bucket numbers of single tokens and of pairs."""
    shift = np.uint64(64 - bits)
    single = (hashes >> shift).astype(np.int64)
    pairs = (joined(hashes, 2) >> shift).astype(np.int64) + (1 << bits)
    return [single, pairs]


def words_by_text(hashes: np.ndarray, cuts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts and the buckets of their different tokens, in order."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    both = np.unique((np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)) << bits) + bucket)
    return both >> bits, both & ((1 << bits) - 1)


def count_ngrams(docs: DataFrame, settings: Settings) -> DataFrame:
    """Counts per bucket over all documents and over those with ``target``; columns text, target."""
    bits = settings.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = np.zeros(2 << bits, dtype=np.int64)
        target = np.zeros(2 << bits, dtype=np.int64)
        for batch in slices(batches, "text", 2_000_000):
            hashes, cuts = token_hashes(batch.column("text"), WORDS_AND_MARKS)
            single, pairs = buckets(hashes, bits)
            wanted = pc.fill_null(batch.column("target"), False).to_numpy(zero_copy_only=False)
            inner = np.ones(len(pairs), dtype=bool)
            edge = cuts[1:-1] - 1
            inner[edge[(edge >= 0) & (edge < len(pairs))]] = False
            of_target = np.repeat(wanted, np.diff(cuts))
            for total, ones, twos in (
                (raw, single, pairs[inner]),
                (target, single[of_target], pairs[inner & of_target[: len(pairs)]]),
            ):
                total += np.bincount(ones, minlength=len(total))
                total += np.bincount(twos, minlength=len(total))
        seen = np.flatnonzero(raw)
        for first in range(0, len(seen), 100_000):
            part = seen[first : first + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(raw[part]), pa.array(target[part])],
                names=["bucket", "raw", "target"],
            )

    counted = docs.select("text", "target").mapInArrow(count, "bucket long, raw long, target long")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, settings: Settings) -> np.ndarray:
    """Whole log ratios per bucket; the buckets' number bounds what reaches the driver."""
    half = 1 << settings.bits
    kind = (F.col("bucket") >= half).alias("pairs")
    totals = {
        row["pairs"]: row
        for row in counts.groupBy(kind).agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toLocalIterator()
    }
    table = np.zeros(2 * half, dtype=np.int32)
    for pairs, total in totals.items():
        if not total["target"]:
            continue
        expected = F.col("raw") * (total["target"] / total["raw"])
        ratio = F.log((F.col("target") + settings.smooth) / (expected + settings.smooth))
        known = counts.where((kind == pairs) & (expected >= settings.least)).select(
            "bucket", F.round(ratio * UNIT).cast("int").alias("ratio")
        ).toPandas()
        table[known["bucket"].to_numpy()] = known["ratio"].to_numpy()
    return table


def count_toxic(docs: DataFrame, settings: Settings) -> DataFrame:
    """Toxic and other documents per bucket of words, by ``clean``; all documents in bucket -1."""
    bits = settings.toxic_bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, (1 << bits) + 1), dtype=np.int64)
        for batch in slices(batches, "text", 2_000_000):
            clean = batch.column("clean").to_numpy(zero_copy_only=False)
            texts, words = words_by_text(*token_hashes(batch.column("text"), WORDS_AND_MARKS), bits)
            for total, wanted in zip(totals, (~clean, clean)):
                total[1:] += np.bincount(words[wanted[texts]], minlength=1 << bits)
                total[0] += wanted.sum()
        seen = np.flatnonzero(totals.any(axis=0))
        for first in range(0, len(seen), 100_000):
            part = seen[first : first + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part - 1), pa.array(totals[0, part]), pa.array(totals[1, part])],
                names=["bucket", "toxic", "other"],
            )

    counted = docs.select("text", "clean").mapInArrow(count, "bucket long, toxic long, other long")
    return counted.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def toxic_ratios(counts: DataFrame, settings: Settings) -> np.ndarray:
    """Whole positive log ratios per bucket of words; the buckets' number bounds what reaches the driver."""
    table = np.zeros(1 << settings.toxic_bits, dtype=np.int32)
    total = counts.where("bucket = -1").first()
    if total is None or not total["toxic"] or not total["other"]:
        return table
    smooth = settings.toxic_smooth
    share = {kind: (F.col(kind) + smooth) / (total[kind] + 2 * smooth) for kind in ("toxic", "other")}
    known = counts.where((F.col("bucket") >= 0) & (F.col("toxic") >= settings.least_toxic)).select(
        "bucket", F.round(F.log(share["toxic"] / share["other"]) * UNIT).cast("int").alias("ratio")
    ).where("ratio > 0").toPandas()
    table[known["bucket"].to_numpy()] = known["ratio"].to_numpy()
    return table


def toxicities(hashes: np.ndarray, cuts: np.ndarray, ratios: np.ndarray, settings: Settings) -> np.ndarray:
    """Per text the sum of its ``strongest`` ratios of different words."""
    texts, words = words_by_text(hashes, cuts, settings.toxic_bits)
    found = ratios[words]
    texts, found = texts[found > 0], found[found > 0].astype(np.int64)
    order = np.lexsort((-found, texts))
    texts, found = texts[order], found[order]
    counted = np.arange(len(texts)) - np.searchsorted(texts, texts) < settings.strongest
    total = np.zeros(len(cuts) - 1, dtype=np.int64)
    np.add.at(total, texts[counted], found[counted])
    return total


def weigh(
    docs: DataFrame, table: np.ndarray, toxic: np.ndarray, settings: Settings, text_path: tuple[str, ...]
) -> DataFrame:
    """The rows with last columns ``_weight`` and ``_toxicity`` in units of 2^-16.

    The text is a column or, to send no text twice, a field of a struct column. The tables have two
    to the power of ``bits`` entries per n-gram length, 1 MB as set here, and of ``toxic_bits``
    entries, 4 MB.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast((table, toxic))
    added = [T.StructField(name, T.LongType()) for name in ("_weight", "_toxicity")]
    schema = T.StructType([*docs.schema.fields, *added])
    at, bits = docs.columns.index(text_path[0]), settings.bits
    fields = docs.schema[text_path[0]].dataType
    within = [fields.names.index(text_path[1])] if len(text_path) > 1 else []

    def texts(batch: pa.RecordBatch) -> pa.Array:
        column = batch.column(at)
        return pc.struct_field(column, within) if within else column

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios, toxic_words = broadcast.value
        for batch in slices(batches, texts, 2_000_000):
            hashes, cuts = token_hashes(texts(batch), WORDS_AND_MARKS)
            single, pairs = buckets(hashes, bits)
            of_single = np.concatenate([[0], np.cumsum(ratios[single], dtype=np.int64)])
            of_pairs = np.concatenate([[0], np.cumsum(ratios[pairs], dtype=np.int64)])
            first, last = cuts[:-1], cuts[1:]
            # Pairs that reach over the end of a text belong to none.
            most = np.minimum(np.maximum(last - 1, first), len(pairs))
            total = of_single[last] - of_single[first]
            total = total + of_pairs[most] - of_pairs[np.minimum(first, len(pairs))]
            weight = np.rint(total / np.sqrt(np.maximum(last - first, 1))).astype(np.int64)
            toxicity = toxicities(hashes, cuts, toxic_words, settings)
            arrays = [batch.column(i) for i in range(batch.num_columns)]
            names = [*batch.schema.names, "_weight", "_toxicity"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(weight), pa.array(toxicity)], names=names)

    return docs.mapInArrow(weights, schema)


def best_threshold(weights: np.ndarray, good: np.ndarray) -> int | None:
    """The weight from which on documents count as good with the fewest errors.

    Of equal choices the lowest. None where there is only one kind.
    """
    if not len(good) or good.all() or not good.any():
        return None
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    # errors when the first i are rejected: good ones among them and bad ones behind them
    errors = np.concatenate([[0], np.cumsum(good)]) + (~good).sum() - np.concatenate([[0], np.cumsum(~good)])
    allowed = np.concatenate([[True], weights[1:] != weights[:-1], [False]])
    return int(weights[int(np.argmin(np.where(allowed, errors, len(good) + 1)))])


def draw_key(id_col: str | Column, text_col: str | Column, settings: Settings) -> Column:
    """Weight plus a Gumbel variate that depends on the document alone, in units of 2^-16."""
    draw = F.xxhash64(id_col, F.xxhash64(text_col), F.lit(settings.seed))
    uniform = (F.pmod(draw, F.lit(1 << 52)) + 0.5) / float(1 << 52)
    variate = -F.log(-F.log(uniform)) * (settings.temperature * UNIT)
    return F.col("_weight") + F.round(variate).cast("long")


def kth_largest(keys: DataFrame, k: int) -> int | None:
    """The k-th largest value of column ``key``, by counts in bins of 2^16 and then by value.

    The driver gets at most 2^16 counts at a time, whatever the number of rows.
    """
    most = 1 << 15
    coarse = F.least(F.lit(most), F.greatest(F.lit(-most), F.shiftright("key", 16)))
    left = k
    for level in (coarse, F.col("key")):
        counts = keys.groupBy(level.alias("at")).count().orderBy(F.desc("at"))
        for row in counts.toLocalIterator():
            if row["count"] >= left:
                keys = keys.where(level == row["at"])
                found = row["at"]
                break
            left -= row["count"]
        else:
            return None
    return found


@dataclass(frozen=True)
class Classifier:
    """A fitted model and draw: the ratios, and the least key and most toxicity kept (None: all)."""

    ratios: np.ndarray
    cutoff: int | None
    settings: Settings
    toxic: np.ndarray
    most_toxic: int | None


def fit(
    docs: DataFrame,
    labels: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Classifier:
    """Count both models over the documents, weigh all of them and find the k that are kept."""
    sample = stored(labelled_sample(labels, settings, id_col), "quality-sample")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # The sample is bounded by most_labelled rows of 11 bytes.
    target = F.broadcast(sample.where("good and clean and fit").select("id", F.lit(True).alias("target")))
    counts = stored(
        count_ngrams(rows.join(target, "id", "left"), settings), "quality-counts"
    )
    ratios = log_ratios(counts, settings)
    judged = F.broadcast(sample.where("fit").select("id", "clean"))
    toxic = toxic_ratios(stored(count_toxic(rows.join(judged, "id"), settings), "toxic-counts"), settings)
    keys = stored(
        weigh(rows, ratios, toxic, settings, ("text",)).select(
            "id", "_weight", "_toxicity", draw_key("id", "text", settings).alias("key")
        ),
        "quality-keys",
    )
    held_out = keys.join(F.broadcast(sample.where("not fit")), "id").select(
        "id", "_weight", "_toxicity", "good", "clean"
    )
    # With repeated ids there may be more rows than labels; of those the first by the draw.
    seen = held_out.orderBy(F.xxhash64("id", F.lit(settings.seed)), "id", "_weight", "_toxicity").limit(
        settings.most_labelled
    ).toPandas()
    threshold = best_threshold(seen["_weight"].to_numpy(), seen["good"].to_numpy(dtype=bool))
    mildness = best_threshold(-seen["_toxicity"].to_numpy(), seen["clean"].to_numpy(dtype=bool))
    most_toxic = None if mildness is None else -mildness
    if threshold is None:
        return Classifier(ratios, None, settings, toxic, most_toxic)
    k = keys.where(F.col("_weight") >= threshold).count()
    cutoff = kth_largest(keys.select("key"), k) if k else None
    return Classifier(ratios, cutoff, settings, toxic, most_toxic)


def classify(
    docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows as a struct ``row`` with ``log_weight``, ``key``, ``toxicity`` and whether they are ``kept``."""
    rows = docs.select(F.struct("*").alias("row"))
    id_of, text_of = (F.col("row").getField(name) for name in (id_col, text_col))
    key = draw_key(id_of, text_of, model.settings)
    drawn = F.lit(True) if model.cutoff is None else key >= model.cutoff
    mild = F.lit(True) if model.most_toxic is None else F.col("_toxicity") <= model.most_toxic
    return weigh(rows, model.ratios, model.toxic, model.settings, ("row", text_col)).select(
        "row",
        (F.col("_weight") / UNIT).alias("log_weight"),
        (key / UNIT).alias("key"),
        (F.col("_toxicity") / UNIT).alias("toxicity"),
        (drawn & mild).alias("kept"),
    )
