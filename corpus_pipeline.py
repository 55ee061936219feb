"""From raw documents to packed training sequences in five stages."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from botiquin.llm import decontamination, jaccard, line_dedup, packing, quality
from botiquin.llm.tables import intermediates, small_batches, table
from botiquin.session import work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(work: Stage) -> Stage:
    @wraps(work)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return work(spark, docs, sf_dir)

    return run


@_stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that importance resampling rejects."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs, model).where("kept").select("row.*")


@_stage
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut later occurrences of windows of three lines or sentences; drop texts of which nothing is left.

    ``n_chars`` is the length of the text that is left.
    """
    cleaned = line_dedup.remove_repeated_passages(docs)
    left = (F.col("n_removed") == 0) | F.col("text").rlike("\\S")
    return cleaned.where(left.isNull() | left).select(*_columns(docs, F.col("text")))


@_stage
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return jaccard.keep_one(docs, jaccard.Similarity(words=5, over=4, under=5))


@_stage
def cut_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the words that benchmark windows cover; drop texts of which no word is left by it."""
    cut = decontamination.remove_passages(docs, table(spark, sf_dir, "benchmark"))
    return cut.select(F.struct("*").alias("row"), "text").select(*_columns(docs, F.col("text")))


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences with their ids, for training."""
    return packing.pack_texts(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


def _columns(docs: DataFrame, text: Column) -> list[Column]:
    """The columns of the documents from the struct ``row``, with a new text and its length."""
    changed = {"text": text, "n_chars": F.coalesce(F.length(text).cast("long"), F.col("row.n_chars"))}
    return [changed.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns]


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", cut_benchmark_passages),
    ("packing", pack_sequences),
]

# The models of the first stage and the tokenizer of the last are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_dir(spark, f"pipeline-{name}")
        with intermediates():
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
