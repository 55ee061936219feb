"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botiquin.llm import (
    ball_codes,
    decontamination,
    hilbert,
    jaccard,
    line_dedup,
    packing,
    polytope,
    quality,
    relative_lz,
    secrets,
    stripes,
    token_store,
    url_rules,
)
from botiquin.llm.tables import small_batches, table
from botiquin.session import work_dir

TOKENIZER = "word_bpe_49k.json"

URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.classify(docs.select("doc_id", "text"), model).select(
        "row.doc_id", "log_weight", "key", "kept"
    )


def token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    token_store.write_tokens(docs, path, public_tokenizers.path(TOKENIZER), end_id=1)
    return token_store.checksums(token_store.read_tokens(spark, path))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    alike = jaccard.Similarity(words=4, over=85, under=100)
    return jaccard.classes(table(spark, sf_dir, "documents"), alike).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id"
    )


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_texts(docs, public_tokenizers.path(TOKENIZER), packing.Limits())


def secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "word", "part", F.sha2("value", 256).alias("value_sha256"),
        "probability", "is_secret",
    )


def url_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "mined_confidence")


def hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    dimensions = [F.col("source"), F.col("lang"), hilbert.size_level(F.col("n_chars"))]
    return hilbert.hilbert_shards(rows, dimensions, ["doc_id", "text_crc32", "size"]).select(
        "row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


def polytope_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polytope.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(docs).select(
        "row.doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256")
    )


def relative_lz_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return relative_lz.remove_repeats(docs).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def ball_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = ball_codes.codes(table(spark, sf_dir, "embeddings"))
    return coded.select(
        F.col("id").alias("vec_id"), "code", "error", "label_error",
        F.lit(ball_codes.digest(books)).alias("codebooks_sha256"),
    )


def source_stripes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stripes.divergences(table(spark, sf_dir, "documents"))


def _bounded(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


_OPERATORS = {
    "op1_quality_classifier": quality_classifier,
    "op2_token_binary": token_binary,
    "op3_ngram_jaccard_join": ngram_jaccard_join,
    "op4_benchmark_decontamination": benchmark_decontamination,
    "op5_secret_forest": secret_forest,
    "op6_vector_packing": vector_packing,
    "op7_url_association_rules": url_association_rules,
    "op8_hilbert_sharding": hilbert_sharding,
    "op9_polytope_search": polytope_search,
    "op10_line_windows": line_windows,
    "op11_relative_lz": relative_lz_repeats,
    "op12_ball_codes": ball_tree_codes,
    "op13_source_stripes": source_stripes,
}

QUERIES = {name: _bounded(query) for name, query in _OPERATORS.items()}
