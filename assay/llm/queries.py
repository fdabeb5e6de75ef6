"""Registered queries: one per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .bpe import round_trip
from .common import table
from .lexical import build_index, search
from .lines import dedup_lines
from .mixing import mix
from .repeats import drop_repeats
from .secrets import RULES, scan_secrets, spans_text
from .simhash import near_duplicates
from .tokens import token_counts
from .topk import top_products
from .toxicity import THRESHOLD, held_out, score_docs
from .warc import archive_pages
from .whitening import whiten


def op1_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"))


def op2_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(table(spark, folder, "embeddings")).withColumn(
        "score", F.col("score").cast("bigint"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def token_digests(docs: DataFrame) -> DataFrame:
    """Per document the number and digests of its ids and of the bytes decoded from them."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip(docs, path, public_tokenizers.PATTERN).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"))


def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents").select("doc_id", "source"), rest=None).select(
        "doc_id", "source", "__mix.*")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_docs(table(spark, folder, "documents"), table(spark, folder, "labels")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    _, records = archive_pages(table(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type",
                          "refers_to")


def op8_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    spans = F.col("__spans")
    counts = [F.size(F.filter(spans["kind"], F.lit(i).__eq__)).cast("bigint")
              .alias(f"n_{r.kind}") for i, r in enumerate(RULES)]
    return scan_secrets(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", *counts, spans_text(spans).alias("spans")).withColumn(
        "base_sha256", F.sha2("spans", 256))


def op10_lines(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2("text", 256).alias("kept_sha256"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


def op12_lexical(spark: SparkSession, folder: str) -> DataFrame:
    return search(build_index(table(spark, folder, "documents")),
                  table(spark, folder, "benchmark"))


def op13_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


QUERIES = {
    "op1_nearest": op1_nearest, "op2_topk": op2_topk, "op3_simhash": op3_simhash,
    "op4_bpe": op4_bpe, "op5_mixing": op5_mixing, "op6_toxicity": op6_toxicity,
    "op7_warc": op7_warc, "op8_repeats": op8_repeats, "op9_secrets": op9_secrets,
    "op10_lines": op10_lines, "op11_whitening": op11_whitening,
    "op12_lexical": op12_lexical, "op13_tokens": op13_tokens,
}
