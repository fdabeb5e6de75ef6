"""From raw documents to token ids: toxic documents go, repeated lines go, one of each group of near
copies stays, sources are interleaved to their target weights, and the texts are encoded."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.bpe import round_trip
from assay.llm.common import table
from assay.llm.lines import dedup_lines
from assay.llm.mixing import in_mixed_order
from assay.llm.simhash import one_per_group
from assay.llm.toxicity import keep_clean
from assay.session import new_folder

RANKS = "byte_bpe_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the lines that stay in it; ``n_chars`` counts them again."""
    kept = dedup_lines(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of linked fingerprints."""
    return one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the mixture's order from the first row of the first file on. Every source
    of the input is scheduled on its own."""
    return in_mixed_order(docs, rest=None)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers) of every document. ``part`` and ``row``,
    the file and row that held it, keep the mixture's order. The digest of the bytes decoded from
    the ids shows that nothing is lost."""
    place = F.struct("doc_id", F.col("_metadata.file_name").alias("part"),
                     F.col("_metadata.row_index").alias("row"))
    return round_trip(docs.select(place.alias("doc_id"), "text"), public_tokenizers.path(RANKS),
                      public_tokenizers.PATTERN).select(
        "doc_id.*", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies), ("mixing", mix_sources), ("bpe", tokenise),
]

# Neither a trained classifier nor token merges can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
