"""The corpus pipeline: documents are identified, cleaned, deduplicated, decontaminated and encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veiledlake.llm import bpe, decontaminate, jaccard, language, lines
from veiledlake.llm.common import broadcast_if_small, settled, small_batches, small_reads, table

# Documents whose language is less sure than this are rejected.
MIN_SCORE = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or in no language that the labels know, go."""
    small_batches(spark)
    found = language.identify(docs).where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return found.select(docs.columns)


def cut_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go; the number of characters is counted again."""
    small_reads(spark)
    cut = lines.drop_site_lines(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id stays."""
    small_batches(spark)
    found = jaccard.jaccard_components(docs)
    return _without(docs, found.where("doc_id <> component_id").select("doc_id"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated").select("doc_id"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the digest of what they decode to."""
    small_batches(spark)
    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary, decoded="decoded")
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", cut_site_lines),
    ("jaccard_join", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("byte_bpe", encode_tokens),
]

# Language identification is learned, and SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = settled(docs)
    return docs


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents whose id is not listed; a document without an id is listed by the null."""
    ids = settled(ids.select(F.col("doc_id").alias("_gone")).distinct())
    return docs.join(broadcast_if_small(ids), F.col("doc_id").eqNullSafe(F.col("_gone")), "left_anti")
