"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veiledlake.llm import (
    bpe,
    chat,
    collocations,
    decontaminate,
    fingerprints,
    jaccard,
    language,
    lines,
    pii,
    repeats,
    runs,
    secret_scan,
    site_trees,
)
from veiledlake.llm.common import SPACE_WORDS, table
from veiledlake.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    counts = [_count("base", kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_span_text("base"), 256).alias("base_sha256"), _span_text("spans").alias("spans")
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op5_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = chat.perspectives(table(spark, sf_dir, "conversations"))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return views.withColumn("spans", F.array_join(spans, ","))


def op6_site_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = site_trees.extract(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.fit(docs))
    found = found.withColumn("base", F.filter("secrets", lambda s: s["kind"] != "secret"))
    counts = [_count("base", kind).alias(f"n_{kind}") for kind in secret_scan.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_span_text("base"), 256).alias("base_sha256"), _span_text("secrets").alias("spans")
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = bpe.encode(docs.select("doc_id", "text"), vocabulary, packed="packed", decoded="decoded")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fingerprints.compare_with_next(docs, fingerprints.rarity_of(docs))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = lines.drop_site_lines(table(spark, sf_dir, "documents"))
    return docs.select("doc_id", "source", "text", "n_lines", "n_dropped")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.drop_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", planted_runs("doc_id", "text").alias("text"))
    found = runs.find_runs(docs).withColumn("best", runs.longest_run("runs"))
    best, lines = F.col("best"), F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def planted_runs(doc_id: str, text: str) -> Column:
    """The text, or for one document in ten (by a checksum of its id) its words with a stretch that repeats."""
    words, h = F.regexp_extract_all(F.col(text), F.lit(SPACE_WORDS), F.lit(0)), F.crc32(F.col(doc_id).cast("string"))

    def repeated(ws: Column) -> Column:
        n, g = F.size(ws), F.floor(h / 10)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        return F.array_join(
            F.transform(ws, lambda w, i: F.when(i < a, w).otherwise(F.get(ws, a + F.pmod(i - a, p)))), " "
        )

    planted = F.get(F.transform(F.array(words), lambda ws: F.when(F.size(ws) > 0, repeated(ws))), F.lit(0))
    return F.when(F.pmod(h, F.lit(10)) == 0, planted).otherwise(F.col(text))


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _span_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_language_id,
        op3_personal_data,
        op4_jaccard_join,
        op5_chat_perspectives,
        op6_site_trees,
        op7_secrets,
        op8_byte_bpe,
        op9_fingerprints,
        op10_line_dedup,
        op11_collocations,
        op12_substring_dedup,
        op13_periodic_runs,
    )
}
