"""Registered queries of the operators over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm import bpe, context_mix, curriculum, eenns, exact_dedup, langid, oracles, quality, repair, rules, spelling, warc
from churnkit.llm.common import read, remainder
from churnkit.llm.grid_join import near_duplicates
from churnkit.llm.ngram_join import jaccard_components


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(read(spark, folder, "documents"))


def op2_grid_order_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "embeddings"))


def op3_quality_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, read(spark, folder, "labels"))
    return quality.judge(docs, model).drop("text")


def op4_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return context_mix.scores(read(spark, folder, "documents"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    learned = rules.train(docs, read(spark, folder, "labels"))
    return rules.judge(docs, learned).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op6_repair_shards(spark: SparkSession, folder: str) -> DataFrame:
    shards = repair.write_shards(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return repair.read_shards(shards)


def op7_curriculum_mix(spark: SparkSession, folder: str) -> DataFrame:
    return curriculum.taken(read(spark, folder, "documents"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = warc.write_archives(read(spark, folder, "pages"), least=0)
    return warc.read_archives(archives, blocks=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to")
    )


def op9_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_nearest_centroid(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = langid.train(docs.filter(~held_out).select("doc_id", "text", "lang"))
    return langid.predict(docs.select("doc_id", "text"), model).withColumn("held_out", held_out)


def op11_mean_variance_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return eenns.clusters(read(spark, folder, "embeddings"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(read(spark, folder, "documents")))


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.decisions(read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard,
        op2_grid_order_join,
        op3_quality_ordinal,
        op4_context_mixing,
        op5_quality_rules,
        op6_repair_shards,
        op7_curriculum_mix,
        op8_warc,
        op9_bpe_round_trip,
        op10_nearest_centroid,
        op11_mean_variance_clusters,
        op12_spelling_variants,
        op13_exact_dedup,
    )
}
ORACLES: dict[str, str] = oracles.SQL
