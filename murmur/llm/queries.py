"""Registered queries of this subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from murmur.llm import (chat, decontam, hard_negatives, html_text, jaccard_join, langid, lm_score, multi_index, oracles, quality,
                        sentencepiece_fst, toxicity, warc, whitening)
from murmur.llm.common import remainder, sized_join, table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 3) != 1)
    lexicon = toxicity.fit(toxicity.labelled(docs, labels))
    return toxicity.score(docs, lexicon).select(
        F.col("key").alias("doc_id"), F.coalesce(remainder(F.col("key"), 3) == 1, F.lit(False)).alias("held_out"),
        "score", "predicted")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.join(docs).select(F.col("key").alias("doc_id"), "n_shingles", "component_id")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_fst.encode(docs).withColumnRenamed("key", "doc_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archive_and_read(table(spark, sf_dir, "pages"))
    page = lambda c: F.when(F.col(c) != "None", F.col(c)).cast("long")
    return records.select(page("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          page("refers_to").alias("refers_to"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = (table(spark, sf_dir, "labels").where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
            .withColumn("is_target", F.lit(True)))
    model = lm_score.fit(sized_join(docs, good, "doc_id", "left"))
    return lm_score.score(docs, model).withColumnRenamed("key", "doc_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(remainder(F.col("doc_id"), 4) != 2).select("text", "lang"))
    return langid.identify(docs.select("doc_id", "text"), model).select(
        F.col("key").alias("doc_id"), F.coalesce(remainder(F.col("key"), 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred", "score")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contamination(docs, table(spark, sf_dir, "benchmark")).select(
        F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat.digest(chat.windows(turns.unionByName(probe))).withColumnRenamed("conv", "conv_id")


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ``deviation`` outgrows a long at some ten million rows: null there, exact in ``deviation_exact``.
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("deviation", "deviation_exact").withColumn(
        "deviation", F.col("deviation_exact").try_cast("long"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_html_extraction": op1_html_extraction,
        "op2_toxicity": op2_toxicity,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_warc": op5_warc,
        "op6_quality_rules": op6_quality_rules,
        "op7_lm_score": op7_lm_score,
        "op8_language_id": op8_language_id,
        "op10_chat_format": op10_chat_format,
        "op9_benchmark_decontamination": op9_benchmark_decontamination,
        "op11_embedding_whitening": op11_embedding_whitening,
        "op12_nearest_neighbours": op12_nearest_neighbours,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return pipeline | {
        "op3_jaccard_join": oracles.JACCARD,
        "op5_warc": oracles.WARC,
        "op6_quality_rules": oracles.QUALITY,
        "op9_benchmark_decontamination": oracles.DECONTAMINATION,
        "op13_hard_negatives": oracles.HARD_NEGATIVES,
    }
