"""A training-corpus pipeline over ``documents``: five stages, each stored as Parquet and read by the next.

Each stage function takes ``(spark, docs, sf_dir)``.  All but the last return rows
of ``docs`` with its columns; the last returns token ids.  Nulls, empty
tables, repeated rows and extra columns are handled as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from murmur.llm import decontam, jaccard_join, quality, sentencepiece_fst, toxicity
from murmur.llm.common import remainder, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic by a lexicon learnt from the labelled ones (ids with crc32 mod 3 = 1 held out)."""
    labels = table(spark, sf_dir, "labels")
    lexicon = toxicity.fit(toxicity.labelled(docs, labels.where(remainder(labels["doc_id"], 3) != 1)))
    return toxicity.toxicity_filter(docs, lexicon)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality cascade."""
    return quality.quality_filter(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more of their five-word shingles."""
    return jaccard_join.deduplicate(docs, threshold=80, k=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages of a twentieth of their words."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and round_trip of every document."""
    return sentencepiece_fst.encode(docs).withColumnRenamed("key", "doc_id")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("near copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", tokenize),
]

#: Learnt weights and token ids are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of the documents that all stages keep.

    Null and empty texts pass the toxicity stage and fall to the quality stage; of equal rows one stays; null ids are kept
    as they are; an empty table gives no rows; extra columns travel with their rows until the last stage.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
