"""Rule features and tokens for the spam model (all native column expressions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from murmur.functions import text as TX
from murmur.vocab import REFERENCE, Vocab

RULE_FEATURES = ("text_length", "spam_keyword_count", "promotion_count", "is_viral", "engagement_score",
                 "spam_density", "promotion_density", "engagement", "engagement_ratio")


#: The features that depend on the text alone.
TEXT_FEATURES = ("text_length", "spam_keyword_count", "promotion_count")


def text_features(df: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    t = F.col("text")
    return df.withColumns({
        "text_length": F.length(t),
        "spam_keyword_count": TX.split_count(t, vocab.spam_terms),
        "promotion_count": TX.removed_length(t, vocab.promo_terms, vocab.promo_divisor),
    })


def counter_features(df: DataFrame) -> DataFrame:
    """The other features, from the counters and the text features.  Counters are summed as long (no overflow under ANSI)."""
    n = F.col("text_length")
    eng = (F.col("reposts_count").cast("long") + F.col("comments_count") + F.col("attitudes_count"))
    return df.withColumns({
        "engagement": eng,
        "engagement_ratio": eng / (n + 1),
        "is_viral": F.when(F.col("reposts_count") > 1000, 1).otherwise(0),
        "engagement_score": eng,
        "spam_density": F.col("spam_keyword_count") / (n + 1),
        "promotion_density": F.col("promotion_count") / (n + 1),
    })


def rule_features(df: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    """Nine rule features."""
    return counter_features(text_features(df, vocab))


def tokenize(df: DataFrame, col: str = "text", out: str = "words", min_len: int = 2,
             dictionary: DataFrame | None = None) -> DataFrame:
    """Token list per row: letter/digit runs plus Han character bigrams (with a
    ``dictionary``, the words of the Han runs instead), tokens shorter than
    ``min_len`` dropped; NULL or blank text -> []."""
    if dictionary is not None:
        from murmur.operators.segment import segmented_tokens
        return segmented_tokens(df, dictionary, col, out, min_len)
    return df.withColumn(out, TX.tokens(F.col(col), min_len))
