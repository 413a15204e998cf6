"""Keyword statistics over whole texts: term trends and TF-IDF hot keywords."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from murmur.functions import text as TX
from murmur.operators.neighbours import stored
from murmur.vocab import REFERENCE, Vocab

#: Terms whose scores give the least score of a day's best.
FIRST_TERMS = 100


def term_trend(posts: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    """Occurrences of each sensitive term per day (non-overlapping matches).

    The term list is a literal array exploded per row: the scan of each text
    happens inside one codegen stage and the (dt, term) partial sums shrink
    the data before the shuffle.
    """
    terms = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(TX.escape_term(t)).alias("pat"))
                      for t in vocab.sensitive_terms])
    x = posts.select("dt", "text", F.explode(terms).alias("t"))
    hits = F.regexp_count(F.col("text"), F.col("t.pat"))
    return (x.groupBy("dt", F.col("t.term").alias("term")).agg(F.sum(hits).alias("hits"))
            .orderBy("dt", "term"))


def keyword_trend(posts: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    """Day-over-day change of each sensitive term (``lag`` over days per term)."""
    t = term_trend(posts, vocab)
    w = Window.partitionBy("term").orderBy("dt")
    prev = F.lag("hits").over(w)
    return t.withColumn("prev_hits", prev).withColumn("change", F.col("hits") - F.col("prev_hits"))


def hot_keywords(posts: DataFrame, k: int = 10, min_len: int = 2, digits: int = 6, texts: DataFrame | None = None,
                 key: str = "doc_id") -> DataFrame:
    """Top-``k`` TF-IDF keywords per day, a day's posts being one document.

    tf = occurrences of the term that day; idf = ln((days + 1) / (days with
    term + 1)) + 1.  Tokens are exploded per row and counted with partial
    aggregation; the number of days is a scalar subquery.  Ties: term asc.

    With ``texts(key, text)`` the posts carry the key of their text instead: each text is tokenized once, and only terms
    that can be among the best of a day are counted by day (see :func:`_candidate_counts`).
    """
    if texts is None:
        toks = posts.select("dt", F.explode(TX.tokens(F.col("text"), min_len)).alias("term"))
        tf = toks.groupBy("dt", "term").agg(F.count(F.lit(1)).alias("tf"))
    else:
        tf = _candidate_counts(posts, texts, key, k, min_len)
    n_days = posts.select(F.count_distinct("dt")).scalar()
    # days containing the term: a window over the aggregated (dt, term) rows
    # (at most one row per day and term), so the tokens are exploded once
    df_ = F.count(F.lit(1)).over(Window.partitionBy("term"))
    idf = F.log((n_days + F.lit(1)) / (F.col("df") + F.lit(1))) + F.lit(1.0)
    scored = tf.withColumn("df", df_).withColumn("tfidf", F.col("tf") * idf)
    w = Window.partitionBy("dt").orderBy(F.desc("tfidf"), F.asc("term"))
    return (scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("dt", "rank", "term", "tf", "df", F.round("tfidf", digits).alias("tfidf")))


def _candidate_counts(posts: DataFrame, texts: DataFrame, key: str, k: int, min_len: int) -> DataFrame:
    """``dt, term, tf`` of all terms that can be among the ``k`` best of a day, whole for each of them.

    The ``k``-th score of a day is at least that among the ``FIRST_TERMS`` most frequent terms, and the score of a term at
    most its occurrences of all days times the largest idf; terms whose bound is below that of every day are left out.
    """
    days = posts.groupBy("dt", key).agg(F.count(F.lit(1)).alias("n"))
    words = stored(texts.select(key, TX.tokens(F.col("text"), min_len).alias("words")), "tokens")
    each = words.select(key, F.explode("words").alias("term"))
    carried = posts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    totals = stored(each.join(carried, key).groupBy("term").agg(F.sum("n").alias("total")), "totals")

    def by_day(terms: DataFrame) -> DataFrame:
        held = each.join(terms, "term").groupBy(key, "term").agg(F.count(F.lit(1)).alias("c"))
        return days.join(held, key).groupBy("dt", "term").agg(F.sum(F.col("n") * F.col("c")).alias("tf"))

    first = stored(totals.orderBy(F.desc("total"), "term").limit(FIRST_TERMS).select("term"), "first")
    n_days = posts.select(F.count_distinct("dt").alias("d")).first()["d"]
    low = Window.partitionBy("dt").orderBy(F.desc("least"))
    # a term's idf is at least that of a term of all days (null days count as one more)
    least = F.col("tf") * (math.log((n_days + 1) / (n_days + 2)) + 1)
    kth = by_day(first).withColumn("least", least).withColumn("r", F.row_number().over(low)).where(F.col("r") == k)
    found = posts.select(F.col("dt").alias("day")).distinct().join(kth, F.col("day").eqNullSafe(F.col("dt")), "left")
    floor = found.agg(F.min(F.coalesce("least", F.lit(0.0))).alias("floor")).first()["floor"] or 0.0
    most = math.log((n_days + 1) / 2) + 1
    return by_day(stored(totals.where(F.col("total") * most >= floor * (1 - 1e-9)).select("term"), "candidates"))


def sentiment_trend(scored: DataFrame, vocab: Vocab = REFERENCE, digits: int = 6) -> DataFrame:
    """Per day: average score and negative share, with change vs the previous day."""
    neg = F.when(F.col("label") == vocab.negative, 1).otherwise(0)
    d = scored.groupBy("dt").agg(
        F.round(F.avg(F.col("score").cast("decimal(38,18)")), digits).cast("double").alias("avg_score"),
        F.round(F.sum(neg) / F.count(F.lit(1)), digits).alias("negative_share"))
    w = Window.orderBy("dt")   # one row per day: a tiny frame, a single partition is fine
    return (d.withColumn("avg_score_change", F.round(F.col("avg_score") - F.lag("avg_score").over(w), digits))
             .withColumn("negative_share_change",
                         F.round(F.col("negative_share") - F.lag("negative_share").over(w), digits)))
