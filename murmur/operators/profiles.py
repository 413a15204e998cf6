"""User profiles: time habits, regions, identity and interaction.

Top-1 choices per user (most active period, most negative period, top hour,
top region) are ``min_by`` aggregates over a struct key that carries the
tie-breaker: no window sort, partial aggregation before the shuffle, and the
result does not depend on partitioning.  All per-user frames are keyed on
``user_id`` so the assembling left joins reuse one hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from murmur.functions.time import is_night
from murmur.operators.clean import explode_region
from murmur.operators.indicators import stamp
from murmur.vocab import REFERENCE, Vocab


def first_non_null(x: Column, order: Column) -> Column:
    """Deterministic ``first(x, ignoreNulls)``: x of the earliest row with x set."""
    return F.min_by(x, F.when(x.isNotNull(), order))


def _earliest() -> Column:
    return F.struct(F.col("created_at"), F.col("id"))


def known_users(scored: DataFrame) -> DataFrame:
    """A NULL user_id would form a group of its own and survive anti joins."""
    return scored.where(F.col("user_id").isNotNull())


def _interactions() -> Column:
    return (F.col("reposts_count").cast("long") + F.col("comments_count") + F.col("attitudes_count"))


# --- time habits ---------------------------------------------------------------

def exact_avg(c: Column, digits: int) -> Column:
    """Average over exact decimals, rounded HALF_UP: the same result whatever
    the partitioning or summation order (a double sum is order dependent and
    averages of 2-digit values often land exactly on a rounding half)."""
    return F.round(F.avg(c.cast("decimal(38,18)")), digits).cast("double")


def user_period_stats(scored: DataFrame, digits: int | None = None) -> DataFrame:
    avg = F.avg("score")
    return known_users(scored).groupBy("user_id", "time_period").agg(
        F.count(F.lit(1)).alias("period_post_cnt"),
        (avg if digits is None else F.round(avg, digits)).alias("period_avg_score"))


def user_period_pref(scored: DataFrame) -> DataFrame:
    """Most active, most negative (lowest avg, NULL first) and most positive
    (highest avg, NULL last) period per user; ties -> period name ascending."""
    s = user_period_stats(scored)
    tp, cnt, avg = F.col("time_period"), F.col("period_post_cnt"), F.col("period_avg_score")
    return s.groupBy("user_id").agg(
        F.min_by(tp, F.struct(-cnt, tp)).alias("prefer_time_period"),
        F.min_by(tp, F.struct(avg.isNotNull(), avg, tp)).alias("emo_time_period"),
        F.min_by(tp, F.struct(avg.isNull(), -avg, tp)).alias("high_time_period"))


def user_prefer_hour(scored: DataFrame) -> DataFrame:
    per = known_users(scored).groupBy("user_id", "hour").agg(F.count(F.lit(1)).alias("cnt"))
    return per.groupBy("user_id").agg(
        F.min_by(F.col("hour"), F.struct(-F.col("cnt"), F.col("hour"))).alias("prefer_hour"))


def user_time_stats(scored: DataFrame) -> DataFrame:
    night = F.when(is_night(F.col("hour")), 1).otherwise(0)
    return known_users(scored).groupBy("user_id").agg(
        F.round(F.stddev_samp("score"), 4).alias("hourly_sentiment_stddev"),
        first_non_null(F.col("screen_name"), _earliest()).alias("screen_name"),
        F.round(F.sum(night) / F.count(F.lit(1)), 4).alias("night_post_ratio"))


def user_time_profile(scored: DataFrame, run_ts: str | None = None) -> DataFrame:
    """:func:`user_time_stats`, :func:`user_period_pref` and :func:`user_prefer_hour` in one pass.

    The period is a function of the hour, so the posts are reduced once to
    (user, period, hour) rows with counts and power sums of the scores; the at most
    25 such rows of a user give the period, hour and user level.
    """
    name = F.when(F.col("screen_name").isNotNull(), F.struct("created_at", "id", "screen_name"))
    cell = (known_users(scored).groupBy("user_id", "time_period", "hour")
            .agg(F.count(F.lit(1)).alias("cnt"), F.count("score").alias("n"), F.sum("score").alias("s"),
                 F.sum(F.col("score") * F.col("score")).alias("s2"), F.min(name).alias("name"))
            .withColumn("by_hour", F.struct((-F.col("cnt")).alias("k"), "hour"))
            .withColumn("night", F.when(is_night(F.col("hour")), F.col("cnt")).otherwise(0)))
    period = (cell.groupBy("user_id", "time_period")
              .agg(*[F.sum(c).alias(c) for c in ("cnt", "n", "s", "s2", "night")], F.min("name").alias("name"), F.min("by_hour").alias("by_hour"))
              .withColumn("avg", F.col("s") / F.when(F.col("n") > 0, F.col("n"))))
    tp, avg, n, total = F.col("time_period"), F.col("avg"), F.sum("n"), F.sum("s")
    spread = F.sqrt(F.greatest(F.lit(0.0), F.sum("s2") - total * total / F.when(n > 0, n)) / F.when(n > 1, n - 1))
    out = period.groupBy("user_id").agg(
        F.coalesce(F.round(spread, 4), F.lit(0.0)).alias("hourly_sentiment_stddev"),
        F.min("name")["screen_name"].alias("screen_name"),
        F.round(F.sum("night") / F.sum("cnt"), 4).alias("night_post_ratio"),
        F.min_by(tp, F.struct(-F.col("cnt"), tp)).alias("prefer_time_period"),
        F.min_by(tp, F.struct(avg.isNotNull(), avg, tp)).alias("emo_time_period"),
        F.min_by(tp, F.struct(avg.isNull(), -avg, tp)).alias("high_time_period"),
        F.min("by_hour")["hour"].alias("prefer_hour"))
    return stamp(out, run_ts)


# --- regions ---------------------------------------------------------------------

def user_region_stats(scored: DataFrame) -> DataFrame:
    r = explode_region(known_users(scored), keep=["user_id", "score"])
    return r.groupBy("user_id", "region").agg(
        F.count(F.lit(1)).alias("region_focus_count"),
        F.round(F.avg("score"), 4).alias("top_region_avg_score"))


def user_region_profile(scored: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Top region (most posts, ties by name) and number of distinct regions.

    Both come from one aggregate over the (user, region) rows: the distinct
    count is the number of those rows, so no second distinct aggregate.
    """
    s = user_region_stats(scored)
    key = F.struct(-F.col("region_focus_count"), F.col("region"))
    best = F.min_by(F.struct("region", "region_focus_count", "top_region_avg_score"), key)
    out = s.groupBy("user_id").agg(best.alias("b"), F.count(F.lit(1)).alias("region_diversity_score"))
    out = out.select("user_id", F.col("b.region").alias("top_focus_region"),
                     F.col("b.region_focus_count").alias("region_focus_count"),
                     F.col("b.top_region_avg_score").alias("top_region_avg_score"),
                     "region_diversity_score")
    return stamp(out, run_ts)


def user_top_region(scored: DataFrame) -> DataFrame:
    return user_region_profile(scored).drop("region_diversity_score")


def region_diversity(scored: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct regions per user (exact; ``approx`` uses HyperLogLog++)."""
    r = explode_region(known_users(scored), keep=["user_id"])
    f = F.approx_count_distinct if approx else F.count_distinct
    return r.groupBy("user_id").agg(f("region").alias("region_diversity_score"))


# --- identity and interaction ---------------------------------------------------------

def user_auth_profile(scored: DataFrame, vocab: Vocab = REFERENCE, denominator: str = "all",
                      run_ts: str | None = None) -> DataFrame:
    """Interaction averages of positive / negative posts, confidence, leverage.

    ``denominator="all"`` divides by all of the user's posts, as the original
    does; ``"label"`` divides by the posts of that label (at least 1).
    """
    lab = F.col("label")
    inter = _interactions()

    def avg_of(name):
        num = F.sum(F.when(lab == name, inter).otherwise(0))
        den = (F.count(F.lit(1)) if denominator == "all"
               else F.greatest(F.sum(F.when(lab == name, 1).otherwise(0)), F.lit(1)))
        return F.round(num / den, 2)

    out = known_users(scored).groupBy("user_id").agg(
        first_non_null(F.col("user_authentication"), _earliest()).alias("user_authentication"),
        avg_of(vocab.positive).alias("pos_interaction_avg"),
        avg_of(vocab.negative).alias("neg_interaction_avg"),
        exact_avg(F.col("confidence"), 4).alias("avg_model_confidence"))
    pos = F.col("pos_interaction_avg")
    out = out.withColumn("sentiment_leverage", F.round(
        F.col("neg_interaction_avg") / F.when(pos == 0, F.lit(1)).otherwise(pos), 2))
    auth = F.col("user_authentication")
    out = out.withColumn("is_official", F.when(auth.isNotNull() & (auth == vocab.official_flag_value), 1)
                         .otherwise(0))
    return stamp(out, run_ts)


def sentiment_leverage(scored: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    """Negative vs positive interaction per post (nightly form, divisor >= 1)."""
    lab = F.col("label")
    inter = _interactions()

    def avg_of(name):
        num = F.sum(F.when(lab == name, inter).otherwise(0)).cast("double")
        den = F.greatest(F.sum(F.when(lab == name, 1).otherwise(0)).cast("double"), F.lit(1.0))
        return F.round(num / den, 2)

    out = known_users(scored).groupBy("user_id").agg(avg_of(vocab.negative).alias("neg_avg"),
                                                     avg_of(vocab.positive).alias("pos_avg"))
    pos = F.col("pos_avg")
    out = out.withColumn("sentiment_leverage", F.round(
        F.col("neg_avg") / F.when(pos == 0, F.lit(1.0)).otherwise(pos), 4))
    return out.select("user_id", "sentiment_leverage").na.fill(0.0, ["sentiment_leverage"])
