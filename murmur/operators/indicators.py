"""Volume, sentiment, region and interaction statistics.

All are hash aggregates (partial aggregation before the shuffle, so a hot
group costs one partial row per map task).  Outputs are tiny; sorts on them
are for presentation only.  ``run_ts`` adds the batch stamp column the
serving tables carry; it is an argument, never the wall clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from murmur.functions.time import readme_period_of_hour
from murmur.operators.clean import explode_region, nonempty
from murmur.vocab import REFERENCE, Vocab


def stamp(df: DataFrame, run_ts: str | None, name: str = "create_time") -> DataFrame:
    return df if run_ts is None else df.withColumn(name, F.lit(run_ts))


def maybe_round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def _count(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


# --- post volume (posts table) -------------------------------------------

def auth_post_count(posts: DataFrame, run_ts: str | None = None) -> DataFrame:
    return stamp(_count(posts, ["user_authentication"]), run_ts)


def period_post_count(posts: DataFrame, run_ts: str | None = None) -> DataFrame:
    return stamp(_count(posts, ["time_period"]), run_ts)


def hour_post_count(posts: DataFrame, run_ts: str | None = None) -> DataFrame:
    return stamp(_count(posts, ["hour"]).orderBy("hour"), run_ts)


def day_post_count(posts: DataFrame, run_ts: str | None = None) -> DataFrame:
    return stamp(_count(posts, ["dt"]).orderBy("dt"), run_ts)


def period_auth_count(posts: DataFrame, run_ts: str | None = None) -> DataFrame:
    return stamp(_count(posts, ["time_period", "user_authentication"]), run_ts)


def region_post_count(posts: DataFrame, run_ts: str | None = None) -> DataFrame:
    r = explode_region(posts)
    return stamp(_count(r, ["region"]).orderBy(F.desc("count"), "region"), run_ts)


def grouping_sets_overview(posts: DataFrame) -> DataFrame:
    """Identity, period and period x identity counts in one scan and one shuffle."""
    g = posts.groupingSets(
        [[F.col("user_authentication")], [F.col("time_period")],
         [F.col("time_period"), F.col("user_authentication")]],
        "time_period", "user_authentication")
    return g.agg(F.grouping("time_period").cast("int").alias("g_period"),
                 F.grouping("user_authentication").cast("int").alias("g_auth"),
                 F.count(F.lit(1)).alias("count"))


# --- sentiment (scored table) ----------------------------------------------

def sentiment_overview(scored: DataFrame) -> DataFrame:
    """Label, period x label and identity x label counts in one scan and one shuffle."""
    g = scored.groupingSets(
        [[F.col("label")], [F.col("time_period"), F.col("label")], [F.col("user_authentication"), F.col("label")]],
        "time_period", "user_authentication", "label")
    return g.agg(F.grouping("time_period").cast("int").alias("g_period"),
                 F.grouping("user_authentication").cast("int").alias("g_auth"),
                 F.count(F.lit(1)).alias("value"))


def label_count(scored: DataFrame, vocab: Vocab = REFERENCE, run_ts: str | None = None) -> DataFrame:
    known = scored.where(F.col("label").isin(vocab.positive, vocab.negative, vocab.neutral))
    return stamp(_count(known, ["label"], "value"), run_ts)


def label_by_period(scored: DataFrame, run_ts: str | None = None) -> DataFrame:
    return stamp(_count(scored, ["time_period", "label"], "value"), run_ts)


def label_by_auth(scored: DataFrame, run_ts: str | None = None) -> DataFrame:
    return stamp(_count(scored, ["user_authentication", "label"], "value"), run_ts)


def interaction_by_label(scored: DataFrame, run_ts: str | None = None) -> DataFrame:
    return stamp(scored.groupBy("label").agg(
        F.round(F.avg("reposts_count"), 2).alias("avg_repost"),
        F.round(F.avg("comments_count"), 2).alias("avg_comment"),
        F.round(F.avg("attitudes_count"), 2).alias("avg_attitude")), run_ts)


def region_heat(scored: DataFrame, min_posts: int = 5, digits: int | None = None,
                run_ts: str | None = None) -> DataFrame:
    """Average score per region with at least ``min_posts`` posts (HAVING)."""
    r = explode_region(scored.where(F.col("score").isNotNull()), keep=["score"])
    agg = r.groupBy("region").agg(maybe_round(F.avg("score"), digits).alias("avg_score"),
                                  F.count(F.lit(1)).alias("count"))
    return stamp(agg.where(F.col("count") >= min_posts).orderBy(F.desc("avg_score"), "region"), run_ts)


def day_label_ratio(scored: DataFrame, run_ts: str | None = None) -> DataFrame:
    """Per day and label: count, day total and percentage (2 decimals).

    The day total is a window sum over the already aggregated (dt, label)
    rows -- a handful per day -- instead of a second aggregate and join.
    """
    per = _count(scored.where(nonempty(F.col("label"))), ["dt", "label"], "value")
    total = F.sum("value").over(Window.partitionBy("dt"))
    out = (per.withColumn("total", total)
              .withColumn("ratio", F.round(F.col("value") / F.col("total") * 100, 2))
              .orderBy("dt", "label"))
    return stamp(out, run_ts)


def confidence_level(c: Column, vocab: Vocab) -> Column:
    lv = vocab.confidence_levels
    return F.when(c >= vocab.high_at, lv[0]).when(c >= vocab.mid_at, lv[1]).otherwise(lv[2])


def confidence_level_count(scored: DataFrame, vocab: Vocab = REFERENCE,
                           run_ts: str | None = None) -> DataFrame:
    lv = scored.where(F.col("confidence").isNotNull()).select(
        confidence_level(F.col("confidence"), vocab).alias("level"))
    return stamp(_count(lv, ["level"], "value"), run_ts)


# --- README-declared statistics --------------------------------------------

def volume_trend(posts: DataFrame) -> DataFrame:
    """Discussion volume per day and hour."""
    return _count(posts, ["dt", "hour"]).orderBy("dt", "hour")


def negative_share(scored: DataFrame, vocab: Vocab = REFERENCE, digits: int = 6) -> DataFrame:
    """Share of negative posts among all posts of a day."""
    neg = F.when(F.col("label") == vocab.negative, 1).otherwise(0)
    return (scored.groupBy("dt")
            .agg(F.count(F.lit(1)).alias("n_posts"), F.sum(neg).alias("n_negative"))
            .withColumn("negative_share", F.round(F.col("n_negative") / F.col("n_posts"), digits))
            .orderBy("dt"))


def high_interaction(posts: DataFrame, min_reposts: int = 1000) -> DataFrame:
    """Posts per day whose reposts exceed ``min_reposts`` (the viral rule)."""
    return _count(posts.where(F.col("reposts_count") > min_reposts), ["dt"]).orderBy("dt")


def engagement(df: DataFrame) -> Column:
    return (F.coalesce(F.col("reposts_count"), F.lit(0)).cast("long")
            + F.coalesce(F.col("comments_count"), F.lit(0))
            + F.coalesce(F.col("attitudes_count"), F.lit(0)))


def hot_posts(posts: DataFrame, k: int = 10) -> DataFrame:
    """Top-``k`` posts per day by total interaction (ties: smaller id first).

    ``row_number() <= k`` plans as a partial WindowGroupLimit before the
    shuffle, so a hot day ships at most k rows per map partition.
    """
    w = Window.partitionBy("dt").orderBy(F.desc("interaction"), F.asc("id"))
    return (posts.select("dt", "id", "user_id", engagement(posts).alias("interaction"))
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))


def auth_class(c: Column, vocab: Vocab) -> Column:
    """Official / institution / celebrity / ordinary from identity markers."""
    names, marks = vocab.auth_classes, vocab.auth_class_markers

    def any_of(ms):
        e = F.lit(False)
        for m in ms:
            e = e | F.coalesce(c.contains(m), F.lit(False))
        return e
    return (F.when(any_of(marks[0]), names[0]).when(any_of(marks[1]), names[1])
            .when(any_of(marks[2]), names[2]).otherwise(names[3]))


def auth_class_count(posts: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    return _count(posts.select(auth_class(F.col("user_authentication"), vocab).alias("auth_class")),
                  ["auth_class"])


def engagement_tier(e: Column, vocab: Vocab) -> Column:
    t = vocab.engagement_tiers
    return F.when(e >= 1000, t[0]).when(e >= 300, t[1]).when(e >= 50, t[2]).otherwise(t[3])


def engagement_tier_count(posts: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    return _count(posts.select(engagement_tier(engagement(posts), vocab).alias("tier")), ["tier"])


def length_class(n: Column, vocab: Vocab) -> Column:
    c = vocab.length_classes
    return F.when(n <= 80, c[0]).when(n <= 200, c[1]).when(n.isNotNull(), c[2])


def length_class_count(posts: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    return _count(posts.select(length_class(F.length("text"), vocab).alias("length_class")),
                  ["length_class"])


def quality_share(pred: DataFrame, vocab: Vocab = REFERENCE, pred_col: str = "prediction",
                  digits: int = 6) -> DataFrame:
    """Per day: valid and spam counts from a 1/0 prediction, and the spam share."""
    p = F.col(pred_col)
    spam = F.when(p == 0, 1).otherwise(0)
    return (pred.where(p.isNotNull()).groupBy("dt")
            .agg(F.count(F.lit(1)).alias("n_posts"), F.sum(spam).alias("n_spam"))
            .withColumn("n_valid", F.col("n_posts") - F.col("n_spam"))
            .withColumn("spam_share", F.round(F.col("n_spam") / F.col("n_posts"), digits))
            .orderBy("dt"))


def post_tags(posts: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    """Per day: posts with a #topic#, with an @mention, and plain ones.

    Runs on the text as ingested, before mention removal.
    """
    t = F.col("text")
    has_topic = F.coalesce(t.contains("#"), F.lit(False))
    has_mention = F.coalesce(t.contains("@"), F.lit(False))
    n = vocab.post_tag_names
    return (posts.groupBy("dt").agg(
        F.sum(has_topic.cast("int")).alias("n_" + n[0]),
        F.sum(has_mention.cast("int")).alias("n_" + n[1]),
        F.sum((~has_topic & ~has_mention).cast("int")).alias("n_" + n[2]))
        .orderBy("dt"))


def readme_period_count(posts: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    return _count(posts.select(readme_period_of_hour(F.col("hour"), vocab).alias("day_part")),
                  ["day_part"])


def daily_hot_topic(topics: DataFrame) -> DataFrame:
    """Each day's most discussed topic (ties: alphabetical)."""
    per = _count(topics.where(F.col("topic_label").isNotNull()), ["dt", "topic_label"], "posts")
    # (dt, topic) rows are few per day: the top-1 is an aggregate, no sort.
    best = per.groupBy("dt").agg(
        F.min_by(F.struct("topic_label", "posts"),
                 F.struct(-F.col("posts"), F.col("topic_label"))).alias("b"))
    return best.select("dt", F.col("b.topic_label").alias("topic_label"), F.col("b.posts").alias("posts"))
