"""Nightly user features, segments and cluster profile.

The original splits users into three driver-side lists; here the segment is
one column on one frame and cluster assignment is a Spark ML
``GaussianMixture`` fitted and applied on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from murmur.operators.indicators import stamp
from murmur.operators.profiles import _earliest, first_non_null, known_users, user_region_stats
from murmur.functions.time import is_night
from murmur.schemas import CLUSTER_FEATURES
from murmur.vocab import REFERENCE, Vocab

SEGMENTS = ("official", "silent", "active")
OFFICIAL_CLUSTER, DEFAULT_CLUSTER = 99, -1


def user_features(scored: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    """Five behaviour features per user (plus name and identity).

    Identity, sentiment spread, night share and the leverage sums share one
    ``groupBy(user_id)`` (one scan, one shuffle of partial aggregates); the
    region features need the exploded locations and are a second aggregate.
    """
    s = known_users(scored)
    night = F.when(is_night(F.col("hour")), 1).otherwise(0)
    lab = F.col("label")
    inter = F.col("reposts_count").cast("long") + F.col("comments_count") + F.col("attitudes_count")

    def sums(name):
        return (F.sum(F.when(lab == name, inter).otherwise(0)).cast("double"),
                F.sum(F.when(lab == name, 1).otherwise(0)).cast("double"))
    neg_s, neg_n = sums(vocab.negative)
    pos_s, pos_n = sums(vocab.positive)
    core = s.groupBy("user_id").agg(
        first_non_null(F.col("screen_name"), _earliest()).alias("screen_name"),
        first_non_null(F.col("user_authentication"), _earliest()).alias("user_authentication"),
        F.round(F.stddev_samp("score"), 4).alias("hourly_sentiment_stddev"),
        F.round(F.sum(night).cast("double") / F.count(F.lit(1)), 4).alias("night_post_ratio"),
        F.round(neg_s / F.greatest(neg_n, F.lit(1.0)), 2).alias("_neg_avg"),
        F.round(pos_s / F.greatest(pos_n, F.lit(1.0)), 2).alias("_pos_avg"))
    pos = F.col("_pos_avg")
    lev = F.round(F.col("_neg_avg") / F.when(pos == 0, F.lit(1.0)).otherwise(pos), 4)
    core = (core.withColumn("sentiment_leverage", lev).drop("_neg_avg", "_pos_avg")
            .na.fill(0.0, ["hourly_sentiment_stddev", "sentiment_leverage"])
            .na.fill(vocab.default_auth, ["user_authentication"]))
    rs = user_region_stats(scored)
    key = F.struct(-F.col("region_focus_count"), F.col("region"))
    feat34 = rs.groupBy("user_id").agg(
        F.min_by(F.col("top_region_avg_score"), key).alias("top_region_avg_score"),
        F.count(F.lit(1)).alias("region_diversity_score"))
    out = (core.join(feat34, "user_id", "left")
           .na.fill(0.0)
           .withColumn("region_diversity_score", F.col("region_diversity_score").cast("long")))
    return out.select("user_id", "screen_name", "user_authentication", *CLUSTER_FEATURES)


def is_official(auth: Column, name: Column, vocab: Vocab) -> Column:
    e = F.lit(False)
    for s in vocab.official_auth_substrings:
        e = e | F.coalesce(auth.contains(s), F.lit(False))
    for p in vocab.official_name_patterns:
        e = e | F.coalesce(name.like(p), F.lit(False))
    return e


def is_silent() -> Column:
    return ((F.col("hourly_sentiment_stddev") <= 0.001) & (F.col("night_post_ratio") == 0.0)
            & (F.col("region_diversity_score") == 0) & (F.col("sentiment_leverage") == 0.0))


def segment_users(features: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    """official > silent > active, as one column (no anti joins, no collect)."""
    off = is_official(F.col("user_authentication"), F.col("screen_name"), vocab)
    seg = F.when(off, SEGMENTS[0]).when(F.coalesce(is_silent(), F.lit(False)), SEGMENTS[1]).otherwise(SEGMENTS[2])
    return features.withColumn("segment", seg)


def cluster_profile(segmented: DataFrame, assignments: DataFrame | None = None,
                    run_ts: str | None = None) -> DataFrame:
    """Segment defaults, then model assignments for active users.

    ``assignments`` (user_id, cluster_id, prob_0..prob_3) comes from
    :func:`fit_clusters` or any scorer; an active user without a row gets the
    default (-1, 0.25 x 4), silent users too, official accounts get 99 and 0s.
    """
    df = segmented
    if assignments is not None:
        a = assignments.select("user_id", F.col("cluster_id").alias("_cid"),
                               *[F.col(f"prob_{i}").alias(f"_p{i}") for i in range(4)])
        df = df.join(a, "user_id", "left")
    seg = F.col("segment")
    cid = F.when(seg == SEGMENTS[0], F.lit(OFFICIAL_CLUSTER))
    probs = []
    for i in range(4):
        p = F.when(seg == SEGMENTS[0], F.lit(0.0))
        if assignments is not None:
            p = p.when(seg == SEGMENTS[2], F.coalesce(F.col(f"_p{i}"), F.lit(0.25)))
        probs.append(p.otherwise(F.lit(0.25)).alias(f"prob_{i}"))
    if assignments is not None:
        cid = cid.when(seg == SEGMENTS[2], F.coalesce(F.col("_cid"), F.lit(DEFAULT_CLUSTER)))
    cid = cid.otherwise(F.lit(DEFAULT_CLUSTER)).alias("cluster_id")
    out = df.select("user_id", "screen_name", *CLUSTER_FEATURES, cid, *probs)
    return stamp(out, run_ts, "update_time")


def fit_clusters(segmented: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 100):
    """Fit a Gaussian mixture on the active users' five features (Spark ML, EM on executors)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    active = segmented.where(F.col("segment") == SEGMENTS[2])
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(CLUSTER_FEATURES), outputCol="_raw", handleInvalid="skip"),
        StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True),
        GaussianMixture(k=k, seed=seed, maxIter=max_iter, featuresCol="_features",
                        predictionCol="cluster_id", probabilityCol="_prob"),
    ])
    return pipe.fit(active)


def assign_clusters(model, segmented: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array
    active = segmented.where(F.col("segment") == SEGMENTS[2])
    out = model.transform(active).withColumn("_pa", vector_to_array("_prob"))
    k = model.stages[-1].getK()
    return out.select("user_id", F.col("cluster_id").cast("int"),
                      *[F.col("_pa")[i].alias(f"prob_{i}") for i in range(k)])


def cluster_users(scored: DataFrame, vocab: Vocab = REFERENCE, model=None,
                  run_ts: str | None = None) -> DataFrame:
    """Features -> segments -> (optional) mixture assignments -> profile rows."""
    seg = segment_users(user_features(scored, vocab), vocab)
    assignments = assign_clusters(model, seg) if model is not None else None
    return cluster_profile(seg, assignments, run_ts)
