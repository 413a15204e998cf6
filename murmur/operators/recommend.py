"""Personalised top-N recommendations.

Pipeline: candidate pool -> hot / final score -> two recall channels (users'
top region, users' preferred period) -> merge, drop own posts, dedup ->
personal score from cluster probabilities -> top N per user.

Scale design
------------
Both recall channels are equi-joins on a low-cardinality key (a region, one
of six periods): joined naively they emit users x posts / 6 rows.  They never
do here.  For a fixed topic the personal score is ``a * (f + r * f * (1 - score))``
with ``f = final_score`` and a user's weights ``a >= 1`` and ``0 <= r <= bonus_weight``, so the
order of posts depends on the ratio ``r`` alone.  Its range is cut into buckets: a
post whose best value in a bucket is below the worst values of posts of N + 1
distinct authors is in no top N of that bucket's users (at most one of those
authors is the user).  Buckets are refined in rounds, each into ``FAN``, where a
child only tests its parent's survivors and only buckets with users go on;
users then join the survivors of their (key, topic, bucket).  The number of
rounds is a matter of cost and cannot change the result.
``prune=False`` gives the plain joins of the original (tests compare both).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from murmur.vocab import REFERENCE, Vocab
from murmur.session import cut

POST_ATTRS = ("bid", "screen_name", "text", "topic_label", "location")


def candidate_pool(topics: DataFrame, as_of: str, days: int = 7, min_confidence: float = 0.7) -> DataFrame:
    """Recent posts with a confident topic.  ``dt`` is compared as a string
    literal so the filter prunes ``dt`` partitions at the scan."""
    import datetime as _dt
    start = (_dt.date.fromisoformat(as_of) - _dt.timedelta(days=days)).isoformat()
    return (topics.where((F.col("dt") >= F.lit(start)) & F.col("topic_label").isNotNull()
                         & (F.col("confidence") >= min_confidence))
            .select("id", "bid", F.col("user_id").cast("string").alias("author_id"), "screen_name",
                    *(["text"] if "text" in topics.columns else []),
                    "topic_label", "location", "time_period"))


def _hot_score() -> Column:
    z = F.lit(0)
    return F.log1p(F.coalesce(F.col("reposts_count"), z) * 0.5
                   + F.coalesce(F.col("comments_count"), z) * 0.2
                   + F.coalesce(F.col("attitudes_count"), z) * 0.1)


def candidate_scored(pool: DataFrame, sentiment: DataFrame, floor: float = 0.5,
                     hot_weight: float = 0.6, score_weight: float = 0.4) -> DataFrame:
    """final = 0.6 * minmax(hot) + 0.4 * score, kept when >= ``floor``.

    The joined pool is stored, as its min and max (scalar subqueries, no
    cross join) and its rows are read from it; the range falls back to 1
    when below 1e-9.
    """
    s = sentiment.select("id", "score", "reposts_count", "comments_count", "attitudes_count")
    raw = cut(pool.join(s, "id", "left").withColumn("hot_score", _hot_score()).select(*pool.columns, "score", "hot_score"))
    hs_min = raw.select(F.min("hot_score")).scalar()
    hs_max = raw.select(F.max("hot_score")).scalar()
    rng = F.when(hs_max - hs_min < 1e-9, F.lit(1.0)).otherwise(hs_max - hs_min)
    norm = (F.col("hot_score") - hs_min) / rng
    final = norm * hot_weight + F.coalesce(F.col("score"), F.lit(0.0)) * score_weight
    keep = [c for c in pool.columns if c != "id"]
    return (raw.withColumn("final_score", final)
            .where(F.col("final_score") >= floor)
            .select("id", *keep, "final_score", F.coalesce(F.col("score"), F.lit(0.0)).alias("score")))


# --- ratio buckets -------------------------------------------------------------------

FAN, ROUNDS = 8, 3              # FAN ** ROUNDS buckets at the end
MARGIN = 1e-9                   # relative; rounding of the personal score never reorders a dropped pair


def ratio_survivors(cands: DataFrame, buckets: DataFrame, top_n: int, widest: float, rounds: int = ROUNDS) -> DataFrame:
    """Rows of ``cands(_ckey, _topic, author_id, final_score, score, ...)`` that may be in a top N, with
    the ``_bucket`` (of ``FAN ** rounds`` over ratios 0 to ``widest``) they may be in it for.

    ``buckets(_ckey, _topic, _bucket)``: the buckets that have users.
    """
    group = ["_ckey", "_topic", "_bucket"]
    rest = cands.withColumn("_bucket", F.lit(0).cast("long"))
    for level in range(1, rounds + 1):
        there = buckets.withColumn("_bucket", F.floor(F.col("_bucket") / FAN ** (rounds - level))).distinct()
        rest = (rest.withColumn("_part", F.explode(F.array(*[F.lit(q) for q in range(FAN)])))
                .withColumn("_bucket", F.col("_bucket") * FAN + F.col("_part")).drop("_part")
                .join(there, group, "left_semi"))
        width = widest / FAN ** level
        y = F.col("final_score") * (F.lit(1.0) - F.col("score"))
        ends = [F.col("final_score") + (F.col("_bucket") + k) * F.lit(width) * y for k in (0, 1)]
        rest = rest.withColumn("_low", F.least(*ends)).withColumn("_high", F.greatest(*ends))
        nth = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("_best")))
        bar = (rest.groupBy(*group, "author_id").agg(F.max("_low").alias("_best"))
               .withColumn("_nth", nth).where(F.col("_nth") <= top_n + 1)
               .groupBy(*group).agg(F.min("_best").alias("_bar"), F.count("*").alias("_authors")).where(F.col("_authors") > top_n)
               .select(*group, "_bar"))
        rest = rest.join(bar, group, "left").where(F.col("_bar").isNull() | (F.col("_high") >= F.col("_bar") * (1 - MARGIN)))
        rest = rest.drop("_low", "_high", "_bar")
        if level < rounds:
            rest = cut(rest)
    return rest


# --- recall -------------------------------------------------------------------------

PROB_COLS = ("life_prob", "night_cat_prob", "big_v_weight", "vent_prob")
RECALL_COLS = ("target_user_id", "id", "author_id", "topic_label", "final_score", "score", "recall_reason")


def user_weights(profile: DataFrame, user_col: str, clusters: DataFrame | None) -> DataFrame:
    """(target_user_id, _key, four cluster probabilities; missing -> 0.0)."""
    u = (profile.select(F.col("user_id").cast("string").alias("target_user_id"), F.col(user_col).alias("_key"))
         .where(F.col("_key").isNotNull()))
    if clusters is None:
        return u.select("*", *[F.lit(0.0).alias(p) for p in PROB_COLS])
    c = clusters.select(F.col("user_id").cast("string").alias("_uid"),
                        *[F.col(f"prob_{i}").alias(p) for i, p in enumerate(PROB_COLS)])
    j = u.join(c, u["target_user_id"] == c["_uid"], "left").drop("_uid")
    return j.withColumns({p: F.coalesce(F.col(p), F.lit(0.0)) for p in PROB_COLS})


def _plain_recall(users: DataFrame, cands: DataFrame, cand_col: str, reason: str) -> DataFrame:
    u = users.select("target_user_id", "_key")
    c = cands.select("id", "author_id", "topic_label", F.col(cand_col).alias("_ckey"), "final_score", "score")
    j = u.join(c, u["_key"] == c["_ckey"], "inner")
    return j.select(*RECALL_COLS[:-1], F.lit(reason).alias("recall_reason"))


def _bucket_recall(users: DataFrame, cands: DataFrame, cand_col: str, reason: str, top_n: int,
                   vocab: Vocab, bonus_weight: float, rounds: int) -> DataFrame:
    """The rows of the plain join that can reach a user's top N (see the module's notes)."""
    # a post without author is never recommended (own-post exclusion drops it)
    c = cut(cands.select("id", "author_id", "topic_label", F.coalesce("topic_label", F.lit("")).alias("_topic"),
                         F.col(cand_col).alias("_ckey"), "final_score", "score")
            .where(F.col("_ckey").isNotNull() & F.col("author_id").isNotNull()))
    topics = c.select("_ckey", "_topic", "topic_label").distinct()
    ratio = (F.lit(bonus_weight) * F.col("vent_prob")) / (F.lit(1.0) + F.lit(bonus_weight) * topic_bonus(vocab))
    last = FAN ** rounds - 1
    place = F.floor(ratio / F.lit(bonus_weight) * (last + 1)).cast("long")
    u = cut(users.join(topics, users["_key"] == topics["_ckey"])
            .select("target_user_id", "_ckey", "_topic", F.least(F.lit(last).cast("long"), F.greatest(F.lit(0).cast("long"), place)).alias("_bucket"))
            .distinct())
    group = ["_ckey", "_topic", "_bucket"]
    kept = ratio_survivors(c, u.select(*group).distinct(), top_n, bonus_weight, rounds)
    return u.join(kept, group).select(*RECALL_COLS[:-1], F.lit(reason).alias("recall_reason"))


def _recall(profile: DataFrame, user_col: str, cands: DataFrame, cand_col: str, reason: str,
            prune: bool, top_n: int, clusters: DataFrame | None, vocab: Vocab, bonus_weight: float,
            rounds: int) -> DataFrame:
    users = user_weights(profile, user_col, clusters)
    if not prune:
        return _plain_recall(users, cands, cand_col, reason)
    return _bucket_recall(users, cands, cand_col, reason, top_n, vocab, bonus_weight, rounds)


def recall_region(region_profile: DataFrame, cands: DataFrame, prune: bool = False, top_n: int = 15,
                  vocab: Vocab = REFERENCE, clusters: DataFrame | None = None, bonus_weight: float = 1.5,
                  rounds: int = ROUNDS) -> DataFrame:
    """Users x posts whose (unsplit) location equals the user's top region;
    with ``prune`` only rows that can reach the user's top N (exact when
    ``clusters`` is the same frame later given to :func:`personalized_rank`)."""
    return _recall(region_profile, "top_focus_region", cands, "location", vocab.recall_reasons[0], prune,
                   top_n, clusters, vocab, bonus_weight, rounds)


def recall_time(time_profile: DataFrame, cands: DataFrame, prune: bool = False, top_n: int = 15,
                vocab: Vocab = REFERENCE, clusters: DataFrame | None = None, bonus_weight: float = 1.5,
                rounds: int = ROUNDS) -> DataFrame:
    """Users x posts of the user's preferred day period; ``prune`` as above."""
    return _recall(time_profile, "prefer_time_period", cands, "time_period", vocab.recall_reasons[1], prune,
                   top_n, clusters, vocab, bonus_weight, rounds)


def recall_union(region_rec: DataFrame, time_rec: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    """Both channels, own posts removed, one row per (user, post); a post
    recalled by both keeps the region reason (fixed priority)."""
    u = region_rec.unionByName(time_rec).where(F.col("target_user_id") != F.col("author_id"))
    pri = F.when(F.col("recall_reason") == vocab.recall_reasons[0], 0).otherwise(1)
    other = [c for c in u.columns if c not in ("target_user_id", "id")]
    best = F.min_by(F.struct(*other), F.struct(pri, F.col("recall_reason")))
    return u.groupBy("target_user_id", "id").agg(best.alias("_r")).select(
        "target_user_id", "id", *[F.col("_r." + c).alias(c) for c in other])


def topic_bonus(vocab: Vocab) -> Column:
    """The part of the bonus that a post's topic gives."""
    t = F.col("topic_label")

    def ind(topics):
        return F.when(t.isin(*topics), F.lit(1.0)).otherwise(F.lit(0.0))
    return (F.col("life_prob") * ind(vocab.everyday_topics)
            + F.col("night_cat_prob") * ind(vocab.night_topics)
            + F.col("big_v_weight") * ind(vocab.big_account_topics)
            + F.col("vent_prob") * ind(vocab.venting_topics))


def personal_bonus(vocab: Vocab) -> Column:
    return topic_bonus(vocab) + F.col("vent_prob") * (F.lit(1.0) - F.col("score"))


def personalized_rank(recalls: DataFrame, clusters: DataFrame, vocab: Vocab = REFERENCE,
                      bonus_weight: float = 1.5) -> DataFrame:
    """personal = final * (1 + bonus_weight * bonus); users without a cluster row get 0 probs."""
    c = clusters.select(F.col("user_id").cast("string").alias("_uid"),
                        F.col("prob_0").alias("life_prob"), F.col("prob_1").alias("night_cat_prob"),
                        F.col("prob_2").alias("big_v_weight"), F.col("prob_3").alias("vent_prob"))
    j = recalls.join(c, recalls["target_user_id"] == c["_uid"], "left").drop("_uid")
    j = j.withColumns({k: F.coalesce(F.col(k), F.lit(0.0))
                       for k in ("life_prob", "night_cat_prob", "big_v_weight", "vent_prob")})
    j = j.withColumn("personalized_bonus", personal_bonus(vocab))
    return j.withColumn("personalized_score",
                        F.col("final_score") * (F.lit(1.0) + F.col("personalized_bonus") * F.lit(bonus_weight)))


def recommend_topn(ranked: DataFrame, cands: DataFrame, n: int = 15, digits: int | None = None,
                   run_ts: str | None = None) -> DataFrame:
    """Top ``n`` per user (ties: smaller post id), then the post attributes
    are joined back for the ``n`` survivors only (late materialisation)."""
    w = Window.partitionBy("target_user_id").orderBy(F.desc("personalized_score"), F.asc("id"))
    top = (ranked.select("target_user_id", "id", "personalized_score", "recall_reason")
           .withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn"))
    attrs = cands.select("id", *[c for c in POST_ATTRS if c in cands.columns])
    score = F.col("personalized_score")
    out = top.join(attrs, "id", "left").select(
        F.col("target_user_id").alias("user_id"), F.col("id").alias("post_id"),
        *[c for c in POST_ATTRS if c in cands.columns],
        (score if digits is None else F.round(score, digits)).alias("score"), "recall_reason")
    return out if run_ts is None else out.withColumn("create_time", F.lit(run_ts))


def recommend(topics: DataFrame, sentiment: DataFrame, time_profile: DataFrame, region_profile: DataFrame,
              clusters: DataFrame, as_of: str, vocab: Vocab = REFERENCE, n: int = 15, days: int = 7,
              prune: bool = True, digits: int | None = None, run_ts: str | None = None) -> DataFrame:
    """The whole recommendation job as one DataFrame.

    Texts are not carried through scoring and recall; they are joined back
    for the final top-N rows only.
    """
    pool = candidate_pool(topics, as_of, days)
    cands = candidate_scored(pool.drop("text") if "text" in pool.columns else pool, sentiment)
    if prune:
        cands = cut(cands)      # read by both channels
        clusters = cut(clusters)  # read by both channels and the final scoring
    rec = recall_union(recall_region(region_profile, cands, prune, n, vocab, clusters),
                       recall_time(time_profile, cands, prune, n, vocab, clusters), vocab)
    ranked = personalized_rank(rec, clusters, vocab)
    return recommend_topn(ranked, pool, n, digits, run_ts)
