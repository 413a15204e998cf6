"""Registered statistics queries (volume, sentiment, README-declared)."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.operators import indicators as ind
from murmur.plans.oracle import REGIONS, SCORED, in_list, q, sround, with_posts
from murmur.plans.registry import register
from murmur.sources.posts_view import posts_view, posts_with_text, sentiment_table
from murmur.sources.tables import table
from murmur.vocab import FIXTURE as V


def _posts(spark, d):
    return posts_view(spark, d, vocab=V)


def _scored(spark, d):
    return sentiment_table(_posts(spark, d))


# regions of scored posts with a score (same CTE, other name and filter)
SCORED_REGIONS = REGIONS.replace("regions AS", "sregions AS").replace(
    "WHERE p.location", "WHERE p.label IS NOT NULL AND p.score IS NOT NULL AND p.location")


# --- AG1-AG6 ----------------------------------------------------------------

register("auth_post_count", with_posts(
    'SELECT user_authentication, count(*) AS "count" FROM posts GROUP BY user_authentication'))(
    lambda s, d: ind.auth_post_count(_posts(s, d)))

register("period_post_count", with_posts(
    'SELECT time_period, count(*) AS "count" FROM posts GROUP BY time_period'))(
    lambda s, d: ind.period_post_count(_posts(s, d)))

register("hour_post_count", with_posts(
    'SELECT hour, count(*) AS "count" FROM posts GROUP BY hour ORDER BY hour'))(
    lambda s, d: ind.hour_post_count(_posts(s, d)))

register("day_post_count", with_posts(
    'SELECT dt, count(*) AS "count" FROM posts GROUP BY dt ORDER BY dt'), headline=True)(
    lambda s, d: ind.day_post_count(_posts(s, d)))

register("period_auth_count", with_posts(
    'SELECT time_period, user_authentication, count(*) AS "count" FROM posts '
    'GROUP BY time_period, user_authentication'))(
    lambda s, d: ind.period_auth_count(_posts(s, d)))

register("region_post_count", with_posts(
    'SELECT region, count(*) AS "count" FROM regions GROUP BY region', extra_ctes=REGIONS))(
    lambda s, d: ind.region_post_count(_posts(s, d)))

register("grouping_sets_overview", with_posts(
    "SELECT time_period, user_authentication, "
    "CAST(grouping(time_period) AS INTEGER) AS g_period, "
    "CAST(grouping(user_authentication) AS INTEGER) AS g_auth, count(*) AS \"count\" "
    "FROM posts GROUP BY GROUPING SETS ((user_authentication), (time_period), "
    "(time_period, user_authentication))"), headline=True)(
    lambda s, d: ind.grouping_sets_overview(_posts(s, d)))

# --- AG7-AG14 ---------------------------------------------------------------

register("label_count", with_posts(
    f"SELECT label, count(*) AS value FROM scored WHERE label IN "
    f"{in_list([V.positive, V.negative, V.neutral])} GROUP BY label", extra_ctes=SCORED))(
    lambda s, d: ind.label_count(_scored(s, d), V))

register("label_by_period", with_posts(
    "SELECT time_period, label, count(*) AS value FROM scored GROUP BY time_period, label",
    extra_ctes=SCORED))(
    lambda s, d: ind.label_by_period(_scored(s, d)))

register("label_by_auth", with_posts(
    "SELECT user_authentication, label, count(*) AS value FROM scored "
    "GROUP BY user_authentication, label", extra_ctes=SCORED))(
    lambda s, d: ind.label_by_auth(_scored(s, d)))

register("interaction_by_label", with_posts(
    f"SELECT label, {sround('avg(reposts_count)', 2)} AS avg_repost, "
    f"{sround('avg(comments_count)', 2)} AS avg_comment, "
    f"{sround('avg(attitudes_count)', 2)} AS avg_attitude FROM scored GROUP BY label",
    extra_ctes=SCORED))(
    lambda s, d: ind.interaction_by_label(_scored(s, d)))

register("region_heat", with_posts(
    f'SELECT region, {sround("avg(score)", 6)} AS avg_score, count(*) AS "count" '
    f"FROM sregions GROUP BY region HAVING count(*) >= 5", extra_ctes=SCORED_REGIONS))(
    lambda s, d: ind.region_heat(_scored(s, d), digits=6))

register("day_label_ratio", with_posts(
    f"""SELECT dt, label, value, total, {sround('value / total * 100', 2)} AS ratio FROM (
      SELECT dt, label, count(*) AS value,
             CAST(sum(count(*)) OVER (PARTITION BY dt) AS BIGINT) AS total
      FROM scored WHERE label IS NOT NULL AND label <> '' GROUP BY dt, label) t
    ORDER BY dt, label""", extra_ctes=SCORED), headline=True)(
    lambda s, d: ind.day_label_ratio(_scored(s, d)))

register("confidence_level_count", with_posts(
    f"""SELECT CASE WHEN confidence >= CAST({V.high_at} AS DOUBLE) THEN {q(V.confidence_levels[0])}
                WHEN confidence >= CAST({V.mid_at} AS DOUBLE) THEN {q(V.confidence_levels[1])}
                ELSE {q(V.confidence_levels[2])} END AS level, count(*) AS value
    FROM scored WHERE confidence IS NOT NULL GROUP BY level""", extra_ctes=SCORED))(
    lambda s, d: ind.confidence_level_count(_scored(s, d), V))

# --- README-declared (DOC1, 2, 4, 7, 10-15, 17) -------------------------------

register("volume_trend", with_posts(
    'SELECT dt, hour, count(*) AS "count" FROM posts GROUP BY dt, hour'))(
    lambda s, d: ind.volume_trend(_posts(s, d)))

register("negative_share", with_posts(
    f"""SELECT dt, n_posts, n_negative, {sround('n_negative / n_posts', 6)} AS negative_share FROM (
      SELECT dt, count(*) AS n_posts,
             CAST(sum(CASE WHEN label = {q(V.negative)} THEN 1 ELSE 0 END) AS BIGINT) AS n_negative
      FROM scored GROUP BY dt) t""", extra_ctes=SCORED))(
    lambda s, d: ind.negative_share(_scored(s, d), V))

register("high_interaction", with_posts(
    'SELECT dt, count(*) AS "count" FROM posts WHERE reposts_count > 1000 GROUP BY dt'))(
    lambda s, d: ind.high_interaction(_posts(s, d)))

_INTERACTION = ("CAST(coalesce(reposts_count, 0) AS BIGINT) + coalesce(comments_count, 0) "
                "+ coalesce(attitudes_count, 0)")

register("hot_posts", with_posts(
    f"""SELECT dt, id, user_id, interaction, CAST(rank AS INTEGER) AS rank FROM (
      SELECT dt, id, user_id, {_INTERACTION} AS interaction,
             row_number() OVER (PARTITION BY dt ORDER BY {_INTERACTION} DESC, id ASC) AS rank
      FROM posts) t WHERE rank <= 10"""), headline=True)(
    lambda s, d: ind.hot_posts(_posts(s, d), k=10))


def _contains_any(col, marks):
    return "(" + " OR ".join(f"coalesce(contains({col}, {q(m)}), false)" for m in marks) + ")" if marks else "false"


_ac = V.auth_classes
_am = V.auth_class_markers
register("auth_class_count", with_posts(
    f"""SELECT CASE WHEN {_contains_any('user_authentication', _am[0])} THEN {q(_ac[0])}
                WHEN {_contains_any('user_authentication', _am[1])} THEN {q(_ac[1])}
                WHEN {_contains_any('user_authentication', _am[2])} THEN {q(_ac[2])}
                ELSE {q(_ac[3])} END AS auth_class, count(*) AS "count"
    FROM posts GROUP BY auth_class"""))(
    lambda s, d: ind.auth_class_count(_posts(s, d), V))

_t = V.engagement_tiers
register("engagement_tier_count", with_posts(
    f"""SELECT CASE WHEN e >= 1000 THEN {q(_t[0])} WHEN e >= 300 THEN {q(_t[1])}
                WHEN e >= 50 THEN {q(_t[2])} ELSE {q(_t[3])} END AS tier, count(*) AS "count"
    FROM (SELECT {_INTERACTION} AS e FROM posts) t GROUP BY tier"""))(
    lambda s, d: ind.engagement_tier_count(_posts(s, d), V))

_lc = V.length_classes
register("length_class_count", with_posts(
    f"""SELECT CASE WHEN length(text) <= 80 THEN {q(_lc[0])} WHEN length(text) <= 200 THEN {q(_lc[1])}
                WHEN length(text) IS NOT NULL THEN {q(_lc[2])} END AS length_class, count(*) AS "count"
    FROM posts GROUP BY length_class""", with_text=True))(
    lambda s, d: ind.length_class_count(posts_with_text(s, d, V), V))


def _quality_frame(s, d):
    p = posts_with_text(s, d, V, keep_doc_id=True).drop("text")
    lab = table(s, d, "labels").select("doc_id", F.col("quality").alias("prediction"))
    return p.join(lab, "doc_id")


register("quality_share", with_posts(
    f"""SELECT dt, n_posts, n_spam, n_posts - n_spam AS n_valid,
           {sround('n_spam / n_posts', 6)} AS spam_share FROM (
      SELECT p.dt, count(*) AS n_posts,
             CAST(sum(CASE WHEN l.quality = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_spam
      FROM posts p JOIN labels l
        ON l.doc_id = CAST(p.id AS BIGINT) % (SELECT count(*) FROM documents)
      WHERE l.quality IS NOT NULL GROUP BY p.dt) t"""))(
    lambda s, d: ind.quality_share(_quality_frame(s, d), V))

_tn = V.post_tag_names
register("post_tags", with_posts(
    f"""SELECT dt,
      CAST(sum(CASE WHEN coalesce(contains(text, '#'), false) THEN 1 ELSE 0 END) AS BIGINT) AS n_{_tn[0]},
      CAST(sum(CASE WHEN coalesce(contains(text, '@'), false) THEN 1 ELSE 0 END) AS BIGINT) AS n_{_tn[1]},
      CAST(sum(CASE WHEN NOT coalesce(contains(text, '#'), false)
                     AND NOT coalesce(contains(text, '@'), false) THEN 1 ELSE 0 END) AS BIGINT) AS n_{_tn[2]}
    FROM posts GROUP BY dt""", with_text=True))(
    lambda s, d: ind.post_tags(posts_with_text(s, d, V), V))

_rp = V.readme_periods
register("readme_period_count", with_posts(
    f"""SELECT CASE WHEN hour < 6 THEN {q(_rp[0])} WHEN hour < 11 THEN {q(_rp[1])}
                WHEN hour < 15 THEN {q(_rp[2])} WHEN hour < 19 THEN {q(_rp[3])}
                WHEN hour IS NOT NULL THEN {q(_rp[4])} END AS day_part, count(*) AS "count"
    FROM posts GROUP BY day_part"""))(
    lambda s, d: ind.readme_period_count(_posts(s, d), V))

register("daily_hot_topic", with_posts(
    """SELECT dt, topic_label, posts FROM (
      SELECT dt, topic_label, count(*) AS posts,
             row_number() OVER (PARTITION BY dt ORDER BY count(*) DESC, topic_label ASC) AS rn
      FROM posts WHERE topic_label IS NOT NULL GROUP BY dt, topic_label) t WHERE rn = 1"""))(
    lambda s, d: ind.daily_hot_topic(_posts(s, d)))

register("sentiment_overview", with_posts(
    "SELECT time_period, user_authentication, label, "
    "CAST(grouping(time_period) AS INTEGER) AS g_period, "
    "CAST(grouping(user_authentication) AS INTEGER) AS g_auth, count(*) AS value "
    "FROM scored GROUP BY GROUPING SETS ((label), (time_period, label), (user_authentication, label))",
    extra_ctes=SCORED))(
    lambda s, d: ind.sentiment_overview(_scored(s, d)))
