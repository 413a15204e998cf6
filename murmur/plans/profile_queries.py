"""Registered user-profile, segment and cluster queries."""

from __future__ import annotations

from murmur.operators import clusters as CL
from murmur.operators import profiles as PR
from murmur.plans.oracle import SCORED, q, sround, with_posts
from murmur.plans.registry import register
from murmur.sources.posts_view import posts_view, sentiment_table
from murmur.vocab import FIXTURE as V


def _scored(spark, d):
    return sentiment_table(posts_view(spark, d, vocab=V))


def _first(col):
    return f"first({col} ORDER BY created_at, id) FILTER (WHERE {col} IS NOT NULL)"


_INTER = "CAST(reposts_count AS BIGINT) + comments_count + attitudes_count"


PROFILE_CTES = f"""{SCORED},
ups AS (
  SELECT user_id, time_period, count(*) AS period_post_cnt, avg(score) AS period_avg_score
  FROM scored WHERE user_id IS NOT NULL GROUP BY user_id, time_period),
pref AS (
  SELECT user_id,
         max(CASE WHEN rp = 1 THEN time_period END) AS prefer_time_period,
         max(CASE WHEN re = 1 THEN time_period END) AS emo_time_period,
         max(CASE WHEN rh = 1 THEN time_period END) AS high_time_period
  FROM (SELECT *,
          row_number() OVER (PARTITION BY user_id ORDER BY period_post_cnt DESC, time_period ASC) AS rp,
          row_number() OVER (PARTITION BY user_id ORDER BY period_avg_score ASC NULLS FIRST, time_period ASC) AS re,
          row_number() OVER (PARTITION BY user_id ORDER BY period_avg_score DESC NULLS LAST, time_period ASC) AS rh
        FROM ups) t
  WHERE rp = 1 OR re = 1 OR rh = 1
  GROUP BY user_id),
phour AS (
  SELECT user_id, hour AS prefer_hour FROM (
    SELECT user_id, hour, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, hour ASC) AS rn
    FROM scored WHERE user_id IS NOT NULL GROUP BY user_id, hour) t WHERE rn = 1),
uts AS (
  SELECT user_id, {sround('stddev_samp(score)', 4)} AS hourly_sentiment_stddev,
         {_first('screen_name')} AS screen_name,
         {sround('sum(CASE WHEN hour >= 23 OR hour < 4 THEN 1 ELSE 0 END) / count(*)', 4)} AS night_post_ratio
  FROM scored WHERE user_id IS NOT NULL GROUP BY user_id),
uregions AS (
  SELECT p.user_id, p.score, rg.region
  FROM scored p, unnest(string_split(p.location, ' | ')) AS rg(region)
  WHERE p.user_id IS NOT NULL AND p.location IS NOT NULL AND p.location <> '' AND rg.region <> ''),
urs AS (
  SELECT user_id, region, count(*) AS region_focus_count,
         {sround('avg(score)', 4)} AS top_region_avg_score
  FROM uregions GROUP BY user_id, region),
utop AS (
  SELECT user_id, region AS top_focus_region, region_focus_count, top_region_avg_score FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY region_focus_count DESC, region ASC) AS rn
    FROM urs) t WHERE rn = 1),
udiv AS (SELECT user_id, count(DISTINCT region) AS region_diversity_score FROM uregions GROUP BY user_id),
levavg AS (
  SELECT user_id,
    {sround(f"CAST(sum(CASE WHEN label = {q(V.negative)} THEN {_INTER} ELSE 0 END) AS DOUBLE) / greatest(CAST(sum(CASE WHEN label = {q(V.negative)} THEN 1 ELSE 0 END) AS DOUBLE), 1.0)", 2)} AS neg_avg,
    {sround(f"CAST(sum(CASE WHEN label = {q(V.positive)} THEN {_INTER} ELSE 0 END) AS DOUBLE) / greatest(CAST(sum(CASE WHEN label = {q(V.positive)} THEN 1 ELSE 0 END) AS DOUBLE), 1.0)", 2)} AS pos_avg
  FROM scored WHERE user_id IS NOT NULL GROUP BY user_id),
lev AS (
  SELECT user_id, coalesce({sround('neg_avg / CASE WHEN pos_avg = 0 THEN 1.0 ELSE pos_avg END', 4)}, 0.0)
         AS sentiment_leverage FROM levavg),
f12 AS (
  SELECT user_id, {_first('screen_name')} AS screen_name,
         coalesce({_first('user_authentication')}, {q(V.default_auth)}) AS user_authentication,
         coalesce({sround('stddev_samp(score)', 4)}, 0.0) AS hourly_sentiment_stddev,
         {sround('CAST(sum(CASE WHEN hour >= 23 OR hour < 4 THEN 1 ELSE 0 END) AS DOUBLE) / count(*)', 4)} AS night_post_ratio
  FROM scored WHERE user_id IS NOT NULL GROUP BY user_id),
feat AS (
  SELECT f12.user_id, f12.screen_name, f12.user_authentication,
         f12.hourly_sentiment_stddev, f12.night_post_ratio,
         CAST(coalesce(udiv.region_diversity_score, 0) AS BIGINT) AS region_diversity_score,
         coalesce(utop.top_region_avg_score, 0.0) AS top_region_avg_score,
         coalesce(lev.sentiment_leverage, 0.0) AS sentiment_leverage
  FROM f12 LEFT JOIN utop ON utop.user_id = f12.user_id
           LEFT JOIN udiv ON udiv.user_id = f12.user_id
           LEFT JOIN lev ON lev.user_id = f12.user_id),
seg AS (
  SELECT feat.*, CASE
    WHEN {' OR '.join([f"coalesce(contains(user_authentication, {q(s)}), false)" for s in V.official_auth_substrings]
                      + [f"coalesce(screen_name LIKE {q(p)}, false)" for p in V.official_name_patterns])} THEN 'official'
    WHEN hourly_sentiment_stddev <= 0.001 AND night_post_ratio = 0.0 AND region_diversity_score = 0
         AND sentiment_leverage = 0.0 THEN 'silent'
    ELSE 'active' END AS segment
  FROM feat),
cprof AS (
  SELECT user_id, screen_name, hourly_sentiment_stddev, night_post_ratio, region_diversity_score,
         top_region_avg_score, sentiment_leverage,
         CASE WHEN segment = 'official' THEN 99 ELSE -1 END AS cluster_id,
         CASE WHEN segment = 'official' THEN 0.0 ELSE 0.25 END AS prob_0,
         CASE WHEN segment = 'official' THEN 0.0 ELSE 0.25 END AS prob_1,
         CASE WHEN segment = 'official' THEN 0.0 ELSE 0.25 END AS prob_2,
         CASE WHEN segment = 'official' THEN 0.0 ELSE 0.25 END AS prob_3
  FROM seg),
utime AS (
  SELECT uts.user_id, coalesce(uts.hourly_sentiment_stddev, 0.0) AS hourly_sentiment_stddev,
         uts.screen_name, uts.night_post_ratio, pref.prefer_time_period, pref.emo_time_period,
         pref.high_time_period, phour.prefer_hour
  FROM uts LEFT JOIN pref ON pref.user_id = uts.user_id LEFT JOIN phour ON phour.user_id = uts.user_id),
uregion AS (
  SELECT utop.*, udiv.region_diversity_score FROM utop LEFT JOIN udiv ON udiv.user_id = utop.user_id)"""


def P(body: str) -> str:
    return with_posts(body, V, extra_ctes=PROFILE_CTES)


register("user_period_stats", P(
    f"SELECT user_id, time_period, period_post_cnt, {sround('period_avg_score', 6)} AS period_avg_score FROM ups"))(
    lambda s, d: PR.user_period_stats(_scored(s, d), digits=6))
register("user_period_pref", P("SELECT * FROM pref"))(
    lambda s, d: PR.user_period_pref(_scored(s, d)))
register("user_prefer_hour", P("SELECT * FROM phour"))(
    lambda s, d: PR.user_prefer_hour(_scored(s, d)))
register("user_time_stats", P("SELECT * FROM uts"))(
    lambda s, d: PR.user_time_stats(_scored(s, d)))
register("user_time_profile", P("SELECT * FROM utime"), headline=True)(
    lambda s, d: PR.user_time_profile(_scored(s, d)))
register("user_region_stats", P("SELECT * FROM urs"))(
    lambda s, d: PR.user_region_stats(_scored(s, d)))
register("user_top_region", P("SELECT * FROM utop"))(
    lambda s, d: PR.user_top_region(_scored(s, d)))
register("region_diversity", P("SELECT * FROM udiv"))(
    lambda s, d: PR.region_diversity(_scored(s, d)))
register("user_region_profile", P("SELECT * FROM uregion"), headline=True)(
    lambda s, d: PR.user_region_profile(_scored(s, d)))
register("user_auth_profile", P(f"""
  SELECT user_id, user_authentication, pos_interaction_avg, neg_interaction_avg, avg_model_confidence,
         {sround('neg_interaction_avg / CASE WHEN pos_interaction_avg = 0 THEN 1 ELSE pos_interaction_avg END', 2)}
           AS sentiment_leverage,
         CASE WHEN user_authentication IS NOT NULL AND user_authentication = {q(V.official_flag_value)}
              THEN 1 ELSE 0 END AS is_official
  FROM (
    SELECT user_id, {_first('user_authentication')} AS user_authentication,
      {sround(f"sum(CASE WHEN label = {q(V.positive)} THEN {_INTER} ELSE 0 END) / count(*)", 2)} AS pos_interaction_avg,
      {sround(f"sum(CASE WHEN label = {q(V.negative)} THEN {_INTER} ELSE 0 END) / count(*)", 2)} AS neg_interaction_avg,
      {sround('avg(CAST(confidence AS DECIMAL(38,18)))', 4)} AS avg_model_confidence
    FROM scored WHERE user_id IS NOT NULL GROUP BY user_id) t"""))(
    lambda s, d: PR.user_auth_profile(_scored(s, d), V))
register("sentiment_leverage", P("SELECT * FROM lev"))(
    lambda s, d: PR.sentiment_leverage(_scored(s, d), V))
register("user_features", P("SELECT * FROM feat"))(
    lambda s, d: CL.user_features(_scored(s, d), V))
register("segment_users", P("SELECT * FROM seg"), headline=True)(
    lambda s, d: CL.segment_users(CL.user_features(_scored(s, d), V), V))
register("cluster_profile_default", P("SELECT * FROM cprof"))(
    lambda s, d: CL.cluster_users(_scored(s, d), V))


def _gmm_profile(s, d):
    seg = CL.segment_users(CL.user_features(_scored(s, d), V), V)
    model = CL.fit_clusters(seg)
    return CL.cluster_profile(seg, CL.assign_clusters(model, seg))


register("cluster_users")(_gmm_profile)
