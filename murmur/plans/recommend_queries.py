"""Registered recommendation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.operators import clusters as CL
from murmur.operators import profiles as PR
from murmur.operators import recommend as RC
from murmur.plans.oracle import in_list, q, sround, with_posts
from murmur.plans.profile_queries import PROFILE_CTES
from murmur.plans.registry import register
from murmur.session import cut
from murmur.sources.posts_view import attach_text, posts_view, posts_with_text, sentiment_table, topic_table
from murmur.vocab import FIXTURE as V

AS_OF = "2024-01-31"      # the fixture covers 2024-01-01 .. 2024-01-30
START = "2024-01-24"      # AS_OF - 7 days


def _frames(s, d, text: bool = False):
    posts = posts_with_text(s, d, V) if text else posts_view(s, d, vocab=V)
    scored = sentiment_table(posts_view(s, d, vocab=V))
    return topic_table(posts), scored


def _pool(s, d):
    topics, _ = _frames(s, d)
    return RC.candidate_pool(topics, AS_OF)


def _scored_cands(s, d):
    topics, scored = _frames(s, d)
    return RC.candidate_scored(RC.candidate_pool(topics, AS_OF), scored)


def _personal(scored):
    """Probabilities that differ from user to user, by a formula that both engines compute."""
    uid = F.col("user_id").cast("long")
    part = lambda a, m, by: ((uid * a) % m).cast("double") / F.lit(by)
    return scored.where("user_id IS NOT NULL").select("user_id").distinct().select(
        "user_id", part(7, 101, 300.0).alias("prob_0"), part(11, 103, 300.0).alias("prob_1"),
        part(13, 107, 300.0).alias("prob_2"), part(17, 97, 97.0).alias("prob_3"))


def _recommend(s, d, model=False, personal=False):
    topics, scored = _frames(s, d)
    if personal:
        clusters = _personal(scored)
    elif model:
        seg = cut(CL.segment_users(CL.user_features(scored, V), V))      # read by each step of the fit and by the profile
        clusters = CL.cluster_profile(seg, CL.assign_clusters(CL.fit_clusters(seg), seg))
    else:
        clusters = CL.cluster_users(scored, V)
    top = RC.recommend(topics, scored, PR.user_time_profile(scored), PR.user_region_profile(scored),
                       clusters, AS_OF, V, n=15, digits=6)
    # texts are joined for the final top-N rows only
    cols = ["user_id", "post_id", "bid", "screen_name", "text", "topic_label", "location", "score",
            "recall_reason"]
    return attach_text(s, d, top, "post_id").select(*cols)


_D = "CAST({} AS DOUBLE)"
CAND_CTES = PROFILE_CTES + f""",
cand AS (
  SELECT id, bid, user_id AS author_id, screen_name, topic_label, location, time_period
  FROM posts WHERE dt >= {q(START)} AND topic_label IS NOT NULL AND confidence >= 0.7),
raw AS (
  SELECT c.*, s.score,
         ln(1 + ({_D.format('coalesce(s.reposts_count, 0)')} * 0.5
                 + {_D.format('coalesce(s.comments_count, 0)')} * 0.2
                 + {_D.format('coalesce(s.attitudes_count, 0)')} * 0.1)) AS hot_score
  FROM cand c LEFT JOIN scored s ON s.id = c.id),
mm AS (SELECT min(hot_score) AS mn, max(hot_score) AS mx FROM raw),
cs AS (
  SELECT * FROM (
    SELECT raw.id, raw.bid, raw.author_id, raw.screen_name, raw.topic_label, raw.location, raw.time_period,
           (raw.hot_score - mm.mn) / (CASE WHEN mm.mx - mm.mn < 1e-9 THEN 1.0 ELSE mm.mx - mm.mn END) * 0.6
             + coalesce(raw.score, 0.0) * 0.4 AS final_score,
           coalesce(raw.score, 0.0) AS score
    FROM raw CROSS JOIN mm) t
  WHERE final_score >= 0.5)"""


def _ind(topics):
    return f"(CASE WHEN topic_label IN {in_list(topics)} THEN 1.0 ELSE 0.0 END)"


REC_CTES = f"""rr AS (
  SELECT ur.user_id AS target_user_id, cs.id, cs.author_id, cs.topic_label, cs.final_score, cs.score,
         'region' AS recall_reason
  FROM uregion ur JOIN cs ON ur.top_focus_region = cs.location),
tr AS (
  SELECT ut.user_id AS target_user_id, cs.id, cs.author_id, cs.topic_label, cs.final_score, cs.score,
         'time_period' AS recall_reason
  FROM utime ut JOIN cs ON ut.prefer_time_period = cs.time_period),
dd AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY target_user_id, id
                                 ORDER BY CASE WHEN recall_reason = 'region' THEN 0 ELSE 1 END) AS rn
    FROM (SELECT * FROM rr UNION ALL SELECT * FROM tr) u
    WHERE target_user_id <> author_id) t WHERE rn = 1),
pr AS (
  SELECT dd.*, coalesce(c.prob_0, 0.0) AS life_prob, coalesce(c.prob_1, 0.0) AS night_cat_prob,
         coalesce(c.prob_2, 0.0) AS big_v_weight, coalesce(c.prob_3, 0.0) AS vent_prob
  FROM dd LEFT JOIN cprof c ON c.user_id = dd.target_user_id),
ps AS (
  SELECT *, final_score * (1.0 + (life_prob * {_ind(V.everyday_topics)} + night_cat_prob * {_ind(V.night_topics)}
                                  + big_v_weight * {_ind(V.big_account_topics)} + vent_prob * {_ind(V.venting_topics)}
                                  + vent_prob * (1.0 - score)) * 1.5) AS personalized_score
  FROM pr),
top AS (
  SELECT *, row_number() OVER (PARTITION BY target_user_id ORDER BY personalized_score DESC, id ASC) AS rn2
  FROM ps)"""

RECOMMEND_SQL = with_posts(f"""SELECT t.target_user_id AS user_id, t.id AS post_id, p.bid, p.screen_name, p.text,
       p.topic_label, p.location, {sround('t.personalized_score', 6)} AS score, t.recall_reason
FROM top t JOIN posts p ON p.id = t.id
WHERE t.rn2 <= 15""", V, with_text=True, extra_ctes=CAND_CTES + ",\n" + REC_CTES)


register("candidate_pool", with_posts(
    f"SELECT id, bid, author_id, screen_name, topic_label, location, time_period FROM cand",
    V, extra_ctes=CAND_CTES))(_pool)

register("candidate_scored", with_posts(
    f"SELECT id, bid, author_id, screen_name, topic_label, location, time_period, "
    f"{sround('final_score', 9)} AS final_score, score FROM cs", V, extra_ctes=CAND_CTES))(
    lambda s, d: _scored_cands(s, d).withColumn("final_score", F.round("final_score", 9)))

register("recommend_topn", RECOMMEND_SQL, headline=True)(lambda s, d: _recommend(s, d))
_PERSONAL_SQL = """(SELECT DISTINCT user_id, CAST(CAST(user_id AS BIGINT) * 7 % 101 AS DOUBLE) / 300.0 AS prob_0,
       CAST(CAST(user_id AS BIGINT) * 11 % 103 AS DOUBLE) / 300.0 AS prob_1, CAST(CAST(user_id AS BIGINT) * 13 % 107 AS DOUBLE) / 300.0 AS prob_2,
       CAST(CAST(user_id AS BIGINT) * 17 % 97 AS DOUBLE) / 97.0 AS prob_3 FROM scored WHERE user_id IS NOT NULL)"""
register("recommend_topn_personal", RECOMMEND_SQL.replace("LEFT JOIN cprof c ON", f"LEFT JOIN {_PERSONAL_SQL} c ON"))(
    lambda s, d: _recommend(s, d, personal=True))
register("recommend_topn_gmm")(lambda s, d: _recommend(s, d, model=True))
