"""Registered rollup queries: daily partial aggregates and statistics merged from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.operators import rollup as RU, sketches as SK
from murmur.plans.oracle import sround, with_posts
from murmur.plans.registry import register
from murmur.sources.posts_view import posts_view
from murmur.vocab import FIXTURE as V


def _rollup(s, d):
    return RU.daily_rollup(posts_view(s, d, vocab=V))


def _dec(c):
    return f"CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,18))"


_SETS = ", ".join("(dt, " + ", ".join(st) + ")" for st in RU.ROLLUP_SETS)
_NAME = "CASE " + " ".join(
    "WHEN " + " AND ".join(f"grouping({c}) = {0 if c in st else 1}" for c in RU.DIMS)
    + f" THEN '{RU.set_name(st)}'" for st in RU.ROLLUP_SETS) + " END"

register("daily_rollup", with_posts(f"""
  SELECT dt, user_authentication, time_period, hour, label, {_NAME} AS grouping_set,
         count(*) AS n,
         CAST(sum(reposts_count) AS BIGINT) AS sum_reposts, CAST(sum(comments_count) AS BIGINT) AS sum_comments,
         CAST(sum(attitudes_count) AS BIGINT) AS sum_attitudes,
         count(reposts_count) AS n_reposts, count(comments_count) AS n_comments,
         count(attitudes_count) AS n_attitudes, count(score) AS n_score,
         CAST(sum({_dec('score')}) AS DOUBLE) AS sum_score, count(confidence) AS n_confidence,
         CAST(sum({_dec('confidence')}) AS DOUBLE) AS sum_confidence
  FROM posts GROUP BY GROUPING SETS ({_SETS})""", V))(
    lambda s, d: _rollup(s, d).withColumns({"sum_score": F.col("sum_score").cast("double"),
                                           "sum_confidence": F.col("sum_confidence").cast("double")}))

register("rollup_auth_post_count", with_posts(
    'SELECT user_authentication, count(*) AS "count" FROM posts GROUP BY user_authentication', V))(
    lambda s, d: RU.merged(_rollup(s, d), ("user_authentication",))
    .select("user_authentication", F.col("n").alias("count")))

register("rollup_interaction_by_label", with_posts(
    f"""SELECT label, {sround('avg(reposts_count)', 2)} AS avg_repost, {sround('avg(comments_count)', 2)} AS avg_comment,
           {sround('avg(attitudes_count)', 2)} AS avg_attitude,
           {sround(f"sum({_dec('score')}) / count(score)", 6)} AS avg_score
    FROM posts GROUP BY label""", V))(
    lambda s, d: RU.merged(_rollup(s, d), ("label",)).select(
        "label", F.round(F.col("sum_reposts") / F.col("n_reposts"), 2).alias("avg_repost"),
        F.round(F.col("sum_comments") / F.col("n_comments"), 2).alias("avg_comment"),
        F.round(F.col("sum_attitudes") / F.col("n_attitudes"), 2).alias("avg_attitude"),
        RU.avg_of("sum_score", "n_score", 6).alias("avg_score")))


# late rows: half of an old day arrives after the rollup was refreshed once; the next refresh must find them
def _late_rows(s, d):
    from murmur.session import scratch_path
    path = scratch_path(s, "rollup") + "/daily"
    posts = posts_view(s, d, vocab=V)
    late = (F.col("dt") == "2024-01-10") & (F.col("id").cast("long") % 2 == 0)
    RU.refresh_changed(s, posts.where(~late), path)
    RU.refresh_changed(s, posts, path)
    return RU.merged(s.read.parquet(path), ("label",)).select("label", F.col("n").alias("count"))


register("rollup_late_rows", with_posts('SELECT label, count(*) AS "count" FROM posts GROUP BY label', V))(_late_rows)

# --- sketches merged over days (AG20, AG24) -------------------------------------------------------

AUTH = ("user_authentication",)
MILLE = (500, 900, 990)


def _distinct_users(s, d):
    """Users of the last seven days: one merge of seven stored sketches, beside the exact count."""
    posts = posts_view(s, d, vocab=V)
    keys = ("dt", *AUTH)
    found = SK.merged_users(SK.over_last_days(SK.daily_sketches(posts, AUTH, "attitudes_count"), 7), keys)
    exact = (SK.over_last_days(posts.select(*keys, "user_id").distinct(), 7)
             .groupBy(*keys).agg(F.count_distinct("user_id").alias("exact_users")))
    near = F.abs(F.col("users") - F.col("exact_users")) <= F.col("exact_users") * F.lit(SK.USERS_BOUND) + F.lit(0.5)
    return (found.join(exact, [found[k].eqNullSafe(exact[k]) for k in keys])
            .select(*[found[k] for k in keys], "exact_users", near.alias("within_bound")))


register("rollup_distinct_users", with_posts("""SELECT t.dt, u.user_authentication, count(DISTINCT u.user_id) AS exact_users, TRUE AS within_bound
FROM (SELECT DISTINCT dt, user_authentication, user_id FROM posts) u
JOIN (SELECT strftime(day, '%Y-%m-%d') AS dt, CAST(day AS DATE) AS day
      FROM (SELECT unnest(generate_series(CAST(min(dt) AS DATE), CAST(max(dt) AS DATE), INTERVAL 1 DAY)) AS day FROM posts) x) t
  ON CAST(u.dt AS DATE) BETWEEN t.day - 6 AND t.day
GROUP BY t.dt, u.user_authentication""", V))(_distinct_users)


def _quantiles(s, d):
    posts = posts_view(s, d, vocab=V)
    out = SK.exact_quantiles(posts, SK.daily_sketches(posts, ("label",), "attitudes_count"), ("label",), "attitudes_count", MILLE)
    near = F.abs(F.col("quantile") - F.col("exact")) <= F.abs("exact") * F.lit(SK.ALPHA + 1e-9)
    return out.select("label", "mille", F.round("quantile", 6).alias("quantile"), "exact", near.alias("within_bound"))


_middle = f"2 / ({SK.GAMMA!r} + 1) * pow({SK.GAMMA!r}, ceil(ln(abs(v)) / {SK.LN_GAMMA!r}))"
register("rollup_quantiles", with_posts(f"""SELECT label, mille, CASE WHEN v = 0 THEN 0.0 ELSE sign(v) * {sround(_middle, 6)} END AS quantile,
  v AS exact, TRUE AS within_bound
FROM (SELECT label, attitudes_count AS v, row_number() OVER (PARTITION BY label ORDER BY attitudes_count) AS i,
             count(*) OVER (PARTITION BY label) AS n FROM posts WHERE attitudes_count IS NOT NULL) r,
     (VALUES {", ".join(f"({m})" for m in MILLE)}) m(mille)
WHERE i = greatest(1, (mille * n + 999) // 1000)""", V))(_quantiles)
