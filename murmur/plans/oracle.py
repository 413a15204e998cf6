"""DuckDB SQL building blocks for the oracle side of every registered query.

The ``posts`` CTE is the same view as :func:`murmur.sources.posts_view.posts_view`
written in plain SQL over the given tables.
"""

from __future__ import annotations

from murmur.vocab import FIXTURE, Vocab


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(vals) -> str:
    return "(" + ", ".join(q(v) for v in vals) + ")"


def sround(x: str, n: int) -> str:
    """ROUND HALF_UP on the shortest decimal text of a double (as Spark does)."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def period_case(hour: str, v: Vocab = FIXTURE) -> str:
    b, p = v.period_bounds, v.periods
    parts = [f"WHEN {hour} < {bound} THEN {q(name)}" for bound, name in zip(b, p[:5])]
    return "CASE " + " ".join(parts) + f" ELSE {q(p[5])} END"


def posts_cte(v: Vocab = FIXTURE, with_text: bool = False) -> str:
    text_col = ", d.text AS text" if with_text else ""
    text_join = ("LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)"
                 if with_text else "")
    return f"""posts_base AS (
  SELECT CAST(e.event_id AS VARCHAR) AS id,
         'b' || CAST(e.event_id AS VARCHAR) AS bid,
         CAST(e.user_id AS VARCHAR) AS user_id,
         c.c_name || CASE WHEN e.user_id % 11 = 0 THEN ' news' ELSE '' END AS screen_name,
         CASE WHEN e.event_id % 3 = 0 THEN '#' || e.event_type || '#' END AS topics,
         CAST(floor(e.value * 10) AS INTEGER) AS reposts_count,
         CAST(floor(e.value * 3) AS INTEGER) AS comments_count,
         CAST(floor(e.value * 20) AS INTEGER) AS attitudes_count,
         CASE WHEN e.user_id % 13 = 5 THEN CAST(date_trunc('day', e.ts) AS TIMESTAMP) + INTERVAL 12 HOUR
              ELSE e.ts END AS created_at,
         CASE WHEN e.user_id % 13 = 5 OR e.event_id % 10 = 0 THEN NULL
              WHEN e.event_id % 10 = 1 THEN ''
              WHEN e.event_id % 10 IN (2, 3) THEN r.r_name || ' | ' || n.n_name
              ELSE r.r_name END AS location,
         CASE e.user_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'Official media'
              WHEN 2 THEN 'Institution' WHEN 3 THEN 'Celebrity' END AS user_authentication,
         CASE WHEN e.event_id % 50 = 7 THEN NULL
              WHEN e.user_id % 13 = 5 THEN {q(v.neutral)}
              WHEN e.event_type IN ('purchase', 'signup') THEN {q(v.positive)}
              WHEN e.event_type = 'error' THEN {q(v.negative)}
              ELSE {q(v.neutral)} END AS label,
         CASE WHEN e.user_id % 13 = 5 THEN CAST(0.5 AS DOUBLE) ELSE e.value / (e.value + 50.0) END AS score,
         CAST((e.event_id * 37) % 100 AS DOUBLE) / 100.0 AS confidence,
         CASE e.event_id % 5 WHEN 0 THEN 'city' WHEN 1 THEN 'livelihood'
              WHEN 2 THEN 'feedback' WHEN 3 THEN 'government' END AS topic_label
         {text_col}
  FROM events e
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN nation n ON n.n_nationkey = (e.user_id * 7 + e.event_id % 3) % 25
  JOIN region r ON r.r_regionkey = n.n_regionkey
  {text_join}
),
posts AS (
  SELECT *, CAST(hour(created_at) AS INTEGER) AS hour,
         {period_case('hour(created_at)', v)} AS time_period,
         strftime(created_at, '%Y-%m-%d') AS dt
  FROM posts_base
)"""


def with_posts(body: str, v: Vocab = FIXTURE, with_text: bool = False, extra_ctes: str = "") -> str:
    ctes = posts_cte(v, with_text)
    if extra_ctes:
        ctes += ",\n" + extra_ctes
    return f"WITH {ctes}\n{body}"


SCORED = "scored AS (SELECT * FROM posts WHERE label IS NOT NULL)"

REGIONS = """regions AS (
  SELECT p.*, rg.region
  FROM posts p, unnest(string_split(p.location, ' | ')) AS rg(region)
  WHERE p.location IS NOT NULL AND p.location <> '' AND rg.region <> ''
)"""
