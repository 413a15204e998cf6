"""Statistics and profile edge cases on hand-made frames."""

import datetime as dt

import pytest

from murmur.operators import clusters as CL
from murmur.operators import indicators as IND
from murmur.operators import profiles as PR
from murmur.vocab import FIXTURE as V

SCHEMA = ("id string, user_id string, screen_name string, user_authentication string, label string, "
          "score double, confidence double, reposts_count int, comments_count int, attitudes_count int, "
          "location string, hour int, time_period string, dt string, created_at timestamp")
P = V.periods


def _row(i, user, hour, label=V.neutral, score=0.5, conf=0.5, loc=None, auth=None, name=None, r=0, c=0, a=0):
    return (str(i), user, name or f"user{user}", auth, label, score, conf, r, c, a, loc, hour,
            P[0] if hour < 6 else P[3], "2024-01-01", dt.datetime(2024, 1, 1, hour, i % 60))


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_single_post_user_and_night_ratio(spark):
    df = _df(spark, [_row(1, "u1", 23), _row(2, "u2", 3), _row(3, "u2", 4), _row(4, "u2", 22)])
    got = {r.user_id: r for r in PR.user_time_profile(df).collect()}
    assert got["u1"].hourly_sentiment_stddev == 0.0          # one post: stddev NULL -> 0
    assert got["u1"].night_post_ratio == 1.0
    assert got["u2"].night_post_ratio == pytest.approx(0.3333)  # 3h is night, 4h and 22h are not


def test_ties_are_broken_deterministically(spark):
    rows = [_row(1, "u", 1, score=0.2), _row(2, "u", 13, score=0.8),     # one post per period: count tie
            _row(3, "v", 5, loc="B"), _row(4, "v", 7, loc="A")]          # region tie A/B
    df = _df(spark, rows)
    pref = {r.user_id: r for r in PR.user_period_pref(df).collect()}
    assert pref["u"].prefer_time_period == min(P[0], P[3])            # ties -> name ascending
    assert pref["u"].emo_time_period == P[0] and pref["u"].high_time_period == P[3]
    top = {r.user_id: r.top_focus_region for r in PR.user_region_profile(df).collect()}
    assert top["v"] == "A"
    hours = {r.user_id: r.prefer_hour for r in PR.user_prefer_hour(df).collect()}
    assert hours["u"] == 1


def test_null_scores_sort_first_for_most_negative(spark):
    rows = [_row(1, "u", 1, score=None), _row(2, "u", 13, score=0.1)]
    pref = PR.user_period_pref(_df(spark, rows)).first()
    assert pref.emo_time_period == P[0]                               # NULL average first (asc)
    assert pref.high_time_period == P[3]                              # NULL last (desc)


def test_auth_profile_denominators_and_leverage(spark):
    rows = [_row(1, "u", 10, label=V.positive, r=10, c=0, a=0, auth="Official media"),
            _row(2, "u", 11, label=V.negative, r=30, c=0, a=0),
            _row(3, "u", 12, label=V.neutral, r=0)]
    p = PR.user_auth_profile(_df(spark, rows), V).first()
    assert p.pos_interaction_avg == pytest.approx(3.33) and p.neg_interaction_avg == 10.0  # / all 3 posts
    assert p.sentiment_leverage == 3.0 and p.is_official == 1
    p2 = PR.user_auth_profile(_df(spark, rows), V, denominator="label").first()
    assert p2.pos_interaction_avg == 10.0 and p2.neg_interaction_avg == 30.0
    lev = PR.sentiment_leverage(_df(spark, [_row(1, "w", 10, label=V.negative, r=9)]), V).first()
    assert lev.sentiment_leverage == 9.0                              # no positive posts: divisor 1


def test_segments_partition_users_and_are_null_safe(spark):
    rows = [_row(1, "off", 12, auth="Official media"), _row(2, "news", 12, name="daily news"),
            _row(3, "quiet", 12), _row(4, "quiet", 12),
            _row(5, "act", 1, score=0.1, loc="A"), _row(6, "act", 2, score=0.9, loc="B"),
            _row(7, "nul", 12, name=None)]
    df = _df(spark, rows).na.fill({"screen_name": ""})
    seg = {r.user_id: r.segment for r in CL.segment_users(CL.user_features(df, V), V).collect()}
    assert seg == {"off": "official", "news": "official", "quiet": "silent", "act": "active", "nul": "silent"}
    prof = {r.user_id: r for r in CL.cluster_users(df, V).collect()}
    assert prof["off"].cluster_id == 99 and prof["off"].prob_0 == 0.0
    assert prof["quiet"].cluster_id == -1 and prof["quiet"].prob_3 == 0.25


def test_region_heat_having_and_confidence_levels(spark):
    rows = [_row(i, "u", 10, loc="A") for i in range(5)] + [_row(10 + i, "u", 10, loc="B") for i in range(4)]
    rh = {r.region: r["count"] for r in IND.region_heat(_df(spark, rows)).collect()}
    assert rh == {"A": 5}                                           # 4 posts: below HAVING
    conf = [_row(1, "u", 1, conf=0.9), _row(2, "u", 1, conf=0.7), _row(3, "u", 1, conf=0.69)]
    lv = {r.level: r.value for r in IND.confidence_level_count(_df(spark, conf), V).collect()}
    assert lv == {V.confidence_levels[0]: 1, V.confidence_levels[1]: 1, V.confidence_levels[2]: 1}


def test_day_ratio_sums_to_100_and_grouping_sets(spark):
    from murmur.sources.posts_view import posts_view, sentiment_table
    from conftest import SF0001
    posts = posts_view(spark, SF0001, vocab=V)
    r = IND.day_label_ratio(sentiment_table(posts)).groupBy("dt").sum("ratio").collect()
    assert all(abs(x[1] - 100) < 0.05 for x in r)
    g = IND.grouping_sets_overview(posts)
    n = posts.count()
    assert g.where("g_period = 1").groupBy().sum("count").first()[0] == n
    assert g.where("g_auth = 1").groupBy().sum("count").first()[0] == n
    assert g.where("g_auth = 0 and g_period = 0").groupBy().sum("count").first()[0] == n
