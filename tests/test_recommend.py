"""Recommendation: recall by ratio buckets gives exactly the plain-join top N."""

import random

import pytest
from pyspark.sql import functions as F

from murmur.operators import clusters as CL
from murmur.operators import profiles as PR
from murmur.operators import recommend as RC
from murmur.sources.posts_view import posts_with_text, sentiment_table, topic_table
from murmur.vocab import FIXTURE as V

from conftest import SF0001, SF001

TOPICS = ("city", "livelihood", "feedback", "government")
PERIODS = V.periods
REGIONS = ("A", "B", "C")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _synthetic(spark, n_posts=600, n_users=40, seed=7):
    rnd = random.Random(seed)
    finals = [0.5, 0.6, 0.7, 0.75, 0.8, 0.9, 1.0]          # many exact ties
    scores = [0.0, 0.25, 0.5, 0.75, 1.0]
    cands = []
    for i in range(n_posts):
        author = None if i % 37 == 0 else str(rnd.choice(range(n_users)) if i % 5 else 3)  # one prolific author
        cands.append((f"p{i:04d}", author, rnd.choice(TOPICS), rnd.choice(REGIONS),
                      rnd.choice(PERIODS[:3]), rnd.choice(finals), rnd.choice(scores)))
    c = spark.createDataFrame(cands, "id string, author_id string, topic_label string, location string, "
                                     "time_period string, final_score double, score double")
    users = [(str(u), rnd.choice(PERIODS[:3]), rnd.choice(REGIONS)) for u in range(n_users)]
    u = spark.createDataFrame(users, "user_id string, prefer_time_period string, top_focus_region string")
    probs = []
    for uid in range(n_users - 5):                       # five users without a cluster row
        p = [rnd.random() for _ in range(4)]
        s = sum(p)
        probs.append((str(uid), *[x / s for x in p]))
    cl = spark.createDataFrame(probs, "user_id string, prob_0 double, prob_1 double, prob_2 double, prob_3 double")
    return c, u, cl


def _topn(cands, users, clusters, prune, n, rounds=2):
    rec = RC.recall_union(
        RC.recall_region(users, cands, prune, n, V, clusters, rounds=rounds),
        RC.recall_time(users, cands, prune, n, V, clusters, rounds=rounds), V)
    ranked = RC.personalized_rank(rec, clusters, V)
    return RC.recommend_topn(ranked, cands.withColumn("bid", F.col("id")), n)


@pytest.mark.parametrize("n,rounds", [(1, 3), (3, 0), (15, 1)])
def test_pruned_equals_plain_synthetic(spark, n, rounds):
    c, u, cl = _synthetic(spark)
    plain = _rows(_topn(c, u, cl, False, n))
    pruned = _rows(_topn(c, u, cl, True, n, rounds))
    assert plain == pruned
    assert len(plain) > 0


def test_shared_classes_and_prolific_author_fallback(spark):
    """Most users share one probability class; one author owns the best posts of a group."""
    rows = [(f"q{i:03d}", "7", "city", "A", PERIODS[0], 0.99 - i * 0.001, 0.1) for i in range(40)]
    rows += [(f"r{i:03d}", str(10 + i % 9), "city", "A", PERIODS[0], 0.6 + (i % 7) * 0.01, 0.3) for i in range(60)]
    c = spark.createDataFrame(rows, "id string, author_id string, topic_label string, location string, "
                                    "time_period string, final_score double, score double")
    u = spark.createDataFrame([(str(x), PERIODS[0], "A") for x in range(30)],
                              "user_id string, prefer_time_period string, top_focus_region string")
    cl = spark.createDataFrame([(str(x), 0.25, 0.25, 0.25, 0.25) for x in range(30) if x != 3],
                               "user_id string, prob_0 double, prob_1 double, prob_2 double, prob_3 double")
    for n in (3, 15):
        assert _rows(_topn(c, u, cl, False, n)) == _rows(_topn(c, u, cl, True, n))


def test_buckets_bound_the_rows_a_user_joins(spark):
    """Posts on one smooth curve (each best for some ratio) and users who all differ: the hard case for pruning."""
    rnd = random.Random(3)
    posts, n_users, n = 4000, 80, 5
    rows = []
    for i in range(posts):
        x = rnd.random()
        rows.append((f"p{i:04d}", str(1000 + i % 50), "city", "A", PERIODS[0], 0.5 + 0.5 * x, x * x))
    c = spark.createDataFrame(rows, "id string, author_id string, topic_label string, location string, "
                                    "time_period string, final_score double, score double")
    u = spark.createDataFrame([(str(x), PERIODS[0], "A") for x in range(n_users)],
                              "user_id string, prefer_time_period string, top_focus_region string")
    cl = spark.createDataFrame([(str(x), 0.0, 0.0, 0.0, x / n_users) for x in range(n_users)],
                               "user_id string, prob_0 double, prob_1 double, prob_2 double, prob_3 double")
    pruned = RC.recall_time(u, c, True, n, V, cl)
    per_bucket = pruned.groupBy("target_user_id").count().agg(F.max("count"), F.avg("count")).first()
    assert per_bucket[0] <= posts * 0.08, per_bucket          # the smooth curve keeps about the root of a bucket's width
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Arrow" not in plan
    a, b = (_rows(RC.recommend_topn(RC.personalized_rank(RC.recall_union(r, r.limit(0), V), cl, V), c.withColumn("bid", F.col("id")), n))
            for r in (RC.recall_time(u, c, False, n, V, cl), pruned))
    assert a == b


def test_pruned_equals_plain_on_fixture(spark):
    posts = posts_with_text(spark, SF001, V)
    scored = sentiment_table(posts.drop("text"))
    args = (topic_table(posts), scored, PR.user_time_profile(scored), PR.user_region_profile(scored),
            CL.cluster_users(scored, V), "2024-01-31", V)
    plain = _rows(RC.recommend(*args, n=15, prune=False))
    pruned = _rows(RC.recommend(*args, n=15, prune=True))
    assert plain == pruned and len(plain) > 0


def test_recommend_properties(spark):
    posts = posts_with_text(spark, SF0001, V)
    scored = sentiment_table(posts.drop("text"))
    topics = topic_table(posts)
    out = RC.recommend(topics, scored, PR.user_time_profile(scored), PR.user_region_profile(scored),
                       CL.cluster_users(scored, V), "2024-01-31", V, n=15)
    authors = {r.id: r.user_id for r in topics.select("id", "user_id").collect()}
    rows = out.collect()
    per_user = {}
    for r in rows:
        per_user.setdefault(r.user_id, []).append(r)
        assert authors[r.post_id] != r.user_id              # never one's own post
        assert r.recall_reason in V.recall_reasons
    assert all(len(v) <= 15 for v in per_user.values())
    for v in per_user.values():                               # one row per (user, post)
        assert len({r.post_id for r in v}) == len(v)


def test_candidate_scored_edge_cases(spark):
    pool = spark.createDataFrame([("1", "b1", "u1", "s", "city", "A", "p"), ("2", "b2", "u2", "s", "city", "A", "p")],
                                 "id string, bid string, author_id string, screen_name string, topic_label string, "
                                 "location string, time_period string")
    sent = spark.createDataFrame([("1", 0.9, 10, 10, 10), ("2", 0.9, 10, 10, 10)],
                                 "id string, score double, reposts_count int, comments_count int, attitudes_count int")
    got = {r.id: r.final_score for r in RC.candidate_scored(pool, sent).collect()}
    # equal hot scores: range falls back to 1, norm = 0, final = 0.4 * 0.9 < 0.5 -> empty
    assert got == {}
    sent2 = sent.where(F.col("id") == "1")                   # post 2 has no sentiment row
    got2 = {r.id: (r.final_score, r.score) for r in RC.candidate_scored(pool, sent2).collect()}
    assert got2 == {"1": (pytest.approx(0.6 + 0.36), 0.9)}
    empty = RC.candidate_scored(pool.limit(0), sent)
    assert empty.count() == 0


def test_both_channels_keep_region_reason(spark):
    c = spark.createDataFrame([("p1", "9", "city", "A", PERIODS[0], 0.9, 0.5)],
                              "id string, author_id string, topic_label string, location string, "
                              "time_period string, final_score double, score double")
    u = spark.createDataFrame([("1", PERIODS[0], "A")], "user_id string, prefer_time_period string, top_focus_region string")
    rec = RC.recall_union(RC.recall_region(u, c, vocab=V), RC.recall_time(u, c, vocab=V), V).collect()
    assert [(r.target_user_id, r.id, r.recall_reason) for r in rec] == [("1", "p1", "region")]


@pytest.mark.parametrize("m", [14, 15, 16])
def test_users_with_14_15_16_candidates(spark, m):
    rows = [(f"p{i:02d}", str(100 + i), "city", "A", PERIODS[0], 0.5 + i / 100, 0.5) for i in range(m)]
    c = spark.createDataFrame(rows, "id string, author_id string, topic_label string, location string, "
                                    "time_period string, final_score double, score double")
    u = spark.createDataFrame([("1", PERIODS[0], "A"), ("2", PERIODS[1], "B")],
                              "user_id string, prefer_time_period string, top_focus_region string")
    cl = spark.createDataFrame([("1", 0.1, 0.2, 0.3, 0.4)], "user_id string, prob_0 double, prob_1 double, "
                                                              "prob_2 double, prob_3 double")
    got = _rows(_topn(c, u, cl, True, 15))
    assert got == _rows(_topn(c, u, cl, False, 15))
    assert len(got) == min(m, 15) and {r[0] for r in got} == {"1"}


def test_null_author_posts_do_not_force_fallback(spark):
    """Many top posts without author: every user still gets an exact list, no mass fallback."""
    rows = [(f"n{i:02d}", None, "city", "A", PERIODS[0], 0.99 - i / 1000, 0.2) for i in range(40)]
    rows += [(f"a{i:02d}", str(50 + i), "city", "A", PERIODS[0], 0.6 + i / 1000, 0.2) for i in range(20)]
    c = spark.createDataFrame(rows, "id string, author_id string, topic_label string, location string, "
                                    "time_period string, final_score double, score double")
    u = spark.createDataFrame([(str(x), PERIODS[0], "A") for x in range(10)],
                              "user_id string, prefer_time_period string, top_focus_region string")
    cl = spark.createDataFrame([(str(x), 0.25, 0.25, 0.25, 0.25) for x in range(10)],
                               "user_id string, prob_0 double, prob_1 double, prob_2 double, prob_3 double")
    assert _rows(_topn(c, u, cl, False, 15)) == _rows(_topn(c, u, cl, True, 15))


def test_features_of_the_mixture_are_computed_once(spark, monkeypatch):
    from murmur.operators import clusters
    from murmur.plans import catalog
    from conftest import SF0001
    seen, fit = [], clusters.fit_clusters
    monkeypatch.setattr(clusters, "fit_clusters", lambda seg, **kw: seen.append(seg) or fit(seg, **kw))
    catalog.queries()["recommend_topn_gmm"](spark, SF0001)
    assert "parquet" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()     # no step of the fit reads the tables


def test_pool_is_joined_to_its_scores_once(spark):
    from murmur.operators import recommend
    pool = spark.createDataFrame([(str(i), "a", "e") for i in range(6)], "id string, author_id string, topic_label string")
    scored = spark.createDataFrame([(str(i), i / 6, 10 * i, 0, 0) for i in range(5)],
                                   "id string, score double, reposts_count int, comments_count int, attitudes_count int")
    out = recommend.candidate_scored(pool, scored)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()            # min, max and rows read what is stored
    assert sorted(r["id"] for r in out.collect()) == ["2", "3", "4"]
