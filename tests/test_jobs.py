"""Composed jobs end to end on the fixture (Parquet publisher, no external services)."""

import os

from pyspark.sql import functions as F

from murmur.operators import scoring as SC
from murmur.plans import jobs as J
from murmur.sources.posts_view import posts_view, posts_with_text, sentiment_table
from murmur.vocab import FIXTURE as V

from conftest import SF0001


def test_score_job_is_incremental(spark, tmp):
    posts = posts_with_text(spark, SF0001, V).drop("label", "score", "confidence")
    out = os.path.join(tmp, "sentiment")
    cols = ["id", "text", "label", "label_id", "score", "confidence", "dt"]
    day = "2024-01-10"
    n1 = J.score_job(spark, posts, out, day, SC.lexicon_sentiment(V), cols, "2024-01-12 00:00:00")
    assert n1 == posts.where(F.col("dt") == day).count() > 0
    n2 = J.score_job(spark, posts, out, day, SC.lexicon_sentiment(V), cols, "2024-01-12 00:10:00")
    assert n2 == 0                                       # nothing new: nothing rescored
    assert spark.read.parquet(out).count() == n1


def test_indicator_and_portrait_jobs_publish(spark, tmp):
    posts = posts_view(spark, SF0001, vocab=V)
    pub = J.Publisher(base_path=os.path.join(tmp, "serving"))
    J.indicators_job(posts, sentiment_table(posts), pub, "2024-02-01 00:00:00", V)
    J.user_portrait_job(sentiment_table(posts), pub, "2024-02-01 00:00:00", V)
    names = set(os.listdir(os.path.join(tmp, "serving")))
    assert {"day_post_count", "day_label_ratio", "region_hot", "user_time_sentiment_profile"} <= names
    d = spark.read.parquet(os.path.join(tmp, "serving", "day_post_count"))
    assert d.agg(F.sum("count")).first()[0] == posts.count()
    assert d.select("create_time").distinct().first()[0] == "2024-02-01 00:00:00"


def test_run_once_per_day(spark, tmp):
    ck = os.path.join(tmp, "ck")
    calls = []
    assert J.run_once_per_day(spark, ck, "nightly", "2024-01-05", lambda: calls.append(1))
    assert not J.run_once_per_day(spark, ck, "nightly", "2024-01-05", lambda: calls.append(1))
    assert J.run_once_per_day(spark, ck, "nightly", "2024-01-06", lambda: calls.append(1))
    assert calls == [1, 1]
    assert J.scored_day("2024-01-05") == "2024-01-03"


def test_ingest_job_with_saved_spam_model(spark, tmp):
    from murmur.operators import spam as SP
    from murmur.sinks import lake as L
    from murmur.sources.posts_view import raw_messages
    from murmur.sources.tables import table
    posts = posts_with_text(spark, SF0001, V, keep_doc_id=True)
    lab = table(spark, SF0001, "labels").select("doc_id", F.col("quality").alias("label"))
    model_path = os.path.join(tmp, "spam_model")
    ev = J.train_spam_job(spark, posts.drop("label").join(lab, "doc_id"), model_path, V)
    assert ev.first().total > 0
    inp = os.path.join(tmp, "in")
    raw_messages(posts).write.text(inp)
    q = J.ingest_job(spark, os.path.join(tmp, "landing"), os.path.join(tmp, "ck"), source="files",
                     model_path=model_path, vocab=V, available_now=True, path=inp)
    q.awaitTermination()
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
    metrics = q.lastProgress["observedMetrics"]["ingest"] if q.lastProgress else None
    landed = L.read_landing(spark, os.path.join(tmp, "landing"))
    assert 0 < landed.count() <= posts.count()
    assert metrics is None or metrics["messages"] >= 0


def test_rollup_refresh_only_touched_days(spark, tmp):
    from murmur.operators import rollup as RU
    posts = posts_view(spark, SF0001, vocab=V)
    path = os.path.join(tmp, "rollup")
    RU.refresh_rollup(spark, posts, path)
    base = RU.merged(spark.read.parquet(path), ("user_authentication",))
    assert base.agg(F.sum("n")).first()[0] == posts.count()
    before = {r.dt for r in spark.read.parquet(path).select("dt").distinct().collect()}
    # a re-crawl of one day with one post dropped: only that partition is rewritten
    day = "2024-01-10"
    changed = posts.where((F.col("dt") != day) | (F.col("id") != posts.where(F.col("dt") == day).first().id))
    RU.refresh_rollup(spark, changed, path, days=[day])
    after = spark.read.parquet(path)
    assert {r.dt for r in after.select("dt").distinct().collect()} == before
    assert RU.merged(after, ("user_authentication",)).agg(F.sum("n")).first()[0] == posts.count() - 1


def test_indicators_from_rollups_equal_direct(spark, tmp):
    posts = posts_view(spark, SF0001, vocab=V)
    scored = sentiment_table(posts)
    direct, rolled = (J.Publisher(base_path=os.path.join(tmp, x)) for x in ("direct", "rolled"))
    J.indicators_job(posts, scored, direct, "t", V)
    J.indicators_job(posts, scored, rolled, "t", V, rollup_path=os.path.join(tmp, "ru"),
                     ckpt_path=os.path.join(tmp, "ck"))
    J.indicators_job(posts, scored, rolled, "t", V, rollup_path=os.path.join(tmp, "ru"),
                     ckpt_path=os.path.join(tmp, "ck"))                    # second run: only the last day
    for name in ("label_count", "label_count_by_time", "user_auth_label_count", "interaction_count_by_label"):
        a = spark.read.parquet(os.path.join(tmp, "direct", name))
        b = spark.read.parquet(os.path.join(tmp, "rolled", name)).select(*a.columns)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
