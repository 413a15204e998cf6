"""State tables, incremental jobs and their guards; plans and jobs that building a query starts."""

import os

import pytest
from pyspark.sql import functions as F

from murmur import session
from murmur.operators import rollup as RU
from murmur.operators import scoring as SC
from murmur.operators.dedup import latest_per_key
from murmur.plans import catalog, jobs as J
from murmur.schemas import JOB_CHECKPOINT
from murmur.sinks import lake as L
from murmur.sources.posts_view import posts_view, posts_with_text, sentiment_table
from murmur.vocab import FIXTURE as V, REFERENCE

from conftest import SF0001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_state_keeps_all_tasks_and_old_version_on_failure(spark, tmp):
    ck = os.path.join(tmp, "ck")
    L.update_last_dt(spark, ck, "a", "2024-01-01")
    L.update_last_dt(spark, ck, "b", "2024-01-02")
    L.update_last_dt(spark, ck, "a", "2024-01-03")
    assert {(r.task_name, r.last_dt) for r in L.read_versioned(spark, ck, JOB_CHECKPOINT).collect()} == {("a", "2024-01-03"), ("b", "2024-01-02")}
    os.makedirs(os.path.join(ck, "v00000009"))                       # a write that never finished
    assert L.read_last_dt(spark, ck, "b").first().last_dt == "2024-01-02"
    newest = os.path.join(ck, "v00000003")
    for name in os.listdir(newest):
        if name.endswith(".parquet"):
            with open(os.path.join(newest, name), "wb") as f:
                f.write(b"broken")
    with pytest.raises(Exception):
        L.read_last_dt(spark, ck, "b").collect()
    with pytest.raises(Exception):
        L.update_last_dt(spark, ck, "c", "2024-01-04")
    assert L._versions(spark, ck) == [1, 2, 3]


def test_score_job_runs_again_after_a_failed_write(spark, tmp):
    posts = posts_with_text(spark, SF0001, V).drop("label", "score", "confidence")
    out, day = os.path.join(tmp, "sentiment"), "2024-01-10"
    cols = ["id", "text", "label", "label_id", "score", "confidence", "dt"]

    def broken(texts):
        return SC.lexicon_sentiment(V)(texts).withColumn("score", F.raise_error(F.lit("down")).cast("double"))

    with pytest.raises(Exception):
        J.score_job(spark, posts, out, day, broken, cols, "2024-01-12 00:00:00")
    n = J.score_job(spark, posts, out, day, SC.lexicon_sentiment(V), cols, "2024-01-12 00:00:00")
    assert n == spark.read.parquet(out).count() == spark.read.parquet(out).select("id").distinct().count() > 0
    with open(os.path.join(out, f"dt={day}", "part-broken.parquet"), "wb") as f:
        f.write(b"broken")
    with pytest.raises(Exception):                                   # a read error is not a first run
        J.score_job(spark, posts, out, day, SC.lexicon_sentiment(V), cols, "2024-01-12 00:00:00")


def test_scorers_share_one_result_per_text_and_in_place_ones_do_not_shuffle(spark):
    posts = spark.createDataFrame([(i, "same good text", "old") for i in range(5)] + [(9, "", None)], "id long, text string, label string")
    scorer = SC.lexicon_sentiment(V)
    assert "Exchange" not in _plan(SC.score_text(posts, scorer))

    def external(texts):
        return scorer(texts)

    a, b = (sorted(map(str, SC.score_text(posts, s).select("id", "label", "score").collect())) for s in (scorer, external))
    assert a == b and len(a) == 5


def test_last_arrived_copy_wins(spark, tmp):
    old = spark.createDataFrame([("1", "2024-01-01 00:00:00", 500, "2024-01-01")], "id string, created_at string, reposts_count int, dt string")
    L.write_posts_batch(old, tmp + "/l", 0)
    L.write_posts_batch(old.withColumn("reposts_count", F.lit(9)), tmp + "/l", 1)
    assert [r.reposts_count for r in L.read_landing(spark, tmp + "/l").collect()] == [9]
    J.compact_job(spark, tmp + "/l", tmp + "/t", ["2024-01-01"])
    assert [r.reposts_count for r in spark.read.parquet(tmp + "/t").collect()] == [9]


def test_dedup_limits_groups_before_the_shuffle_and_sorts_no_texts(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("id"), F.col("id").alias("n"), F.lit("text").alias("text"))
    plan = _plan(latest_per_key(df, ["id"], "n"))
    assert "WindowGroupLimit" in plan and "SortAggregate" not in plan
    assert {r.n for r in latest_per_key(df, ["id"], "n").collect()} == set(range(90, 100))
    assert "SortAggregate" not in _plan(catalog.queries()["posts_ingest"](spark, SF0001))


def test_rollup_refreshes_late_changed_and_emptied_days(spark, tmp):
    posts, path = posts_view(spark, SF0001, vocab=V).cache(), tmp + "/daily"
    direct = lambda df: {(r.label, r["count"]) for r in df.groupBy("label").count().collect()}
    merged = lambda: {(r.label, r.n) for r in RU.merged(spark.read.parquet(path), ("label",)).collect()}
    first = posts.where("NOT (dt = '2024-01-10' AND CAST(id AS BIGINT) % 2 = 0)")
    assert len(RU.refresh_changed(spark, first, path)) == first.select("dt").distinct().count()
    assert RU.refresh_changed(spark, posts, path) == ["2024-01-10"] and merged() == direct(posts)
    assert RU.refresh_changed(spark, posts, path) == []
    gone = posts.where("dt <> '2024-01-11'")
    assert RU.refresh_changed(spark, gone, path) == ["2024-01-11"] and merged() == direct(gone)


def test_indicator_job_without_posts_publishes_nothing(spark, tmp):
    posts = posts_view(spark, SF0001, vocab=V).limit(0)
    J.indicators_job(posts, sentiment_table(posts), J.Publisher(base_path=tmp + "/serving"), "2024-02-01 00:00:00", V)
    assert not os.path.exists(tmp + "/serving")


def test_indicator_job_from_rollups_equals_the_direct_statistics(spark, tmp):
    posts = posts_view(spark, SF0001, vocab=V)
    for name, kw in (("a", {}), ("b", {"rollup_path": tmp + "/r", "ckpt_path": tmp + "/ck"})):
        J.indicators_job(posts, sentiment_table(posts), J.Publisher(base_path=f"{tmp}/{name}"), "2024-02-01 00:00:00", V, **kw)
    assert sorted(os.listdir(tmp + "/a")) == sorted(os.listdir(tmp + "/b"))
    for t in os.listdir(tmp + "/a"):
        a, b = (spark.read.parquet(f"{tmp}/{x}/{t}") for x in "ab")
        cols = sorted(a.columns)
        assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect())), t
    assert L.read_last_dt(spark, tmp + "/ck", "indicators").first().last_dt == posts.agg(F.max("dt")).first()[0]


def test_cluster_recommend_and_export_jobs(spark, tmp):
    posts = posts_view(spark, SF0001, vocab=V)
    pub = J.Publisher(base_path=tmp + "/serving")
    J.cluster_profile_job(sentiment_table(posts), pub, "2024-02-01 00:00:00", V)
    assert spark.read.parquet(tmp + "/serving/user_gmm_profile").count() > 0
    posts_with_text(spark, SF0001, V).write.partitionBy("dt").parquet(tmp + "/posts")
    J.export_text_job(spark, tmp + "/posts", tmp + "/csv", n=7)
    rows = spark.read.option("header", "true").option("multiLine", "true").csv(tmp + "/csv")
    assert rows.columns == ["bid", "text"] and rows.count() >= 7
    spark.sql(f"CREATE TABLE posts_ext USING parquet LOCATION '{tmp}/posts'")
    L.repair_partitions(spark, "posts_ext")
    assert spark.table("posts_ext").count() == posts.count()
    spark.sql("DROP TABLE posts_ext")


def test_no_machine_local_checkpoints_on_a_cluster():
    assert session._single_process("local") and session._single_process("local[4]")
    assert not any(session._single_process(m) for m in ("local-cluster[2,1,1024]", "yarn", "spark://h:7077", "k8s://x"))


def test_building_a_text_query_runs_no_stage_but_schema_reads(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    try:
        df = catalog.queries()["rule_features"](spark, SF0001)
        built = len(tracker.getJobIdsForGroup("build"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tables = len({f.rsplit("/", 1)[0] for f in df.inputFiles()}) + 5
    assert built <= tables                                            # one schema read a table


def test_blocklist_has_all_terms():
    assert len(REFERENCE.blocklist) == 9 and len(set(REFERENCE.blocklist)) == 9
