"""Sinks (replay-safe landing, upsert, blue/green, export, job checkpoint) and streaming."""

import json
import os

import pytest
from pyspark.sql import functions as F

from murmur.operators import clean as C
from murmur.sinks import lake as L
from murmur.sources.files import read_training_csv
from murmur.sources.posts_view import posts_with_text, raw_messages
from murmur.streaming import ingest as S
from murmur.vocab import FIXTURE as V

from conftest import SF0001


def _posts(spark):
    return spark.createDataFrame(
        [("1", "2024-01-01", "2024-01-01 10:00:00", 5), ("2", "2024-01-01", "2024-01-01 11:00:00", 6),
         ("3", "2024-01-02", "2024-01-02 09:00:00", 7)],
        "id string, dt string, created_at string, reposts_count int").withColumn(
        "created_at", F.to_timestamp("created_at"))


def test_batch_replay_is_idempotent(spark, tmp):
    path = os.path.join(tmp, "landing")
    df = _posts(spark)
    L.write_posts_batch(df, path, 0)
    L.write_posts_batch(df.where(F.col("id") == "3"), path, 1)
    L.write_posts_batch(df.where(F.col("id") == "3"), path, 1)      # replay of batch 1
    assert spark.read.parquet(path).count() == 4                    # batch 0 (3) + batch 1 (1)
    assert L.read_landing(spark, path).count() == 3                 # (dt, id) dedup on read


def test_upsert_merge_and_partitioned(spark, tmp):
    old = _posts(spark)
    new = spark.createDataFrame([("3", "2024-01-02", None, 70), ("4", "2024-01-02", None, 8)],
                                "id string, dt string, created_at timestamp, reposts_count int")
    got = {r.id: r.reposts_count for r in L.upsert_merge(old, new, ["id"]).collect()}
    assert got == {"1": 5, "2": 6, "3": 70, "4": 8}
    path = os.path.join(tmp, "table")
    old.write.partitionBy("dt").parquet(path)
    L.upsert_partitioned(spark, new, path, ["id"])
    got = {r.id: r.reposts_count for r in spark.read.parquet(path).collect()}
    assert got == {"1": 5, "2": 6, "3": 70, "4": 8}


def test_blue_green_switch(spark, tmp):
    base = os.path.join(tmp, "rec")
    df = _posts(spark)
    a = L.publish_blue_green(spark, df, "v_rec_test", base)
    assert spark.table("v_rec_test").count() == 3
    b = L.publish_blue_green(spark, df.limit(1), "v_rec_test", base)
    assert {a, b} == {"v1", "v2"} and spark.table("v_rec_test").count() == 1
    c = L.publish_blue_green(spark, df, "v_rec_test", base)
    assert c == a and spark.table("v_rec_test").count() == 3


def test_export_and_job_checkpoint(spark, tmp):
    posts = posts_with_text(spark, SF0001, V)
    out = os.path.join(tmp, "export")
    L.export_text_sample(posts, out, n=50)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    back = spark.read.option("header", "true").option("multiLine", "true").csv(out)
    assert back.columns == ["bid", "text"] and back.count() == 50
    ck = os.path.join(tmp, "ck")
    assert L.read_last_dt(spark, ck, "t").first().last_dt == "1970-01-01"
    L.update_last_dt(spark, ck, "t", "2024-01-05")
    L.update_last_dt(spark, ck, "u", "2024-01-03")
    L.update_last_dt(spark, ck, "t", "2024-01-07")
    assert L.read_last_dt(spark, ck, "t").first().last_dt == "2024-01-07"
    assert L.read_last_dt(spark, ck, "u").first().last_dt == "2024-01-03"


def test_training_csv_gbk(spark, tmp):
    p = os.path.join(tmp, "train.csv")
    with open(p, "w", encoding="gbk") as f:
        f.write("text,reposts_count,comments_count,attitudes_count,label\n")
        f.write("免费领取红包,1,2,3,0\n正常的内容,4,5,6,1\n没有标签,1,1,1,\n")
    df = read_training_csv(spark, p)
    got = sorted((r.text, r.label) for r in df.collect())
    assert got == [("免费领取红包", 0.0), ("正常的内容", 1.0)]


def _write_messages(spark, msgs, path):
    spark.createDataFrame([(m,) for m in msgs], "value string").coalesce(1).write.mode("append").text(path)


def test_stream_equals_batch_with_duplicates_and_rejects(spark, tmp):
    inp, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    raw = raw_messages(posts_with_text(spark, SF0001, V))
    msgs = [r.json_data for r in raw.collect()]
    _write_messages(spark, msgs[:500], inp)
    _write_messages(spark, msgs[250:], inp)                       # overlapping re-delivery
    first = json.loads(msgs[0])
    shadow = dict(first, created_at=None, text="a null-time copy of the same id")
    _write_messages(spark, [json.dumps({"id": "x", "text": "no time here at all"}), "{bad", json.dumps(shadow)], inp)
    q = S.write_posts_stream(S.clean_stream(S.read_post_stream(spark, "files", inp, max_files_per_trigger=1),
                                            V, watermark="40 days"), out, ck, available_now=True)
    q.awaitTermination()
    got = L.read_landing(spark, out)
    batch = C.derive_time(C.clean_posts(C.parse_posts(raw), V), V)
    assert sorted(r.id for r in got.select("id").collect()) == sorted(r.id for r in batch.select("id").collect())
    assert got.where(F.col("id") == "x").count() == 0
    kept = got.where(F.col("id") == first["id"]).select("text").collect()   # the good copy survives
    assert [r.text for r in kept] == [r.text for r in batch.where(F.col("id") == first["id"]).select("text").collect()]


def test_stream_replay_after_failure(spark, tmp):
    inp, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    raw = raw_messages(posts_with_text(spark, SF0001, V))
    _write_messages(spark, [r.json_data for r in raw.collect()], inp)
    flag = os.path.join(tmp, "failed_once")

    def flaky(df, bid):
        L.write_posts_batch(df, out, bid)
        if not os.path.exists(flag):
            open(flag, "w").close()
            raise RuntimeError("sink failure after the write")

    stream = S.clean_stream(S.read_post_stream(spark, "files", inp), V, watermark="40 days")
    q = stream.writeStream.foreachBatch(flaky).option("checkpointLocation", ck).trigger(availableNow=True).start()
    with pytest.raises(Exception):
        q.awaitTermination()
    q2 = S.write_posts_stream(stream, out, ck, available_now=True)
    q2.awaitTermination()
    n = raw.count()
    landed = spark.read.parquet(out)
    assert landed.count() == landed.select("id").distinct().count()    # replay overwrote its partitions
    assert L.read_landing(spark, out).count() <= n
    assert L.read_landing(spark, out).count() == C.clean_posts(C.parse_posts(raw), V).count()


def test_hourly_volume_stream(spark, tmp):
    inp = os.path.join(tmp, "in")
    raw = raw_messages(posts_with_text(spark, SF0001, V))
    _write_messages(spark, [r.json_data for r in raw.collect()], inp)
    posts = S.clean_stream(S.read_post_stream(spark, "files", inp), V, watermark="40 days")
    q = (S.hourly_volume_stream(posts).writeStream.outputMode("update").format("memory")
         .queryName("hv_test").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {r.hour_start: r.posts for r in spark.table("hv_test").collect()}
    batch = C.derive_time(C.clean_posts(C.parse_posts(raw), V), V)
    want = {r[0]: r[1] for r in batch.groupBy(F.date_trunc("hour", "created_at")).count().collect()}
    assert got == want


def test_compact_day_is_rerunnable(spark, tmp):
    landing, target = os.path.join(tmp, "landing"), os.path.join(tmp, "posts")
    df = _posts(spark)
    L.write_posts_batch(df, landing, 0)
    L.write_posts_batch(df.where(F.col("id") == "1").withColumn("reposts_count", F.lit(50))
                        .withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 1 MINUTE")), landing, 1)
    for _ in range(2):                                   # a rerun gives the same day partition
        L.compact_day(spark, landing, target, "2024-01-01")
    got = {r.id: r.reposts_count for r in spark.read.parquet(target).collect()}
    assert got == {"1": 50, "2": 6}                      # newest copy of id 1; only that day written


def test_messages_are_dealt_over_files_of_a_bounded_size(spark, tmp, monkeypatch):
    """Five micro-batches, whatever the number of files, and no file or task holds a fifth of the messages."""
    from murmur.plans import io_queries as Q
    monkeypatch.setattr(Q, "MESSAGES_A_FILE", 50)
    Q._message_stream(spark, raw_messages(Q._dealt_texts(spark, SF0001)), tmp)
    read = spark.read.text(tmp + "/in").select("value", F.input_file_name().alias("f"))
    sizes = [r["count"] for r in read.groupBy("f").count().collect()]
    want = spark.read.parquet(f"{SF0001}/events.parquet").count()
    assert max(sizes) <= 50 and sum(sizes) == want and len(sizes) > 5
