"""Registered source / sink / stream queries (each reads the given tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.operators.dedup import latest_per_key
from murmur.plans.oracle import with_posts
from murmur.plans.registry import register
from murmur.plans.text_queries import CLEAN_SQL_BODY
from murmur.session import scratch_path
from murmur.sinks.lake import incremental_since, read_landing, upsert_merge
from murmur.sources.posts_view import attach_text, posts_view, posts_with_text, raw_messages
from murmur.sources.tables import read_day, read_table_dedup, read_text_sample
from murmur.streaming.ingest import clean_stream, read_post_stream, write_posts_stream
from murmur.vocab import FIXTURE as V

VIEW_COLS = ("id, bid, user_id, screen_name, topics, reposts_count, comments_count, attitudes_count, "
             "strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, location, user_authentication, label, "
             "score, confidence, topic_label, hour, time_period, dt")


def _present(df):
    """Timestamps as text for engine-neutral comparison."""
    return df.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


def _posts(s, d):
    return posts_view(s, d, vocab=V)


# SRC4: every post crawled twice with the same created_at; the copy that arrived last wins, whatever its values
def _recrawled(s, d):
    first = _posts(s, d).withColumn("reposts_count", F.col("reposts_count") + 500).withColumn("batch_id", F.lit(0))
    return first.unionByName(_posts(s, d).withColumn("batch_id", F.lit(1)))


register("read_table_dedup", with_posts(f"SELECT {VIEW_COLS} FROM posts", V))(
    lambda s, d: _present(read_table_dedup(_recrawled(s, d)).drop("batch_id")))

# SRC5/6: one day partition
register("read_day", with_posts(f"SELECT {VIEW_COLS} FROM posts WHERE dt = '2024-01-15'", V))(
    lambda s, d: _present(read_day(_posts(s, d), "2024-01-15")))

# SRC8/SO2: training-text sample (bid, text), first 10 000 by id
register("export_text_sample", with_posts(
    "SELECT bid, text FROM posts WHERE text IS NOT NULL AND text <> '' ORDER BY id LIMIT 500", V, with_text=True))(
    lambda s, d: read_text_sample(posts_with_text(s, d, V), 500))

# SNK9 (lake form): re-crawled counters of the last three days replace the old rows, each crawled
# twice (the copy with more reposts wins), and a tenth of them again under a new id (inserts)
_NEW_SQL = ("SELECT id, bid, user_id, screen_name, topics, reposts_count + 1 AS reposts_count, comments_count, "
            "attitudes_count, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, location, "
            "user_authentication, label, score, confidence, topic_label, hour, time_period, dt "
            "FROM posts WHERE dt >= '2024-01-28'")
_INSERT_SQL = _NEW_SQL.replace("SELECT id,", "SELECT 'n' || id AS id,").replace("WHERE dt", "WHERE CAST(id AS BIGINT) % 10 = 0 AND dt")


def _upsert(s, d):
    old = _posts(s, d)
    new = old.where(F.col("dt") >= "2024-01-28").withColumn("reposts_count", F.col("reposts_count") + 1)
    extra = new.where("CAST(id AS BIGINT) % 10 = 0").withColumn("id", F.concat(F.lit("n"), "id"))
    new = new.unionByName(extra)
    stale = new.withColumn("reposts_count", F.col("reposts_count") - 1)
    return _present(upsert_merge(old, stale.unionByName(new), ["id"], "reposts_count"))


register("upsert_merge", with_posts(
    f"SELECT {VIEW_COLS} FROM posts WHERE NOT (dt >= '2024-01-28') UNION ALL {_NEW_SQL} UNION ALL {_INSERT_SQL}", V))(_upsert)

# SNK12: only days after the last processed one
register("incremental_since", with_posts(
    'SELECT dt, count(*) AS "count" FROM posts WHERE dt > \'2024-01-20\' GROUP BY dt', V))(
    lambda s, d: incremental_since(_posts(s, d), "2024-01-20").groupBy("dt").agg(F.count(F.lit(1)).alias("count")))

# ST4 on its own: deterministic newest-copy dedup of a frame with changed copies
register("dedup_latest", with_posts(
    """SELECT id, reposts_count FROM (
         SELECT id, reposts_count, row_number() OVER (PARTITION BY id ORDER BY created_at DESC, reposts_count DESC) AS rn
         FROM (SELECT id, created_at, reposts_count FROM posts
               UNION ALL SELECT id, created_at + INTERVAL 1 MINUTE, reposts_count + 5 FROM posts) u) t
       WHERE rn = 1""", V))(
    lambda s, d: latest_per_key(
        _posts(s, d).select("id", "created_at", "reposts_count").unionByName(
            _posts(s, d).select("id", (F.col("created_at") + F.expr("INTERVAL 1 MINUTE")).alias("created_at"),
                                (F.col("reposts_count") + 5).alias("reposts_count"))),
        ["id"], "created_at").select("id", "reposts_count"))


# STR1-STR6: the given posts as JSON message files -> streaming ingest -> landing table
BATCHES = 5
MESSAGES_A_FILE = 50_000


def _dealt(posts):
    """Posts dealt by id over so many tasks that a file holds posts of all days and no task holds a fifth of them."""
    s = posts.sparkSession
    n = max(BATCHES, s.sparkContext.defaultParallelism, int(s.conf.get("spark.sql.shuffle.partitions")))
    return posts.repartition(n, F.xxhash64(*posts.columns))


def _dealt_texts(s, d):
    """Dealt before the texts are attached, which are not shuffled again."""
    return attach_text(s, d, _dealt(_posts(s, d)))


def _message_stream(s, messages, base):
    """The messages in compressed files of a bounded size, read in ``BATCHES`` micro-batches."""
    (messages.write.option("compression", "gzip").option("maxRecordsPerFile", MESSAGES_A_FILE).text(f"{base}/in"))
    files = len(s.read.text(f"{base}/in").inputFiles())
    return read_post_stream(s, "files", f"{base}/in", max_files_per_trigger=max(1, -(-files // BATCHES)))


def _finish(q):
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _stream_ingest(s, d):
    base = scratch_path(s, "stream")
    raw = _message_stream(s, raw_messages(_dealt_texts(s, d)), base)
    _finish(write_posts_stream(clean_stream(raw, V), f"{base}/out", f"{base}/ckpt", available_now=True))
    return _present(read_landing(s, f"{base}/out"))


register("stream_ingest", with_posts(
    f"""SELECT id, bid, user_id, screen_name, text, location, topics, reposts_count, comments_count,
           attitudes_count, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, user_authentication,
           hour, time_period, dt FROM ({CLEAN_SQL_BODY.replace('created_at,', "date_trunc('minute', created_at) AS created_at,", 1)}) c""",
    V, with_text=True))(_stream_ingest)


# STR2: messages whose time cannot be read are kept aside, not dropped
def _stream_rejected(s, d):
    from murmur.streaming.ingest import rejected_stream, write_rejected_stream
    base = scratch_path(s, "rejected")
    raw = raw_messages(_dealt_texts(s, d))
    spoilt = F.get_json_object("json_data", "$.id").cast("long") % 10 == 0
    raw = raw.withColumn("json_data", F.when(spoilt, F.regexp_replace("json_data", '"created_at":"[^"]*"', '"created_at":"soon"'))
                         .otherwise(F.col("json_data")))
    _finish(write_rejected_stream(rejected_stream(_message_stream(s, raw, base), V), f"{base}/out", f"{base}/ckpt", available_now=True))
    return s.read.parquet(f"{base}/out").select("id", "bid", "user_id", "text")


register("stream_rejected", with_posts("SELECT id, bid, user_id, text FROM posts WHERE CAST(id AS BIGINT) % 10 = 0", V, with_text=True))(
    _stream_rejected)


# SRC3: labelled posts written as a header CSV, read back with the training reader
def _training_csv(s, d):
    from murmur.sources.files import read_training_csv
    from murmur.sources.tables import table
    path = scratch_path(s, "train-csv") + "/csv"
    p = posts_with_text(s, d, V, keep_doc_id=True).drop("label")
    lab = table(s, d, "labels").select("doc_id", F.col("quality").cast("string").alias("label"))
    (p.join(lab, "doc_id")
      .select("text", *[F.col(c).cast("string").alias(c) for c in ("reposts_count", "comments_count",
                                                                     "attitudes_count")], "label")
      .write.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
      .option("ignoreTrailingWhiteSpace", "false").csv(path))
    return read_training_csv(s, path, encoding="UTF-8")


register("training_csv", with_posts(
    """SELECT p.text, CAST(p.reposts_count AS VARCHAR) AS reposts_count,
              CAST(p.comments_count AS VARCHAR) AS comments_count,
              CAST(p.attitudes_count AS VARCHAR) AS attitudes_count, CAST(l.quality AS DOUBLE) AS label
       FROM posts p JOIN labels l ON l.doc_id = CAST(p.id AS BIGINT) % (SELECT count(*) FROM documents)
       WHERE l.quality IS NOT NULL""", V, with_text=True))(_training_csv)


# DOC1 (stream form): tumbling one-hour post counts over the ingested message stream
def _stream_hourly(s, d):
    from murmur.streaming.ingest import hourly_volume_stream
    base = scratch_path(s, "hourly")
    posts = clean_stream(_message_stream(s, raw_messages(_dealt_texts(s, d)), base), V)
    q = (hourly_volume_stream(posts).writeStream.outputMode("update")
         .foreachBatch(lambda df, bid: df.write.mode("append").parquet(f"{base}/out"))
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    _finish(q)
    # update mode may emit an hour more than once (once per batch that touched it): keep the last value
    out = s.read.parquet(f"{base}/out")
    last = out.groupBy("hour_start").agg(F.max("posts").alias("posts"))
    return last.select(F.date_format("hour_start", "yyyy-MM-dd HH:mm:ss").alias("hour_start"), "posts")


register("stream_hourly_volume", with_posts(
    f"""SELECT strftime(date_trunc('hour', created_at), '%Y-%m-%d %H:%M:%S') AS hour_start, count(*) AS posts
        FROM ({CLEAN_SQL_BODY}) c GROUP BY 1""", V, with_text=True))(_stream_hourly)


# STR2 with state that expires: every post crawled three times while its counters grow, the copies dealt over five batches
def _stream_recrawl(s, d):
    from murmur.streaming.recrawl import counter_updates, read_counters, write_updates
    base = scratch_path(s, "recrawl")
    posts = _posts(s, d).withColumn("text", F.lit("")).withColumn("crawl", F.explode(F.array(F.lit(0), F.lit(10), F.lit(20))))
    raw = raw_messages(_dealt(posts.withColumn("reposts_count", F.col("reposts_count") + F.col("crawl")).drop("crawl")))
    _finish(write_updates(counter_updates(_message_stream(s, raw, base), V), f"{base}/out", f"{base}/ckpt", available_now=True))
    return read_counters(s.read.parquet(f"{base}/out")).select(
        "id", F.col("dt").cast("string").alias("dt"), "reposts_count", "comments_count", "attitudes_count")


register("stream_recrawl", with_posts(
    """SELECT id, dt, CAST(reposts_count + 20 AS BIGINT) AS reposts_count, CAST(comments_count AS BIGINT) AS comments_count,
              CAST(attitudes_count AS BIGINT) AS attitudes_count FROM posts""", V))(_stream_recrawl)
