"""The ``posts`` view: social posts derived from the given tables.

Formulas follow ``FIXTURES.md`` section C; :mod:`murmur.plans.oracle` holds
the same view in DuckDB SQL.  Every query registered in
``__spark_entry__`` starts here, so its work grows with ``events`` (and
``documents`` for text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from murmur.functions.time import day_key, period_of_hour
from murmur.sources.tables import ensure_parallelism, table
from murmur.vocab import FIXTURE, Vocab

AUTH_BY_MOD6 = ("", "Official media", "Institution", "Celebrity")
TOPIC_BY_MOD5 = ("city", "livelihood", "feedback", "government")


def _nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    # nation (25 rows) and region (5 rows) have a fixed size at every scale
    # factor, so broadcasting them is bounded.
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return F.broadcast(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name"))


def posts_view(spark: SparkSession, sf_dir: str, with_text: bool = False,
               vocab: Vocab = FIXTURE) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    nr = _nation_region(spark, sf_dir)

    e = e.withColumn("_nkey", ((F.col("user_id") * 7 + F.col("event_id") % 3) % 25).cast("int"))
    j = (e.join(c, e.user_id == c.c_custkey)
          .join(nr, F.col("_nkey") == nr.n_nationkey))

    eid, uid = F.col("event_id"), F.col("user_id")
    quiet = (uid % 13) == 5          # users whose posts are all at noon, unlocated, neutral
    ts = F.col("ts").cast("timestamp")
    created = F.when(quiet, F.date_trunc("day", ts) + F.expr("INTERVAL 12 HOURS")).otherwise(ts)
    m10 = eid % 10
    location = (F.when(quiet | (m10 == 0), F.lit(None).cast("string"))
                 .when(m10 == 1, F.lit(""))
                 .when(m10.isin(2, 3), F.concat(F.col("r_name"), F.lit(" | "), F.col("n_name")))
                 .otherwise(F.col("r_name")))
    m6 = uid % 6
    auth = F.when(m6 == 0, AUTH_BY_MOD6[0])
    for k in (1, 2, 3):
        auth = auth.when(m6 == k, AUTH_BY_MOD6[k])
    et = F.col("event_type")
    label = (F.when(eid % 50 == 7, F.lit(None).cast("string"))
              .when(quiet, vocab.neutral)
              .when(et.isin("purchase", "signup"), vocab.positive)
              .when(et == "error", vocab.negative)
              .otherwise(vocab.neutral))
    m5 = eid % 5
    topic = F.when(m5 == 0, TOPIC_BY_MOD5[0])
    for k in (1, 2, 3):
        topic = topic.when(m5 == k, TOPIC_BY_MOD5[k])
    value = F.col("value")

    cols = [
        eid.cast("string").alias("id"),
        F.concat(F.lit("b"), eid.cast("string")).alias("bid"),
        uid.cast("string").alias("user_id"),
        F.concat(F.col("c_name"), F.when(uid % 11 == 0, F.lit(" news")).otherwise(F.lit(""))).alias("screen_name"),
        F.when(eid % 3 == 0, F.concat(F.lit("#"), et, F.lit("#"))).alias("topics"),
        F.floor(value * 10).cast("int").alias("reposts_count"),
        F.floor(value * 3).cast("int").alias("comments_count"),
        F.floor(value * 20).cast("int").alias("attitudes_count"),
        created.alias("created_at"),
        location.alias("location"),
        auth.alias("user_authentication"),
        label.alias("label"),
        F.when(quiet, F.lit(0.5)).otherwise(value / (value + F.lit(50.0))).alias("score"),
        (((eid * 37) % 100).cast("double") / F.lit(100.0)).alias("confidence"),
        topic.alias("topic_label"),
    ]
    out = j.select(*cols)
    out = (out.withColumn("hour", F.hour("created_at"))
              .withColumn("time_period", period_of_hour(F.col("hour"), vocab))
              .withColumn("dt", day_key(F.col("created_at"))))
    if with_text:
        out = _attach_text(spark, sf_dir, out)
    return out


def with_doc_id(spark: SparkSession, sf_dir: str, posts: DataFrame) -> DataFrame:
    """doc_id = event_id mod count(documents); the count is a scalar subquery,
    evaluated once, no cross join."""
    n_docs = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    return posts.withColumn("doc_id", F.col("id").cast("long") % n_docs)


def _attach_text(spark: SparkSession, sf_dir: str, posts: DataFrame, keep_doc_id: bool = False) -> DataFrame:
    # text work is CPU-heavy per row: spread a single-split input first (the
    # narrow post columns are shuffled, before the texts are attached)
    posts = ensure_parallelism(posts)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_doc"), "text")
    out = (with_doc_id(spark, sf_dir, posts)
           .join(docs, F.col("doc_id") == F.col("_doc"), "left")
           .drop("_doc"))
    return out if keep_doc_id else out.drop("doc_id")


def posts_with_text(spark: SparkSession, sf_dir: str, vocab: Vocab = FIXTURE,
                    keep_doc_id: bool = False) -> DataFrame:
    return _attach_text(spark, sf_dir, posts_view(spark, sf_dir, vocab=vocab), keep_doc_id)


def sentiment_table(posts: DataFrame) -> DataFrame:
    """Posts that carry a sentiment result (the scored table)."""
    return posts.where(F.col("label").isNotNull())


def topic_table(posts: DataFrame) -> DataFrame:
    """Posts with their topic result (``confidence`` doubles as topic confidence)."""
    return posts.drop("label", "score")


def raw_messages(posts: DataFrame) -> DataFrame:
    """Posts as stream messages: one JSON text per row in column ``json_data``
    (the 21-field message contract; NULL fields are omitted, counters are
    JSON numbers, ``created_at`` is ``yyyy-MM-dd HH:mm`` text)."""
    msg = F.struct(
        "id", "bid", "user_id", "screen_name", "text",
        F.concat(F.lit("post/"), F.col("bid")).alias("article_url"),
        "location",
        F.lit(None).cast("string").alias("at_users"),
        "topics",
        F.lit(None).cast("string").alias("pics"),
        F.lit(None).cast("string").alias("video_url"),
        "reposts_count", "comments_count", "attitudes_count",
        F.date_format("created_at", "yyyy-MM-dd HH:mm").alias("created_at"),
        F.lit("feed").alias("source"),
        F.lit(None).cast("string").alias("retweet_id"),
        F.lit(None).cast("string").alias("ip"),
        "user_authentication",
        F.lit(None).cast("string").alias("vip_type"),
        (F.col("user_id").cast("int") % 7).alias("vip_level"),
    )
    return posts.select(F.to_json(msg).alias("json_data"))


def attach_text(spark: SparkSession, sf_dir: str, df: DataFrame, id_col: str = "id") -> DataFrame:
    """Add ``text`` to rows that carry a post id (late materialisation of texts)."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_doc"), "text")
    n_docs = table(spark, sf_dir, "documents").select(F.count(F.lit(1))).scalar()
    return (df.withColumn("_dkey", F.col(id_col).cast("long") % n_docs)
              .join(docs, F.col("_dkey") == F.col("_doc"), "left")
              .drop("_dkey", "_doc"))


def with_text_columns(spark: SparkSession, sf_dir: str, posts: DataFrame, of_docs, how: str = "left") -> DataFrame:
    """Columns that depend on a text alone, computed once a document (``of_docs``: ``doc_id, text`` -> ``doc_id``, columns)
    and joined to the posts that carry it; no text is joined to a post."""
    docs = ensure_parallelism(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return with_doc_id(spark, sf_dir, ensure_parallelism(posts)).join(of_docs(docs), "doc_id", how)
