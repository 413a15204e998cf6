"""Canonical schemas (one constant per stored table)."""

from pyspark.sql import types as T

S, I, D, L, TS = T.StringType(), T.IntegerType(), T.DoubleType(), T.LongType(), T.TimestampType()


def _struct(*cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Raw stream message: counters are declared as strings so that a quoted "7"
# still parses (try_cast later), as per-field JSON extraction does.
POST_RAW_FIELDS = (
    "id", "bid", "user_id", "screen_name", "text", "article_url", "location",
    "at_users", "topics", "pics", "video_url", "reposts_count", "comments_count",
    "attitudes_count", "created_at", "source", "retweet_id", "ip",
    "user_authentication", "vip_type", "vip_level",
)
INT_FIELDS = ("reposts_count", "comments_count", "attitudes_count", "vip_level")
POST_RAW = _struct(*[(f, S) for f in POST_RAW_FIELDS])

# Columns the ingest drops (stream clean step).
DROPPED_FIELDS = ("article_url", "at_users", "pics", "video_url", "source",
                  "retweet_id", "ip", "vip_type", "vip_level")

POSTS = _struct(
    ("id", S), ("bid", S), ("user_id", S), ("screen_name", S), ("text", S), ("topics", S),
    ("reposts_count", I), ("comments_count", I), ("attitudes_count", I),
    ("created_at", TS), ("location", S), ("user_authentication", S),
    ("hour", I), ("time_period", S), ("dt", S),
)

TRAINING_CSV = _struct(("text", S), ("reposts_count", S), ("comments_count", S),
                       ("attitudes_count", S), ("label", S))

JOB_CHECKPOINT = _struct(("task_name", S), ("last_dt", S))

CLUSTER_FEATURES = ("hourly_sentiment_stddev", "night_post_ratio",
                    "region_diversity_score", "top_region_avg_score", "sentiment_leverage")
