"""Composed jobs (the original's entry points), invoked by a scheduler with a run date.

Each job reads tables, composes operators and writes its outputs through a
``Publisher`` (Parquet lake by default, JDBC optional).  No job collects
data-sized results to the driver; the once-per-day guard is a job checkpoint.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from murmur.operators import clusters as CL
from murmur.operators import indicators as IND
from murmur.operators import profiles as PR
from murmur.operators import recommend as RC
from murmur.operators import rollup as RU
from murmur.operators import scoring as SC
from murmur.operators import spam as SP
from murmur.sinks import jdbc as J
from murmur.sinks import lake as L
from murmur.sources.tables import read_day, read_table_dedup
from murmur.streaming import ingest as S
from murmur.vocab import REFERENCE, Vocab
from murmur.session import cut, path_exists


@dataclass
class Publisher:
    """Where serving tables go: ``base_path`` (Parquet, overwrite) or ``jdbc_url``."""
    base_path: str | None = None
    jdbc_url: str | None = None
    jdbc_props: dict | None = None

    def overwrite(self, df: DataFrame, name: str) -> None:
        if self.jdbc_url:
            J.publish_overwrite(df, self.jdbc_url, name, self.jdbc_props)
        else:
            df.write.mode("overwrite").parquet(f"{self.base_path.rstrip('/')}/{name}")


def ingest_job(spark: SparkSession, landing: str, checkpoint: str, source: str = "kafka",
               model_path: str | None = None, vocab: Vocab = REFERENCE, trigger: str = "220 seconds",
               available_now: bool = False, **src):
    """JB1: stream -> parse -> clean -> dedup -> (spam filter) -> day partitions.

    Messages without id or time go to ``<landing>_rejected`` by a query of their own
    (in ``spark.streams.active``); the query of the posts is returned.
    """
    model = None
    if model_path:
        from pyspark.ml import PipelineModel
        model = PipelineModel.load(model_path)
    # dedup state grows with the ids of the watermark horizon: keep it in RocksDB
    # (off-heap, spills to local disk, checkpointed) unless the cluster chose a provider
    key = "spark.sql.streaming.stateStore.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    raw = S.read_post_stream(spark, source, **src)
    S.write_rejected_stream(S.rejected_stream(S.read_post_stream(spark, source, **src), vocab), f"{landing.rstrip('/')}_rejected",
                            f"{checkpoint.rstrip('/')}_rejected", trigger, available_now=available_now)
    return S.write_posts_stream(S.clean_stream(raw, vocab, model=model), landing, checkpoint, trigger,
                                available_now=available_now)


def compact_job(spark: SparkSession, landing: str, target: str, days: list[str]) -> None:
    """Fold the given days of the landing table into the ``dt`` table, one copy per (dt, id)."""
    for day in days:
        L.compact_day(spark, landing, target, day)


def train_spam_job(spark: SparkSession, labelled: DataFrame, model_path: str, vocab: Vocab = REFERENCE) -> DataFrame:
    """Fit once, save, return the hold-out evaluation (the original refits at every start)."""
    train, test = SP.train_test_split(SP.training_set(labelled))
    model = SP.train_spam_model(train, vocab)
    model.write().overwrite().save(model_path)
    return SP.eval_classifier(SP.predict_spam(test, model, vocab))


def score_job(spark: SparkSession, posts: DataFrame, done_path: str, day: str, scorer: SC.Scorer,
              out_cols: list[str], run_ts: str, stamp_col: str | None = None) -> int:
    """JB2 / JB3: score the day's new posts and append them to ``done_path``.

    The already-scored side is bounded to the same day partition.
    """
    done = (spark.read.parquet(done_path).where(F.col("dt") == day) if path_exists(spark, done_path)
            else posts.limit(0).select("id"))              # first run, nothing scored yet
    new = cut(SC.score_new_posts(read_day(posts, day), done, scorer, run_ts, stamp_col).select(*out_cols))
    n = new.count()                                # reads the checkpoint, not the inputs
    if n:
        new.write.mode("append").partitionBy("dt").parquet(done_path)
    return n


#: Columns that the statistics of :func:`indicators_job` need.
INDICATOR_COLS = ("dt", "id", "batch_id", "created_at", "user_authentication", "time_period", "hour", "location", "label", "score",
                  "confidence", "reposts_count", "comments_count", "attitudes_count")


def indicators_job(posts: DataFrame, scored: DataFrame, pub: Publisher, run_ts: str,
                   vocab: Vocab = REFERENCE, rollup_path: str | None = None, ckpt_path: str | None = None,
                   task: str = "indicators") -> None:
    """JB4: volume statistics of all posts, then sentiment statistics.

    With ``rollup_path`` the additive counts come from daily rollups: only days
    whose scored rows changed since the last run are re-aggregated (late rows of
    old days too, found by a count and hash sum per day), the rest is a merge of
    stored rollups.  Both inputs are deduplicated once and stored.  No posts: nothing is published.
    """
    p, s = (cut(read_table_dedup(x.select(*[c for c in INDICATOR_COLS if c in x.columns]))) for x in (posts, scored))
    if p.isEmpty():
        return
    outs = {}
    if rollup_path:
        spark = posts.sparkSession
        changed = RU.refresh_changed(spark, s, rollup_path)
        r = spark.read.parquet(rollup_path)

        def count_of(dims, name="count"):
            return IND.stamp(RU.merged(r, dims).select(*dims, F.col("n").alias(name)), run_ts)
        known = F.col("label").isin(vocab.positive, vocab.negative, vocab.neutral)
        outs.update({
            "label_count": count_of(("label",), "value").where(known),
            "label_count_by_time": count_of(("time_period", "label"), "value"),
            "user_auth_label_count": count_of(("user_authentication", "label"), "value"),
            "interaction_count_by_label": IND.stamp(RU.merged(r, ("label",)).select(
                "label", F.round(F.col("sum_reposts") / F.col("n_reposts"), 2).alias("avg_repost"),
                F.round(F.col("sum_comments") / F.col("n_comments"), 2).alias("avg_comment"),
                F.round(F.col("sum_attitudes") / F.col("n_attitudes"), 2).alias("avg_attitude")), run_ts),
        })
        if ckpt_path and changed:
            L.update_last_dt(spark, ckpt_path, task, max(changed))
    outs.update({
        "user_post_count": IND.auth_post_count(p, run_ts),
        "time_period_count": IND.period_post_count(p, run_ts),
        "hour_post_count": IND.hour_post_count(p, run_ts),
        "day_post_count": IND.day_post_count(p, run_ts),
        "time_period_user_count": IND.period_auth_count(p, run_ts),
        "region_hot": IND.region_post_count(p, run_ts),
        "region_heat_statistic": IND.region_heat(s, run_ts=run_ts),
        "day_label_ratio": IND.day_label_ratio(s, run_ts),
        "confidence_level_count": IND.confidence_level_count(s, vocab, run_ts),
    })
    for key, fn in (("label_count", lambda: IND.label_count(s, vocab, run_ts)),
                    ("label_count_by_time", lambda: IND.label_by_period(s, run_ts)),
                    ("user_auth_label_count", lambda: IND.label_by_auth(s, run_ts)),
                    ("interaction_count_by_label", lambda: IND.interaction_by_label(s, run_ts))):
        outs.setdefault(key, fn())
    for name, df in outs.items():
        pub.overwrite(df, name)


def user_portrait_job(scored: DataFrame, pub: Publisher, run_ts: str, vocab: Vocab = REFERENCE) -> None:
    """JB5: time, region and identity profiles."""
    s = read_table_dedup(scored)
    pub.overwrite(PR.user_auth_profile(s, vocab, run_ts=run_ts), "user_auth_sentiment_profile")
    pub.overwrite(PR.user_region_profile(s, run_ts), "user_region_sentiment_profile")
    pub.overwrite(PR.user_time_profile(s, run_ts), "user_time_sentiment_profile")


def cluster_profile_job(scored: DataFrame, pub: Publisher, run_ts: str, vocab: Vocab = REFERENCE,
                        model=None) -> None:
    """JB6: features -> segments -> mixture (fitted when no model is given) -> profile."""
    seg = cut(CL.segment_users(CL.user_features(read_table_dedup(scored), vocab), vocab))
    model = model or CL.fit_clusters(seg)
    pub.overwrite(CL.cluster_profile(seg, CL.assign_clusters(model, seg), run_ts), "user_gmm_profile")


def recommend_job(spark: SparkSession, topics: DataFrame, scored: DataFrame, time_profile: DataFrame,
                  region_profile: DataFrame, clusters: DataFrame, as_of: str, view: str, base_path: str,
                  run_ts: str, vocab: Vocab = REFERENCE) -> str | None:
    """JB7: top-N per user, published by blue/green switch; skipped when empty."""
    top = RC.recommend(topics, scored, time_profile, region_profile, clusters, as_of, vocab, run_ts=run_ts)
    top = cut(top)
    if top.isEmpty():
        return None
    return L.publish_blue_green(spark, top, view, base_path)


def export_text_job(spark: SparkSession, posts_path: str, out_path: str, n: int = 10000) -> None:
    """JB8: ``bid, text`` sample as one CSV file, reading only those columns."""
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("bid", T.StringType()), T.StructField("text", T.StringType()),
                           T.StructField("id", T.StringType())])
    L.export_text_sample(spark.read.schema(schema).parquet(posts_path), out_path, n)


def run_once_per_day(spark: SparkSession, ckpt_path: str, task: str, run_date: str, fn) -> bool:
    """STR8: run ``fn`` unless ``task`` already ran for ``run_date``; record success after."""
    last = L.read_last_dt(spark, ckpt_path, task).first()["last_dt"]
    if last >= run_date:
        return False
    fn()
    L.update_last_dt(spark, ckpt_path, task, run_date)
    return True


def scored_day(run_date: str, lag_days: int = 2) -> str:
    """The day the incremental scorers work on (the original uses today - 2)."""
    return (_dt.date.fromisoformat(run_date) - _dt.timedelta(days=lag_days)).isoformat()
