"""Physical-plan properties the design relies on."""

import os

from pyspark.sql import functions as F

from murmur.operators import indicators as IND
from murmur.operators import keywords as KW
from murmur.operators import profiles as PR
from murmur.sources.posts_view import posts_view, posts_with_text, sentiment_table
from murmur.sources.tables import read_day
from murmur.vocab import FIXTURE as V

from conftest import SF0001


def _plan(df, mode="formatted"):
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_filter_reaches_scan(spark, tmp):
    path = os.path.join(tmp, "posts")
    posts_view(spark, SF0001, vocab=V).write.partitionBy("dt").parquet(path)
    df = read_day(spark.read.parquet(path), "2024-01-15")
    p = _physical(df)
    assert "PartitionFilters: [isnotnull(dt" in p and "2024-01-15" in p


def test_column_pruning_and_pushdown(spark):
    df = posts_view(spark, SF0001, vocab=V).where(F.col("reposts_count") > 1000).select("id")
    p = _physical(df)
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in p or "value" in p
    assert "c_acctbal" not in p and "props" not in p


def test_topn_per_group_uses_window_group_limit(spark):
    p = _physical(IND.hot_posts(posts_view(spark, SF0001, vocab=V), 10))
    assert "WindowGroupLimit" in p


def test_native_operators_have_no_python_eval(spark):
    posts = posts_with_text(spark, SF0001, V)
    scored = sentiment_table(posts_view(spark, SF0001, vocab=V))
    for df in (IND.day_label_ratio(scored), PR.user_time_profile(scored), PR.user_region_profile(scored),
               KW.term_trend(posts, V), KW.hot_keywords(posts)):
        p = _physical(df)
        assert "EvalPython" not in p and "PythonUDF" not in p and "ArrowEvalPython" not in p


def test_top1_per_user_is_a_partial_aggregate(spark):
    """min_by over a string buffer plans as a sort aggregate, but with a
    partial (map-side) step before the shuffle and no window."""
    scored = sentiment_table(posts_view(spark, SF0001, vocab=V))
    p = _physical(PR.user_period_pref(scored))
    assert "Window" not in p
    assert "partial_min_by" in p
