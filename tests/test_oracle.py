"""Every registered query with an oracle equals DuckDB on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from murmur.plans import catalog
from oracle_harness import compare, duck

from conftest import SF0001

SLOW = {"spam_model_eval", "filter_spam", "cluster_users", "recommend_topn_gmm"}


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF0001).toPandas()
    odf = con.execute(E.oracle_sql()[name]).df()
    assert compare(sdf, odf) is None


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql()) - SLOW))
def test_rows_only_queries_run(spark, name):
    assert E.queries()[name](spark, SF0001).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and len(df.columns) > 0


@pytest.mark.parametrize("name", ["hour_post_count", "day_post_count", "posts_ingest", "read_day", "user_time_profile"])
def test_time_dependent_queries_in_another_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        sdf = E.queries()[name](spark, SF0001).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert compare(sdf, con.execute(E.oracle_sql()[name]).df()) is None
