"""Mergeable sketches: stated bounds, merges over any days, exact ranks, late rows of a stored rollup."""

import math
import random

from pyspark.sql import functions as F

from murmur.operators import rollup as RU, sketches as SK

SCHEMA = "dt string, g string, user_id string, v double"


def _posts(spark, n=6000, seed=3):
    rng = random.Random(seed)
    rows = [(f"2024-01-{1 + rng.randrange(9):02d}", rng.choice(["a", "b", None]), f"u{rng.randrange(2500)}",
             rng.choice([rng.paretovariate(0.5), -rng.expovariate(1e-3), 0.0, 1.0, 5.0])) for _ in range(n)]
    rows += [("2024-01-02", "a", None, None), ("2024-01-02", "a", "u1", float("nan")), ("2024-01-03", "b", "u2", float("inf")),
             ("2024-01-03", "none", None, None)]
    return rows, spark.createDataFrame(rows, SCHEMA)


def _exact(rows, key, mille):
    v = sorted(r[3] for r in rows if r[1] == key and r[3] is not None and math.isfinite(r[3]))
    return v[max(1, -(-mille * len(v) // 1000)) - 1]


def test_quantiles_stay_within_the_bound_and_exact_ones_are_exact(spark):
    rows, posts = _posts(spark)
    mille = (1, 250, 500, 990, 1000)
    sk = SK.daily_sketches(posts, ("g",), "v")
    got = SK.exact_quantiles(posts, sk, ("g",), "v", mille).collect()
    assert {(r["g"], r["mille"]) for r in got} == {(g, m) for g in ("a", "b", None) for m in mille}
    for r in got:
        want = _exact(rows, r["g"], r["mille"])
        assert r["exact"] == want
        assert abs(r["quantile"] - want) <= SK.ALPHA * abs(want) * (1 + 1e-9)
    assert {(r["g"], r["mille"], r["quantile"]) for r in got} == {tuple(r) for r in SK.quantiles(sk, ("g",), mille).collect()}


def test_bins_do_not_depend_on_partitions_or_merges(spark):
    _, posts = _posts(spark, 2000)
    whole = SK.daily_sketches(posts.withColumn("dt", F.lit("2024-01-01")), ("g",), "v").select("g", F.inline("bins"))
    merged = SK.merged_bins(SK.daily_sketches(posts.repartition(7), ("g",), "v"), ("g",))
    assert {tuple(r) for r in whole.collect()} == {tuple(r) for r in merged.collect()}


def test_distinct_users_of_trailing_days(spark):
    rows, posts = _posts(spark)
    sk = SK.daily_sketches(posts, ("g",), "v")
    got = {(r["dt"], r["g"]): r["users"] for r in SK.merged_users(SK.over_last_days(sk, 3), ("dt", "g")).collect()}
    for (dt, g), users in got.items():
        day = int(dt[-2:])
        want = len({r[2] for r in rows if r[1] == g and day - 3 < int(r[0][-2:]) <= day and r[2] is not None})
        assert abs(users - want) <= SK.USERS_BOUND * want
    assert max(dt for dt, _ in got) == "2024-01-09" and got["2024-01-03", "none"] == 0


def test_stored_sketches_find_late_rows(spark, tmp):
    rows, posts = _posts(spark, 1500)
    build = lambda p: SK.daily_sketches(p, ("g",), "v")
    late = (F.col("dt") == "2024-01-05") & F.col("user_id").endswith("7")
    assert len(RU.refresh_changed(spark, posts.where(~late), tmp + "/s", build=build)) == 9
    assert RU.refresh_changed(spark, posts, tmp + "/s", build=build) == ["2024-01-05"]
    stored, direct = spark.read.parquet(tmp + "/s"), build(posts)
    assert {tuple(r) for r in SK.merged_bins(stored, ("g",)).collect()} == {tuple(r) for r in SK.merged_bins(direct, ("g",)).collect()}
    est = [{r["g"]: r["users"] for r in SK.merged_users(x, ("g",)).collect()} for x in (stored, direct)]
    assert est[0] == est[1]
    assert SK.over_last_days(stored, 2).where("dt = '2024-01-09'").count() > 0


def test_empty_table(spark):
    _, posts = _posts(spark, 10)
    sk = SK.daily_sketches(posts.limit(0), ("g",), "v")
    assert sk.count() == SK.quantiles(sk, ("g",)).count() == SK.merged_users(sk, ("g",)).count() == 0
    assert SK.over_last_days(sk, 7).count() == 0
