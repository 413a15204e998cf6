"""Per-day rollups: statistics from additive daily partial aggregates.

The original rescans the whole history every ten minutes to recompute every
statistic.  Here each day is aggregated once into a small rollup (one
``GROUPING SETS`` pass, one shuffle), stored partitioned by ``dt`` and
rewritten only for new or changed days; every statistic is then a tiny
aggregate over the rollups.  Counts are longs and sums are exact decimals,
so merging is exact and order independent (a double sum is not).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# grouping sets (besides dt) and the measures kept for each
ROLLUP_SETS = (
    ("user_authentication",),
    ("time_period",),
    ("hour",),
    ("time_period", "user_authentication"),
    ("label",),
    ("time_period", "label"),
    ("user_authentication", "label"),
)
DIMS = ("user_authentication", "time_period", "hour", "label")
DEC = "decimal(38,18)"


def set_name(dims: tuple[str, ...]) -> str:
    return "+".join(dims)


def daily_rollup(posts: DataFrame, sets=ROLLUP_SETS) -> DataFrame:
    """(dt, set, dimension values) -> n, counter sums, exact score and confidence sums."""
    g = posts.groupingSets([[F.col("dt"), *[F.col(c) for c in s]] for s in sets], "dt", *DIMS)
    gid = F.grouping_id()          # over (dt, *DIMS); dt is in every set
    out = g.agg(
        gid.alias("_gid"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("reposts_count").cast("long")).alias("sum_reposts"),
        F.sum(F.col("comments_count").cast("long")).alias("sum_comments"),
        F.sum(F.col("attitudes_count").cast("long")).alias("sum_attitudes"),
        F.count("reposts_count").alias("n_reposts"),
        F.count("comments_count").alias("n_comments"),
        F.count("attitudes_count").alias("n_attitudes"),
        F.count("score").alias("n_score"),
        F.sum(F.col("score").cast(DEC)).alias("sum_score"),
        F.count("confidence").alias("n_confidence"),
        F.sum(F.col("confidence").cast(DEC)).alias("sum_confidence"))
    # readable set name from the grouping id (bit i set = DIMS[i] rolled up)
    name = None
    for s in sets:
        bits = sum(1 << (len(DIMS) - 1 - DIMS.index(c)) for c in DIMS if c not in s)
        cond = F.col("_gid") == bits
        name = F.when(cond, set_name(s)) if name is None else name.when(cond, set_name(s))
    return out.withColumn("grouping_set", name).drop("_gid")


def refresh_rollup(spark, posts: DataFrame, path: str, days: list[str] | None = None, build=daily_rollup) -> None:
    """Recompute the rollup of ``days`` (all days when None) by ``build`` and overwrite just
    those ``dt`` partitions (dynamic partition overwrite)."""
    src = posts if days is None else posts.where(F.col("dt").isin(*days))
    (build(src).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt").parquet(path))


def day_marks(posts: DataFrame) -> DataFrame:
    """``dt`` with the number and hash sum of its rows: differs if any row of the day does."""
    row = F.xxhash64(*[F.col(c) for c in sorted(posts.columns)]).cast("decimal(38,0)")
    return posts.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum(row).alias("h"))


def refresh_changed(spark, posts: DataFrame, path: str, build=daily_rollup) -> list[str]:
    """Refresh the rollup of exactly the days whose rows changed since the last
    call (new, late, updated or removed rows; a day left without rows keeps an empty
    rollup); returns them.  The marks of the days are kept beside the rollup and
    written after it, so a failed refresh is repeated."""
    from murmur.sinks.lake import read_versioned, write_versioned
    marks = day_marks(posts)
    old = read_versioned(spark, f"{path.rstrip('/')}_marks", marks.schema)
    same = marks.join(old, ["dt", "n", "h"], "left_semi").select("dt")
    days = sorted(r[0] for r in marks.select("dt").union(old.select("dt")).distinct().join(same, "dt", "left_anti").collect())
    if days:
        gone = {r[0] for r in old.select("dt").join(marks, "dt", "left_anti").collect()}
        if left := [d for d in days if d not in gone]:
            refresh_rollup(spark, posts, path, days=left, build=build)
        for d in gone:
            hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/dt={d}")
            hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
        write_versioned(spark, marks, f"{path.rstrip('/')}_marks")
    return days


def merged(rollup: DataFrame, dims: tuple[str, ...], since: str | None = None,
           until: str | None = None) -> DataFrame:
    """Merge days of one grouping set: counts and sums add up exactly."""
    r = rollup.where(F.col("grouping_set") == set_name(dims))
    if since is not None:
        r = r.where(F.col("dt") >= F.lit(since))
    if until is not None:
        r = r.where(F.col("dt") <= F.lit(until))
    measures = [c for c in rollup.columns if c.startswith("n") or c.startswith("sum_")]
    return r.groupBy(*dims).agg(*[F.sum(c).alias(c) for c in measures])


def avg_of(sum_col: str, n_col: str, digits: int) -> Column:
    """Exact average from merged sums, HALF_UP rounded, as double."""
    return F.round(F.col(sum_col) / F.col(n_col), digits).cast("double")
