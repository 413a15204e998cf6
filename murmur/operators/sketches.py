"""Mergeable sketches as stored columns of daily rollups: distinct users and quantiles over any days.

Counts and sums of days add up, distinct counts and quantiles do not.  Each (day, group) therefore keeps

* ``users``: a HyperLogLog sketch, merged by ``hll_union_agg``; the standard error is about ``1.04 / sqrt(2 ** LG_K)``;
* ``bins``: how many values fall into each bin of a logarithmic scale, merged by adding counts.  A bin's middle is within
  ``ALPHA`` of each of its values, so every quantile is within that *relative* error, whatever the distribution, and the
  counts do not depend on the order of rows or merges.

The exact quantile costs one more pass: the merged bins name the bin that holds a rank, and only the values of those bins
are counted (:func:`exact_quantiles`); the values of a group are never sorted.

Null users and null, NaN and infinite values are left out; a group without values has no bins and null quantiles; negative
values have mirrored bins; zero and magnitudes below 1e-300 share bin 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

LG_K = 14
#: Four standard errors of the estimate.
USERS_BOUND = 4 * 1.04 / math.sqrt(2 ** LG_K)
ALPHA = 0.01
GAMMA = (1 + ALPHA) / (1 - ALPHA)
LN_GAMMA = math.log(GAMMA)
#: Bins of the least magnitude are number 1 and -1.
SHIFT = math.ceil(300 * math.log(10) / LN_GAMMA) + 2
BIN_TYPE = "array<struct<bin:int,n:bigint>>"


def bin_of(c: Column) -> Column:
    """The bin of a value; null for null, NaN and infinite ones."""
    x = c.cast("double")
    x = F.when(F.abs(x) < F.lit(float("inf")), x)            # NaN is above all numbers
    scale = (F.ceil(F.log(F.abs(x)) / F.lit(LN_GAMMA)) + F.lit(SHIFT)).cast("int")
    return F.when(F.abs(x) < F.lit(1e-300), 0).when(x > 0, scale).when(x < 0, -scale)


def middle(b: Column) -> Column:
    """The value that stands for a bin."""
    size = F.lit(2 / (GAMMA + 1)) * F.pow(F.lit(GAMMA), F.abs(b) - F.lit(SHIFT))
    return F.when(b == 0, F.lit(0.0)).otherwise(F.signum(b) * size)


def daily_sketches(posts: DataFrame, dims: tuple[str, ...], value: str, user: str = "user_id", dt: str = "dt") -> DataFrame:
    """``dt, dims, users, bins`` per day and group.  Bins are summed before they are listed: a list has at most one entry a
    bin, however many rows a day has."""
    keys = [dt, *dims]
    users = posts.groupBy(*keys).agg(F.hll_sketch_agg(user, F.lit(LG_K)).alias("users"))
    bins = (posts.groupBy(*keys, bin_of(F.col(value)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(F.col("bin").isNotNull(), F.struct("bin", "n")))).cast(BIN_TYPE).alias("bins")))
    same = [users[k].eqNullSafe(bins[k]) for k in keys]
    return users.join(bins, same).select(*[users[k] for k in keys], "users", "bins")


def merged_users(sketches: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``keys, users`` (the estimate) over all days of each group."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"))


def over_last_days(sketches: DataFrame, days: int, dt: str = "dt") -> DataFrame:
    """Each row once for every day whose last ``days`` days hold it (its own and later ones, up to the last day there is)."""
    last = sketches.select(F.max(F.to_date(dt))).scalar()
    day = F.to_date(F.col(dt))
    return (sketches.withColumn("_until", F.least(F.date_add(day, days - 1), last))
            .withColumn(dt, F.explode(F.sequence(day, F.col("_until")))).withColumn(dt, F.date_format(dt, "yyyy-MM-dd"))
            .drop("_until"))


def merged_bins(sketches: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``keys, bin, n`` over all days of each group."""
    return (sketches.select(*keys, F.inline("bins")).groupBy(*keys, "bin").agg(F.sum("n").alias("n")))


def quantile_bins(bins: DataFrame, keys: tuple[str, ...], mille: tuple[int, ...]) -> DataFrame:
    """``keys, mille, bin, before, target``: the bin that holds the value of rank ``ceil(mille / 1000 * n)``, the values before
    that bin and the rank.  A window over a group's bins (some thousand rows, whatever the number of values)."""
    w = Window.partitionBy(*keys)
    upto = F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    b = bins.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n")).withColumn("total", F.sum("n").over(w))
    target = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("mille") * F.col("total") / F.lit(1000)).cast("long"))
    return (b.withColumn("mille", F.explode(F.array(*[F.lit(m) for m in mille]))).withColumn("target", target)
            .where((F.col("before") < F.col("target")) & (F.col("target") <= F.col("upto")))
            .select(*keys, "mille", "bin", "before", "target"))


def quantiles(sketches: DataFrame, keys: tuple[str, ...], mille: tuple[int, ...] = (500, 900, 990)) -> DataFrame:
    """``keys, mille, quantile`` within ``ALPHA`` of the exact value, from the stored bins alone."""
    q = quantile_bins(merged_bins(sketches, keys), keys, mille)
    return q.select(*keys, "mille", middle(F.col("bin")).alias("quantile"))


def exact_quantiles(posts: DataFrame, sketches: DataFrame, keys: tuple[str, ...], value: str,
                    mille: tuple[int, ...] = (500, 900, 990)) -> DataFrame:
    """``keys, mille, quantile, exact``: the sketch's value and the exact one, counted among the values of its bin."""
    q = quantile_bins(merged_bins(sketches, keys), keys, mille)
    wanted = q.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("bin").alias("_bin")).distinct()
    rows = posts.select(*keys, F.col(value).alias("_value")).withColumn("bin", bin_of(F.col("_value")))
    near = rows.join(wanted, [rows[k].eqNullSafe(wanted[f"_{k}"]) for k in keys] + [rows["bin"] == wanted["_bin"]], "left_semi")
    counts = near.groupBy(*keys, "bin", "_value").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys, "bin").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_upto", F.sum("_n").over(w))
    p, c = q.alias("p"), counts.alias("c")
    same = [F.col(f"p.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    rank = F.col("p.target") - F.col("p.before")
    hit = (F.col("c._upto") >= rank) & (F.col("c._upto") - F.col("c._n") < rank)
    return p.join(c, [*same, F.col("p.bin") == F.col("c.bin"), hit]).select(
        *[F.col(f"p.{k}") for k in keys], "p.mille", middle(F.col("p.bin")).alias("quantile"), F.col("c._value").alias("exact"))
