"""Forecasts of the negative share: a least-squares line over recent days; exponential smoothing with a backtest."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window, functions as F

from murmur.operators.clean import explode_region
from murmur.vocab import REFERENCE, Vocab


def negative_forecast(scored: DataFrame, as_of: str, days: int = 7, vocab: Vocab = REFERENCE,
                      digits: int = 6) -> DataFrame:
    """Per region: daily negative share over the ``days`` days before ``as_of``,
    fitted with ``regr_slope`` / ``regr_intercept`` (x = day index), the
    value extrapolated to ``as_of`` and the direction of the slope."""
    start = (_dt.date.fromisoformat(as_of) - _dt.timedelta(days=days)).isoformat()
    recent = scored.where((F.col("dt") >= F.lit(start)) & (F.col("dt") < F.lit(as_of)))
    neg = F.when(F.col("label") == vocab.negative, 1).otherwise(0)
    daily = (explode_region(recent, keep=["dt", "label"])
             .groupBy("region", "dt").agg((F.sum(neg) / F.count(F.lit(1))).alias("share")))
    x = F.datediff(F.to_date("dt"), F.to_date(F.lit(start))).cast("double")
    fit = daily.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_days"),
        F.regr_slope(F.col("share"), x).alias("slope"),
        F.regr_intercept(F.col("share"), x).alias("intercept"))
    slope = F.round("slope", digits)
    return fit.select(
        "region", "n_days", slope.alias("slope"), F.round("intercept", digits).alias("intercept"),
        F.round(F.col("intercept") + F.col("slope") * F.lit(float(days)), digits).alias("forecast"),
        F.when(slope > 0, "up").when(slope < 0, "down").otherwise("flat").alias("direction"))


#: Smoothing weights tried for level, trend and season, in the order in which ties are broken.
ALPHAS, BETAS, GAMMAS = (0.2, 0.5, 0.8), (0.0, 0.1, 0.3), (0.0, 0.3)


def smoothed(series: DataFrame, key: str, at: str, value: str, period: int = 7, warm_up: int = 7) -> DataFrame:
    """Exponential smoothing with additive trend and season of each ``key(at, value)``, for each triple of weights.

    One ordered fold per key and triple; ``sse`` sums the squared one-step errors (each forecast from the values before it
    only) after ``warm_up`` values.  The values of a key are taken as evenly spaced, in the order of ``at``.
    """
    rows = (series.where(F.col(value).isNotNull() & F.col(key).isNotNull()).groupBy(key)
            .agg(F.transform(F.sort_array(F.collect_list(F.struct(at, F.col(value).cast("double").alias("y")))), lambda x: x["y"]).alias("y")))
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(g).alias("g"))
                     for i, (a, b, g) in enumerate((a, b, g) for a in ALPHAS for b in BETAS for g in GAMMAS)])
    zero = F.lit(0.0)
    start = F.struct(F.lit(0).alias("n"), F.get("y", F.lit(0)).alias("level"), zero.alias("trend"),
                     F.array_repeat(zero, period).alias("season"), zero.alias("sse"))

    def step(s, y):
        w, at_ = F.col("w"), s["n"] % period
        season = F.get(s["season"], at_)
        base = s["level"] + s["trend"]
        error = y - (base + season)
        level = base + w["a"] * error
        return F.struct(
            (s["n"] + 1).alias("n"), level.alias("level"), (s["trend"] + w["b"] * (level - s["level"] - s["trend"])).alias("trend"),
            F.transform(s["season"], lambda x, i: F.when(i == at_, x + w["g"] * (y - level - x)).otherwise(x)).alias("season"),
            (s["sse"] + F.when(s["n"] >= warm_up, error * error).otherwise(zero)).alias("sse"))

    return rows.withColumn("w", F.explode(grid)).withColumn("s", F.aggregate("y", start, step))


def smoothed_forecast(series: DataFrame, key: str, at: str = "dt", value: str = "share", period: int = 7, warm_up: int = 7,
                      digits: int = 6) -> DataFrame:
    """Per key: the weights of least rolling one-step error, the forecast of the next value with its 95 % interval, the root
    mean square error of the method and that of a straight line through the last ``period`` values, over the same origins.

    Keys with no more than ``warm_up`` values have no row.
    """
    tried = smoothed(series, key, at, value, period, warm_up).where(F.col("s.n") > warm_up)
    best = tried.groupBy(key).agg(F.min_by(F.struct("w", "s"), F.struct(F.round("s.sse", 12), "w.i")).alias("best"))
    order = Window.partitionBy(key).orderBy(at)
    x = series.where(F.col(value).isNotNull() & F.col(key).isNotNull()).withColumn("i", F.row_number().over(order).cast("double"))
    before = order.rowsBetween(-period, -1)
    line = (x.withColumn("slope", F.regr_slope(value, "i").over(before)).withColumn("cut", F.regr_intercept(value, "i").over(before))
            .where(F.col("i") > warm_up).groupBy(key)
            .agg(F.sqrt(F.avg(F.pow(F.col(value) - F.col("cut") - F.col("slope") * F.col("i"), F.lit(2)))).alias("line")))
    s, w = F.col("best.s"), F.col("best.w")
    sigma = F.sqrt(s["sse"] / (s["n"] - warm_up))
    ahead = s["level"] + s["trend"] + F.get(s["season"], s["n"] % period)
    r = lambda c: F.round(c, digits)
    return best.join(line, key).select(
        key, s["n"].cast("long").alias("n_days"), w["a"].alias("alpha"), w["b"].alias("beta"), w["g"].alias("gamma"), r(ahead).alias("forecast"),
        r(ahead - 1.96 * sigma).alias("low"), r(ahead + 1.96 * sigma).alias("high"), r(sigma).alias("rmse"), r(F.col("line")).alias("line_rmse"))


def negative_shares(scored: DataFrame, vocab: Vocab = REFERENCE) -> DataFrame:
    """``region, dt, share``: the negative share of each region and day."""
    neg = F.when(F.col("label") == vocab.negative, 1).otherwise(0)
    return explode_region(scored, keep=["dt", "label"]).groupBy("region", "dt").agg((F.sum(neg) / F.count(F.lit(1))).alias("share"))
