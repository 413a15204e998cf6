"""Exponential smoothing against a plain loop; its forecast on known series."""

import math
import random

import pytest

from murmur.operators import forecast


def plain(values, period=7, warm_up=7):
    best = None
    for i, (a, b, g) in enumerate((a, b, g) for a in forecast.ALPHAS for b in forecast.BETAS for g in forecast.GAMMAS):
        level, trend, season, sse = values[0], 0.0, [0.0] * period, 0.0
        for n, y in enumerate(values):
            error = y - (level + trend + season[n % period])
            old, level = level, level + trend + a * error
            trend += b * (level - old - trend)
            season[n % period] += g * (y - level - season[n % period])
            sse += error * error if n >= warm_up else 0
        key = (round(sse, 12), i)
        if best is None or key < best[0]:
            best = key, (a, b, g), level + trend + season[len(values) % period], math.sqrt(sse / (len(values) - warm_up))
    return best[1:]


def test_smoothing_equals_a_plain_loop_and_a_straight_line_is_its_rival(spark):
    rng = random.Random(5)
    series = {f"k{j}": [0.3 + 0.01 * j * t / 9 + 0.1 * (t % 7 == 3) + rng.uniform(-0.02, 0.02) for t in range(n)]
              for j, n in enumerate((8, 15, 30, 31))}
    rows = [(k, f"2024-01-{t + 1:02d}", v) for k, vs in series.items() for t, v in enumerate(vs)]
    rows += [("short", f"2024-01-{t + 1:02d}", 0.5) for t in range(7)] + [(None, "2024-01-01", 0.1), ("k0", "2024-02-09", None)]
    rng.shuffle(rows)
    got = {r["region"]: r for r in forecast.smoothed_forecast(
        spark.createDataFrame(rows, "region string, dt string, share double"), "region").collect()}
    assert got.keys() == series.keys()
    for k, values in series.items():
        (a, b, g), ahead, rmse = plain(values)
        r = got[k]
        assert (r["alpha"], r["beta"], r["gamma"], r["n_days"]) == (a, b, g, len(values))
        assert r["forecast"] == pytest.approx(ahead, abs=1e-6) and r["rmse"] == pytest.approx(rmse, abs=1e-6)
        assert r["high"] - r["low"] == pytest.approx(2 * 1.96 * rmse, abs=3e-6)
        errors = []
        for n in range(7, len(values)):
            xs, ys = range(n - 7, n), values[n - 7:n]
            mx, my = sum(xs) / 7, sum(ys) / 7
            slope = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / sum((x - mx) ** 2 for x in xs)
            errors.append((values[n] - my - slope * (n - mx)) ** 2)
        assert r["line_rmse"] == pytest.approx(math.sqrt(sum(errors) / len(errors)), abs=1e-6)
    assert got["k3"]["rmse"] < got["k3"]["line_rmse"]


def test_constant_series_and_empty_tables(spark):
    df = spark.createDataFrame([("a", f"2024-01-{t + 1:02d}", 0.25) for t in range(10)], "region string, dt string, share double")
    r = forecast.smoothed_forecast(df, "region").first()
    assert (r["forecast"], r["low"], r["high"], r["rmse"]) == (0.25, 0.25, 0.25, 0.0)
    assert forecast.smoothed_forecast(df.limit(0), "region").count() == 0
