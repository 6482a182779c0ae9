"""Regressions by normal equations against NumPy's least squares, row by row."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightly.operators import normal, regress, skew

DAY = dt.date(2024, 1, 1)


def rows_of(spark, data):
    return spark.createDataFrame(data, "k string, date date, v double, x double, twice double, gappy double")


def made(rng, key, n, gap=0.1):
    level, out = 7.0, []
    for t in range(n):
        level = 3 + 0.6 * level + rng.gauss(0, 0.5) + (t % 7 == 5)
        x = rng.gauss(0, 1)
        if rng.random() >= gap or t in (0, n - 1):
            out.append((key, DAY + dt.timedelta(t), level + x, x, 2 * x, None if t == 0 and key == "b" else rng.random()))
    return out


def solved(design, y):
    keep = []
    for j in range(design.shape[1]):
        if np.linalg.matrix_rank(design[:, [*keep, j]]) > len(keep):
            keep.append(j)
    beta = np.zeros(design.shape[1])
    beta[keep] = np.linalg.lstsq(design[:, keep], y, rcond=None)[0]
    return beta, len(keep)


def plain_arx(data, exog, lags, horizon=7, window=30, season=7, z=regress.BAND_Z):
    grid, last, known = [], None, {d: r for _, d, *r in data}
    day = min(known)
    while day <= max(known):
        last = known.get(day, last)
        grid.append((day, last))
        day += dt.timedelta(1)
    y = np.array([r[0] for _, r in grid])
    x = np.array([[r[i] for i in exog] for _, r in grid], float).reshape(len(y), len(exog))
    unknown = np.isnan(x).any(axis=0)
    x[:, unknown] = 0
    n = len(y)
    end = min(n, max(n - min(horizon, max(1, n // 3)), max(10, n - window)))
    dy, dx = y[season:] - y[:-season], x[season:] - x[:-season]
    at = range(season + lags, end)
    steps, out = n - end, list(y[:end])
    if len(at) < 1 + lags + (~unknown).sum() + 2:
        return [(d, y[:end].mean(), y[:end].mean() - 0.5, y[:end].mean() + 0.5) for d, _ in grid[end:]]
    design = np.array([[1, *(dy[t - season - k] for k in range(1, lags + 1)), *dx[t - season]] for t in at])
    beta, used = solved(design, dy[: end - season][lags:])
    rest = dy[: end - season][lags:] - design @ beta
    sigma = np.sqrt(rest @ rest / max(1, len(at) - used))
    shock, weight, total, done = [], [], 0.0, []
    for s in range(steps):
        t = end + s
        moves = [out[t - k] - out[t - k - season] for k in range(1, lags + 1)]
        out.append(out[t - season] + beta[0] + beta[1 : 1 + lags] @ moves + beta[1 + lags :] @ dx[t - season])
        shock.append(1.0 if s == 0 else sum(beta[1 + k] * shock[s - 1 - k] for k in range(lags) if s - 1 - k >= 0))
        weight.append(shock[s] + (weight[s - season] if s >= season else 0))
        total += weight[s] ** 2
        half = z * sigma * np.sqrt(total)
        done.append((grid[t][0], out[t], out[t] - half, out[t] + half))
    return done


@pytest.mark.parametrize("lags, exog", [(1, []), (2, ["x"]), (3, ["x", "twice", "gappy"])])
def test_arx_equals_a_plain_fit(spark, lags, exog):
    rng = random.Random(lags)
    data = {k: made(rng, k, n) for k, n in (("a", 90), ("b", 60), ("short", 14), ("c", 31))}
    df = rows_of(spark, [r for rows in data.values() for r in rows]).repartition(3)
    got = regress.seasonal_arx_forecast(df, "v", keys=["k"], exog=exog, lags=lags, horizon=12).collect()
    place = {"x": 1, "twice": 2, "gappy": 3}
    for k, rows in data.items():
        want = plain_arx(rows, [place[e] for e in exog], lags, horizon=12)
        mine = sorted((r.date, r.prediction, r.lower, r.upper) for r in got if r.k == k)
        assert [r[0] for r in mine] == [r[0] for r in want]
        np.testing.assert_allclose([r[1:] for r in mine], [r[1:] for r in want], rtol=1e-6, atol=1e-6)


def test_solve_drops_dependent_columns(spark):
    rng = np.random.default_rng(0)
    for width, twin in ((4, None), (5, 2), (3, 1)):
        x = rng.normal(size=(40, width))
        if twin is not None:
            x[:, twin] = 3 * x[:, 0]
        y = rng.normal(size=40)
        full = np.column_stack([x, y])
        gram = (full.T @ full)[:width].tolist()
        one = spark.createDataFrame([(gram,)], "g array<array<double>>").select(normal.solve(F.col("g"), width).alias("s")).first().s
        beta, used = solved(x, y)
        assert one.used == used
        np.testing.assert_allclose(one.beta, beta, atol=1e-9)


def test_no_python_in_the_plans(spark):
    df = rows_of(spark, made(random.Random(1), "a", 60))
    for made_df in (
        regress.autoreg_fit(df, "v", 3, keys=["k"]), regress.autoreg_forecast(df, "v", 3, 5, keys=["k"]),
        regress.seasonal_arx_forecast(df, "v", keys=["k"], exog=["x"]),
    ):
        plan = made_df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_lag_products_equal_the_sums(spark):
    rng = random.Random(5)
    y = [rng.gauss(7, 2) for _ in range(50)]
    df = spark.createDataFrame([(DAY + dt.timedelta(t), v) for t, v in enumerate(y)], "date date, v double")
    for lags in (1, 4, 20):
        got = [r.coefficient for r in regress.autoreg_fit(df, "v", lags).orderBy("term").collect()]
        z = np.array(y)
        design = np.column_stack([np.ones(50 - lags), *[z[lags - k : 50 - k] for k in range(1, lags + 1)]])
        np.testing.assert_allclose(got, np.linalg.lstsq(design, z[lags:], rcond=None)[0], atol=1e-7)


def test_a_series_is_one_narrow_row(spark):
    """No lag columns beside the days, and no join that shuffles the days anew."""
    df = rows_of(spark, made(random.Random(3), "a", 60))
    inputs = df.groupBy("k", "date").agg(F.avg("v").alias("v"))
    own = plan_of(inputs).count("Exchange")
    for made_df in (
        regress.autoreg_fit(inputs, "v", 5, keys=["k"]), regress.autoreg_forecast(inputs, "v", 5, 3, keys=["k"]),
        regress.autoreg_fitted(inputs, "v", 5, keys=["k"]),
    ):
        plan = plan_of(made_df)
        assert "Join" not in plan and "Window" not in plan and plan.count("Exchange") == own + 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fitted_values_of_null_keys_and_repeated_days(spark):
    rng = np.random.default_rng(4)
    y = rng.normal(7, 1, 40)
    rows = [(k, DAY + dt.timedelta(t), float(v + shift)) for k in (None, "a") for t, v in enumerate(y) for shift in (-1, 1)]
    got = regress.autoreg_fitted(spark.createDataFrame(rows, "k string, date date, v double"), "v", 4, keys=["k"]).collect()
    design = np.column_stack([np.ones(36), *[y[4 - k : 40 - k] for k in range(1, 5)]])
    want = design @ np.linalg.lstsq(design, y[4:], rcond=None)[0]
    for key in (None, "a"):
        mine = sorted((r.date, r.actual, r.fitted) for r in got if r.k == key)
        assert [r[0] for r in mine] == [DAY + dt.timedelta(t) for t in range(4, 40)]
        np.testing.assert_allclose([r[1:] for r in mine], np.column_stack([y[4:], want]))


def test_tasks_of_the_arx_grow_with_the_days(spark, monkeypatch):
    rng = random.Random(6)
    df = rows_of(spark, made(rng, "a", 60) + made(rng, "b", 60))
    usual = regress.seasonal_arx_forecast(df, "v", keys=["k"], exog=["x"])
    monkeypatch.setattr(skew, "TASK_DAYS", 2)
    many = regress.seasonal_arx_forecast(df, "v", keys=["k"], exog=["x"])
    assert "60), REPARTITION_BY_NUM" in plan_of(many)  # two series of 60 days
    a, b = (sorted((r.k, r.date, r.prediction, r.lower) for r in d.collect()) for d in (usual, many))
    assert [r[:2] for r in a] == [r[:2] for r in b]
    np.testing.assert_allclose([r[2:] for r in a], [r[2:] for r in b])
