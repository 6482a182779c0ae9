from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightly.operators import boosting, forecast as fc, regress
from tests.helpers import by, daily


@pytest.mark.parametrize("n,test", [(1, 1), (2, 1), (5, 1), (9, 3), (40, 7)])
def test_split_sizes(spark, n, test):
    rows = fc.backtest_split(daily(spark, range(n))).orderBy("date").collect()
    assert [r.is_test for r in rows] == [False] * (n - test) + [True] * test


def test_split_window_and_floor(spark):
    df = daily(spark, range(40))
    assert fc.backtest_split(df, backtest_window=3).where("is_test").count() == 3
    assert fc.backtest_split(daily(spark, range(12)), min_train=10).where("is_test").count() == 2
    assert fc.backtest_split(daily(spark, range(6)), min_train=10).where("is_test").count() == 0


def test_rolling_mean_forecast(spark):
    rows = fc.rolling_mean_forecast(daily(spark, range(30)), "v").orderBy("date").collect()
    assert [r.actual for r in rows] == [float(v) for v in range(23, 30)]
    assert {(r.prediction, r.lower, r.upper) for r in rows} == {(19.0, 18.5, 19.5)}
    flat = fc.flat_baseline(daily(spark, range(30)), "v", backtest_window=2).collect()
    assert len(flat) == 7 and flat[0].lower is None
    assert fc.last_rolling_mean(daily(spark, range(30)), "v").first().level == 26.0


def test_naive_mean_forecast(spark):
    rows = fc.naive_mean_forecast(daily(spark, range(30)), "v").collect()
    assert len(rows) == 7 and rows[0].prediction == pytest.approx(np.mean(range(23)))


def test_metrics(spark):
    rows = [
        ("m", "t", 7.0, 6.5, 7.5, 7.4), ("m", "t", 1.0, 0.5, 1.5, 0.0), ("m", "t", 7.0, 6.5, 7.5, None),
        ("n", "t", 4.0, None, None, 5.0),
    ]
    df = spark.createDataFrame(rows, "model string, target string, prediction double, lower double, upper double, actual double")
    got = by(fc.backtest_metrics(df), "model")
    assert got["m"].mae == pytest.approx(0.7) and got["m"].mape == pytest.approx(0.4 / 7.4)
    assert got["m"].coverage == pytest.approx(1 / 3)
    assert (got["n"].mae, got["n"].mape, got["n"].coverage) == (1.0, 0.2, None)


def _ar(n=120, seed=0):
    rng = np.random.default_rng(seed)
    y = [7.0]
    for _ in range(n - 1):
        y.append(2.0 + 0.7 * y[-1] + rng.normal(scale=0.3))
    return np.array(y)


def test_ar1_equals_the_keyed_regression_with_one_lag(spark):
    df = daily(spark, _ar(), key="a")
    fit = fc.ar1_fit(df, "v", keys=["k"]).first()
    beta = {r.term: r.coefficient for r in regress.autoreg_fit(df, "v", 1, keys=["k"]).collect()}
    assert (fit.intercept, fit.slope) == (pytest.approx(beta[0]), pytest.approx(beta[1]))
    closed = by(fc.ar1_forecast(df, "v", 10, keys=["k"]), "step")
    walked = by(regress.autoreg_forecast(df, "v", 1, 10, keys=["k"]), "step")
    for step in range(1, 11):
        assert closed[step].forecast == pytest.approx(walked[step].forecast)
        assert closed[step].date == walked[step].date
    assert closed[1].date == date(2024, 4, 30)


def test_autoreg_matches_numpy(spark):
    y, p = _ar(), 5
    x = np.column_stack([np.ones(len(y) - p)] + [y[p - k : len(y) - k] for k in range(1, p + 1)])
    beta = np.linalg.lstsq(x, y[p:], rcond=None)[0]
    df = daily(spark, y)
    got = [r.coefficient for r in regress.autoreg_fit(df, "v", p).orderBy("term").collect()]
    assert got == pytest.approx(list(beta))
    fitted = regress.autoreg_fitted(df, "v", p).orderBy("date").collect()
    assert [r.fitted for r in fitted] == pytest.approx(list(x @ beta)) and fitted[0].date == date(2024, 1, 6)
    known = list(y)
    for _ in range(3):
        known.append(beta[0] + sum(beta[k] * known[-k] for k in range(1, p + 1)))
    ahead = regress.autoreg_forecast(df, "v", p, 3).orderBy("step").collect()
    assert [r.forecast for r in ahead] == pytest.approx(known[-3:])


def test_autoreg_of_short_and_constant_series(spark):
    assert regress.autoreg_fit(daily(spark, range(5), key="a"), "v", 5, keys=["k"]).count() == 0
    assert regress.autoreg_forecast(daily(spark, range(5)), "v", 5, 3).count() == 0
    assert regress.autoreg_fitted(daily(spark, range(5)), "v", 5).count() == 0
    flat = regress.autoreg_forecast(daily(spark, [6.0] * 20), "v", 3, 2).collect()
    assert [r.forecast for r in flat] == pytest.approx([6.0, 6.0])


def test_seasonal_arx_follows_an_exact_weekly_series(spark):
    weekly = [6.0, 6.5, 7.0, 7.5, 8.0, 9.0, 9.5]
    y = [weekly[i % 7] + 0.01 * i for i in range(70)]
    rows = regress.seasonal_arx_forecast(daily(spark, y, key="a"), "v", keys=["k"]).orderBy("date").collect()
    assert len(rows) == 7
    for r in rows:
        assert r.prediction == pytest.approx(r.actual) and r.lower <= r.prediction <= r.upper


def test_seasonal_arx_uses_features_and_widens_its_band(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=90)
    y = 7 + 2 * x + rng.normal(scale=0.01, size=90)
    df = daily(spark, y).join(daily(spark, x).withColumnRenamed("v", "x"), "date")
    with_x = regress.seasonal_arx_forecast(df, "v", exog=["x"]).orderBy("date").collect()
    without = regress.seasonal_arx_forecast(df, "v").collect()
    every = regress.seasonal_arx_forecast(df, "v", exog=None).orderBy("date").collect()
    assert [r.prediction for r in every] == [r.prediction for r in with_x]
    error = lambda rows: np.mean([abs(r.prediction - r.actual) for r in rows])
    assert error(with_x) < 0.1 < error(without)
    widths = [r.upper - r.lower for r in with_x]
    assert all(b >= a - 1e-9 for a, b in zip(widths, widths[1:]))


def test_seasonal_arx_falls_back_to_the_mean(spark):
    rows = regress.seasonal_arx_forecast(daily(spark, range(14), key="a"), "v", keys=["k"]).collect()
    assert len(rows) == 4 and rows[0].prediction == pytest.approx(4.5) and rows[0].upper == pytest.approx(5.0)
    assert regress.seasonal_arx_forecast(daily(spark, [None, None], key="a"), "v", keys=["k"]).count() == 0


def test_forecast_vs_actual_keeps_days_without_actual(spark):
    ahead = spark.createDataFrame([(date(2024, 1, 2), 7.0), (date(2025, 1, 1), 7.0)], "date date, prediction double")
    got = by(fc.forecast_vs_actual(ahead, daily(spark, [1, 2]), "v"), "date")
    assert got[date(2024, 1, 2)].actual == 2.0 and got[date(2025, 1, 1)].actual is None


def test_gbt_learns_and_leaves_the_target_source_out(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 1, 80)
    df = daily(spark, 6 + 2 * (x > 0.5)).join(daily(spark, x).withColumnRenamed("v", "x"), "date")
    df = df.withColumns({"duration_min": F.col("v") * 60, "sleep_hours": F.col("v")}).drop("v")
    assert boosting.feature_columns(df, "sleep_hours") == ["x"]
    assert boosting.feature_columns(df, "sleep_hours", leaky=True) == ["x", "duration_min"]
    model, made = boosting.gbt_fit(df, "sleep_hours", n_estimators=5, learning_rate=0.5)
    rows = made.collect()
    assert len(rows) == 7 and np.mean([abs(r.prediction - r.actual) for r in rows]) < 0.3
    assert model.getNumTrees == 5 and rows[0].lower is None
    with pytest.raises(ValueError):
        boosting.gbt_fit(df.select("date", "sleep_hours"), "sleep_hours")


def test_register_forecaster(spark):
    fc.register_forecaster("same", lambda df, target, **kw: df)
    assert fc.FORECASTERS.pop("same") is not None
