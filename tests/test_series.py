from __future__ import annotations

import random
import re
from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from nightly.operators import decompose, detect, forecast, regress, series, skew
from tests.helpers import by, daily


@pytest.fixture(scope="module")
def gappy(spark):
    """Two keyed daily series with missing days, NULL days at the ends and repeated days."""
    rng = random.Random(2)
    rows = []
    for key in ("a", "b"):
        for day in range(60):
            if rng.random() < 0.3:
                continue
            for _ in range(rng.choice((1, 1, 2))):
                value = None if day in (0, 1, 58, 59, 20) else rng.uniform(4, 10)
                rows.append((key, day, value))
        rows += [(key, 0, None), (key, 59, None)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    return df.select("k", F.date_add(F.to_date(F.lit("2023-12-20")), F.col("i")).alias("date"), "v").cache()


def _pandas(df, key):
    pdf = df.where(F.col("k") == key).toPandas()
    s = pdf.set_index(pd.to_datetime(pdf["date"]))["v"]
    return s.groupby(level=0).mean().asfreq("D")


@pytest.mark.parametrize("key", ["a", "b"])
def test_densify_fill_and_interpolate_match_pandas(gappy, key):
    mean = series.daily_mean(gappy, "v", keys=["k"])
    dense = series.calendar_densify(mean, keys=["k"])
    want = _pandas(gappy, key)

    def column(df):
        rows = df.where(F.col("k") == key).orderBy("date").collect()
        assert [pd.Timestamp(r.date) for r in rows] == list(want.index)
        return np.array([np.nan if r.v is None else r.v for r in rows])

    np.testing.assert_allclose(column(dense), want.to_numpy())
    np.testing.assert_allclose(column(series.forward_fill(dense, ["v"], keys=["k"])), want.ffill().to_numpy())
    line = want.interpolate(limit_direction="both").to_numpy()
    np.testing.assert_allclose(column(series.interpolate_linear(dense, "v", keys=["k"])), line)
    np.testing.assert_allclose(column(series.regular_series(gappy, "v", keys=["k"])), line)


def test_series_chain_has_one_shuffle_after_the_mean(gappy):
    plan = series.regular_series(gappy, "v", keys=["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "SinglePartition" not in plan


def test_single_day_and_empty_series(spark):
    one = series.regular_series(daily(spark, [5.0]), "v")
    assert [tuple(r) for r in one.collect()] == [(date(2024, 1, 1), 5.0)]
    assert series.regular_series(daily(spark, [5.0]).where("false"), "v").count() == 0
    assert series.forecast_calendar(daily(spark, [None]).where("false"), 3).count() == 0


def test_exog_align(spark):
    spine = daily(spark, [1, 1, 1, 1]).select("date")
    features = daily(spark, [None, 2, None, 4]).withColumnRenamed("v", "x")
    got = [r.x for r in series.exog_align(spine, features, ["x"]).orderBy("date").collect()]
    assert got == [None, 2.0, 2.0, 4.0]


def test_daily_target_means_every_numeric_column(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), 420.0, True, "x", 1), (date(2024, 1, 1), 480.0, False, "y", 2), (date(2024, 1, 2), None, True, "z", 3)],
        "date date, duration_min double, nap boolean, name string, n int",
    )
    done = series.daily_target(df, "hours", column="duration_min", transform="minutes_to_hours")
    row = done.collect()
    assert len(row) == 1 and "name" not in done.columns
    assert (row[0].hours, row[0].duration_min, row[0].nap, row[0].n) == (7.5, 450.0, 0.5, 1.5)
    with pytest.raises(ValueError):
        series.daily_target(df, "absent")
    with pytest.raises(ValueError):
        series.daily_target(df, "n", transform="log")


def test_lag_pairs(spark):
    got = [(r.y_t, r.y_next) for r in series.lag_pairs(daily(spark, [1, 2, 4]), "v").orderBy("date").collect()]
    assert got == [(1.0, 2.0), (2.0, 4.0)]


def test_acf_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = np.cumsum(rng.normal(size=80))
    got = by(series.acf(daily(spark, x), "v", 10), "lag")
    d = x - x.mean()
    r = [float((d[k:] * d[: len(d) - k]).sum() / (d * d).sum()) for k in range(11)]
    for k in range(11):
        assert got[k].acf == pytest.approx(r[k])
        band = 0.0 if k == 0 else series.Z95 * np.sqrt((1 + 2 * sum(v * v for v in r[1:k])) / 80)
        assert got[k].band == pytest.approx(band)
    assert series.acf(daily(spark, [1, 2, 3]), "v", 30).count() == 3
    assert {row.acf for row in series.acf(daily(spark, [2, 2, 2]), "v", 2).collect()} == {None}


@pytest.mark.parametrize(
    "values,best",
    [([], None), ([5, 10], 0), ([7, 9, 8], 3), ([7, None, 8, 8, 6, 7], 2), ([6, 7, 7, 6, 8, 8, 8], 3)],
)
def test_streak(spark, values, best):
    df = daily(spark, values) if values else daily(spark, [1]).where("false")
    row = series.healthy_streak(df, "v").first()
    assert (row.best_streak if row else None) == best


def test_streak_over_missing_days(spark):
    df = daily(spark, [8, 8, None, 8]).where("v is not null")
    assert series.healthy_streak(df, "v").first().best_streak == 3
    assert series.healthy_streak(df, "v", calendar=True).first().best_streak == 2


def test_last_rows_limit_before_the_shuffle(spark, gappy):
    done = series.last_rows(gappy, 2, keys=["k"], order=["date", "v"])
    assert done.count() == 4
    assert "WindowGroupLimit" in done._jdf.queryExecution().executedPlan().toString()


def test_iso_week_goes_with_its_year(spark):
    df = spark.sql("select timestamp_ntz'2024-12-30 08:05:00' as start_ts union all select timestamp_ntz'2023-01-01 00:00:00'")
    got = [(r.iso_week, r.day_name) for r in series.calendar_features(df).orderBy("start_ts").collect()]
    assert got == [("2022-W52", "Sunday"), ("2025-W01", "Monday")]


@pytest.mark.parametrize("period", [7, 4])
def test_decomposition_matches_a_numpy_model(spark, period):
    rng = np.random.default_rng(1)
    n = 41
    y = 7 + 0.02 * np.arange(n) + np.sin(2 * np.pi * np.arange(n) / period) + rng.normal(scale=0.1, size=n)
    weights = np.full(period, 1 / period) if period % 2 else np.r_[0.5, np.ones(period - 1), 0.5] / period
    half = len(weights) // 2
    trend = np.full(n, np.nan)
    trend[half : n - half] = np.convolve(y, weights, mode="valid")
    means = np.array([np.nanmean((y - trend)[k::period]) for k in range(period)])
    means -= means.mean()
    seasonal = np.tile(means, n // period + 1)[:n]
    rows = decompose.seasonal_decompose(daily(spark, y, key="s"), "v", period, keys=["k"]).orderBy("date").collect()
    got = {c: np.array([np.nan if r[c] is None else r[c] for r in rows]) for c in ("trend", "seasonal", "resid")}
    np.testing.assert_allclose(got["trend"], trend)
    np.testing.assert_allclose(got["seasonal"], seasonal)
    np.testing.assert_allclose(got["resid"], y - trend - seasonal, atol=1e-12)


def test_decomposition_needs_two_periods(spark):
    assert decompose.seasonal_decompose(daily(spark, range(13)), "v").count() == 0
    assert decompose.seasonal_decompose(daily(spark, range(14)), "v").count() == 14


def test_decomposition_uses_one_shuffle(spark):
    done = decompose.seasonal_decompose(daily(spark, range(30), key="s"), "v", keys=["k"])
    assert done._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_change_points_match_numpy(spark):
    y = [7.0] * 10 + [12.0] * 10 + [None] + [12.0, 12.1, 12.0]
    clean = np.array([v for v in y if v is not None])
    jumps = np.abs(np.diff(clean))
    want = [i + 1 for i, v in enumerate(jumps) if v >= 3 * jumps.std()]
    got = detect.change_points(daily(spark, y), "v", penalty=3.0).collect()
    assert [r.position for r in got] == want == [10]
    assert got[0].date == date(2024, 1, 11) and got[0].jump == 5.0


def test_change_points_of_short_and_constant_series(spark):
    assert detect.change_points(daily(spark, [1, 9] * 4), "v", penalty=0.1).count() == 0
    assert detect.change_points(daily(spark, [3] * 12), "v").count() == 0
    # Equal jumps have no deviation: the penalty itself is the limit.
    assert detect.change_points(daily(spark, [0, 6] * 6), "v").count() == 11


def _residuals(spark, values, key="m"):
    return spark.createDataFrame([(key, i, v) for i, v in enumerate(values)], "k string, i int, residual double")


def test_zscore_anomalies(spark):
    values = [0.1, -0.1] * 20 + [None, 9.0]
    clean = np.array([v for v in values if v is not None])
    far = np.abs(clean - clean.mean()) >= 3 * clean.std()
    for keys in ([], ["k"]):
        rows = detect.anomalies_zscore(_residuals(spark, values), keys=keys).orderBy("i").collect()
        assert [r.is_anomaly for r in rows] == list(far) and rows[0].method == "zscore"
    assert not any(r.is_anomaly for r in detect.anomalies_zscore(_residuals(spark, [2.0] * 5)).collect())
    assert detect.anomalies_zscore(_residuals(spark, [None])).count() == 0


def test_iqr_anomalies(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    rows = detect.anomalies_iqr(_residuals(spark, values), threshold=1.5).orderBy("i").collect()
    assert [r.is_anomaly for r in rows] == [False] * 4 + [True]
    assert not any(r.is_anomaly for r in detect.anomalies_iqr(_residuals(spark, [1.0] * 8 + [9.0])).collect())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tasks(df) -> set[int]:
    return {int(n) for n in re.findall(r"hashpartitioning\([^()]*, (\d+)\), REPARTITION_BY_NUM", _plan(df))}


def _sorted(df):
    return sorted(tuple(str(v) if c in ("k", "date") else round(v, 9) if v is not None else -1.0 for c, v in zip(df.columns, r)) for r in df.collect())


@pytest.mark.parametrize(
    "make",
    [
        lambda df: series.regular_series(df, "v", keys=["k"]),
        lambda df: decompose.seasonal_decompose(series.regular_series(df, "v", keys=["k"]), "v", keys=["k"]),
        lambda df: forecast.ar1_forecast(series.regular_series(df, "v", keys=["k"]), "v", keys=["k"]),
        lambda df: regress.autoreg_fitted(series.regular_series(df, "v", keys=["k"]), "v", 5, keys=["k"]),
    ],
)
def test_tasks_grow_with_the_days_of_the_series(gappy, monkeypatch, make):
    usual = make(gappy)
    monkeypatch.setattr(skew, "TASK_DAYS", 2)
    many = make(gappy)
    assert _tasks(many) == {60} and _tasks(usual) == {8}  # two series of 60 days, eight cores
    assert _plan(many).count("Exchange hashpartitioning") == 2
    assert _sorted(many) == _sorted(usual)


@pytest.mark.parametrize("fill", [lambda d: series.forward_fill(d, ["v"], keys=["k"]), lambda d: series.interpolate_linear(d, "v", keys=["k"])])
def test_tasks_of_a_filled_calendar_grow_with_its_days(gappy, monkeypatch, fill):
    mean = series.daily_mean(gappy, "v", keys=["k"])
    usual = fill(series.calendar_densify(mean, keys=["k"]))
    monkeypatch.setattr(skew, "TASK_DAYS", 2)
    many = fill(series.calendar_densify(mean, keys=["k"]))
    assert _tasks(many) == {60} and _plan(many).count("Exchange hashpartitioning") == 2
    assert _sorted(many) == _sorted(usual) == _sorted(fill(series.calendar_densify(mean, keys=["k"], tasks=3)))
