"""Fitted forecasters: saved, loaded, scored, and named by the reports."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from nightly.operators import boosting, forecast as fc, models, regress
from nightly.plans import pipelines
from nightly.sinks import writers
from nightly.sinks.models import load_fitted, save_fitted, saved_models
from nightly.sources import files

KEYS = ["user_id"]


def frame(spark, users=12, days=50):
    """Two signals that drive the target, of many users."""
    rng = random.Random(9)
    rows = []
    for u in range(users):
        for t in range(days):
            a, b = rng.random(), rng.random()
            rows.append((f"u{u}", date(2024, 1, 1) + timedelta(t), 6 + 2 * (a > 0.5) + (b > 0.7) + rng.gauss(0, 0.05), a, b))
    return spark.createDataFrame(rows, "user_id string, date date, v double, a double, b double")


OPTIONS = {"gbt": {"n_estimators": 15, "learning_rate": 0.4}, "seasonal_arx": {"exog": ["a"], "lags": 2}, "rolling_mean": {"window": 5}}


@pytest.mark.parametrize("name", sorted(models.MODELS))
@pytest.mark.parametrize("keys", [KEYS, []])
def test_a_loaded_model_scores_like_the_fitted_one(spark, folder, name, keys):
    df = frame(spark, 3)
    df = df if keys else df.where("user_id = 'u1'").drop("user_id")
    fitted = models.fit(name, df, "v", keys=keys, **OPTIONS.get(name, {}))
    direct = sorted(models.score(fitted, df).collect())
    save_fitted(spark, fitted, f"{folder}/m")
    loaded = load_fitted(spark, f"{folder}/m")
    assert (loaded.name, loaded.target, loaded.keys) == (name, "v", tuple(keys))
    assert sorted(models.score(loaded, df).collect()) == direct and len(direct) == 7 * (3 if keys else 1)
    made = saved_models(spark, folder).first()
    assert made.path.endswith("/m") and made["name"] == name


@pytest.mark.parametrize("name, forecaster", [
    ("rolling_mean", fc.rolling_mean_forecast), ("naive_mean", fc.naive_mean_forecast), ("flat", fc.flat_baseline),
    ("seasonal_arx", regress.seasonal_arx_forecast),
])
def test_fit_and_score_are_the_forecaster(spark, name, forecaster):
    df = frame(spark, 4, 40)
    got = models.score(models.fit(name, df, "v", keys=KEYS), df)
    want = forecaster(df, "v", keys=KEYS)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_pooled_trees_beat_the_rolling_mean(spark, monkeypatch):
    monkeypatch.setattr(boosting, "TRAIN_ROWS", 150)
    df = frame(spark)
    tasks = []
    real = boosting.GBTRegressor.fit

    def watched(self, rows, *more):
        tasks.append(rows.rdd.getNumPartitions())
        return real(self, rows, *more)

    monkeypatch.setattr(boosting.GBTRegressor, "fit", watched)
    trees = boosting.gbt_forecast(df, "v", keys=KEYS, n_estimators=20, learning_rate=0.3)
    flat = fc.rolling_mean_forecast(df, "v", keys=KEYS)
    error = {n: f.agg(F.avg(F.abs(F.col("actual") - F.col("prediction")))).first()[0] for n, f in (("trees", trees), ("flat", flat))}
    assert error["trees"] < 0.3 * error["flat"] and trees.count() == 12 * 7
    assert tasks == [4]


def test_train_names_its_models(spark, folder):
    nights = [
        (f"n{u}_{t}", f"u{u}", f"2024-0{1 + t // 28}-{1 + t % 28:02d} 22:00:00", 400.0 + (37 * t + 11 * u) % 90, 0.8 + (t % 9) / 100)
        for u in range(2) for t in range(56)
    ]
    df = spark.createDataFrame(nights, "id string, user_id string, start string, duration_min double, efficiency double").selectExpr(
        "id", "user_id", "timestamp(start) as start_ts", "timestamp(start) + interval 8 hours as end_ts", "duration_min", "efficiency",
        "false as is_nap", "'UTC' as tz", "'oura' as source",
    )
    writers.write_curated(df, f"{folder}/cur/sleep")
    chosen = {"seasonal_arx": {"exog": None}, "rolling_mean": {}, "gbt": {"n_estimators": 3}}
    pipelines.train(spark, f"{folder}/cur/sleep", f"{folder}/out", models=chosen)
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "part-*.json").json(f"{folder}/out/reports")
    paths = {r.model_name: r.model_path for r in raw.select("model_name", "model_path").collect()}
    assert set(paths) == set(chosen)
    daily = pipelines.daily_target(
        pipelines.circadian_features(files.curated_sleep(spark, f"{folder}/cur/sleep")), "sleep_hours", column="duration_min",
        transform="minutes_to_hours",
    )
    written = spark.read.option("header", True).csv(f"{folder}/out/forecasts")
    for name, path in paths.items():
        scored = models.score(load_fitted(spark, path), daily).agg(F.round(F.sum("prediction"), 6)).first()[0]
        kept = written.where(F.col("model") == name).agg(F.round(F.sum(F.col("prediction").cast("double")), 6)).first()[0]
        assert scored == pytest.approx(kept, abs=1e-4)


def test_a_pass_of_the_trees_starts_few_tasks(spark, monkeypatch):
    """600 passes over 25,000 rows in one task each; a task of a pass costs more to start than 10,000 rows to read."""
    seen = []

    class Trainer:
        def __init__(self, **_):
            pass

        def fit(self, rows):
            seen.append((rows.rdd.getNumPartitions(), rows.count()))

    monkeypatch.setattr(boosting, "GBTRegressor", Trainer)
    df = spark.range(25_000).selectExpr("id % 500 AS k", "date_add(date'2024-01-01', int(id div 500)) AS date", "double(id) AS v", "double(id % 7) AS x")
    boosting.gbt_train(df, "v", keys=["k"], features=["x"])
    assert seen == [(1, 25_000 - 500 * 7)]
