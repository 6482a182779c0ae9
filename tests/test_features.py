"""Circadian features, baselines and fusion against a pandas model."""

from __future__ import annotations

import os
import random
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from nightly.functions.time import to_utc_wall
from nightly.operators import circadian, fuse
from nightly.operators.baselines import personal_baselines
from tests.helpers import by, frame, record, sinusoid, utc


@pytest.fixture(scope="module")
def mixed(spark):
    """Three users, repeated days, unknown durations and a constant user."""
    rng = random.Random(11)
    rows = []
    for i in range(120):
        user = f"u{rng.randrange(3)}"
        start = utc(2024, 1, 1, 20) + timedelta(hours=7 * i, minutes=rng.randrange(60))
        minutes = None if rng.random() < 0.1 else (400.0 if user == "u0" else rng.uniform(120, 720))
        rows.append(
            record(id=f"n{i:03d}", user_id=user, start_ts=start, end_ts=start + timedelta(hours=8),
                   duration_min=minutes, efficiency=None if rng.random() < 0.1 else rng.random())
        )
    return frame(spark, rows).cache()


def _close(got, want, name):
    if want is None or (isinstance(want, float) and np.isnan(want)):
        assert got is None, name
    else:
        assert got == pytest.approx(want, abs=1e-9), name


def test_circadian_matches_a_pandas_model(spark, mixed):
    got = by(circadian.circadian_features(mixed), "id")
    pdf = mixed.withColumn("start_ts", to_utc_wall(F.col("start_ts"))).toPandas()
    pdf = pdf.sort_values(["user_id", "start_ts"]).reset_index(drop=True)
    pdf["sleep_hours"] = pdf["duration_min"] / 60
    lack = (8.0 - pdf["sleep_hours"]).clip(lower=0)
    middle = pdf["start_ts"] + pd.to_timedelta(pdf["duration_min"], unit="m") / 2
    pdf["mid"] = middle.dt.hour + middle.dt.minute / 60
    user = pdf["user_id"]

    def rolled(values, n, how="mean"):
        grouped = values.groupby(user)
        return grouped.transform(lambda s: getattr(s.rolling(n, min_periods=1), how)())

    want = {
        "sleep_hours_roll7": rolled(pdf["sleep_hours"], 7), "sleep_hours_roll14": rolled(pdf["sleep_hours"], 14),
        "efficiency_roll7": rolled(pdf["efficiency"], 7), "efficiency_roll14": rolled(pdf["efficiency"], 14),
        "sleep_debt_roll7": rolled(lack, 7, "sum"), "sleep_debt_roll14": rolled(lack, 14, "sum"),
        "midpoint_hour_local": pdf["mid"],
        "social_jetlag": (pdf["mid"] - rolled(pdf["mid"], 7)).abs().fillna(0.0),
    }
    for i, row in pdf.iterrows():
        made = got[row["id"]]
        for name, values in want.items():
            _close(made[name], values[i], name)
        assert made.date == row["start_ts"].date() and made.day_of_week == row["start_ts"].dayofweek
        assert made.month == row["start_ts"].month and made.is_weekend == (made.day_of_week >= 5)


def test_required_columns_on_the_sinusoid(spark):
    done = circadian.circadian_features(sinusoid(spark))
    assert {"sleep_hours", "sleep_hours_roll7", "sleep_hours_roll14", "social_jetlag", "day_of_week"} <= set(done.columns)
    assert done.count() == 60 and "_deficit" not in done.columns


def test_single_operators_agree_with_the_whole(mixed):
    whole = by(circadian.circadian_features(mixed), "id")
    parts = [circadian.rolling_means(mixed), circadian.sleep_debt(mixed), circadian.social_jetlag(mixed)]
    for part in parts:
        for key, row in by(part, "id").items():
            for name in set(part.columns) & set(["sleep_hours_roll7", "sleep_debt_roll14", "social_jetlag"]):
                _close(row[name], whole[key][name], name)


def test_missing_user_column_is_one_anonymous_user(mixed):
    done = circadian.circadian_features(mixed.drop("user_id"))
    assert {r.user_id for r in done.select("user_id").distinct().collect()} == {"anonymous"}


@pytest.mark.parametrize("window", [3, 30])
def test_baselines_match_a_pandas_model(spark, mixed, window):
    base = mixed.withColumns({"date": F.to_date(to_utc_wall(F.col("start_ts"))), "sleep_hours": F.col("duration_min") / 60})
    done = personal_baselines(base, order=["date", "start_ts", "id"], columns=["sleep_hours", "absent"], window=window)
    assert not [c for c in done.columns if c.startswith("absent")]
    got = by(done, "id")
    pdf = base.withColumn("start_ts", to_utc_wall(F.col("start_ts"))).toPandas().sort_values(["user_id", "start_ts"]).reset_index(drop=True)
    grouped = pdf["sleep_hours"].groupby(pdf["user_id"])
    need = min(window, 7)
    mean = grouped.transform(lambda s: s.rolling(window, min_periods=need).mean())
    std = grouped.transform(lambda s: s.rolling(window, min_periods=need).apply(np.nanstd))
    for i, row in pdf.iterrows():
        made = got[row["id"]]
        _close(made.sleep_hours_baseline, mean[i], "mean")
        _close(made.sleep_hours_baseline_std, std[i], "std")
        if made.sleep_hours_baseline_std and made.sleep_hours_baseline_std > 1e-9 and made.sleep_hours is not None:
            _close(made.sleep_hours_zscore, (row["sleep_hours"] - mean[i]) / std[i], "z")
        else:
            assert made.sleep_hours_zscore == 0.0


def _signals(spark):
    day = [date(2024, 1, d) for d in (2, 3, 4)]
    hrv = spark.createDataFrame([("u", d, 70.0 + i, 90.0) for i, d in enumerate(day)], "user_id string, date date, hrv_rmssd double, hrv_sdnn double")
    steps = spark.createDataFrame([("u", d, 9000 - i) for i, d in enumerate(day)], "user_id string, date date, steps long")
    return hrv, steps


def test_feature_store_is_a_left_join(spark):
    rows = [
        record(id=f"n{i}", start_ts=utc(2024, 1, 1 + i, 22, 30), end_ts=utc(2024, 1, 2 + i, 6), duration_min=470.0 - i)
        for i in range(3)
    ]
    sleep = frame(spark, rows).withColumns(
        {"date": F.to_date(to_utc_wall(F.col("start_ts"))), "is_weekend": F.lit(False)}
    )
    store = fuse.feature_store(sleep, _signals(spark))
    got = by(store, "date")
    assert len(got) == 3 and got[date(2024, 1, 1)].hrv_rmssd is None and got[date(2024, 1, 3)].steps == 8999
    assert {"sleep_hours", "hrv_rmssd", "steps", "sleep_hours_baseline", "sleep_hours_zscore", "steps_zscore"} <= set(store.columns)
    assert not {"start_ts", "id"} & set(store.columns)
    assert "hrv_rmssd" not in fuse.feature_store(sleep).columns


def test_repeated_signal_keys_are_reported(spark):
    hrv, _ = _signals(spark)
    fuse.check_unique_signal_keys(hrv, "hrv")
    with pytest.raises(ValueError, match="hrv"):
        fuse.check_unique_signal_keys(hrv.union(hrv), "hrv")


def test_feature_store_shuffles_each_input_once(spark):
    """Signals too large to broadcast: one exchange per input, one for the windows."""
    sleep = spark.range(100).select(
        F.concat(F.lit("u"), F.col("id") % 5).alias("user_id"), F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 3).cast("int")).alias("date"),
        F.lit(400.0).alias("duration_min"), F.lit(0.9).alias("efficiency"), F.lit(True).alias("is_weekend"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        store = fuse.feature_store(sleep, _signals(spark))
        plan = store._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 4
        assert "SinglePartition" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_registered_feature_store_has_six_exchanges(spark):
    """Sessions and four signals shuffled once each, and one shuffle by user for the windows."""
    import __spark_entry__ as entry
    from tests.conftest import DATA

    if not os.path.isdir(DATA):
        pytest.skip("needs the given tables")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()["feature_store"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_feature_store_with_a_large_user(spark):
    from nightly.operators.skew import spread

    sleep = sinusoid(spark, 80).withColumns(
        {"date": F.to_date(to_utc_wall(F.col("start_ts"))), "is_weekend": F.lit(False)}
    )
    signals = [s.withColumn("user_id", F.lit("user123")) for s in _signals(spark)]
    plain = fuse.feature_store(sleep, signals, extra=["id"])
    split = fuse.feature_store(sleep, signals, extra=["id"], found=spread(sleep, ["user_id"], 20))
    a, b = by(plain, "id"), by(split, "id")
    assert a.keys() == b.keys()
    for key, row in a.items():
        for name in plain.columns:
            want = row[name]
            assert b[key][name] == (pytest.approx(want) if isinstance(want, float) else want), name
