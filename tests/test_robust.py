"""NULL keys, rows that must not vanish, text of many spellings."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from nightly.functions.frame import attach_stats
from nightly.functions.time import local_to_utc
from nightly.operators import canonical, profile
from nightly.operators.forecast import feature_columns
from nightly.operators.series import regular_series
from nightly.operators.skew import row_windows, running_totals, spread
from nightly.plans.pipelines import ingest
from nightly.sinks import writers
from nightly.sources import files, text
from tests.helpers import by, frame, record, utc


def _raw(spark, folder, rows):
    names = ["sleep_id", "user_id", "bedtime_start", "bedtime_end", "duration_min", "efficiency", "is_long_nap", "timezone"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    df.coalesce(1).write.option("header", True).csv(f"{folder}/in")
    return f"{folder}/in"


def test_ingest_loses_no_row(spark, folder):
    good = ("a", "u", "2024-01-01T22:00:00", "2024-01-02T06:00:00", "480", "0.9", "false", "UTC")
    rows = [good, ("b", *good[1:7], "Mars/Base"), ("c", "u", "not a time", *good[3:]), ("d", "u", "2024-11-03T01:30:00", "2024-11-03T09:00:00", "450", "0.9", "no", "America/Los_Angeles"), ("e", *good[1:5], "87", *good[6:])]
    path, out = _raw(spark, folder, rows), f"{folder}/sleep"
    done = ingest(spark, "oura", path, out)
    assert done.rows == 1 and files.scan_curated(spark, out).count() == 1
    bad = by(files.scan_curated(spark, f"{out}_quarantine"), "id")
    assert set(bad) == set("bcde") and "tz_unknown" in bad["b"].violations and "start_ts_null" in bad["d"].violations
    assert done.path.endswith(f"run_id={bad['b'].run_id}")
    with pytest.raises(ValueError, match="tz_unknown"):
        ingest(spark, "oura", path, f"{folder}/strict", strict=True)


def test_null_is_a_key(spark):
    rows = [(i, None if i % 3 == 0 else "k", float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, k string, duration_min double")
    want = df.toPandas().groupby("k", dropna=False).duration_min.agg(["mean", "median"])
    got = {r.k: r for r in profile.headline_metrics(df, "duration_min", ["k"]).collect()}
    z = by(canonical.zscore_duration(df, ["k"]), "id")
    for k, sub in df.toPandas().groupby("k", dropna=False):
        k = k if isinstance(k, str) else None
        assert got[k].nights == len(sub) and got[k].median_hours == pytest.approx(sub.duration_min.median())
        for i, v in zip(sub.id, sub.duration_min):
            assert z[i].duration_zscore == pytest.approx((v - sub.duration_min.mean()) / sub.duration_min.std(ddof=0))
    assert len(want) == 2 and attach_stats(df, df.groupBy("k").agg(F.max("id").alias("m")), ["k"]).where("m is null").isEmpty()


def test_a_large_null_key_is_split(spark):
    rows = [(None if i < 90 else f"k{i % 2}", i, float(i % 7)) for i in range(100)]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    found = spread(df, ["k"], 20)
    small, large = found.split(df)
    assert (small.count(), large.count()) == (10, 90)

    def sums(w):
        return [F.sum("v").over(w.rowsBetween(-6, 0)).alias("s")]

    plain = by(row_windows(df, sums, keys=["k"], order=["i"], lookback=6), "i")
    split = by(row_windows(df, sums, keys=["k"], order=["i"], lookback=6, found=found), "i")
    assert {i: r.s for i, r in plain.items()} == {i: r.s for i, r in split.items()}
    tiny = by(row_windows(df, sums, keys=["k"], order=["i"], lookback=6, found=spread(df, ["k"], 3)), "i")
    assert {i: r.s for i, r in plain.items()} == {i: r.s for i, r in tiny.items()}
    totals = by(running_totals(df, {"t": F.col("v")}, keys=["k"], order=["i"], found=found), "i")
    assert {i: r.t for i, r in totals.items()} == {i: r.t for i, r in by(running_totals(df, {"t": F.col("v")}, keys=["k"], order=["i"]), "i").items()}


def test_dates_of_many_spellings(spark):
    raw = spark.createDataFrame([(d, "7.5") for d in ("2021-05-01", "5/2/2021", "May 3, 2021", "2021/05/04", "5 May 2021", "never")], "date string, sleep_hours string")
    assert sorted(str(r.date) for r in text.primary_daily(raw).collect()) == [f"2021-05-0{i}" for i in range(1, 6)]
    steps = text.step_signals(raw.select(F.lit("u").alias("user_id"), "date", F.lit("10").alias("steps")))
    assert steps.where("date is null").count() == 1


def test_offsets_count_in_durations(spark):
    raw = spark.createDataFrame([("2024-03-31 00:30:00 +0100", "2024-03-31 08:30:00 +0200"), ("1/2/2024 22:00:00", "2/2/2024 06:00:00")], "startDate string, endDate string")
    got = text.secondary_sessions(raw).collect()
    assert [r.hours for r in got] == [7.0, 8.0] and got[0].startDate == datetime(2024, 3, 31, 0, 30)


def test_screen_time_does_not_follow_the_session_zone(spark):
    events = spark.createDataFrame([("u", utc(2024, 1, 1, 23, 30))], "user_id string, timestamp timestamp")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            row = text.late_screen_rollup(events).first()
            assert row.late_screen_flag and str(row.date) == "2024-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("zone,wall", [("Antarctica/Troll", "2024-10-27 01:10:00"), ("Antarctica/Troll", "2024-10-27 02:30:00"), ("Factory", "2024-01-01 00:00:00")])
def test_times_that_occur_twice_and_zones_the_jvm_lacks(spark, zone, wall):
    df = spark.sql(f"SELECT TIMESTAMP_NTZ'{wall}' AS t, '{zone}' AS tz")
    assert local_to_utc(df, ["t"], "tz").first().t is None


def test_reports_of_both_layouts(spark, folder):
    rows = [(f"m{i % 2}", "t", (0.1, 0.2, 0.3)) for i in range(50)]
    reports = spark.createDataFrame(rows, "model_name string, target string, metrics struct<mae:double,mape:double,coverage:double>")
    writers.write_reports(reports, f"{folder}/r")
    assert files.scan_reports(spark, f"{folder}/r").count() == 50
    with open(f"{folder}/r/own.json", "w") as f:
        json.dump({"model_name": "x", "target": "t", "metrics": {"mae": 1.0}}, f, indent=2)
    assert files.scan_reports(spark, f"{folder}/r").count() == 51


def test_runs_and_own_baselines_are_no_features(spark, folder):
    writers.write_curated(frame(spark, [record()]), f"{folder}/s", now=utc(2024, 1, 1, 0, 0, 7))
    back = files.curated_sleep(spark, f"{folder}/s")
    assert back.first().run_id.startswith("000007")
    wide = back.selectExpr("*", "1.0 as sleep_hours", "2.0 as sleep_hours_baseline", "2.0 as sleep_hours_baseline_std", "0.0 as sleep_hours_zscore", "1 as steps")
    found = feature_columns(wide, "sleep_hours")
    assert "steps" in found and not {"run_id", "run_date", "sleep_hours_baseline", "sleep_hours_baseline_std", "sleep_hours_zscore"} & set(found)


def test_nan_and_minus_zero(spark):
    df = spark.createDataFrame([(float("nan"),), (0.0,), (-0.0,), (None,)], "v double")
    assert profile.missing_counts(df).first().missing == 2
    assert profile.distinct_counts(df).first().distinct == 1


def test_a_series_without_values_keeps_its_days(spark):
    df = spark.sql("SELECT 'a' AS k, date'2024-01-01' AS date, CAST(NULL AS DOUBLE) AS v UNION ALL SELECT 'a', date'2024-01-04', NULL UNION ALL SELECT 'b', date'2024-01-01', 1.0D")
    got = regular_series(df, "v", keys=["k"]).collect()
    assert sorted((r.k, r.date.day, r.v) for r in got) == [("a", d, None) for d in (1, 2, 3, 4)] + [("b", 1, 1.0)]
