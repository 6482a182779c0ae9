from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from nightly.operators.canonical import normalize_timestamps
from nightly.sources import text
from tests.helpers import by


def _write(folder, name, content):
    path = f"{folder}/{name}.csv"
    with open(path, "w") as out:
        out.write(content)
    return path


VENDOR_FILES = {
    "oura": "extra,sleep_id,user_id,bedtime_start,bedtime_end,duration_min,efficiency,is_long_nap,timezone\n",
    "fitbit": "extra,log_id,user_id,start_time,end_time,minutes_asleep,efficiency,is_nap,timezone\n",
    "apple_health": "extra,uuid,user_id,start_date,end_date,duration_min,efficiency,nap,timezone\n",
}


@pytest.mark.parametrize("source", VENDOR_FILES)
def test_vendor_scans(spark, folder, source):
    body = (
        "z,1,7,2024-01-01T23:00:00-08:00,2024-01-02T06:00:00-08:00,420,0.9,,America/Los_Angeles\n"
        "z,2,7,2024-01-02T23:00:00,bad,n/a,0.8,yes,\n"
    )
    path = _write(folder, source, VENDOR_FILES[source] + body)
    got = by(normalize_timestamps(text.scan_vendor(spark, source, path)), "id")
    one, two = got["1"], got["2"]
    assert (one.user_id, one.duration_min, one.efficiency, one.is_nap, one.source) == ("7", 420.0, 0.9, False, source)
    assert one.start_ts == datetime(2024, 1, 2, 7) or one.start_ts.timestamp() > 0
    assert (two.tz, two.is_nap, two.duration_min, two.end_ts) == ("UTC", True, None, None)


def test_unknown_vendor_and_missing_columns(spark, folder):
    with pytest.raises(ValueError, match="unknown vendor"):
        text.scan_vendor(spark, "ring", folder)
    path = _write(folder, "short", "sleep_id,user_id\n1,2\n")
    with pytest.raises(ValueError, match="missing required columns"):
        text.scan_vendor(spark, "oura", path)


def test_columns_bind_by_name_not_position(spark, folder):
    path = _write(folder, "hrv", "sdnn,date,rmssd,user_id\n9,2024-01-02,5,u1\n8,2024-01-03,,u1\n")
    rows = text.scan_hrv(spark, path).collect()
    assert [tuple(r) for r in rows] == [("u1", date(2024, 1, 2), 5.0, 9.0, None)]


def test_primary_drops_unreadable_rows(spark, folder):
    path = _write(folder, "p", "date,sleep_hours\n2024-01-02,7.5\n2024-01-01,x\nnope,6\n2024-01-03,NaN\n")
    assert [tuple(r) for r in text.scan_primary(spark, path).collect()] == [(date(2024, 1, 2), 7.5)]


def test_secondary_is_day_first_and_derives_hours(spark, folder):
    path = _write(
        folder, "s",
        "sourceName,creationDate,startDate,endDate\nphone,03/02/2015 08:00:00,02/02/2015 23:30:00,03/02/2015 07:00:00\n"
        "watch,2015-02-03 08:00:00,2015-02-02 23:00:00,bad\n",
    )
    got = by(text.scan_secondary(spark, path), "sourceName")
    assert got["phone"].startDate == datetime(2015, 2, 2, 23, 30)
    assert got["phone"].hours == 7.5 and got["phone"].Duration.total_seconds() == 27000
    assert got["watch"].startDate == datetime(2015, 2, 2, 23) and got["watch"].hours is None


def test_secondary_without_both_ends(spark):
    df = text.secondary_sessions(spark.createDataFrame([("01/02/2015",)], "startDate string"))
    assert df.columns == ["startDate"] and df.first()[0] == datetime(2015, 2, 1)


def test_steps_fill_and_cut(spark, folder):
    path = _write(folder, "st", "user_id,date,steps\nu,2024-01-01,9.9\nu,2024-01-02,\nu,2024-01-03,many\n")
    got = by(text.scan_steps(spark, path), "date")
    assert [got[date(2024, 1, d)].steps for d in (1, 2, 3)] == [9, 0, 0]
    assert got[date(2024, 1, 1)].active_minutes is None


def test_tags_default_to_false(spark, folder):
    path = _write(folder, "t", "user_id,date,caffeine,alcohol\nu,2024-01-01,True,\nu,2024-01-02,no,maybe\n")
    got = by(text.scan_tags(spark, path), "date")
    assert tuple(got[date(2024, 1, 1)])[2:] == (True, False, False, False)
    assert tuple(got[date(2024, 1, 2)])[2:] == (False, False, False, False)


def test_screen_both_shapes(spark, folder):
    events = _write(
        folder, "e",
        "user_id,timestamp\nu,2024-01-02T23:30:00\nu,2024-01-02T22:00:00\nu,2024-01-03T21:00:00\nu,bad\n",
    )
    got = by(text.scan_screen(spark, events), "date")
    assert (got[date(2024, 1, 2)].late_minutes, got[date(2024, 1, 2)].total_events) == (2, 2)
    assert got[date(2024, 1, 3)].late_screen_flag is False and len(got) == 2
    assert by(text.scan_screen(spark, events, late_hour=21), "date")[date(2024, 1, 3)].late_minutes == 1
    ready = _write(folder, "r", "user_id,date,late_minutes\nu,2024-01-02,12\nu,2024-01-03,\n")
    got = by(text.scan_screen(spark, ready), "date")
    assert got[date(2024, 1, 2)].late_screen_flag is True
    assert (got[date(2024, 1, 3)].late_minutes, got[date(2024, 1, 3)].total_events) == (0, 0)


def test_screen_rollup_combines_before_the_shuffle(spark):
    df = spark.createDataFrame([("u", datetime(2024, 1, 1, 23))], "user_id string, timestamp timestamp_ntz")
    plan = text.late_screen_rollup(df)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("Exchange") == 1
    assert text.late_screen_rollup(df.where(F.lit(False))).count() == 0
