from __future__ import annotations

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from nightly.functions import time as nt
from tests.helpers import utc

# A change in spring and one in autumn for each zone.
CHANGES = {
    "America/Los_Angeles": [datetime(2024, 3, 10, 2), datetime(2024, 11, 3, 1)],
    "Europe/London": [datetime(2024, 3, 31, 1), datetime(2024, 10, 27, 1)],
    "America/New_York": [datetime(2024, 3, 10, 2), datetime(2024, 11, 3, 1)],
    "Australia/Sydney": [datetime(2024, 4, 7, 2), datetime(2024, 10, 6, 2)],
    "UTC": [datetime(2024, 3, 10, 2)],
    "Asia/Kolkata": [datetime(2024, 3, 10, 2)],
}


def _times():
    rows = []
    for zone, changes in CHANGES.items():
        for change in changes:
            for quarter in range(-16, 17):
                rows.append((zone, change + timedelta(minutes=15 * quarter, microseconds=123456)))
    return rows


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York"])
def test_local_times_around_clock_changes(spark, session_zone):
    rows = _times()
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        df = spark.createDataFrame(rows, "tz string, local timestamp_ntz").withColumn("ts", F.col("local"))
        done = nt.normalize_instants(df, ["ts"], "tz")
        got = {
            (r.tz, r.local): r.us for r in done.select("tz", "local", F.unix_micros("ts").alias("us")).collect()
        }
        back = done.where("ts is not null").select("ts").withColumn("w", nt.to_utc_wall(F.col("ts")))
        same = back.where(F.unix_micros(nt.to_instant(F.col("w"))) != F.unix_micros("ts"))
        assert same.count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for zone, local in rows:
        want = pd.Timestamp(local).tz_localize(zone, nonexistent="shift_forward", ambiguous="NaT")
        if want is pd.NaT:
            assert got[zone, local] is None, (zone, local)
        else:
            assert got[zone, local] == want.value // 1000, (zone, local)


def test_half_hour_change(spark):
    rows = [
        ("Australia/Lord_Howe", datetime(2024, 4, 7, 1, 45)),  # occurs twice
        ("Australia/Lord_Howe", datetime(2024, 4, 7, 1, 15)),
        ("Australia/Lord_Howe", datetime(2024, 10, 6, 2, 15)),  # skipped
    ]
    df = spark.createDataFrame(rows, "tz string, ts timestamp_ntz")
    got = [r[0] for r in nt.local_to_utc(df, ["ts"], "tz").select("ts").collect()]
    assert got == [None, datetime(2024, 4, 6, 14, 15), datetime(2024, 10, 5, 15, 30)]


def test_text_is_instant_or_wall_time_value_by_value(spark):
    rows = [
        ("2024-01-01T23:00:00-08:00", "Europe/London", utc(2024, 1, 2, 7)),
        ("2024-01-01 23:00:00+0100", "Europe/London", utc(2024, 1, 1, 22)),
        ("2024-01-01T23:00:00Z", "America/Los_Angeles", utc(2024, 1, 1, 23)),
        ("2024-01-01T23:00:00", "America/Los_Angeles", utc(2024, 1, 2, 7)),
        ("2024-01-01", "America/Los_Angeles", utc(2024, 1, 1, 8)),
        ("2024-01-01T23:00:00", None, utc(2024, 1, 1, 23)),
        ("2024-01-01T23:00:00", "Mars/Base", None),
        ("soon", "UTC", None),
        (None, "UTC", None),
    ]
    df = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(rows)], "i int, ts string, tz string")
    got = nt.normalize_instants(df, ["ts"], "tz").orderBy("i").select(F.unix_micros("ts"))
    want = [None if w is None else int(w.timestamp() * 1_000_000) for *_, w in rows]
    assert [r[0] for r in got.collect()] == want


def test_parse_wall_formats(spark):
    df = spark.createDataFrame([("03/02/2015 23:10:00",), ("2015-02-13",), ("x",), (None,)], "t string")
    got = [r[0] for r in df.select(nt.parse_wall(F.col("t"), ("d/M/yyyy HH:mm:ss",))).collect()]
    assert got == [datetime(2015, 2, 3, 23, 10), datetime(2015, 2, 13), None, None]
