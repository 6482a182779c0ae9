from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from nightly.operators import canonical as c, privacy
from nightly.schema import SLEEP_COLUMNS, schema_hash
from tests.helpers import by, frame, record, utc

ZONES = ["UTC", "America/Los_Angeles", "Europe/London"]


@st.composite
def raw_rows(draw):
    """Rows with naive local times, some in gaps or overlaps, some outside the duration bounds."""
    rows = []
    for i in range(draw(st.integers(3, 10))):
        zone = draw(st.sampled_from(ZONES))
        start = draw(st.datetimes(datetime(2023, 1, 1), datetime(2024, 12, 31)))
        local = start.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(zone))
        length = draw(st.timedeltas(timedelta(minutes=10), timedelta(hours=15)))
        rows.append(
            (
                f"rec_{i}", "user123", local.replace(tzinfo=None), (local + length).replace(tzinfo=None),
                length.total_seconds() / 60, draw(st.floats(0, 1)), draw(st.booleans()), zone,
                draw(st.sampled_from(["oura", "fitbit", "apple_health"])),
            )
        )
    return rows


SCHEMA = (
    "id string, user_id string, start_ts timestamp_ntz, end_ts timestamp_ntz, duration_min double, "
    "efficiency double, is_nap boolean, tz string, source string"
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(raw_rows())
def test_normalize_matches_a_pandas_model(spark, rows):
    got = by(
        c.normalize_sessions(spark.createDataFrame(rows, SCHEMA)).withColumns(
            {"s": F.unix_micros("start_ts"), "e": F.unix_micros("end_ts")}
        ),
        "id",
    )
    durations = pd.Series([min(max(r[4], 120.0), 720.0) for r in rows])
    std = durations.std(ddof=0)
    kept = 0
    for i, r in enumerate(rows):
        ends = [
            pd.Timestamp(t).tz_localize(r[7], nonexistent="shift_forward", ambiguous="NaT") for t in r[2:4]
        ]
        if any(t is pd.NaT for t in ends):
            assert r[0] not in got
            continue
        kept += 1
        row = got[r[0]]
        assert [row.s, row.e] == [t.value // 1000 for t in ends]
        assert row.duration_min == durations[i]
        assert row.duration_was_clipped == (durations[i] != r[4])
        assert row.is_weekend == (ends[0].tz_convert("UTC").weekday() >= 5)
        z = (durations[i] - durations.mean()) / std if std > 0 else 0.0
        assert row.duration_zscore == pytest.approx(z, abs=1e-9)
        assert row.is_outlier_duration == (abs(z) >= 3)
    assert len(got) == kept


def test_equal_durations_have_zero_zscore(spark):
    df = frame(spark, [record(id=str(i)) for i in range(3)])
    assert {r.duration_zscore for r in c.zscore_duration(df).collect()} == {0.0}
    assert {r.duration_zscore for r in c.zscore_duration(df, ["user_id"]).collect()} == {0.0}


def test_keyed_zscore(spark):
    df = frame(
        spark,
        [record(id="1", user_id="a", duration_min=100.0), record(id="2", user_id="a", duration_min=300.0),
         record(id="3", user_id="b", duration_min=500.0)],
    )
    got = by(c.zscore_duration(df, ["user_id"]), "id")
    assert [got[i].duration_zscore for i in "123"] == [-1.0, 1.0, 0.0]


def test_null_duration_is_not_flagged_as_clipped_but_breaks_the_contract(spark):
    df = c.clip_duration(frame(spark, [record(duration_min=None)]))
    row = df.first()
    assert row.duration_min is None and row.duration_was_clipped is False
    assert [r.rule for r in c.contract_violations(df.select(*SLEEP_COLUMNS)).collect()] == ["duration_min_null"]


BROKEN = [
    (dict(efficiency=1.4), "efficiency_out_of_range"),
    (dict(efficiency=float("nan")), "efficiency_out_of_range"),
    (dict(duration_min=0.0), "duration_not_positive"),
    (dict(duration_min=float("nan")), "duration_not_positive"),
    (dict(end_ts=utc(2024, 1, 1, 22)), "end_not_after_start"),
    (dict(user_id=None), "user_id_null"),
    (dict(start_ts=None), "start_ts_null"),
    (dict(tz="Mars/Base"), "tz_unknown"),
]


@pytest.mark.parametrize("change,rule", BROKEN)
def test_contract_rules(spark, change, rule):
    df = frame(spark, [record(), record(id="bad", **change)])
    assert [(r.id, r.rule) for r in c.contract_violations(df).collect()] == [("bad", rule)]
    good, bad = c.quarantine_split(df)
    assert [r.id for r in good.collect()] == ["a"] and [r.id for r in bad.collect()] == ["bad"]
    assert good.columns == SLEEP_COLUMNS
    with pytest.raises(ValueError, match=rule):
        c.validate(df)


def test_valid_records_pass(spark):
    edge = [record(id="x", efficiency=0.0), record(id="y", efficiency=1.0)]
    assert c.validate(frame(spark, edge)) == 2
    assert c.validate(frame(spark, [])) == 0


def test_canonicalize_needs_its_columns_and_names_them_sorted(spark):
    with pytest.raises(ValueError, match=r"\['bedtime_end', 'bedtime_start'"):
        c.canonicalize(spark.createDataFrame([("a",)], "user_id string"), "oura")


def test_register_vendor(spark):
    with pytest.raises(ValueError):
        c.register_vendor("ring", {"x": "id"})
    c.register_vendor("ring", {f"r_{n}": n for n in SLEEP_COLUMNS if n != "source"})
    try:
        df = frame(spark, [record()]).drop("source")
        renamed = df.select(*[F.col(n).alias(f"r_{n}") for n in df.columns])
        assert c.canonicalize(renamed, "ring").first().source == "ring"
    finally:
        del c.VENDOR_SPECS["ring"]


def test_drop_repeats_keeps_the_latest(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "one")], "id string, run int, v string")
    assert {r.id: r.v for r in c.drop_repeats(df, ["id"], "run").collect()} == {"a": "new", "b": "one"}
    assert c.drop_repeats(df).count() == 2


def test_schema_hash_is_stable():
    assert schema_hash() == schema_hash() and len(schema_hash()) == 64


def test_scrub_hashes_text_drops_numbers_and_keeps_exempt(spark, monkeypatch):
    monkeypatch.setenv(privacy.SALT_ENV, "unit-test-salt")
    df = spark.createDataFrame(
        [("user123", "Test User", "user@example.com", 420, 3.5, None, "oura", "watch")],
        "user_id string, name string, email string, duration_min int, midpoint_hour_local double, "
        "id string, source string, sourceName string",
    )
    done = privacy.scrub(df, ["name", "email", "user_id"])
    row = done.first()
    assert "midpoint_hour_local" not in done.columns
    assert row.user_id == "user123" and row.source == "oura" and row.duration_min == 420
    assert row.name == "5d3c68ac20177089"
    assert row.id is None
    assert row.sourceName != "watch" and len(row.sourceName) == 16
    assert privacy.scrub(df).first() == row
    assert privacy.scrub(df, salt="other").first().name != row.name
