"""Shapes of physical plans that matter on large data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from catalog import bind
from nightly.operators import canonical, circadian, profile, series
from tests.conftest import DATA


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> list[str]:
    return [line for line in plan(df).splitlines() if "FileScan" in line]


def test_circadian_features_are_one_window_over_one_shuffle(spark):
    text = plan(circadian.circadian_features(bind.sessions(spark, DATA).withColumn("start_ts", F.col("start_ts"))))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Window [") + text.count("Window(") <= 1


def test_global_statistics_do_not_gather_rows(spark):
    text = plan(canonical.zscore_duration(canonical.clip_duration(bind.sessions(spark, DATA))))
    assert "Window" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize(
    "make",
    [
        lambda s: profile.night_counts(bind.nights(s, DATA)),
        lambda s: profile.value_counts(bind.nights(s, DATA), "source"),
        lambda s: profile.weekday_matrix(bind.nights(s, DATA)),
        lambda s: profile.describe_categorical(bind.sessions(s, DATA), ["tz"]),
        lambda s: series.daily_mean(bind.nights(s, DATA), "sleep_hours"),
    ],
)
def test_aggregates_combine_before_the_shuffle(spark, make):
    text = plan(make(spark))
    assert "partial_" in text and "CartesianProduct" not in text


def test_only_needed_columns_are_read(spark):
    lines = scans(profile.value_counts(bind.sessions(spark, DATA), "source"))
    assert all("ReadSchema: struct<event_type:string>" in line for line in lines)


def test_filters_reach_the_scan(spark):
    lines = scans(bind.hrv(spark, DATA))
    assert any("EqualTo(event_type,purchase)" in line for line in lines)


def test_timestamps_are_converted_once(spark):
    """Dropping rows without timestamps must not repeat the zone conversion in a filter."""
    text = plan(canonical.normalize_sessions(bind.sessions(spark, DATA)))
    filters = [line for line in text.splitlines() if "Filter" in line]
    assert not any("convert_timezone" in line for line in filters)


def test_describe_counts_each_column_without_one_scan_per_column(spark):
    text = plan(profile.missing_counts(bind.sessions(spark, DATA)))
    assert text.count("FileScan") == 1
