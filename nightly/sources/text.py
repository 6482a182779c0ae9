"""CSV scans. Columns are bound by header name, read as text and cast value by value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from nightly.functions.frame import column_or, parse_double, require_columns
from nightly.functions.time import hours_between, parse_wall, utc_offset, wall_of
from nightly.operators.canonical import VENDOR_SPECS, canonicalize

# Tried in order where text is not ISO; month before day, as the daily exports have it.
DATE_FORMATS = ("M/d/yyyy", "M/d/yyyy HH:mm", "M/d/yyyy HH:mm:ss", "yyyy/M/d", "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy")
DAY_FIRST = ("d/M/yyyy HH:mm:ss", "d/M/yyyy HH:mm", "d/M/yyyy", "d-M-yyyy HH:mm:ss", "d-M-yyyy")
TAG_COLUMNS = ("caffeine", "alcohol", "late_meal", "work_travel")
LATE_HOUR = 22


def read_text_columns(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Header CSV with every column as string."""
    return spark.read.csv(path, header=True, inferSchema=False)


def scan_vendor(spark: SparkSession, source: str, path: str) -> DataFrame:
    """Vendor sleep export -> canonical columns, timestamps still as text."""
    if source not in VENDOR_SPECS:
        raise ValueError(f"unknown vendor {source!r}, known: {sorted(VENDOR_SPECS)}")
    return canonicalize(read_text_columns(spark, path), source)


def primary_daily(raw: DataFrame, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Daily series: rows whose date and hours are both readable."""
    require_columns(raw, ["date", "sleep_hours"], "primary")
    day = parse_wall(F.col("date").cast("string"), tuple(formats)).cast("date")
    hours = parse_double(F.col("sleep_hours").cast("string"))
    return raw.select(day.alias("date"), hours.alias("sleep_hours")).dropna()


def scan_primary(spark: SparkSession, path: str, formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    return primary_daily(read_text_columns(spark, path), formats)


def secondary_sessions(raw: DataFrame, formats: Sequence[str] = DAY_FIRST) -> DataFrame:
    """Session export: day-first dates become wall times, with `Duration` and `hours`.

    ISO text is read as ISO. The two derived columns need both ends. Text with a UTC
    offset keeps its wall time, and the span is taken between the instants.
    """
    named = [c for c in ("startDate", "endDate") if c in raw.columns]
    raw = raw.withColumns({f"_off_{c}": utc_offset(F.col(c).cast("string")) for c in named}) if named else raw
    stamps = {
        c: parse_wall(F.col(c).cast("string"), tuple(formats))
        for c in ("creationDate", "startDate", "endDate")
        if c in raw.columns
    }
    parsed = raw.withColumns(stamps) if stamps else raw
    spare = [f"_off_{c}" for c in named]
    if len(named) < 2:
        return parsed.drop(*spare)
    start, end = (F.col(c) - F.make_dt_interval(secs=F.col(f"_off_{c}")) for c in ("startDate", "endDate"))
    return parsed.withColumns({"Duration": end - start, "hours": hours_between(end, start)}).drop(*spare)


def scan_secondary(
    spark: SparkSession, path: str, formats: Sequence[str] = DAY_FIRST
) -> DataFrame:
    return secondary_sessions(read_text_columns(spark, path), formats)


def _text(name: str):
    return F.col(name).cast("string")


def _user_day(raw: DataFrame, required: Sequence[str], source: str) -> list:
    require_columns(raw, ["user_id", "date", *required], source)
    day = parse_wall(_text("date"), DATE_FORMATS).cast("date")
    return [_text("user_id").alias("user_id"), day.alias("date")]


def hrv_signals(raw: DataFrame) -> DataFrame:
    """Daily heart-rate variability; days without rmssd are left out."""
    keys = _user_day(raw, ["rmssd", "sdnn"], "hrv")
    base = column_or(raw, "baseline_rmssd", None).cast("string")
    return raw.select(
        *keys,
        parse_double(_text("rmssd")).alias("hrv_rmssd"),
        parse_double(_text("sdnn")).alias("hrv_sdnn"),
        parse_double(base).alias("hrv_baseline_rmssd"),
    ).dropna(subset=["hrv_rmssd"])


def step_signals(raw: DataFrame) -> DataFrame:
    """Daily steps; unreadable counts are 0 and fractions are cut off."""
    keys = _user_day(raw, ["steps"], "steps")
    active = column_or(raw, "active_minutes", None).cast("string")
    steps = F.coalesce(parse_double(_text("steps")), F.lit(0.0)).cast("long")
    return raw.select(*keys, steps.alias("steps"), parse_double(active).alias("active_minutes"))


def tag_signals(raw: DataFrame) -> DataFrame:
    """Daily context tags; absent or unreadable tags are false."""
    keys = _user_day(raw, [], "tags")
    tags = [
        F.coalesce(
            F.trim(column_or(raw, t, None).cast("string")).try_cast("boolean"), F.lit(False)
        ).alias(t)
        for t in TAG_COLUMNS
    ]
    return raw.select(*keys, *tags)


def late_screen_rollup(events: DataFrame, late_hour: int = LATE_HOUR) -> DataFrame:
    """Screen events -> one row per user and day.

    `late_minutes` counts late events, which is also `late_events`. The hour is
    that of the wall clock. The count per user-day is combined before the shuffle.
    """
    require_columns(events, ["user_id", "timestamp"], "screen_time")
    dtype = events.schema["timestamp"].dataType
    kept = isinstance(dtype, (T.TimestampType, T.TimestampNTZType))
    wall = wall_of(F.col("timestamp"), dtype) if kept else _text("timestamp").try_cast("timestamp_ntz")
    rows = events.select(_text("user_id").alias("user_id"), wall.alias("_ts"))
    rows = rows.withColumn("date", F.to_date("_ts")).dropna(subset=["user_id", "date"])
    late = F.count_if(F.hour("_ts") >= late_hour)
    return rows.groupBy("user_id", "date").agg(
        late.alias("late_minutes"),
        F.count("_ts").alias("total_events"),
        (late > 0).alias("late_screen_flag"),
        late.alias("late_events"),
    )


def screen_preaggregated(raw: DataFrame) -> DataFrame:
    """Screen time that is already one row per user and day; missing counts are 0."""
    keys = _user_day(raw, [], "screen_time")

    def count(name: str):
        text = column_or(raw, name, None).cast("string")
        return F.coalesce(parse_double(text), F.lit(0.0))

    late = count("late_minutes")
    return raw.select(
        *keys,
        late.cast("long").alias("late_minutes"),
        count("total_events").cast("long").alias("total_events"),
        (late > 0).alias("late_screen_flag"),
        late.cast("long").alias("late_events"),
    )


def screen_signals(raw: DataFrame, late_hour: int = LATE_HOUR) -> DataFrame:
    """Either shape of screen data, told apart by the presence of `timestamp`."""
    if "timestamp" in raw.columns:
        return late_screen_rollup(raw, late_hour)
    return screen_preaggregated(raw)


def scan_hrv(spark: SparkSession, path: str) -> DataFrame:
    return hrv_signals(read_text_columns(spark, path))


def scan_steps(spark: SparkSession, path: str) -> DataFrame:
    return step_signals(read_text_columns(spark, path))


def scan_tags(spark: SparkSession, path: str) -> DataFrame:
    return tag_signals(read_text_columns(spark, path))


def scan_screen(spark: SparkSession, path: str, late_hour: int = LATE_HOUR) -> DataFrame:
    return screen_signals(read_text_columns(spark, path), late_hour)
