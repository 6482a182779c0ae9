"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

import functools
import zoneinfo
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
UTC = "UTC"

# Text that ends in Z or a UTC offset names an instant; other text is wall time.
OFFSET_PATTERN = r"(?i)(\d|\s)(Z|UTC|[+-]\d{2}(:?\d{2})?)$"
COMPACT_OFFSET = r"([+-]\d{2})(\d{2})$"
TIME_OF_DAY = r"\d{1,2}:\d{2}"


def seconds_between(later: Column, earlier: Column) -> Column:
    """Seconds between two wall times as decimal(18,6)."""
    return (later - earlier).cast("interval second").cast("decimal(18,6)")


def hours_between(later: Column, earlier: Column) -> Column:
    return seconds_between(later, earlier).cast("double") / F.lit(3600.0)


def to_instant(utc_wall: Column) -> Column:
    """UTC wall time -> instant."""
    seconds = seconds_between(utc_wall, F.expr(EPOCH))
    return F.timestamp_micros((seconds * F.lit(1000000)).cast("bigint"))


def to_utc_wall(instant: Column) -> Column:
    """Instant -> UTC wall time."""
    micro = F.lit("0.000001").cast("decimal(7,6)")
    seconds = (F.unix_micros(instant).cast("decimal(18,0)") * micro).cast("decimal(18,6)")
    return F.expr(EPOCH) + F.make_dt_interval(secs=seconds)


def utc_wall(df: DataFrame, name: str) -> Column:
    """Column ``name`` as UTC wall time; wall times are taken as UTC already."""
    return wall_of(F.col(name), df.schema[name].dataType)


def wall_of(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return to_utc_wall(col)
    if isinstance(dtype, T.TimestampNTZType):
        return col
    return col.try_cast("timestamp_ntz")


@functools.cache
def _zones() -> tuple[str, ...]:
    """Zones both Python and the JVM know: a conversion to any other raises."""
    jvm = SparkSession.active()._jvm
    there = set(jvm.java.time.ZoneId.getAvailableZoneIds())
    return tuple(sorted(zoneinfo.available_timezones() & there))


def known_zone(tz: str) -> Column:
    """The zone in column ``tz`` (UTC where NULL) if it exists, else NULL.

    Spark raises on unknown zones, so they must not reach a conversion. The list
    becomes one hash-set test in the generated code.
    """
    names = ", ".join(f"'{z}'" for z in _zones())
    return F.expr(f"IF(`{tz}` IS NULL, '{UTC}', IF(`{tz}` IN ({names}), `{tz}`, NULL))")


def _shift(wall: Column, minutes: int) -> Column:
    return wall + F.make_dt_interval(mins=F.lit(minutes))


def _there(zone: Column, utc: Column) -> Column:
    return F.convert_timezone(F.lit(UTC), zone, utc)


def _back(zone: Column, wall: Column) -> Column:
    return F.convert_timezone(zone, F.lit(UTC), wall)


def local_to_utc(df: DataFrame, columns: Sequence[str], tz: str) -> DataFrame:
    """Local wall times in the row's zone ``tz`` -> UTC wall times.

    A wall time skipped by a clock change moves to the first valid instant, one
    that occurs twice becomes NULL, and so does any time in an unknown zone.

    The steps are columns of their own, so every conversion is evaluated once; a
    zone conversion costs more than all other work on a row. The usual time takes
    two of them, rows in UTC none: of a time that occurs twice Spark picks the
    earlier instant, and a skipped time moves past the change, so the clock three
    hours after the result tells whether a change is near (no zone of the time zone
    database turned its clock by more, but for changes of the date line). Only then
    the rarer cases are looked at.
    """
    zone = F.col("_zone")
    staged = df.withColumn("_zone", known_zone(tz))
    staged = staged.withColumns(
        {f"_utc_{c}": F.when(zone != UTC, _back(zone, F.col(c))) for c in columns}
    )
    staged = staged.withColumns(
        {
            f"_near_{c}": _there(zone, _shift(F.col(f"_utc_{c}"), 180)) != _shift(F.col(c), 180)
            for c in columns
        }
    )
    return staged.select(
        *[
            F.when(zone == UTC, F.col(c))
            .when(F.col(f"_near_{c}"), _near_change(F.col(c), F.col(f"_utc_{c}"), zone))
            .otherwise(F.col(f"_utc_{c}"))
            .alias(c)
            if c in columns
            else F.col(c)
            for c in df.columns
        ]
    )


def _near_change(local: Column, utc: Column, zone: Column) -> Column:
    """The UTC wall time of a local time next to a clock change."""
    shown = _there(zone, utc)
    gap = seconds_between(shown, local)
    into_gap = F.pmod(seconds_between(shown, F.expr(EPOCH)), gap)
    after_gap = _back(zone, shown - F.make_dt_interval(secs=into_gap.cast("decimal(18,6)")))
    # The offset a day later tells the other instant a repeated time could name.
    later = seconds_between(_there(zone, _shift(utc, 1440)), _shift(utc, 1440))
    other = local - F.make_dt_interval(secs=later)
    twice = (other != utc) & (_there(zone, other) == local)
    return F.when(gap > 0, after_gap).when(~twice, utc)


def normalize_instants(df: DataFrame, columns: Sequence[str], tz: str) -> DataFrame:
    """Timestamp columns of any form -> instants.

    Instants are kept, wall times are read in zone ``tz``, and text is either,
    value by value: text with an offset is an instant, other text a wall time.
    """
    types = {c: df.schema[c].dataType for c in columns}
    known = {c: f"_known_{c}" for c in columns}
    given, wall = {}, {}
    for c, dtype in types.items():
        if isinstance(dtype, T.TimestampType):
            given[known[c]] = F.col(c)
            wall[c] = F.lit(None).cast("timestamp_ntz")
        elif isinstance(dtype, (T.TimestampNTZType, T.DateType)):
            given[known[c]] = F.lit(None).cast("timestamp")
            wall[c] = F.col(c).cast("timestamp_ntz")
        else:
            text = F.trim(F.col(c))
            aware = text.rlike(TIME_OF_DAY) & text.rlike(OFFSET_PATTERN)
            spelled = F.regexp_replace(text, COMPACT_OFFSET, "$1:$2")
            given[known[c]] = F.when(aware, spelled.try_cast("timestamp"))
            wall[c] = F.when(~aware, text.try_cast("timestamp_ntz"))
    split = df.withColumns(given).withColumns(wall)
    local = [c for c in columns if not isinstance(types[c], T.TimestampType)]
    resolved = local_to_utc(split, local, tz) if local else split
    return resolved.select(
        *[
            F.coalesce(F.col(known[c]), to_instant(F.col(c))).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def parse_wall(text: Column, formats: tuple[str, ...] = ()) -> Column:
    """Text -> wall time: ISO, else the first of ``formats`` that fits, else NULL.

    A UTC offset after a time of day is left out: the wall time stays as written.
    """
    trimmed = F.trim(text)
    aware = trimmed.rlike(TIME_OF_DAY) & trimmed.rlike(OFFSET_PATTERN)
    wall = F.when(aware, F.trim(F.regexp_replace(trimmed, OFFSET_PATTERN, "$1"))).otherwise(trimmed)
    tries = [try_parse(wall, f) for f in formats]
    return F.coalesce(wall.try_cast("timestamp_ntz"), *tries)


def utc_offset(text: Column) -> Column:
    """Seconds east of UTC that a text names behind its time of day, 0 without."""
    trimmed = F.trim(text)
    sign = F.regexp_extract(trimmed, r"\d\s*([+-])(\d{2}):?(\d{2})?$", 1)
    hours, minutes = (F.regexp_extract(trimmed, r"\d\s*([+-])(\d{2}):?(\d{2})?$", i) for i in (2, 3))
    size = F.coalesce(hours.try_cast("int"), F.lit(0)) * 3600 + F.coalesce(minutes.try_cast("int"), F.lit(0)) * 60
    seconds = F.when(sign == "-", -size).otherwise(size)
    return F.when(trimmed.rlike(TIME_OF_DAY) & (sign != ""), seconds).otherwise(0).cast("decimal(18,6)")


def try_parse(text: Column, fmt: str) -> Column:
    """Parse with one pattern, NULL where it does not fit, as wall time.

    The parsed value passes through UTC explicitly so that clock changes of the
    session time zone cannot touch it.
    """
    instant = F.try_to_timestamp(
        F.concat(text, F.lit(" +0000")), F.lit(f"{fmt} Z")
    )
    return to_utc_wall(instant)


def is_weekend(wall: Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(wall) >= 5
