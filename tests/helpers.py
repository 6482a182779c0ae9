from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from nightly.schema import SLEEP_SCHEMA


def utc(*parts) -> datetime:
    return datetime(*parts, tzinfo=timezone.utc)


def record(**change) -> dict:
    base = dict(
        id="a", user_id="u", start_ts=utc(2024, 1, 1, 22), end_ts=utc(2024, 1, 2, 6),
        duration_min=480.0, efficiency=0.9, is_nap=False, tz="UTC", source="oura",
    )
    return {**base, **change}


def frame(spark, rows: list[dict]):
    """Canonical frame, nullable so that broken rows fit."""
    schema = SLEEP_SCHEMA.fromJson(SLEEP_SCHEMA.jsonValue())
    for field in schema.fields:
        field.nullable = True
    return spark.createDataFrame([[r[f] for f in schema.fieldNames()] for r in rows], schema)


def sinusoid(spark, nights: int = 60):
    """One user, one night per day from 2024-01-02 06:00 UTC (22:00 in Los Angeles)."""
    rows = []
    for i in range(nights):
        start = utc(2024, 1, 2, 6) + timedelta(days=i)
        minutes = 420 + 10 * math.sin(i / 6)
        rows.append(
            record(
                id=f"rec_{i}", user_id="user123", start_ts=start,
                end_ts=start + timedelta(minutes=minutes), duration_min=minutes,
                efficiency=0.82 + 0.05 * math.cos(i / 5), tz="America/Los_Angeles", source="synthetic",
            )
        )
    return frame(spark, rows)


def by(df, key: str) -> dict:
    return {r[key]: r for r in df.collect()}


def daily(spark, values, start="2024-01-01", key=None):
    """Daily series from a list; None makes a row with NULL."""
    rows = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, v double")
    df = df.select(F.date_add(F.to_date(F.lit(start)), F.col("i")).alias("date"), "v")
    return df if key is None else df.withColumn("k", F.lit(key))
