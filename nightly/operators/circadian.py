"""Circadian features of sleep sessions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import WindowSpec

from nightly.functions.time import is_weekend, utc_wall
from nightly.operators.skew import Spread, row_windows

TARGET_HOURS = 8.0
WINDOWS = (7, 14)


def _trailing(window: WindowSpec, rows: int) -> WindowSpec:
    return window.rowsBetween(-(rows - 1), 0)


def calendar_columns(df: DataFrame, start: str = "start_ts") -> DataFrame:
    """UTC date, weekday (Monday 0), month and weekend flag of the session start."""
    wall = utc_wall(df, start)
    return df.withColumns(
        {
            "date": F.to_date(wall),
            "day_of_week": F.weekday(wall),
            "month": F.month(wall),
            "is_weekend": is_weekend(wall),
        }
    )


def midpoint_hour(df: DataFrame, start: str = "start_ts", duration: str = "duration_min") -> Column:
    """UTC hour of start + duration/2, whole minutes only."""
    half = F.make_dt_interval(secs=(F.col(duration) * 30.0).cast("decimal(18,6)"))
    middle = utc_wall(df, start) + half
    return F.hour(middle) + F.minute(middle) / F.lit(60.0)


def with_user(df: DataFrame, user: str = "user_id") -> DataFrame:
    return df if user in df.columns else df.withColumn(user, F.lit("anonymous"))


def _prepared(df: DataFrame, user: str) -> DataFrame:
    df = with_user(df, user)
    hours = F.col("duration_min") / 60.0
    return df.withColumns(
        {
            "sleep_hours": hours,
            # greatest() skips NULL, the deficit of an unknown night is unknown.
            "_deficit": F.when(hours.isNotNull(), F.greatest(F.lit(0.0), F.lit(TARGET_HOURS) - hours)),
        }
    )


def rolling_columns(window: WindowSpec, columns: Sequence[str], rows: Sequence[int]) -> list[Column]:
    return [F.avg(c).over(_trailing(window, n)).alias(f"{c}_roll{n}") for n in rows for c in columns]


def debt_columns(window: WindowSpec, rows: Sequence[int]) -> list[Column]:
    return [F.sum("_deficit").over(_trailing(window, n)).alias(f"sleep_debt_roll{n}") for n in rows]


def jetlag_column(window: WindowSpec) -> Column:
    usual = F.avg("midpoint_hour_local").over(_trailing(window, 7))
    gap = F.abs(F.col("midpoint_hour_local") - usual)
    return F.coalesce(gap, F.lit(0.0)).alias("social_jetlag")


def _order(df: DataFrame) -> list[str]:
    return ["start_ts", "id"] if "id" in df.columns else ["start_ts"]


def rolling_means(
    df: DataFrame,
    *,
    user: str = "user_id",
    columns: Sequence[str] = ("sleep_hours", "efficiency"),
    rows: Sequence[int] = WINDOWS,
    found: Spread | None = None,
) -> DataFrame:
    """Trailing means over the last rows (not days) of each user."""
    ready = _prepared(df, user)
    return row_windows(
        ready,
        lambda w: rolling_columns(w, columns, rows),
        keys=[user],
        order=_order(df),
        lookback=max(rows) - 1,
        found=found,
    ).drop("_deficit")


def sleep_debt(
    df: DataFrame, *, user: str = "user_id", rows: Sequence[int] = WINDOWS, found: Spread | None = None
) -> DataFrame:
    """Trailing sums of the hours missing to eight."""
    ready = _prepared(df, user)
    return row_windows(
        ready,
        lambda w: debt_columns(w, rows),
        keys=[user],
        order=_order(df),
        lookback=max(rows) - 1,
        found=found,
    ).drop("_deficit")


def social_jetlag(
    df: DataFrame, *, user: str = "user_id", found: Spread | None = None
) -> DataFrame:
    """Distance of the sleep midpoint from its trailing seven-row mean."""
    ready = with_user(df, user).withColumn("midpoint_hour_local", midpoint_hour(df))
    return row_windows(
        ready, lambda w: [jetlag_column(w)], keys=[user], order=_order(df), lookback=6, found=found
    )


def circadian_features(
    df: DataFrame, *, user: str = "user_id", found: Spread | None = None
) -> DataFrame:
    """All circadian columns with one shuffle by user."""
    ready = calendar_columns(_prepared(df, user)).withColumn("midpoint_hour_local", midpoint_hour(df))
    return row_windows(
        ready,
        lambda w: [
            *rolling_columns(w, ("sleep_hours", "efficiency"), WINDOWS),
            *debt_columns(w, WINDOWS),
            jetlag_column(w),
        ],
        keys=[user],
        order=_order(df),
        lookback=max(WINDOWS) - 1,
        found=found,
    ).drop("_deficit")
