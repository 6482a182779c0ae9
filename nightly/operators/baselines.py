"""Rolling personal baselines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import WindowSpec

from nightly.operators.skew import Spread, row_windows

WINDOW = 30
MIN_ROWS = 7


def baseline_columns(window: WindowSpec, column: str, rows: int) -> list[Column]:
    """Trailing mean, population deviation and z-score, NULL until enough values are there."""
    frame = window.rowsBetween(-(rows - 1), 0)
    value = F.col(column).cast("double")
    enough = F.count(value).over(frame) >= min(rows, MIN_ROWS)
    mean = F.when(enough, F.avg(value).over(frame))
    std = F.when(enough, F.stddev_pop(value).over(frame))
    z = F.when(std > 0, (value - mean) / std)
    return [
        mean.alias(f"{column}_baseline"),
        std.alias(f"{column}_baseline_std"),
        F.coalesce(z, F.lit(0.0)).alias(f"{column}_zscore"),
    ]


def personal_baselines(
    df: DataFrame,
    *,
    user: str = "user_id",
    order: Sequence[str] = ("date",),
    columns: Sequence[str] = ("sleep_hours", "hrv_rmssd", "steps"),
    window: int = WINDOW,
    found: Spread | None = None,
) -> DataFrame:
    """Baseline columns for every value column that the frame has; z is 0 where undefined."""
    present = [c for c in columns if c in df.columns]
    return row_windows(
        df,
        lambda w: [c for name in present for c in baseline_columns(w, name, window)],
        keys=[user],
        order=list(order),
        lookback=window - 1,
        found=found,
    )
