"""Join of sleep sessions with daily signals into the feature store table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from nightly.operators.baselines import WINDOW, personal_baselines
from nightly.operators.skew import Spread, spread

KEYS = ("user_id", "date")
BASELINE_COLUMNS = ("sleep_hours", "hrv_rmssd", "hrv_sdnn", "steps")


def feature_base(sleep: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The columns of the feature store that come from the sleep side."""
    return sleep.select(
        *KEYS, "duration_min", "efficiency", "is_weekend", *extra
    ).withColumn("sleep_hours", F.col("duration_min") / 60.0)


def check_unique_signal_keys(signal: DataFrame, name: str, keys: Sequence[str] = KEYS) -> None:
    """Raise if a signal has two rows for one user and day. One job."""
    repeats = signal.groupBy(*keys).count().where("count > 1")
    if not repeats.isEmpty():
        raise ValueError(f"signal {name} has several rows for one {tuple(keys)}")


def fuse(base: DataFrame, signal: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Left join of one daily signal."""
    return base.join(signal, list(keys), "left")


def feature_store(
    sleep: DataFrame,
    signals: Sequence[DataFrame] = (),
    *,
    extra: Sequence[str] = (),
    window: int = WINDOW,
    found: Spread | None = None,
    unique: bool = False,
) -> DataFrame:
    """Sessions left-joined with every given signal, then the personal baselines.

    The joins run on (user, date), by which a daily aggregate is partitioned
    already, so each input is shuffled once, and once more by user for the windows
    (chunks of the large users, if there are any). AQE splits a large partition of
    a join. Several sessions of one day follow each other by start and id. ``extra``
    names sleep columns to keep; ``unique`` raises if a signal has two rows for one
    user and day, which would repeat sessions (one job per signal).
    """
    order = ["date", *[c for c in ("start_ts", "id") if c in sleep.columns]]
    carried = [c for c in order[1:] if c not in extra]
    base = feature_base(sleep, [*extra, *carried])
    found = found or spread(base, ["user_id"])
    for i, signal in enumerate(signals):
        if unique:
            check_unique_signal_keys(signal, str(i))
        base = fuse(base, signal)
    return personal_baselines(
        base, order=order, columns=BASELINE_COLUMNS, window=window, found=found
    ).drop(*carried)
