"""Backtests and forecasts of daily series as window expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from nightly.functions.frame import (
    ID_COLUMNS,
    as_double,
    numeric_columns,
    over_keys,
    safe_ratio,
)

HORIZON = 7
BACKTEST_WINDOW = 30
BAND = 0.5

Forecaster = Callable[..., DataFrame]
FORECASTERS: dict[str, Forecaster] = {}


def register_forecaster(name: str, fn: Forecaster) -> None:
    """Add a model to the sweep.

    ``fn(df, target, *, keys, date, horizon, backtest_window, **options)`` returns
    ``keys, date, prediction, lower, upper, actual`` for the test rows.
    """
    FORECASTERS[name] = fn


# Columns computed from the night that is to be predicted.
SAME_NIGHT = (
    "duration_min", "sleep_hours", "sleep_hours_roll7", "sleep_hours_roll14",
    "sleep_debt_roll7", "sleep_debt_roll14", "duration_zscore", "is_outlier_duration",
    "duration_was_clipped", "midpoint_hour_local", "social_jetlag",
)


def feature_columns(
    df: DataFrame, target: str, *, keys: Sequence[str] = (), leaky: bool = False
) -> list[str]:
    """Numeric columns without ids, the target and (unless ``leaky``) same-night derivatives."""
    skip = {*ID_COLUMNS, *keys, target, "run_date", "run_id"}
    if not leaky:
        skip |= set(SAME_NIGHT) | {f"{target}_{of}" for of in ("baseline", "baseline_std", "zscore")}
    return numeric_columns(df, exclude=skip)


def backtest_split(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    date: str = "date",
    horizon: int = HORIZON,
    backtest_window: int | None = BACKTEST_WINDOW,
    min_train: int = 0,
) -> DataFrame:
    """Marks the last rows of each series as test rows.

    The test part has min(horizon, max(1, n // 3), backtest_window) rows, but at
    least ``min_train`` rows stay in the training part. Adds ``rn`` (from 1),
    ``n_train`` and ``is_test``.
    """
    series = over_keys(keys)
    n = F.col("_n")
    h = F.least(F.lit(horizon), F.greatest(F.lit(1), F.floor(n / 3)))
    window = F.lit(backtest_window) if backtest_window is not None else F.least(F.lit(30), n)
    end = F.greatest(n - h, F.greatest(F.lit(min_train), n - window))
    return (
        df.withColumns(
            {
                "rn": F.row_number().over(series.orderBy(date)),
                "_n": F.count(F.lit(1)).over(series),
            }
        )
        .withColumn("n_train", F.least(end, n).cast("int"))
        .withColumn("is_test", F.col("rn") > F.col("n_train"))
        .drop("_n")
    )


def values_of(df: DataFrame, target: str, keys: Sequence[str], date: str) -> DataFrame:
    """The known values of the target."""
    return df.select(*keys, date, as_double(df, target).alias("_y")).where(F.col("_y").isNotNull())


def _flat(rows: DataFrame, level, band: float | None, keys: Sequence[str], date: str) -> DataFrame:
    """Test rows with a constant prediction."""
    marked = rows.withColumn("prediction", level).where("is_test")
    p = F.col("prediction")
    null = F.lit(None).cast("double")
    return marked.select(
        *keys,
        date,
        "prediction",
        (null if band is None else p - band).alias("lower"),
        (null if band is None else p + band).alias("upper"),
        F.col("_y").alias("actual"),
    )


def last_rolling_mean(
    df: DataFrame, target: str, *, keys: Sequence[str] = (), date: str = "date", window: int = 7
) -> DataFrame:
    """Mean of the last ``window`` values of each series."""
    back = over_keys(keys).orderBy(F.desc(date))
    ranked = values_of(df, target, keys, date).withColumn("_r", F.row_number().over(back))
    return (
        ranked.where(F.col("_r") <= window)
        .groupBy(*keys)
        .agg(F.avg("_y").alias("level"), F.max(date).alias("last_date"))
    )


def rolling_mean_forecast(
    df: DataFrame,
    target: str,
    *,
    keys: Sequence[str] = (),
    date: str = "date",
    horizon: int = HORIZON,
    backtest_window: int | None = BACKTEST_WINDOW,
    window: int = 7,
    interval: float | None = BAND,
) -> DataFrame:
    """Flat forecast at the mean of the last training rows, with a fixed band."""
    rows = backtest_split(
        values_of(df, target, keys, date),
        keys=keys, date=date, horizon=horizon, backtest_window=backtest_window,
    )
    late = ~F.col("is_test") & (F.col("rn") > F.col("n_train") - window)
    level = F.avg(F.when(late, F.col("_y"))).over(over_keys(keys))
    return _flat(rows, level, interval, keys, date)


def flat_baseline(df: DataFrame, target: str, **options) -> DataFrame:
    """The rolling mean forecast without a band, tested on the last ``horizon`` rows."""
    options.pop("backtest_window", None)
    return rolling_mean_forecast(df, target, backtest_window=None, interval=None, **options)


def naive_mean_forecast(
    df: DataFrame,
    target: str,
    *,
    keys: Sequence[str] = (),
    date: str = "date",
    horizon: int = HORIZON,
    backtest_window: int | None = BACKTEST_WINDOW,
    interval: float | None = BAND,
    min_train: int = 10,
) -> DataFrame:
    """Flat forecast at the mean of all training rows, with a fixed band."""
    rows = backtest_split(
        values_of(df, target, keys, date),
        keys=keys, date=date, horizon=horizon, backtest_window=backtest_window, min_train=min_train,
    )
    level = F.avg(F.when(~F.col("is_test"), F.col("_y"))).over(over_keys(keys))
    return _flat(rows, level, interval, keys, date)


def forecast_vs_actual(
    forecast: DataFrame,
    series: DataFrame,
    value: str,
    *,
    keys: Sequence[str] = (),
    date: str = "date",
) -> DataFrame:
    """Forecast with the value of the same day next to it."""
    actual = series.select(*keys, date, F.col(value).alias("actual"))
    return forecast.drop("actual").join(actual, [*keys, date], "left")


def backtest_metrics(forecast: DataFrame, keys: Sequence[str] = ("model", "target")) -> DataFrame:
    """MAE, MAPE (a ratio, zero actuals left out) and band coverage, one row per key.

    A row with a band and no actual counts as not covered; without a band the
    coverage is NULL.
    """
    error = F.abs(F.col("actual") - F.col("prediction"))
    ratio = F.abs(safe_ratio(error, F.col("actual")))
    banded = F.col("lower").isNotNull() & F.col("upper").isNotNull()
    inside = F.coalesce(F.col("actual").between(F.col("lower"), F.col("upper")), F.lit(False))
    return forecast.groupBy(*keys).agg(
        F.avg(error).alias("mae"),
        F.avg(ratio).alias("mape"),
        F.avg(F.when(banded, inside.cast("double"))).alias("coverage"),
    )


def ar1_fit(
    df: DataFrame, value: str, *, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Least squares of each value on its predecessor, with the last value and day."""
    order = over_keys(keys).orderBy(date)
    pairs = df.select(
        *keys, date, as_double(df, value).alias("_y"), F.lag(as_double(df, value)).over(order).alias("_x")
    )
    return pairs.groupBy(*keys).agg(
        F.regr_intercept("_y", "_x").alias("intercept"),
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_count("_y", "_x").alias("pairs"),
        F.max_by("_y", date).alias("last_value"),
        F.max(date).alias("last_date"),
    )


def ar1_forecast(
    df: DataFrame, value: str, horizon: int = 14, *, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """The AR(1) recursion in closed form for the days after the series."""
    fit = ar1_fit(df, value, keys=keys, date=date).where(F.col("slope").isNotNull())
    steps = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    slope, power = F.col("slope"), F.pow(F.col("slope"), F.col("step"))
    total = F.when(slope == 1.0, F.col("step").cast("double")).otherwise(
        (1 - power) / F.nullif(1 - slope, F.lit(0.0))
    )
    return steps.select(
        *keys,
        F.date_add("last_date", F.col("step")).alias(date),
        "step",
        (F.col("intercept") * total + power * F.col("last_value")).alias("forecast"),
    )


def run_summary(forecast: DataFrame, decomposition: DataFrame, value: str = "forecast") -> DataFrame:
    """First forecast day and value, mean trend and mean seasonal swing, one row."""
    first = forecast.agg(
        F.min("date").alias("next_date"), F.min_by(value, "date").alias("next_value")
    )
    level = decomposition.agg(
        F.avg("trend").alias("mean_trend"), F.avg(F.abs("seasonal")).alias("seasonal_swing")
    )
    row = level.select(F.struct("*")).scalar()
    return first.withColumn("_s", row).select("next_date", "next_value", "_s.*")


register_forecaster("rolling_mean", rolling_mean_forecast)
register_forecaster("naive_mean", naive_mean_forecast)
register_forecaster("flat", flat_baseline)
