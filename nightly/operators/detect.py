"""Change points of daily series and anomalies among residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from nightly.functions.frame import as_double, attach_stats, over_keys
from nightly.operators.quantile import exact_quantiles


def change_points(
    df: DataFrame,
    value: str,
    *,
    keys: Sequence[str] = (),
    date: str = "date",
    penalty: float = 5.0,
    min_size: int = 5,
) -> DataFrame:
    """Days whose jump from the previous value is at least ``penalty`` deviations of all jumps.

    ``position`` counts from 0 within the series without its NULLs. Series with
    fewer than ``2 * min_size`` values have no change points.
    """
    rows = df.select(*keys, date, as_double(df, value).alias(value)).where(F.col(value).isNotNull())
    series = over_keys(keys)
    order = series.orderBy(date)
    jumps = rows.select(
        "*",
        (F.row_number().over(order) - 1).alias("position"),
        F.count(F.lit(1)).over(series).alias("_n"),
        F.abs(F.col(value) - F.lag(value).over(order)).alias("jump"),
    ).withColumn("_std", F.stddev_pop("jump").over(series))
    limit = F.when(F.col("_std") > 0, F.col("_std") * penalty).otherwise(penalty)
    hits = jumps.where((F.col("_n") >= 2 * min_size) & (F.col("jump") >= limit))
    return hits.drop("_n", "_std")


def residuals(forecast: DataFrame) -> DataFrame:
    """Adds actual - prediction."""
    return forecast.withColumn("residual", F.col("actual") - F.col("prediction"))


def anomalies_zscore(
    df: DataFrame, value: str = "residual", *, keys: Sequence[str] = (), threshold: float = 3.0
) -> DataFrame:
    """Flags values at least ``threshold`` population deviations from the mean."""
    v = as_double(df, value)
    rows = df.where(v.isNotNull())
    stats = rows.groupBy(*keys).agg(F.avg(v).alias("_mu"), F.stddev_pop(v).alias("_sd"))
    far = (F.col("_sd") > 0) & (F.abs(v - F.col("_mu")) >= F.col("_sd") * threshold)
    return _flagged(attach_stats(rows, stats, keys), far, "zscore", threshold, ["_mu", "_sd"])


def anomalies_iqr(
    df: DataFrame, value: str = "residual", *, keys: Sequence[str] = (), threshold: float = 3.0
) -> DataFrame:
    """Flags values further than ``threshold`` quartile distances outside the quartiles."""
    v = as_double(df, value)
    rows = df.where(v.isNotNull())
    quart = exact_quantiles(rows, value, [0.25, 0.75], keys=keys).select(
        *keys, F.col("quantiles")[0].alias("_q1"), F.col("quantiles")[1].alias("_q3")
    )
    spread = F.col("_q3") - F.col("_q1")
    far = (spread > 0) & (
        (v < F.col("_q1") - spread * threshold) | (v > F.col("_q3") + spread * threshold)
    )
    return _flagged(attach_stats(rows, quart, keys), far, "iqr", threshold, ["_q1", "_q3"])


def _flagged(df: DataFrame, far, method: str, threshold: float, drop: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {
            "is_anomaly": F.coalesce(far, F.lit(False)),
            "method": F.lit(method),
            "threshold": F.lit(float(threshold)),
        }
    ).drop(*drop)
