"""Additive seasonal decomposition of regular daily series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, Window as W

from nightly.functions.frame import over_keys


def seasonal_decompose(
    df: DataFrame,
    value: str,
    period: int = 7,
    *,
    keys: Sequence[str] = (),
    date: str = "date",
) -> DataFrame:
    """Observed = trend + seasonal + resid.

    The trend is the centred moving mean over one period (half weights at both
    ends for an even period), NULL at the edges. The seasonal part is the mean
    of the detrended values by position in the period, shifted to mean 0. Series
    shorter than two periods give no rows. Expects one row per day without gaps
    (`regular_series`); all windows share the shuffle by the keys.
    """
    keys = list(keys)
    series = over_keys(keys)
    order = series.orderBy(date)
    half = period // 2
    centred = order.rowsBetween(-half, half)
    v = F.col(value)
    complete = F.count(v).over(centred) == 2 * half + 1
    if period % 2:
        trend = F.avg(v).over(centred)
    else:
        ends = F.lag(v, half).over(order) + F.lead(v, half).over(order)
        trend = (F.sum(v).over(centred) - 0.5 * ends) / F.lit(float(period))
    rows = df.select(
        *keys,
        date,
        v.alias("observed"),
        F.count(F.lit(1)).over(series).alias("_n"),
        (F.row_number().over(order) - 1).alias("_rn"),
        F.when(complete, trend).alias("trend"),
    ).where(F.col("_n") >= 2 * period)
    rows = rows.withColumns(
        {"_slot": F.pmod(F.col("_rn"), F.lit(period)), "_rest": F.col("observed") - F.col("trend")}
    )
    slot = W.partitionBy(*(keys or [F.lit(0)]), "_slot")
    rows = rows.withColumns(
        {"_mean": F.avg("_rest").over(slot), "_size": F.count(F.lit(1)).over(slot)}
    )
    centre = F.sum(F.col("_mean") / F.col("_size")).over(series) / F.lit(float(period))
    rows = rows.withColumn("seasonal", F.col("_mean") - centre)
    return rows.select(
        *keys,
        date,
        "observed",
        "trend",
        "seasonal",
        (F.col("observed") - F.col("trend") - F.col("seasonal")).alias("resid"),
    )
