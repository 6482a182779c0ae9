"""Operators over daily series ``(keys..., date, value)``.

A daily series has one row per key and day, made by `daily_mean`, an aggregate
that is combined before its shuffle. The number of days bounds every group, so
the windows here may be partitioned by the keys alone, whatever the number of
raw rows behind a key. All windows of one chain share one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, Window as W

from nightly.functions.frame import as_double, attach_stats, numeric_columns, over_keys
from nightly.functions.time import utc_wall
from nightly.operators.skew import MAX_ROWS, Spread, by_series, row_windows, running_totals, series_tasks

HEALTHY_HOURS = (7.0, 9.0)
# Two-sided 95 % quantile of the standard normal distribution.
Z95 = 1.959963984540054


def daily_mean(
    df: DataFrame, value: str, *, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Mean of all values of one key and day."""
    return df.groupBy(*keys, date).agg(F.avg(as_double(df, value)).alias(value))


def daily_target(
    df: DataFrame,
    name: str,
    *,
    column: str | None = None,
    transform: str | None = None,
    keys: Sequence[str] = (),
    date: str = "date",
) -> DataFrame:
    """Per day the mean of the target and of every numeric or boolean column."""
    column = column or name
    if column not in df.columns:
        raise ValueError(f"target column {column!r} is not in the frame")
    if transform not in (None, "minutes_to_hours"):
        raise ValueError(f"unknown transform {transform!r}")
    value = as_double(df, column)
    if transform == "minutes_to_hours":
        value = value / 60.0
    ready = df.withColumn(name, value)
    names = numeric_columns(ready, exclude=[*keys, date])
    means = [F.avg(as_double(ready, c)).alias(c) for c in names]
    return ready.groupBy(*keys, date).agg(*means).dropna(subset=[name])


def calendar_densify(
    df: DataFrame, *, keys: Sequence[str] = (), date: str = "date", tasks: int | None = None
) -> DataFrame:
    """One row per day between the first and the last day of each series.

    Every row makes the days up to its successor, so this needs no join, and
    later windows over the keys reuse the shuffle. Added days have NULL values.
    ``tasks`` may be counted (`series_tasks`) on the rows that ``df`` is made of,
    where it costs less than on ``df``.
    """
    values = [c for c in df.columns if c not in (*keys, date)]
    following = F.lead(date).over(over_keys(keys).orderBy(date))
    last = F.coalesce(F.date_sub(following, 1), F.col(date))
    known = df.where(F.col(date).isNotNull())
    dealt = by_series(known, keys, tasks or series_tasks(known, keys, date))
    spread = dealt.withColumn("_last", last)
    days = spread.withColumn("_day", F.explode(F.sequence(F.col(date), F.col("_last"))))
    own = F.col("_day") == F.col(date)
    return days.select(
        *keys, F.col("_day").alias(date), *[F.when(own, F.col(v)).alias(v) for v in values]
    )


def forward_fill(
    df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Last known value; NULL before the first one."""
    upto = over_keys(keys).orderBy(date).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, ignorenulls=True).over(upto) for c in columns})


def interpolate_linear(
    df: DataFrame, value: str, *, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Straight line between known values by row position; the ends are carried.

    The next known value is the last one in descending order: a frame that only
    grows, where a frame up to the end of the series would be read again per row.
    """
    order = over_keys(keys).orderBy(date)
    growing = (W.unboundedPreceding, 0)
    upto = order.rowsBetween(*growing)
    onward = over_keys(keys).orderBy(F.desc(date)).rowsBetween(*growing)
    v, pos = F.col(value), F.col("_pos")
    known = F.when(v.isNotNull(), F.struct(pos.alias("p"), v.alias("v")))
    numbered = df.withColumn("_pos", F.row_number().over(order))
    framed = numbered.withColumn("_prev", F.last(known, ignorenulls=True).over(upto)).withColumn(
        "_next", F.last(known, ignorenulls=True).over(onward)
    )
    prev, nxt = F.col("_prev"), F.col("_next")
    share = (pos - prev["p"]) / (nxt["p"] - prev["p"]).cast("double")
    filled = (
        F.when(v.isNotNull(), v)
        .when(prev.isNull(), nxt["v"])
        .when(nxt.isNull(), prev["v"])
        .otherwise(prev["v"] + (nxt["v"] - prev["v"]) * share)
    )
    return framed.withColumn(value, filled).drop("_pos", "_prev", "_next")


def regular_series(
    df: DataFrame, value: str, *, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Daily mean, every day present, gaps interpolated, ends carried.

    The same as densify and interpolate, in one pass over the known days: each
    makes the days up to the next known day on the line between them. A series
    without a known value keeps its days, all NULL. The days are counted first, by
    one job over keys and dates, so that the tasks grow with them.
    """
    daily = daily_mean(df, value, keys=keys, date=date).where(F.col(date).isNotNull())
    daily = by_series(daily, keys, series_tasks(df, keys, date))
    series = over_keys(keys)
    ends = daily.withColumns(
        {"_first": F.min(date).over(series), "_end": F.max(date).over(series), "_known": F.count(value).over(series)}
    )
    empty = (F.col("_known") == 0) & (F.col(date) == F.col("_first"))
    known = ends.where(F.col(value).isNotNull() | empty)
    order = series.orderBy(date)
    linked = known.withColumns(
        {
            "_prev_date": F.lag(date).over(order),
            "_next_date": F.lead(date).over(order),
            "_next": F.lead(value).over(order),
        }
    )
    start = F.when(F.col("_prev_date").isNull(), F.col("_first")).otherwise(F.col(date))
    stop = F.coalesce(F.date_sub("_next_date", 1), F.col("_end"))
    days = linked.withColumn("_day", F.explode(F.sequence(start, stop)))
    share = F.date_diff("_day", date) / F.date_diff("_next_date", date).cast("double")
    v = F.col(value)
    line = F.when(
        (F.col("_day") > F.col(date)) & F.col("_next").isNotNull(), v + (F.col("_next") - v) * share
    ).otherwise(v)
    return days.select(*keys, F.col("_day").alias(date), line.alias(value))


def exog_align(
    spine: DataFrame,
    features: DataFrame,
    columns: Sequence[str],
    *,
    keys: Sequence[str] = (),
    date: str = "date",
) -> DataFrame:
    """Daily feature means on the dates of ``spine``, gaps filled forward."""
    means = features.groupBy(*keys, date).agg(
        *[F.avg(as_double(features, c)).alias(c) for c in columns]
    )
    joined = spine.join(means, [*keys, date], "left")
    return forward_fill(joined, columns, keys=keys, date=date)


def lag_pairs(
    df: DataFrame, value: str, *, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Each value with its successor."""
    step = F.lead(value).over(over_keys(keys).orderBy(date))
    paired = df.withColumn("_next", step).where(F.col("_next").isNotNull())
    return paired.select(*keys, date, F.col(value).alias("y_t"), F.col("_next").alias("y_next"))


def acf(
    df: DataFrame,
    value: str,
    lags: int = 30,
    *,
    keys: Sequence[str] = (),
    order: Sequence[str] = ("date",),
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Autocorrelation up to min(lags, n-1) with the Bartlett band.

    Works on the rows as they are, also on raw ones: the lags are bounded row
    windows and the sums one aggregate.
    """
    keys = list(keys)
    ready = df.select(*keys, *order, as_double(df, value).alias("_v")).where(F.col("_v").isNotNull())
    stats = ready.groupBy(*keys).agg(F.avg("_v").alias("_mu"), F.count("_v").alias("_n"))
    centred = attach_stats(ready, stats, keys).withColumn("_d", F.col("_v") - F.col("_mu"))
    shifted = row_windows(
        centred,
        lambda w: [F.lag("_d", k).over(w).alias(f"_l{k}") for k in range(1, lags + 1)],
        keys=keys,
        order=order,
        lookback=lags,
        max_rows=max_rows,
    )
    products = [F.sum(F.col("_d") * F.col("_d")).alias("_s0")] + [
        F.coalesce(F.sum(F.col("_d") * F.col(f"_l{k}")), F.lit(0.0)).alias(f"_s{k}")
        for k in range(1, lags + 1)
    ]
    sums = shifted.groupBy(*keys).agg(F.max("_n").alias("_n"), *products)
    pairs = F.array(
        *[F.struct(F.lit(k).alias("lag"), F.col(f"_s{k}").alias("s")) for k in range(lags + 1)]
    )
    long = sums.select(*keys, "_n", "_s0", F.explode(pairs).alias("p")).select(
        *keys,
        F.col("p.lag").alias("lag"),
        (F.col("p.s") / F.nullif("_s0", F.lit(0.0))).alias("acf"),
        "_n",
    )
    # At most lags+1 rows per series.
    before = over_keys(keys).orderBy("lag").rowsBetween(W.unboundedPreceding, -1)
    squares = F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(before)
    spreaded = F.sqrt((1 + 2 * F.coalesce(squares, F.lit(0.0))) / F.col("_n"))
    band = F.when(F.col("lag") == 0, 0.0).otherwise(F.lit(Z95) * spreaded)
    return long.withColumn("band", band).where(F.col("lag") < F.col("_n")).drop("_n")


def healthy_streak(
    df: DataFrame,
    value: str = "sleep_hours",
    *,
    keys: Sequence[str] = (),
    order: Sequence[str] = ("date",),
    bounds: tuple[float, float] = HEALTHY_HOURS,
    calendar: bool = False,
    found: Spread | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Length of the longest run of consecutive rows within the bounds, 0 if none.

    Rows of a run share the number of out-of-range rows before them, which is a
    running total; the run lengths are then a plain aggregate. With ``calendar``
    missing days break a run (one row per day is needed then).
    """
    keys = list(keys)
    if calendar:
        df = calendar_densify(df, keys=keys, date=order[0])
    good = F.coalesce(F.col(value).between(*bounds), F.lit(False))
    flagged = df.select(*keys, *order, good.alias("_good"))
    breaks = {"_run": (~F.col("_good")).cast("long")}
    runs = running_totals(flagged, breaks, keys=keys, order=order, found=found, max_rows=max_rows)
    lengths = runs.groupBy(*keys, "_run").agg(F.count_if("_good").alias("_len"))
    return lengths.groupBy(*keys).agg(F.max("_len").alias("best_streak"))


def sort_sessions(df: DataFrame, by: Sequence[str] = ("user_id", "start_ts")) -> DataFrame:
    """Output order, NULLs last. A range-partitioned sort."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in by])


def last_rows(
    df: DataFrame, n: int, *, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The last ``n`` rows of each key.

    Catalyst keeps only ``n`` rows per key and task before the shuffle
    (WindowGroupLimit), so a key never gathers more than n rows per map task.
    """
    latest = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    ranked = df.withColumn("_rank", F.row_number().over(latest))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def forecast_calendar(
    df: DataFrame, horizon: int, *, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """The ``horizon`` days after the last day of each series, numbered from 1."""
    last = df.groupBy(*keys).agg(F.max(date).alias("_last")).where(F.col("_last").isNotNull())
    days = F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))
    listed = last.select(*keys, F.posexplode(days).alias("_i", date))
    return listed.select(*keys, date, (F.col("_i") + 1).alias("step"))


def history_plus_forecast(history: DataFrame, forecast: DataFrame) -> DataFrame:
    """Both stacked; columns of one side are NULL on the other."""
    return history.unionByName(forecast, allowMissingColumns=True)


def calendar_features(df: DataFrame, column: str = "start_ts") -> DataFrame:
    """Calendar parts of a timestamp (UTC)."""
    wall = utc_wall(df, column)
    return df.withColumns(
        {
            "date": F.to_date(wall),
            "hour": F.hour(wall),
            "minute": F.minute(wall),
            "day_of_week": F.weekday(wall),
            "day_name": F.date_format(wall, "EEEE"),
            "month": F.month(wall),
            # The year goes with the week, so days around New Year are right.
            "iso_week": F.concat(
                F.extract(F.lit("YEAROFWEEK"), wall).cast("string"),
                F.lit("-W"),
                F.lpad(F.extract(F.lit("WEEK"), wall).cast("string"), 2, "0"),
            ),
        }
    )
