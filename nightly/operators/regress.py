"""Autoregressions fitted per series by normal equations, without Python workers.

A series has one row per day (`series.regular_series` or the daily mean taken here). Its sums are an aggregate; what remains
is one small system of equations a series, solved by the expressions of `normal`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from nightly.functions.frame import as_double, join_keys, over_keys
from nightly.operators.forecast import (
    BACKTEST_WINDOW,
    HORIZON,
    feature_columns,
    register_forecaster,
)
from nightly.operators.normal import dot, equations, let, moments, solve
from nightly.operators.skew import by_series, series_tasks

SEASON = 7
BAND_Z = 1.959963984540054


def _ready(df: DataFrame, value: str, keys: Sequence[str], date: str) -> DataFrame:
    """One row per series and day, whatever the frame has, so that days bound every group."""
    day = F.col(date).cast("date").alias("date")
    rows = df.select(*keys, day, as_double(df, value).alias("y")).dropna(subset=["date", "y"])
    return rows.groupBy(*keys, "date").agg(F.avg("y").alias("y"))


def _packed(df: DataFrame, value: str, lags: int, keys: Sequence[str], date: str) -> DataFrame:
    """One row per series with more than ``lags`` values: its ``_days`` in order, and their mean.

    A lag is another place of the same array. As columns beside every day, the lags would make each row more than ten times as
    wide on its way through sorts, aggregates and joins.
    """
    days = F.sort_array(F.collect_list(F.struct("date", "y"))).alias("_days")
    return _ready(df, value, keys, date).groupBy(*keys).agg(days, F.avg("y").alias("_mean")).where(F.size("_days") > lags)


def _centred() -> Column:
    """The values of a series around their mean, in order."""
    return F.transform("_days", lambda d: d["y"] - F.col("_mean"))


def _earlier(z: Column, k: Column, lags: int) -> Column:
    """For each of the values that have all their lags the one ``k`` days before."""
    return F.slice(z, lags + 1 - k, F.size(z) - lags)


def _lag_products(z: Column, lags: int) -> Column:
    """Sums of z[t-i] z[t-j] over the days with all lags, i and j from 0 to ``lags``.

    Only those of z[t] are summed over the days. Each further row is the row before moved on by one day: it gains the product
    of two of the first values and loses that of two of the last.
    """
    def own(y: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(lags)), lambda k: F.aggregate(
            F.zip_with(y, _earlier(z, k, lags), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))

    def rows(first: Column, head: Column, tail: Column) -> Column:
        def further(done: Column, i: Column) -> Column:
            def moved(v: Column, j: Column) -> Column:
                return v + F.get(head, i) * F.get(head, j) - F.get(tail, i) * F.get(tail, j)

            row = F.concat(F.array(F.get(first, i + 1)), F.transform(F.slice(F.get(done, i), 1, lags), moved))
            return F.concat(done, F.array(row))

        return F.aggregate(F.sequence(F.lit(0), F.lit(lags - 1)), F.array(first), further)

    return let(let(_earlier(z, F.lit(0), lags), own), lambda first: let(_head(z, lags), lambda head: let(
        _tail(z, lags), lambda tail: rows(first, head, tail))))


def _lag_sums(z: Column, lags: int) -> Column:
    """Sums of z[t-k] over the days with all lags, k from 0 to ``lags``, each from the one before."""
    first = F.aggregate(_earlier(z, F.lit(0), lags), F.lit(0.0), lambda s, v: s + v)
    moves = let(_head(z, lags), lambda head: F.zip_with(head, _tail(z, lags), lambda gained, lost: gained - lost))
    return F.aggregate(moves, F.array(first), lambda done, v: F.concat(done, F.array(F.element_at(done, -1) + v)))


def _head(z: Column, lags: int) -> Column:
    """The first ``lags`` values, latest first."""
    return F.reverse(F.slice(z, 1, lags))


def _tail(z: Column, lags: int) -> Column:
    """The last ``lags`` values, latest first."""
    return F.reverse(F.slice(z, -lags, lags))


def _fits(packed: DataFrame, lags: int, keys: Sequence[str]) -> DataFrame:
    """The rows of `_packed` with the coefficients ``_b`` of the series around its mean, constant first."""
    def system(z: Column, products: Column, sums: Column) -> Column:
        rows = (F.size(z) - lags).cast("double")
        ones = F.concat(F.array(rows), F.slice(sums, 2, lags), F.slice(sums, 1, 1))

        def row(k: Column) -> Column:
            return let(F.get(products, k), lambda p: F.concat(F.array(F.get(sums, k)), F.slice(p, 2, lags), F.slice(p, 1, 1)))

        return F.concat(F.array(ones), F.transform(F.sequence(F.lit(1), F.lit(lags)), row))

    equations_of = let(_centred(), lambda z: let(_lag_products(z, lags), lambda p: let(_lag_sums(z, lags), lambda s: system(z, p, s))))
    return packed.select(*keys, "_days", "_mean", solve(equations_of, lags + 1)["beta"].alias("_b"))


def _original(beta: Column, mean: Column) -> Column:
    """Coefficients for the series itself from those for the series around its mean."""
    slopes = F.slice(beta, 2, F.size(beta))
    total = F.aggregate(slopes, F.lit(0.0), lambda s, v: s + v)
    return F.concat(F.array(F.get(beta, F.lit(0)) + mean * (1 - total)), slopes)


def autoreg_fit(
    df: DataFrame, value: str, lags: int = 30, *, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Coefficients of the regression on a constant and ``lags`` lags, ``(keys, term, coefficient)``.

    Series with at most ``lags`` values give no rows. Lags that depend on those before them, as in a constant series, get the
    coefficient 0. Expects a regular series.
    """
    fits = _fits(_packed(df, value, lags, keys, date), lags, keys)
    own = let(F.col("_b"), lambda beta: _original(beta, F.col("_mean")))
    return fits.select(*keys, F.posexplode(own).alias("term", "coefficient"))


def autoreg_fitted(
    df: DataFrame, value: str, lags: int = 30, *, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Actual and fitted value of every day that has all its lags."""
    fits = _fits(_packed(df, value, lags, keys, date), lags, keys)

    def days(beta: Column, z: Column) -> Column:
        def further(line: Column, k: Column) -> Column:
            return let(F.get(beta, k), lambda b: F.zip_with(line, _earlier(z, k, lags), lambda s, v: s + b * v))

        start = F.array_repeat(F.col("_mean") + F.get(beta, F.lit(0)), F.size(z) - lags)
        lines = F.aggregate(F.sequence(F.lit(1), F.lit(lags)), start, further)
        return F.zip_with(_earlier(F.col("_days"), F.lit(0), lags), lines, lambda d, line: F.struct(
            d["date"].alias("date"), d["y"].alias("actual"), line.alias("fitted")))

    each = let(F.col("_b"), lambda beta: let(_centred(), lambda z: days(beta, z)))
    return fits.select(*keys, F.inline(each))


def autoreg_forecast(
    df: DataFrame,
    value: str,
    lags: int = 30,
    horizon: int = 14,
    *,
    keys: Sequence[str] = (),
    date: str = "date",
) -> DataFrame:
    """Recursive forecast of the days after the series; the state is the list of the latest values."""
    fits = _fits(_packed(df, value, lags, keys, date), lags, keys)

    def path(beta: Column) -> Column:
        def ahead(known: Column, _: Column) -> Column:
            past = F.concat(F.array(F.lit(1.0)), F.slice(known, 1, lags))
            return F.concat(F.array(dot(beta, past)), known)

        return F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), _tail(_centred(), lags), ahead)

    # The coefficients are bound before the recursion: as a column they would be solved again in every step.
    steps = F.reverse(F.slice(let(F.col("_b"), path), 1, horizon))
    last = F.element_at("_days", -1)["date"].alias("_last")
    steps = fits.select(*keys, "_mean", last, F.posexplode(steps).alias("_i", "_z"))
    step = F.col("_i") + 1
    return steps.select(*keys, F.date_add("_last", step).alias("date"), step.alias("step"), (F.col("_mean") + F.col("_z")).alias("forecast"))


def _daily_grid(df: DataFrame, target: str, exog: Sequence[str], keys: Sequence[str], date: str) -> DataFrame:
    """Every day from the first known target to the last day of a series, gaps filled from before."""
    means = [F.avg(as_double(df, c)).alias(c) for c in exog]
    days = df.groupBy(*keys, F.col(date).cast("date").alias("date")).agg(F.avg(as_double(df, target)).alias("_y"), *means)
    days = by_series(days.dropna(subset=["date"]), keys, series_tasks(df, keys, date))
    order = over_keys(keys).orderBy("date")
    # A day stands for the gap behind it too, so filling is copying.
    gap = F.coalesce(F.date_sub(F.lead("date").over(order), 1), F.col("date"))
    last = [F.last(c, ignorenulls=True).over(order).alias(c) for c in ("_y", *exog)]
    filled = days.select(*keys, "date", gap.alias("_until"), *last).where(F.col("_y").isNotNull())
    every = F.explode(F.sequence("date", "_until", F.expr("interval 1 day"))).alias("date")
    return filled.select(*keys, every, "_y", *exog)


def arx_fit(
    df: DataFrame,
    target: str,
    *,
    keys: Sequence[str] = (),
    date: str = "date",
    horizon: int = HORIZON,
    backtest_window: int | None = BACKTEST_WINDOW,
    exog: Sequence[str] | None = (),
    lags: int = 1,
    season: int = SEASON,
) -> tuple[DataFrame, DataFrame]:
    """Coefficient table of the weekly-differenced regression, and the test rows it was not fitted on.

    One row per series: ``beta`` (constant, lags, features; NULL where the series is too short), ``sigma``, ``mean`` of the
    training days and ``recent``, their latest values. Test rows carry the day's feature differences ``dx``.
    """
    exog = feature_columns(df, target, keys=keys) if exog is None else list(exog)
    series = over_keys(keys)
    order = series.orderBy("date")
    grid = _daily_grid(df, target, exog, keys, date)
    n = F.count(F.lit(1)).over(series)
    h = F.least(F.lit(horizon), F.greatest(F.lit(1), F.floor(F.col("_n") / 3)))
    window = F.least(F.lit(30), F.col("_n")) if backtest_window is None else F.lit(backtest_window)
    end = F.least(F.col("_n"), F.greatest(F.col("_n") - h, F.greatest(F.lit(10), F.col("_n") - window)))
    rows = grid.withColumns(
        {"_t": F.row_number().over(order) - 1, "_n": n, "_dy": F.col("_y") - F.lag("_y", season).over(order)}
    ).withColumn("_end", end)
    # Features that are unknown on some day of a series carry no usable signal in it.
    known = {f"_k{i}": F.count(c).over(series) == F.col("_n") for i, c in enumerate(exog)}
    steps = {f"_x{i}": F.col(c) - F.lag(c, season).over(order) for i, c in enumerate(exog)}
    own = {f"_l{k}": F.lag("_dy", k).over(order) for k in range(1, lags + 1)}
    rows = rows.withColumns({**known, **steps, **own})
    rows = rows.withColumns({f"_x{i}": F.when(F.col(f"_k{i}") & F.col(f"_x{i}").isNotNull(), F.col(f"_x{i}")).otherwise(0.0) for i in range(len(exog))})
    train = (F.col("_t") >= season + lags) & (F.col("_t") < F.col("_end"))
    design = [F.lit(1.0), *[F.col(c) for c in own], *[F.col(c) for c in steps]]
    recent = F.collect_list(F.when((F.col("_t") < F.col("_end")) & (F.col("_t") >= F.col("_end") - season - lags), F.struct("_t", "_y")))
    fits = rows.groupBy(*keys).agg(
        *[c.alias(name) for name, c in moments(design, F.col("_dy"), train).items()],
        F.avg(F.when(F.col("_t") < F.col("_end"), F.col("_y"))).alias("mean"),
        F.transform(F.sort_array(recent, asc=False), lambda v: v["_y"]).alias("recent"),
        *[F.first(c).alias(c) for c in known],
    )
    width = len(design)
    usable = F.lit(1 + lags)
    for c in known:
        usable = usable + F.col(c).cast("int")
    fits = fits.withColumn("_eq", equations(width)).withColumn("_fit", solve(F.slice("_eq", 1, width), width))
    right = F.transform(F.slice("_eq", 1, width), lambda row: F.get(row, F.lit(width)))
    rest = F.coalesce(F.col(f"_m{width}_{width}"), F.lit(0.0)) - dot(F.col("_fit.beta"), right)
    enough = F.col("_rows") >= usable + 2
    freedom = F.greatest(F.lit(1), F.col("_rows") - F.col("_fit.used"))
    fits = fits.select(
        *keys, F.when(enough, F.col("_fit.beta")).alias("beta"),
        F.when(enough, F.sqrt(F.greatest(F.lit(0.0), rest) / freedom)).alias("sigma"), "mean", "recent",
    )
    test = rows.where(F.col("_t") >= F.col("_end")).select(
        *keys, "date", F.col("_y").alias("actual"), (F.col("_t") - F.col("_end")).alias("step"),
        F.array(*[F.col(c) for c in steps]).cast("array<double>").alias("dx"),
    )
    return fits, test


def arx_score(
    fits: DataFrame, test: DataFrame, *, keys: Sequence[str] = (), lags: int = 1, season: int = SEASON, z: float = BAND_Z
) -> DataFrame:
    """Forecast of the test rows from a coefficient table of `arx_fit`: ``keys, date, prediction, lower, upper, actual``."""
    day = F.struct("step", "date", "actual", "dx")
    ahead = test.groupBy(*keys).agg(F.sort_array(F.collect_list(day)).alias("_days"))  # at most the test days of a series
    both = join_keys(fits, ahead, keys) if keys else fits.join(F.broadcast(ahead))
    beta = F.col("beta")
    phi = F.slice(beta, 2, lags)
    gamma = F.slice(beta, 2 + lags, F.greatest(F.lit(0), F.size(beta) - 1 - lags))

    def further(known: Column, d: Column) -> Column:
        moves = F.zip_with(F.slice(known, 1, lags), F.slice(known, 1 + season, lags), lambda a, b: a - b)
        step = F.get(beta, F.lit(0)) + dot(phi, moves) + dot(gamma, d["dx"])
        return F.concat(F.array(F.get(known, F.lit(season - 1)) + step), known)

    def growth(state: Column, d: Column) -> Column:
        """Responses to a shock ``step`` days ago: of the differences, of the series, and summed squares of the latter."""
        shock = F.when(d["step"] == 0, 1.0).otherwise(dot(phi, F.slice(state["shock"], 1, lags)))
        return let(shock, lambda s: let(s + F.get(state["weight"], F.lit(season - 1)), lambda w: F.struct(
            F.concat(F.array(s), state["shock"]).alias("shock"), F.concat(F.array(w), state["weight"]).alias("weight"),
            F.concat(state["square"], F.array(F.coalesce(F.element_at(state["square"], -1), F.lit(0.0)) + w * w)).alias("square"),
        )))

    zeros = F.struct(
        F.array_repeat(F.lit(0.0), lags).alias("shock"), F.array_repeat(F.lit(0.0), season).alias("weight"),
        F.array(F.lit(0.0)).alias("square"),
    )
    days = F.size("_days")
    path = F.reverse(F.slice(F.aggregate("_days", F.col("recent"), further), 1, days))
    spread = F.slice(F.aggregate("_days", zeros, growth)["square"], 2, days)
    done = both.withColumns({
        "_path": F.when(beta.isNull(), F.array_repeat("mean", days)).otherwise(path),
        "_half": F.when(beta.isNull(), F.array_repeat(F.lit(0.5), days)).otherwise(
            F.transform(spread, lambda v: z * F.col("sigma") * F.sqrt(v))),
    })
    each = done.select(*keys, F.explode(F.arrays_zip("_days", "_path", "_half")).alias("d"))
    p, half = F.col("d._path"), F.col("d._half")
    return each.select(
        *keys, F.col("d._days.date").alias("date"), p.alias("prediction"), (p - half).alias("lower"), (p + half).alias("upper"),
        F.col("d._days.actual").alias("actual"),
    )


def seasonal_arx_forecast(
    df: DataFrame,
    target: str,
    *,
    keys: Sequence[str] = (),
    date: str = "date",
    horizon: int = HORIZON,
    backtest_window: int | None = BACKTEST_WINDOW,
    exog: Sequence[str] | None = (),
    lags: int = 1,
    season: int = SEASON,
    z: float = BAND_Z,
) -> DataFrame:
    """Weekly-differenced regression on own lags and outside features, tested on the last days.

    The weekly difference of the target is regressed on a constant, its last
    ``lags`` values and the weekly differences of the features. The test days are
    forecast recursively with their known features; the band widens with the step
    by the autoregressive weights. Too short series get the training mean with a
    band of 0.5; features that depend on others or are unknown on some day get the
    coefficient 0. ``exog=None`` takes every numeric column that is not derived
    from the same night.
    """
    fits, test = arx_fit(
        df, target, keys=keys, date=date, horizon=horizon, backtest_window=backtest_window, exog=exog, lags=lags, season=season
    )
    return arx_score(fits, test, keys=keys, lags=lags, season=season, z=z)


register_forecaster("seasonal_arx", seasonal_arx_forecast)
