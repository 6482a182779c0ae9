"""Fitted forecasters: a coefficient table or trees, with all that forecasting from them needs.

`fit` and `score` are the two halves of a forecaster, so that a model can be saved by one job (`sinks.models`) and used by
another. Scoring forecasts the test rows of the frame it is given.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from nightly.functions.frame import join_keys
from nightly.operators import boosting, forecast as fc, regress


@dataclass(frozen=True)
class Fitted:
    """``options`` are plain values: those of the fit, and what it chose itself, as its feature columns."""

    name: str
    target: str
    keys: tuple[str, ...]
    options: dict = field(default_factory=dict)
    table: DataFrame | None = None
    trees: GBTRegressionModel | None = None


@dataclass(frozen=True)
class Model:
    fit: Callable[..., Fitted]
    score: Callable[[Fitted, DataFrame], DataFrame]


MODELS: dict[str, Model] = {}


def fit(name: str, df: DataFrame, target: str, *, keys: Sequence[str] = (), **options) -> Fitted:
    """Fit a registered model on the training rows of every series."""
    return MODELS[name].fit(df, target, keys=tuple(keys), **options)


def score(fitted: Fitted, df: DataFrame) -> DataFrame:
    """``keys, date, prediction, lower, upper, actual`` of the test rows of ``df``."""
    return MODELS[fitted.name].score(fitted, df)


def _split_options(options: dict) -> dict:
    given = {"date": "date", "horizon": fc.HORIZON, "backtest_window": fc.BACKTEST_WINDOW, **options}
    return {k: given[k] for k in ("date", "horizon", "backtest_window")}


def _level(name: str, *, band: float | None, min_train: int = 0, last: bool = True, whole_window: bool = False) -> Model:
    """A flat forecast at the mean of the last, or of all, training rows."""

    def rows(df: DataFrame, target: str, keys: Sequence[str], options: dict) -> DataFrame:
        split = _split_options(options)
        if whole_window:
            split["backtest_window"] = None
        values = fc.values_of(df, target, keys, split["date"])
        return fc.backtest_split(values, keys=list(keys), min_train=min_train, **split)

    def fit_level(df: DataFrame, target: str, *, keys: Sequence[str] = (), **options) -> Fitted:
        options = {"window": 7, "interval": band, **options}
        late: Column = ~F.col("is_test")
        if last:
            late = late & (F.col("rn") > F.col("n_train") - options["window"])
        table = rows(df, target, keys, options).groupBy(*keys).agg(F.avg(F.when(late, F.col("_y"))).alias("level"))
        return Fitted(name, target, tuple(keys), options, table)

    def score_level(fitted: Fitted, df: DataFrame) -> DataFrame:
        test = rows(df, fitted.target, fitted.keys, fitted.options).where("is_test")
        if fitted.keys:
            both = join_keys(test, fitted.table, list(fitted.keys))
        else:
            both = test.join(F.broadcast(fitted.table))
        half = fitted.options["interval"]
        p, none = F.col("level"), F.lit(None).cast("double")
        return both.select(
            *fitted.keys, _split_options(fitted.options)["date"], p.alias("prediction"),
            (none if half is None else p - half).alias("lower"), (none if half is None else p + half).alias("upper"),
            F.col("_y").alias("actual"),
        )

    return Model(fit_level, score_level)


def _arx() -> Model:
    def arguments(options: dict) -> dict:
        own = {"exog": (), "lags": 1, "season": regress.SEASON, **options}
        return {**_split_options(options), **{k: own[k] for k in ("exog", "lags", "season")}}

    def fit_arx(df: DataFrame, target: str, *, keys: Sequence[str] = (), **options) -> Fitted:
        if options.get("exog", ()) is None:
            options["exog"] = fc.feature_columns(df, target, keys=keys)
        options["exog"] = list(options.get("exog", ()))
        table, _ = regress.arx_fit(df, target, keys=keys, **arguments(options))
        return Fitted("seasonal_arx", target, tuple(keys), options, table)

    def score_arx(fitted: Fitted, df: DataFrame) -> DataFrame:
        own = arguments(fitted.options)
        _, test = regress.arx_fit(df, fitted.target, keys=fitted.keys, **own)
        z = fitted.options.get("z", regress.BAND_Z)
        return regress.arx_score(fitted.table, test, keys=list(fitted.keys), lags=own["lags"], season=own["season"], z=z)

    return Model(fit_arx, score_arx)


def _trees() -> Model:
    def fit_trees(df: DataFrame, target: str, *, keys: Sequence[str] = (), **options) -> Fitted:
        trees, features = boosting.gbt_train(df, target, keys=list(keys), **options)
        return Fitted("gbt", target, tuple(keys), {**options, "features": features}, trees=trees)

    def score_trees(fitted: Fitted, df: DataFrame) -> DataFrame:
        split = _split_options(fitted.options)
        return boosting.gbt_score(fitted.trees, df, fitted.target, fitted.options["features"], keys=list(fitted.keys), **split)

    return Model(fit_trees, score_trees)


MODELS |= {
    "rolling_mean": _level("rolling_mean", band=fc.BAND),
    "naive_mean": _level("naive_mean", band=fc.BAND, min_train=10, last=False),
    "flat": _level("flat", band=None, whole_window=True),
    "seasonal_arx": _arx(),
    "gbt": _trees(),
}
