"""Gradient-boosted trees on a daily feature frame, with Spark's own trainer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, functions as F

from nightly.functions.frame import as_double
from nightly.operators.forecast import (
    BACKTEST_WINDOW,
    HORIZON,
    backtest_split,
    feature_columns,
    register_forecaster,
)
from nightly.session import materialize

# Rows per training task, so that the tasks grow with the series. Every level of every tree is a pass over all tasks, some 600
# in all: with few rows a task, starting the tasks takes longer than the passes.
TRAIN_ROWS = 250_000


def _rows(df: DataFrame, target: str, features: Sequence[str], keys: Sequence[str], date: str, horizon: int, backtest_window: int | None) -> DataFrame:
    """Feature vectors of the rows that have all features, the last ones of every series marked as test rows."""
    ready = df.select(
        *keys, date, as_double(df, target).alias("_y"), *[as_double(df, c).alias(c) for c in features]
    ).dropna(subset=["_y", *features])
    marked = backtest_split(ready, keys=keys, date=date, horizon=horizon, backtest_window=backtest_window)
    return VectorAssembler(inputCols=list(features), outputCol="_x").transform(marked).select(*keys, date, "_y", "_x", "is_test")


def gbt_train(
    df: DataFrame,
    target: str,
    *,
    keys: Sequence[str] = (),
    date: str = "date",
    horizon: int = HORIZON,
    backtest_window: int | None = BACKTEST_WINDOW,
    features: Sequence[str] | None = None,
    leaky: bool = False,
    learning_rate: float = 0.05,
    max_depth: int = 3,
    n_estimators: int = 100,
    seed: int = 42,
) -> tuple[GBTRegressionModel, list[str]]:
    """One model over the training rows of all series; returns it with the names of its features.

    The trainer reads the rows once per tree level, so they are written once, in files of about TRAIN_ROWS rows of whole
    series, and cached. A lost executor costs the cached blocks it held.
    """
    features = list(features if features is not None else feature_columns(df, target, keys=keys, leaky=leaky))
    if not features:
        raise ValueError("no feature columns left to train on")
    rows = materialize(_rows(df, target, features, keys, date, horizon, backtest_window), "training").where(~F.col("is_test"))
    tasks = -(-rows.count() // TRAIN_ROWS)
    rows = rows.repartition(max(1, tasks), *(keys or [date])).persist()
    try:
        trainer = GBTRegressor(
            featuresCol="_x", labelCol="_y", predictionCol="prediction",
            maxIter=n_estimators, stepSize=learning_rate, maxDepth=max_depth, seed=seed,
        )
        return trainer.fit(rows), features
    finally:
        rows.unpersist()


def gbt_score(
    model: GBTRegressionModel,
    df: DataFrame,
    target: str,
    features: Sequence[str],
    *,
    keys: Sequence[str] = (),
    date: str = "date",
    horizon: int = HORIZON,
    backtest_window: int | None = BACKTEST_WINDOW,
) -> DataFrame:
    """Forecast of the test rows of every series."""
    null = F.lit(None).cast("double")
    test = _rows(df, target, features, keys, date, horizon, backtest_window).where("is_test")
    return model.transform(test).select(
        *keys, date, "prediction", null.alias("lower"), null.alias("upper"), F.col("_y").alias("actual")
    )


def gbt_fit(df: DataFrame, target: str, **options) -> tuple[GBTRegressionModel, DataFrame]:
    """Train on the first rows of every series, predict the last; returns model and forecast."""
    model, features = gbt_train(df, target, **options)
    shared = {k: v for k, v in options.items() if k in ("keys", "date", "horizon", "backtest_window")}
    return model, gbt_score(model, df, target, features, **shared)


def gbt_forecast(df: DataFrame, target: str, **options) -> DataFrame:
    """Forecast of the test rows only."""
    return gbt_fit(df, target, **options)[1]


register_forecaster("gbt", gbt_forecast)
