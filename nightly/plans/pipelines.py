"""The four jobs: ingest, build features, train, analyse."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from nightly.operators import models as fitted_models, regress
from nightly.operators.canonical import (
    normalize_sessions,
    quarantine_split,
    validate,
)
from nightly.operators.circadian import circadian_features
from nightly.operators.decompose import seasonal_decompose
from nightly.operators.detect import anomalies_zscore, change_points, residuals
from nightly.operators.forecast import (
    BACKTEST_WINDOW,
    FORECASTERS,
    HORIZON,
    backtest_metrics,
    run_summary,
)
from nightly.operators.fuse import feature_store
from nightly.operators.privacy import scrub
from nightly.operators.profile import describe_numeric, describe_table
from nightly.operators.series import acf, daily_target, regular_series
from nightly.schema import FORECAST_COLUMNS, SLEEP_COLUMNS
from nightly.session import job, materialize
from nightly.sinks.models import load_fitted, save_fitted
from nightly.sinks.writers import (
    Written,
    write_curated,
    write_features,
    write_forecasts,
    write_reports,
    write_table,
    write_telemetry,
)
from nightly.sources.files import curated_sleep
from nightly.sources.text import scan_hrv, scan_screen, scan_steps, scan_tags, scan_vendor

TARGETS = {"sleep_hours": {"column": "duration_min", "transform": "minutes_to_hours"}}
MODELS: dict[str, dict] = {
    "seasonal_arx": {"exog": None},  # every numeric column that is not derived from the same night
    "rolling_mean": {},
    "gbt": {"learning_rate": 0.1, "max_depth": 3, "n_estimators": 100},
}


def ingest(
    spark: SparkSession,
    source: str,
    path: str,
    out: str,
    *,
    strict: bool = False,
    local_only: bool = False,
    scrub_fields: Iterable[str] = ("name", "email", "id"),
    telemetry: str | None = None,
) -> Written:
    """Vendor export -> curated run.

    Every row is either curated or goes to ``<out>_quarantine`` with the rules it
    breaks, unreadable times and unknown zones included; the quarantine has the
    same run folders, written after the curated run. ``strict`` raises on the
    first pass instead and writes nothing.
    """
    with job(spark):
        return _ingest(spark, source, path, out, strict, local_only, scrub_fields, telemetry)


def _ingest(
    spark: SparkSession, source: str, path: str, out: str, strict: bool, local_only: bool,
    scrub_fields: Iterable[str], telemetry: str | None,
) -> Written:
    began = time.time()
    bad = None
    sessions = normalize_sessions(scan_vendor(spark, source, path), drop_unknown=False)
    if strict:
        validate(sessions.select(*SLEEP_COLUMNS))
        good = sessions
    else:
        sessions = materialize(sessions, "ingest")
        good, bad = quarantine_split(sessions)
    if local_only:
        good = scrub(good, scrub_fields)
    done = write_curated(good, out)
    if bad is not None and not bad.isEmpty():
        run = done.path.removeprefix(f"{out}/")
        bad.write.mode("overwrite").parquet(f"{out.rstrip('/')}_quarantine/{run}")
    if telemetry:
        write_telemetry(
            spark, telemetry, "ingest", start_time=began, rows_processed=done.rows,
            metadata={"source": source},
        )
    return done


def build_features(
    spark: SparkSession,
    curated: str,
    out: str,
    *,
    hrv: str | None = None,
    steps: str | None = None,
    tags: str | None = None,
    screen: str | None = None,
    scrub_fields: Iterable[str] | None = None,
    telemetry: str | None = None,
    unique: bool = False,
) -> Written:
    """Curated sessions and the given signal files -> feature store.

    ``unique`` raises if a signal has several rows for one user and day, which would repeat sessions.
    """
    began = time.time()
    scans = [(hrv, scan_hrv), (steps, scan_steps), (tags, scan_tags), (screen, scan_screen)]
    signals = [scan(spark, path) for path, scan in scans if path]
    with job(spark):
        store = feature_store(curated_sleep(spark, curated), signals, unique=unique)
        done = write_features(store, out, scrub_fields=scrub_fields)
    if telemetry:
        write_telemetry(
            spark, telemetry, "build-features", start_time=began, rows_processed=done.rows
        )
    return done


def model_folder(path: str, model: str, target: str) -> str:
    return f"{path}/model={model}/target={target}"


def sweep(
    base: DataFrame,
    targets: Mapping[str, Mapping[str, object]] = TARGETS,
    models: Mapping[str, Mapping] = MODELS,
    *,
    keys: Sequence[str] = (),
    horizon: int = HORIZON,
    backtest_window: int = BACKTEST_WINDOW,
    save_to: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Every target with every model: all forecasts, and the daily frames behind them.

    The daily frame of a target is written once and shared by its models. A target
    may name its own ``horizon`` and ``backtest_window``. With ``save_to`` every
    fitted model is saved (`model_folder`), loaded again and scored from there;
    forecasters that were only registered as a function leave nothing to save.
    """
    forecasts, dailies = [], []
    for target, spec in targets.items():
        daily = materialize(
            daily_target(
                base, target, column=spec.get("column"), transform=spec.get("transform"), keys=keys
            ),
            "daily",
        )
        dailies.append(daily.select(*keys, "date", F.lit(target).alias("target"), F.col(target).alias("value")))
        for model, options in models.items():
            if not options.get("enabled", True) or model not in {*FORECASTERS, *fitted_models.MODELS}:
                continue
            options = {k: v for k, v in options.items() if k != "enabled"}
            options = {
                "horizon": int(spec.get("horizon", horizon)),
                "backtest_window": spec.get("backtest_window", backtest_window), **options,
            }
            if model in fitted_models.MODELS:
                fitted = fitted_models.fit(model, daily, target, keys=keys, **options)
                if save_to is not None:
                    path = save_fitted(base.sparkSession, fitted, model_folder(save_to, model, target))
                    fitted = load_fitted(base.sparkSession, path)
                made = fitted_models.score(fitted, daily)
            else:
                made = FORECASTERS[model](daily, target, keys=list(keys), **options)
            forecasts.append(
                made.withColumns({"model": F.lit(model), "target": F.lit(target)}).select(
                    *keys, *FORECAST_COLUMNS
                )
            )
    if not forecasts:
        raise ValueError("the sweep has no enabled model or no target")

    def stacked(frames: list[DataFrame]) -> DataFrame:
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.unionByName(frame)
        return whole

    return stacked(forecasts), stacked(dailies)


def sweep_reports(forecast: DataFrame, daily: DataFrame, *, keys: Sequence[str] = ()) -> DataFrame:
    """Metrics, change points and anomalies per model and target.

    The lists are bounded: change points are days of a daily series, anomalies
    are test days of a backtest. With ``keys`` there is one report per series.
    """
    ids = [*keys, "model", "target"]
    metrics = backtest_metrics(forecast, ids)
    flagged = anomalies_zscore(residuals(forecast), keys=ids)
    odd = flagged.groupBy(*ids).agg(
        F.sort_array(
            F.collect_list(F.struct("date", "residual", "is_anomaly", "method", "threshold"))
        ).alias("anomalies")
    )
    jumps = (
        change_points(daily, "value", keys=[*keys, "target"])
        .groupBy(*keys, "target")
        .agg(F.sort_array(F.collect_list("position")).alias("change_points"))
    )
    return (
        metrics.join(odd, ids, "left")
        .join(jumps, [*keys, "target"], "left")
        .select(
            *keys,
            F.col("model").alias("model_name"),
            "target",
            F.struct("mae", "mape", "coverage").alias("metrics"),
            F.coalesce("change_points", F.array().cast("array<int>")).alias("change_points"),
            "anomalies",
        )
    )


def train(
    spark: SparkSession,
    curated: str,
    out: str,
    *,
    targets: Mapping[str, Mapping[str, object]] = TARGETS,
    models: Mapping[str, Mapping] = MODELS,
    telemetry: str | None = None,
    **options,
) -> Written:
    """Curated sessions -> saved models, forecasts and reports of every model and target."""
    began = time.time()
    with job(spark):
        base = circadian_features(curated_sleep(spark, curated))
        forecast, daily = sweep(base, targets, models, save_to=f"{out}/models", **options)
        forecast = materialize(forecast, "forecast")
        write_forecasts(forecast, f"{out}/forecasts")
        folder = F.concat(F.lit("/model="), F.col("model_name"), F.lit("/target="), F.col("target"))
        saved = F.col("model_name").isin(*fitted_models.MODELS)
        reports = sweep_reports(forecast, daily).withColumns(
            {
                "model_path": F.when(saved, F.concat(F.lit(f"{out}/models"), folder)),
                "forecast_path": F.concat(F.lit(f"{out}/forecasts"), folder),
            }
        )
        done = write_reports(reports, f"{out}/reports")
    if telemetry:
        write_telemetry(spark, telemetry, "train", start_time=began, rows_processed=done.rows)
    return done


def analyze(
    primary: DataFrame,
    out: str,
    *,
    lags: int = 30,
    horizon: int = 14,
    period: int = 7,
    secondary: DataFrame | None = None,
) -> DataFrame:
    """Daily series -> tables of profile, autocorrelation, autoregression and decomposition.

    Returns the one-row run summary.
    """
    value = "sleep_hours"
    write_table(describe_table(primary), f"{out}/tables/primary_summary")
    write_table(describe_numeric(primary, [value]), f"{out}/tables/primary_describe")
    write_table(acf(primary, value, lags), f"{out}/tables/primary_acf")
    regular = materialize(regular_series(primary, value), "regular")
    fit = regress.autoreg_fit(regular, value, lags)
    write_table(fit, f"{out}/tables/primary_autoreg_coefficients")
    write_table(
        regress.autoreg_fitted(regular, value, lags),
        f"{out}/tables/primary_autoreg_fitted_vs_actual",
    )
    forecast = materialize(regress.autoreg_forecast(regular, value, lags, horizon), "ahead")
    write_table(forecast, f"{out}/tables/primary_autoreg_forecast")
    parts = materialize(seasonal_decompose(regular, value, period), "parts")
    write_table(parts, f"{out}/tables/primary_sleep_hours_decomposition")
    if secondary is not None and "hours" in secondary.columns:
        flat = secondary.drop("Duration")
        write_table(describe_table(flat), f"{out}/tables/secondary_summary")
        write_table(describe_numeric(flat, ["hours"]), f"{out}/tables/secondary_describe")
    return run_summary(forecast, parts)
