"""Canonical sleep sessions: column mapping, normalisation, contract checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from nightly.functions.frame import (
    as_double,
    attach_stats,
    keep_known,
    keep_where,
    parse_double,
    require_columns,
)
from nightly.functions.time import is_weekend, known_zone, normalize_instants, to_utc_wall
from nightly.schema import SLEEP_COLUMNS

# Bounds of a plausible session in minutes, outlier limit.
DURATION_BOUNDS = (120.0, 720.0)
OUTLIER_Z = 3.0

# Vendor column -> canonical column.
VENDOR_SPECS: dict[str, dict[str, str]] = {
    "oura": {
        "sleep_id": "id",
        "user_id": "user_id",
        "bedtime_start": "start_ts",
        "bedtime_end": "end_ts",
        "duration_min": "duration_min",
        "efficiency": "efficiency",
        "is_long_nap": "is_nap",
        "timezone": "tz",
    },
    "fitbit": {
        "log_id": "id",
        "user_id": "user_id",
        "start_time": "start_ts",
        "end_time": "end_ts",
        "minutes_asleep": "duration_min",
        "efficiency": "efficiency",
        "is_nap": "is_nap",
        "timezone": "tz",
    },
    "apple_health": {
        "uuid": "id",
        "user_id": "user_id",
        "start_date": "start_ts",
        "end_date": "end_ts",
        "duration_min": "duration_min",
        "efficiency": "efficiency",
        "nap": "is_nap",
        "timezone": "tz",
    },
}


def register_vendor(source: str, columns: Mapping[str, str]) -> None:
    """Add a vendor; the mapping must cover every canonical column but source."""
    missing = sorted(set(SLEEP_COLUMNS) - {"source"} - set(columns.values()))
    if missing:
        raise ValueError(f"vendor {source}: no column maps to {missing}")
    VENDOR_SPECS[source] = dict(columns)


def _typed(df: DataFrame, name: str) -> Column:
    """Canonical type of one mapped column; unreadable values become NULL."""
    dtype = df.schema[name].dataType
    text = isinstance(dtype, T.StringType)
    if name in ("duration_min", "efficiency"):
        return parse_double(F.col(name)) if text else as_double(df, name)
    if name == "is_nap":
        flag = F.trim(F.col(name)).try_cast("boolean") if text else F.col(name).cast("boolean")
        return F.coalesce(flag, F.lit(False))
    if name == "tz":
        return F.coalesce(F.col(name), F.lit("UTC"))
    if name in ("start_ts", "end_ts"):
        return F.col(name)
    return F.col(name).cast("string")


def canonicalize(df: DataFrame, source: str) -> DataFrame:
    """Vendor frame -> nine canonical columns.

    Timestamps stay as they are (text, wall time or instant); `normalize_timestamps`
    resolves them together with the zone column.
    """
    spec = VENDOR_SPECS[source]
    require_columns(df, spec, source)
    named = df.select(*[F.col(a).alias(b) for a, b in spec.items()])
    return finalize(named, source)


def finalize(df: DataFrame, source: str | None = None) -> DataFrame:
    """Canonical names -> canonical types and order, with defaults filled in."""
    require_columns(df, set(SLEEP_COLUMNS) - {"source"}, source or "sessions")
    origin = F.lit(source) if source else F.col("source").cast("string")
    body = [_typed(df, c).alias(c) for c in SLEEP_COLUMNS if c != "source"]
    return df.select(*body, origin.alias("source"))


def normalize_timestamps(
    df: DataFrame, columns: Sequence[str] = ("start_ts", "end_ts"), tz: str = "tz"
) -> DataFrame:
    """Resolve timestamp columns to instants, reading wall times in the row's zone."""
    return normalize_instants(df, columns, tz)


def clip_duration(
    df: DataFrame, bounds: tuple[float, float] = DURATION_BOUNDS, column: str = "duration_min"
) -> DataFrame:
    """Clamp the duration and flag the rows this changed."""
    low, high = (F.lit(float(b)) for b in bounds)
    clipped = F.when(F.col(column).isNotNull(), F.least(F.greatest(F.col(column), low), high))
    return df.withColumns(
        {column: clipped, "duration_was_clipped": ~clipped.eqNullSafe(F.col(column))}
    )


def weekend_flag(df: DataFrame, column: str = "start_ts") -> DataFrame:
    """Weekend by the UTC day of the instant."""
    return df.withColumn("is_weekend", is_weekend(to_utc_wall(F.col(column))))


def zscore_duration(
    df: DataFrame, keys: Sequence[str] = (), column: str = "duration_min"
) -> DataFrame:
    """Population z-score of the duration and the outlier flag.

    The statistics are those of the whole frame unless ``keys`` is given; z is 0
    where the deviation is 0.
    """
    stats = df.groupBy(*keys).agg(
        F.avg(column).alias("_mean"), F.stddev_pop(column).alias("_std")
    )
    z = F.when(F.col("_std") > 0, (F.col(column) - F.col("_mean")) / F.col("_std")).otherwise(0.0)
    scored = attach_stats(df, stats, keys).withColumn("duration_zscore", z)
    flag = F.coalesce(F.abs("duration_zscore") >= OUTLIER_Z, F.lit(False))
    return scored.withColumn("is_outlier_duration", flag).drop("_mean", "_std")


def normalize_sessions(
    df: DataFrame,
    bounds: tuple[float, float] = DURATION_BOUNDS,
    zscore_keys: Sequence[str] = (),
    drop_unknown: bool = True,
) -> DataFrame:
    """Canonical sessions -> normalised sessions.

    As statistics cover all rows, rows without a usable timestamp are dropped last.
    ``drop_unknown=False`` keeps them, with NULL times, for the contract check.
    """
    named = df.withColumns(
        {
            "tz": F.coalesce(F.col("tz"), F.lit("UTC")),
            "is_nap": F.coalesce(F.col("is_nap"), F.lit(False)),
        }
    )
    resolved = weekend_flag(normalize_timestamps(clip_duration(named, bounds)))
    scored = zscore_duration(resolved, zscore_keys)
    return keep_known(scored, ["start_ts", "end_ts"]) if drop_unknown else scored


def contract_rules(df: DataFrame) -> dict[str, Column]:
    """Rule name -> condition under which a row breaks it."""
    require_columns(df, SLEEP_COLUMNS, "contract")
    col = F.col
    rules = {f"{c}_null": col(c).isNull() for c in SLEEP_COLUMNS}
    duration, efficiency = col("duration_min"), col("efficiency")
    rules["duration_not_positive"] = ~(duration > 0) | F.isnan(duration)
    rules["efficiency_out_of_range"] = ~efficiency.between(0.0, 1.0)
    rules["end_not_after_start"] = ~(col("end_ts") > col("start_ts"))
    rules["tz_unknown"] = known_zone("tz").isNull()
    return rules


def _broken(df: DataFrame) -> Column:
    checks = [F.when(cond, F.lit(name)) for name, cond in contract_rules(df).items()]
    return F.array_compact(F.array(*checks))


def contract_violations(df: DataFrame) -> DataFrame:
    """One row ``(id, rule)`` per broken rule."""
    return df.select("id", F.explode(_broken(df)).alias("rule"))


def with_violations(df: DataFrame) -> DataFrame:
    """All rows with the array of broken rules in ``violations``."""
    return df.withColumn("violations", _broken(df))


def quarantine_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and broken rows with the rules they break."""
    checked = with_violations(df)
    bad = F.size("violations") > 0
    good = keep_where(checked, ~bad, ["violations"]).drop("violations")
    return good, keep_where(checked, bad, ["violations"])


def validate(df: DataFrame) -> int:
    """Raise if any row breaks the contract, else return the row count. One job."""
    rules = contract_rules(df)
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in rules.items()]
    ).first()
    broken = {n: counts[n] for n in rules if counts[n]}
    if broken:
        raise ValueError(f"records break the sleep contract: {broken}")
    return counts["rows"]


def drop_repeats(
    df: DataFrame, keys: Sequence[str] = ("id",), latest: str | Column | None = None
) -> DataFrame:
    """One row per key: the one with the greatest ``latest``, as a two-phase aggregate.

    For nights that several ingest runs wrote again.
    """
    if latest is None:
        return df.dropDuplicates(list(keys))
    row = F.struct(*df.columns)
    kept = df.groupBy(*keys).agg(F.max_by(row, latest).alias("_row"))
    return kept.select("_row.*")
