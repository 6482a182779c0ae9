"""Helpers over column names and types. Only keyed `attach_stats` runs a job: it writes its statistics."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window as W
from pyspark.sql.window import WindowSpec

from nightly.session import materialize

ID_COLUMNS = ("date", "user_id", "start_ts", "end_ts", "source")


def require_columns(df: DataFrame, required: Iterable[str], source: str) -> None:
    """Fail at plan time, naming the missing columns in sorted order."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{source}: missing required columns {missing}")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of numeric and boolean columns."""
    skip = set(exclude)
    return [
        f.name
        for f in df.schema.fields
        if f.name not in skip and isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]


def as_double(df: DataFrame, name: str) -> Column:
    """Column as double with NaN turned into NULL."""
    col = F.col(name).cast("double")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(col), col)
    return col


def parse_double(text: Column) -> Column:
    """Text -> double; unreadable text and NaN give NULL."""
    value = F.trim(text).try_cast("double")
    return F.when(~F.isnan(value), value)


def column_or(df: DataFrame, name: str, default: object) -> Column:
    """The column, or a literal where the frame has no such column."""
    return F.col(name) if name in df.columns else F.lit(default)


def over_keys(keys: Sequence[str]) -> WindowSpec:
    """Window over one series. Only for frames whose groups are one row per day
    (or smaller), so that the number of days bounds every group."""
    return W.partitionBy(*[F.col(k) for k in keys]) if keys else W.partitionBy(F.lit(0))


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL as a key like any other; the keys of ``left`` stay."""
    names = {k: f"_right_{i}" for i, k in enumerate(keys)}
    other = right.withColumnsRenamed(names)
    found = F.lit(True)
    for k, name in names.items():
        found = found & left[k].eqNullSafe(other[name])
    return left.join(other, found, how).drop(*names.values())


def attach_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add aggregate columns to every row.

    Without keys the one stats row becomes a scalar subquery. With keys the stats
    table is written once, so that Catalyst knows its true size: below
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast and the rows are not
    shuffled at all, above it the join shuffles and AQE splits large keys.
    """
    if keys:
        return join_keys(df, materialize(stats, "stats"), keys, "left").select(
            *keys, *[c for c in [*df.columns, *stats.columns] if c not in keys]
        )
    row = stats.select(F.struct(*stats.columns).alias("s")).scalar()
    named = df.withColumn("_stats", row)
    return named.select(*df.columns, *[F.col(f"_stats.{c}").alias(c) for c in stats.columns])


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL where den is 0 or NULL."""
    return num / F.nullif(den, F.lit(0.0))


def keep_where(df: DataFrame, condition: Column, costly: Sequence[str]) -> DataFrame:
    """Keep the rows where ``condition`` holds, computing the ``costly`` columns once.

    Catalyst would move a filter below the projection that makes the columns it
    tests, and evaluate them twice per row. Here the rows are dropped by a
    generator instead: it makes one row where the condition holds, else none.
    """
    row = F.when(condition, F.array(F.struct(*costly)))
    rest = [c for c in df.columns if c not in costly]
    return df.select(*rest, F.inline(row)).select(*df.columns)


def keep_known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a NULL in the costly ``columns``."""
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return keep_where(df, known, columns)
