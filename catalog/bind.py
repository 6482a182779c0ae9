"""The given tables seen as sleep data: the inputs of the registered queries.

`events` plays the session export and the daily signals, `lineitem` a long daily
series, `orders` joined with `lineitem` a second session export.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from nightly.functions.time import to_utc_wall
from nightly.operators.canonical import normalize_sessions
from nightly.operators.circadian import circadian_features
from nightly.operators.series import daily_mean
from nightly.operators.skew import Spread, spread
from nightly.session import scratch_path
from nightly.sources.text import late_screen_rollup


# Moves exact ties at the seventh place off the rounding edge, where engines differ.
TIE = 1e-9


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plain(df: DataFrame, **names: str) -> DataFrame:
    """Output form: instants as UTC wall times, integers as long, doubles to 6 places."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = to_utc_wall(c)
        elif isinstance(f.dataType, T.IntegralType):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double") + F.lit(TIE), 6) + F.lit(0.0)
        cols.append(c.alias(names.get(f.name, f.name)))
    return df.select(*cols)


def zone(user):
    return (
        F.when(user % 3 == 0, "UTC")
        .when(user % 3 == 1, "America/Los_Angeles")
        .otherwise("Europe/London")
    )


def sessions(spark: SparkSession, sf: str, *more) -> DataFrame:
    """Sleep sessions in local wall time; ``more`` names further columns to keep."""
    e = table(spark, sf, "events")
    minutes = F.lit(60.0) + F.lit(5.0) * F.col("value")
    kind = F.col("event_type")
    return e.select(
        F.concat(F.lit("ev_"), F.col("event_id").cast("string")).alias("id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
        F.col("ts").alias("start_ts"),
        (F.col("ts") + F.make_dt_interval(mins=F.floor(minutes).cast("int"))).alias("end_ts"),
        minutes.alias("duration_min"),
        (F.get_json_object("props", "$.k").cast("double") / 100.0).alias("efficiency"),
        (kind == "view").alias("is_nap"),
        zone(F.col("user_id")).alias("tz"),
        F.when(kind == "click", "oura")
        .when(kind == "purchase", "fitbit")
        .otherwise("apple_health")
        .alias("source"),
        *more,
    )


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    """The same sessions as text with faults of every kind a contract rule names."""
    k = F.get_json_object("props", "$.k").cast("int")
    s = sessions(
        spark, sf, F.col("event_type").alias("_kind"), F.col("value").alias("_value"), k.alias("_k")
    )
    return s.select(
        "id",
        F.when(F.col("_k") != 7, F.col("user_id")).alias("user_id"),
        F.col("start_ts").cast("string").alias("start_ts"),
        F.when(F.col("_value") < 5, F.col("start_ts")).otherwise(F.col("end_ts")).cast("string").alias("end_ts"),
        F.when(F.col("_kind") == "error", "n/a").otherwise(F.col("duration_min").cast("string")).alias("duration_min"),
        F.when(F.col("_kind") == "signup", F.col("_k").cast("string"))
        .otherwise(F.col("efficiency").cast("string"))
        .alias("efficiency"),
        F.when(F.col("is_nap"), "yes").when(F.col("_k") == 3, "maybe").otherwise("no").alias("is_nap"),
        F.when(F.col("_k") == 13, "Mars/Base").when(F.col("_k") != 14, F.col("tz")).alias("tz"),
        "source",
    )


def normalized(spark: SparkSession, sf: str) -> DataFrame:
    return normalize_sessions(sessions(spark, sf))


def nights(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions with UTC date and hours."""
    n = normalized(spark, sf)
    return n.withColumns(
        {"date": to_utc_wall(F.col("start_ts")).cast("date"), "sleep_hours": F.col("duration_min") / 60.0}
    )


def user_spread(spark: SparkSession, sf: str) -> Spread:
    """Rows per user, counted on the raw sessions, where it costs one narrow column."""
    return spread(sessions(spark, sf), ["user_id"])


def circadian(spark: SparkSession, sf: str) -> DataFrame:
    return circadian_features(normalized(spark, sf), found=user_spread(spark, sf))


def _user_day(e: DataFrame) -> list:
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    return [user.alias("user_id"), F.to_date("ts").alias("date")]


def hrv(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").where(F.col("event_type") == "purchase")
    return e.groupBy(*_user_day(e)).agg(
        F.avg("value").alias("hrv_rmssd"), F.max("value").alias("hrv_sdnn")
    )


def steps(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").where(F.col("event_type") == "click")
    return e.groupBy(*_user_day(e)).agg(F.sum(F.floor("value")).alias("steps"))


def tags(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    kinds = {"caffeine": "click", "alcohol": "purchase", "late_meal": "view", "work_travel": "error"}
    return e.groupBy(*_user_day(e)).agg(
        *[F.bool_or(F.col("event_type") == k).alias(t) for t, k in kinds.items()]
    )


def screen_events(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select(_user_day(e)[0], F.col("ts").alias("timestamp"))


def screen(spark: SparkSession, sf: str) -> DataFrame:
    return late_screen_rollup(screen_events(spark, sf))


def signals(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [f(spark, sf) for f in (hrv, steps, tags, screen)]


def primary(spark: SparkSession, sf: str) -> DataFrame:
    """One long daily series."""
    l = table(spark, sf, "lineitem")
    rows = l.select(F.to_date("l_shipdate").alias("date"), (F.col("l_quantity") * 0.3).alias("sleep_hours"))
    return daily_mean(rows, "sleep_hours")


def supplier_rows(spark: SparkSession, sf: str) -> DataFrame:
    l = table(spark, sf, "lineitem")
    return l.select(
        F.col("l_suppkey").alias("series"),
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_quantity") * 0.3).alias("sleep_hours"),
        F.col("l_discount").alias("efficiency"),
    )


def supplier_daily(spark: SparkSession, sf: str) -> DataFrame:
    """A daily series per supplier, with many missing days."""
    return daily_mean(supplier_rows(spark, sf), "sleep_hours", keys=["series"])


def user_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Mean hours per user and day."""
    return daily_mean(nights(spark, sf), "sleep_hours", keys=["user_id"])


def secondary_text(spark: SparkSession, sf: str) -> DataFrame:
    """Order and ship day as a session export with day-first text."""
    o, l = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    both = l.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    day = "dd/MM/yyyy HH:mm:ss"
    return both.select(
        F.col("o_orderpriority").alias("sourceName"),
        F.col("l_returnflag").alias("device"),
        F.date_format("o_orderdate", day).alias("creationDate"),
        F.date_format("o_orderdate", day).alias("startDate"),
        F.date_format("l_shipdate", day).alias("endDate"),
    )


def as_csv(df: DataFrame, name: str) -> str:
    """Write a header CSV to the scratch folder; returns its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", True).csv(path)
    return path
