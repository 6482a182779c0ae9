"""Sources, cleaning and contracts."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog import bind
from catalog.bind import as_csv, plain
from catalog.registry import query
from catalog.tables_sql import r6
from nightly.operators import canonical, forecast as fc, privacy
from nightly.operators.canonical import VENDOR_SPECS, finalize
from nightly.plans.pipelines import ingest
from nightly.session import scratch_path
from nightly.sinks import writers
from nightly.sources import files, text

CANON_SQL = f"""SELECT id, user_id, start_ts, end_ts, {r6('duration_min', 'duration_min')},
    {r6('efficiency', 'efficiency')}, is_nap, tz, %s AS source FROM utc"""


def _vendor_csv(spark: SparkSession, sf: str, source: str) -> str:
    """All sessions in the vendor's columns; times are wall times or carry their offset."""
    s = bind.sessions(spark, sf)
    wall = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    shown = {c: F.date_format(c, wall) for c in ("start_ts", "end_ts")}
    # January offsets of the three zones.
    offset = F.when(F.col("tz") == "America/Los_Angeles", "-08:00").when(F.col("tz") == "UTC", "Z").otherwise("+00:00")
    aware = F.lit(source == "oura") | (F.lit(source == "apple_health") & F.col("is_nap"))
    stamped = s.withColumns(
        {c: F.concat(v, F.when(aware, offset).otherwise("")) for c, v in shown.items()}
    )
    return as_csv(stamped.select(*[F.col(c).alias(v) for v, c in VENDOR_SPECS[source].items()]), source)


def _scan(spark: SparkSession, sf: str, source: str) -> DataFrame:
    return canonical.normalize_timestamps(text.scan_vendor(spark, source, _vendor_csv(spark, sf, source)))


@query(CANON_SQL % "'oura'")
def src_vendor_oura(spark, sf):
    return plain(_scan(spark, sf, "oura"))


@query(CANON_SQL % "'fitbit'")
def src_vendor_fitbit(spark, sf):
    return plain(_scan(spark, sf, "fitbit"))


@query(CANON_SQL % "'apple_health'", name="src_vendor_apple")
def src_vendor_apple(spark, sf):
    return plain(_scan(spark, sf, "apple_health"))


@query(
    f"""SELECT * FROM (SELECT id, user_id, start_ts, {r6('duration_min', 'duration_min')}, 'oura' AS source,
        CAST(NULL AS DOUBLE) AS efficiency FROM utc
      UNION ALL SELECT id, user_id, start_ts, {r6('duration_min', 'duration_min')}, 'fitbit',
        {r6('efficiency', 'efficiency')} FROM utc)"""
)
def union_vendors(spark, sf):
    """Two exports with different columns stacked by name."""
    one = _scan(spark, sf, "oura").select("id", "user_id", "start_ts", "duration_min", "source")
    two = _scan(spark, sf, "fitbit").select("source", "id", "start_ts", "user_id", "duration_min", "efficiency")
    return plain(one.unionByName(two, allowMissingColumns=True))


@query(
    f"""SELECT CAST(l_shipdate AS DATE) AS date, {r6('l_quantity * 0.3', 'sleep_hours')}
        FROM lineitem WHERE l_returnflag <> 'A'"""
)
def src_primary_daily(spark, sf):
    """Rows whose hours cannot be read are dropped."""
    l = bind.table(spark, sf, "lineitem")
    hours = F.when(F.col("l_returnflag") == "A", "n/a").otherwise((F.col("l_quantity") * 0.3).cast("string"))
    raw = l.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"), hours.alias("sleep_hours"))
    return plain(text.scan_primary(spark, as_csv(raw, "primary")))


@query(
    f"""SELECT o_orderpriority AS "sourceName", l_returnflag AS device, date_trunc('second', o_orderdate) AS "startDate",
        date_trunc('second', l_shipdate) AS "endDate",
        {r6("(epoch(date_trunc('second', l_shipdate)) - epoch(date_trunc('second', o_orderdate))) / 3600.0", 'hours')}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
)
def src_secondary_sessions(spark, sf):
    path = as_csv(bind.secondary_text(spark, sf), "secondary")
    return plain(text.scan_secondary(spark, path).drop("creationDate", "Duration"))


@query(
    f"""SELECT user_id, date, {r6('hrv_rmssd', 'hrv_rmssd')}, {r6('hrv_sdnn', 'hrv_sdnn')},
        CAST(NULL AS DOUBLE) AS hrv_baseline_rmssd FROM hrv"""
)
def src_signal_hrv(spark, sf):
    raw = bind.hrv(spark, sf).withColumnsRenamed({"hrv_rmssd": "rmssd", "hrv_sdnn": "sdnn"})
    return plain(text.scan_hrv(spark, as_csv(raw, "hrv")))


@query("SELECT user_id, date, steps, CAST(NULL AS DOUBLE) AS active_minutes FROM steps")
def src_signal_steps(spark, sf):
    raw = bind.steps(spark, sf).withColumn("steps", F.col("steps").cast("string"))
    return plain(text.scan_steps(spark, as_csv(raw, "steps")))


@query("SELECT user_id, date, caffeine, alcohol, false AS late_meal, work_travel FROM tags")
def src_signal_tags(spark, sf):
    """One tag column is missing in the file."""
    return plain(text.scan_tags(spark, as_csv(bind.tags(spark, sf).drop("late_meal"), "tags")))


@query("SELECT user_id, date, late_minutes, CAST(0 AS BIGINT) AS total_events, late_screen_flag, late_events FROM screen")
def src_screen_preagg(spark, sf):
    """Pre-aggregated screen time without the total."""
    raw = bind.screen(spark, sf).select("user_id", "date", "late_minutes")
    return plain(text.scan_screen(spark, as_csv(raw, "screen")))


@query("SELECT * FROM screen")
def agg_screen_time(spark, sf):
    return plain(bind.screen(spark, sf))


@query(
    f"""SELECT id, user_id, start_ts, {r6('duration_min', 'duration_min')}, is_weekend, source,
        CASE WHEN source <> 'apple_health' THEN round(duration_zscore + 1e-9, 6) + 0.0 END AS duration_zscore FROM norm"""
)
def src_curated_scan(spark, sf):
    """Two runs, the second with fewer columns, read back by name."""
    n = bind.normalized(spark, sf)
    path = scratch_path(spark, "curated") + "/sleep"
    late = F.col("source") == "apple_health"
    writers.write_curated(n.where(~late), path, now=datetime(2024, 2, 1, tzinfo=timezone.utc))
    writers.write_curated(
        n.where(late).drop("duration_zscore"), path, now=datetime(2024, 2, 2, tzinfo=timezone.utc)
    )
    back = files.scan_curated(spark, path)
    return plain(
        back.select("id", "user_id", "start_ts", "duration_min", "is_weekend", "source", "duration_zscore")
    )


@query(
    f"""SELECT model || '_' || target || '.json' AS report, model, target, round(mae + 1e-9, 6) + 0.0 AS mae, round(mape + 1e-9, 6) + 0.0 AS mape,
        round(coverage + 1e-9, 6) + 0.0 AS coverage FROM (
          SELECT 'rolling_mean' AS model, 'sleep_hours' AS target, avg(abs(actual - prediction)) AS mae,
                 avg(abs(actual - prediction) / nullif(abs(actual), 0)) AS mape,
                 avg(CASE WHEN actual BETWEEN lower AND upper THEN 1.0 ELSE 0.0 END) AS coverage FROM uroll
          UNION ALL
          SELECT 'flat', 'sleep_hours', avg(abs(actual - prediction)),
                 avg(abs(actual - prediction) / nullif(abs(actual), 0)), CAST(NULL AS DOUBLE) FROM uroll)"""
)
def src_model_reports(spark, sf):
    """Reports of two models written and read back; the summary file is skipped."""
    from nightly.plans.pipelines import sweep

    made, _ = sweep(
        bind.nights(spark, sf),
        {"sleep_hours": {}},
        {"rolling_mean": {}, "flat": {}},
        keys=["user_id"],
    )
    metrics = fc.backtest_metrics(made).select(
        F.col("model").alias("model_name"), "target", F.struct("mae", "mape", "coverage").alias("metrics")
    )
    path = scratch_path(spark, "reports")
    writers.write_reports(metrics, path)
    back = files.scan_reports(spark, path)
    name = F.concat("model", F.lit("_"), "target", F.lit(".json"))
    return plain(back.select(name.alias("report"), "model", "target", "mae", "mape", "coverage"))


@query("SELECT user_id, date, steps FROM steps")
def src_latest_run(spark, sf):
    """Of two feature files the later one is read."""
    path = scratch_path(spark, "features")
    writers.write_features(bind.hrv(spark, sf), path, now=datetime(2024, 2, 1, tzinfo=timezone.utc))
    writers.write_features(bind.steps(spark, sf), path, now=datetime(2024, 2, 2, tzinfo=timezone.utc))
    return plain(files.scan_run(spark, path))


DIRTY_SQL = """
    SELECT 'ev_' || event_id AS id, CASE WHEN k <> 7 THEN 'u' || user_id END AS user_id,
           CASE WHEN event_type <> 'error' THEN 60 + 5 * value END AS duration_min,
           CASE WHEN event_type = 'signup' THEN CAST(k AS DOUBLE) ELSE k / 100.0 END AS efficiency,
           event_type = 'view' AS is_nap,
           CASE WHEN k = 13 THEN 'Mars/Base' WHEN k = 14 THEN 'UTC' ELSE zone END AS tz,
           CASE WHEN k = 13 THEN NULL WHEN k = 14 THEN ts ELSE timezone('UTC', timezone(zone, ts)) END AS start_ts,
           value < 5 AS no_length, source
    FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k,
                 CASE user_id % 3 WHEN 0 THEN 'UTC' WHEN 1 THEN 'America/Los_Angeles' ELSE 'Europe/London' END AS zone,
                 CASE event_type WHEN 'click' THEN 'oura' WHEN 'purchase' THEN 'fitbit' ELSE 'apple_health' END AS source
          FROM events)"""
RULES_SQL = f"""SELECT id, rule FROM (SELECT id, unnest([
        CASE WHEN user_id IS NULL THEN 'user_id_null' END,
        CASE WHEN start_ts IS NULL THEN 'start_ts_null' END,
        CASE WHEN start_ts IS NULL THEN 'end_ts_null' END,
        CASE WHEN duration_min IS NULL THEN 'duration_min_null' END,
        CASE WHEN NOT efficiency BETWEEN 0 AND 1 THEN 'efficiency_out_of_range' END,
        CASE WHEN start_ts IS NOT NULL AND no_length THEN 'end_not_after_start' END,
        CASE WHEN tz = 'Mars/Base' THEN 'tz_unknown' END]) AS rule
    FROM ({DIRTY_SQL})) WHERE rule IS NOT NULL"""


def _dirty(spark, sf):
    return canonical.normalize_timestamps(finalize(bind.dirty(spark, sf)))


@query(
    f"""SELECT id, user_id, {r6('duration_min', 'duration_min')}, {r6('efficiency', 'efficiency')}, is_nap, tz, source
        FROM ({DIRTY_SQL})"""
)
def canonicalize(spark, sf):
    """Unreadable values become NULL, defaults are filled in."""
    return plain(finalize(bind.dirty(spark, sf)).drop("start_ts", "end_ts"))


@query(RULES_SQL)
def contract_violations(spark, sf):
    return canonical.contract_violations(_dirty(spark, sf))


SPLIT_SQL = f"""SELECT d.id, r.rules IS NOT NULL AS quarantined, coalesce(r.rules, '') AS rules FROM ({DIRTY_SQL}) d
        LEFT JOIN (SELECT id, string_agg(rule, ',' ORDER BY rule) AS rules FROM ({RULES_SQL}) GROUP BY 1) r ON r.id = d.id"""


def _sides(good: DataFrame, bad: DataFrame) -> DataFrame:
    listed = F.array_join(F.array_sort("violations"), ",")
    return good.select("id", F.lit(False).alias("quarantined"), F.lit("").alias("rules")).unionByName(
        bad.select("id", F.lit(True).alias("quarantined"), listed.alias("rules"))
    )


@query(SPLIT_SQL)
def quarantine_split(spark, sf):
    return _sides(*canonical.quarantine_split(_dirty(spark, sf)))


@query(SPLIT_SQL)
def ingest_roundtrip(spark, sf):
    """A vendor export with faults of every kind through the ingest job: no row is lost."""
    dirty = bind.dirty(spark, sf).select(*[F.col(c).alias(v) for v, c in VENDOR_SPECS["oura"].items()])
    out = scratch_path(spark, "ingested")
    ingest(spark, "oura", as_csv(dirty, "dirty"), out)
    return _sides(files.scan_curated(spark, out), files.scan_curated(spark, f"{out}_quarantine"))


@query(f"SELECT id, {r6('duration_min', 'duration_min')}, duration_was_clipped FROM clipped")
def clip_duration(spark, sf):
    return plain(canonical.clip_duration(bind.sessions(spark, sf)).select("id", "duration_min", "duration_was_clipped"))


@query("SELECT id, tz, start_ts, end_ts FROM utc")
def normalize_timestamps(spark, sf):
    return plain(canonical.normalize_timestamps(bind.sessions(spark, sf)).select("id", "tz", "start_ts", "end_ts"))


@query("SELECT id, is_weekend FROM clipped")
def weekend_flag(spark, sf):
    utc = canonical.normalize_timestamps(bind.sessions(spark, sf))
    return canonical.weekend_flag(utc).select("id", "is_weekend")


@query(f"SELECT id, {r6('duration_zscore', 'duration_zscore')}, is_outlier_duration FROM norm")
def zscore_duration(spark, sf):
    clipped = canonical.clip_duration(bind.sessions(spark, sf))
    return plain(canonical.zscore_duration(clipped).select("id", "duration_zscore", "is_outlier_duration"))


@query(
    f"""SELECT id, user_id, start_ts, end_ts, {r6('duration_min', 'duration_min')}, {r6('efficiency', 'efficiency')},
        is_nap, tz, source, duration_was_clipped, is_weekend, {r6('duration_zscore', 'duration_zscore')},
        is_outlier_duration FROM norm"""
)
def normalize_sessions(spark, sf):
    return plain(bind.normalized(spark, sf))


@query(
    f"""SELECT left(sha256('unit-test-salt:' || id), 16) AS id, user_id, source, {r6('duration_min', 'duration_min')},
        left(sha256('unit-test-salt:' || source), 16) AS "sourceName" FROM norm"""
)
def scrub_pii(spark, sf):
    """Text that looks personal is hashed, a numeric column of such a name is dropped."""
    n = bind.circadian(spark, sf).select(
        "id", "user_id", "source", "duration_min", F.col("source").alias("sourceName"), "midpoint_hour_local"
    )
    return plain(privacy.scrub(n, ["name", "email"], salt="unit-test-salt"))
