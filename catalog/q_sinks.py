"""What the writers leave behind, read back."""

from __future__ import annotations

import json
import time

from pyspark.sql import functions as F

from catalog import bind
from catalog.bind import plain
from catalog.q_sources import SPLIT_SQL, _sides
from catalog.registry import query
from catalog.tables_sql import r6
from nightly.operators import forecast as fc
from nightly.operators.canonical import VENDOR_SPECS
from nightly.plans.pipelines import sweep
from nightly.schema import SLEEP_COLUMNS
from nightly.session import materialize, scratch_path
from nightly.sinks import writers
from nightly.sources import files
from nightly.streaming.ingest import ingest_stream


@query(f"SELECT user_id, date, {r6('sleep_hours', 'sleep_hours')} FROM udaily")
def sink_table(spark, sf):
    """Daily hours through a CSV table."""
    path = scratch_path(spark, "table")
    writers.write_table(bind.user_daily(spark, sf), path)
    return plain(spark.read.option("header", True).schema("user_id string, date date, sleep_hours double").csv(path))


@query(
    f"""SELECT format, user_id, count(*) AS nights, {r6('sum(sleep_hours)', 'hours')}
        FROM udaily, (SELECT unnest(['csv', 'parquet']) AS format) GROUP BY 1, 2"""
)
def sink_export(spark, sf):
    """The same frame exported in two formats."""
    path = scratch_path(spark, "export")
    done = writers.write_export(bind.user_daily(spark, sf), path, "daily")
    both = None
    for one in done:
        kind = one.path.rsplit(".", 1)[-1]
        rows = spark.read.option("header", True).schema("user_id string, date date, sleep_hours double").format(kind).load(one.path)
        rows = rows.withColumn("format", F.lit(kind))
        both = rows if both is None else both.unionByName(rows)
    return plain(both.groupBy("format", "user_id").agg(F.count("*").alias("nights"), F.sum("sleep_hours").alias("hours")))


@query(
    f"""SELECT model, target, user_id, date, {r6('prediction', 'prediction')}, {r6('lower', 'lower')}, {r6('upper', 'upper')}, {r6('actual', 'actual')}
        FROM (SELECT 'rolling_mean' AS model, 'sleep_hours' AS target, * FROM uroll
              UNION ALL SELECT 'flat', 'sleep_hours', user_id, date, prediction, NULL, NULL, actual FROM uroll)"""
)
def sink_forecasts(spark, sf):
    """Forecast files, one folder per model and target."""
    daily = bind.user_daily(spark, sf)
    made = None
    for name, model in (("rolling_mean", fc.rolling_mean_forecast), ("flat", fc.flat_baseline)):
        one = model(daily, "sleep_hours", keys=["user_id"]).withColumns({"model": F.lit(name), "target": F.lit("sleep_hours")})
        made = one if made is None else made.unionByName(one)
    path = scratch_path(spark, "forecasts")
    writers.write_forecasts(made, path)
    kinds = "user_id string, date date, prediction double, lower double, upper double, actual double, model string, target string"
    return plain(spark.read.option("header", True).schema(kinds).csv(path))


@query(
    """SELECT 'ingest' AS event, count(*) AS rows_processed, 'success' AS status, CAST(NULL AS VARCHAR) AS error,
        '{"source": "' || source || '"}' AS metadata, true AS timed FROM sessions GROUP BY source"""
)
def sink_telemetry(spark, sf):
    """One line per run, with the rows that run wrote."""
    path = scratch_path(spark, "telemetry")
    sessions = bind.sessions(spark, sf)
    for source in ("oura", "fitbit", "apple_health"):
        began = time.time()
        done = writers.write_table(sessions.where(F.col("source") == source), scratch_path(spark, "run"))
        writers.write_telemetry(spark, path, "ingest", start_time=began, rows_processed=done.rows, metadata={"source": source})
    lines = spark.read.schema(
        "timestamp timestamp, event string, duration_ms long, rows_processed long, status string, error string, metadata string"
    ).json(f"{path}/telemetry")
    timed = F.col("timestamp").isNotNull() & (F.col("duration_ms") >= 0)
    return lines.select("event", "rows_processed", "status", "error", "metadata", timed.alias("timed"))


def _schema_text() -> str:
    """The session schema as it is fingerprinted: JSON with sorted keys."""
    kinds = ["string", "string", "timestamp", "timestamp", "double", "double", "boolean", "string", "string"]
    fields = [{"metadata": {}, "name": n, "nullable": False, "type": t} for n, t in zip(SLEEP_COLUMNS, kinds)]
    return json.dumps({"fields": fields, "type": "struct"}, sort_keys=True)


@query(f"""SELECT count(*) AS rows, sha256('{_schema_text()}') AS schema_hash FROM sessions""")
def schema_fingerprint(spark, sf):
    """The fingerprint in the version pointer of a curated run, and the rows of the run it points to."""
    out = f"{scratch_path(spark, 'curated')}/sleep"
    done = writers.write_curated(bind.sessions(spark, sf), out)
    doc = json.loads(spark.read.text(done.pointer, wholetext=True).first()["value"])
    run = spark.read.parquet(f"{out}/{doc['last_partition']}")
    return run.agg(F.count("*").alias("rows")).withColumn("schema_hash", F.lit(doc["schema_hash"]))


def _last_value(df, target, *, keys, date="date", horizon=fc.HORIZON, backtest_window=fc.BACKTEST_WINDOW):
    """Repeat the last training value."""
    rows = fc.backtest_split(fc.values_of(df, target, keys, date), keys=keys, date=date, horizon=horizon, backtest_window=backtest_window)
    last = F.max(F.when(F.col("rn") == F.col("n_train"), F.col("_y"))).over(fc.over_keys(keys))
    none = F.lit(None).cast("double")
    return rows.withColumn("prediction", last).where("is_test").select(
        *keys, date, "prediction", none.alias("lower"), none.alias("upper"), F.col("_y").alias("actual")
    )


@query(
    f"""SELECT 'last_value' AS model, t.user_id, t.date, {r6('l.sleep_hours', 'prediction')}, {r6('t.sleep_hours', 'actual')}
        FROM usplit t LEFT JOIN (SELECT * FROM usplit WHERE rn = n_train) l ON l.user_id = t.user_id WHERE t.is_test"""
)
def registered_forecaster(spark, sf):
    """A forecaster of one's own in the sweep."""
    fc.register_forecaster("last_value", _last_value)
    try:
        made, _ = sweep(bind.nights(spark, sf), {"sleep_hours": {}}, {"last_value": {}}, keys=["user_id"])
    finally:
        fc.FORECASTERS.pop("last_value")
    return plain(made.select("model", "user_id", "date", "prediction", "actual"))


@query(SPLIT_SQL)
def stream_ingest(spark, sf):
    """The vendor export as a stream of two deliveries, the second with all of the first again: every row is curated once."""
    dirty = bind.dirty(spark, sf).select(*[F.col(c).alias(v) for v, c in VENDOR_SPECS["oura"].items()])
    dirty = materialize(dirty, "deliveries")
    first = F.crc32(F.col(next(iter(VENDOR_SPECS["oura"]))).cast("binary")) % 2 == 0
    inbox, out, state = (scratch_path(spark, n) for n in ("inbox", "streamed", "stream-state"))
    for number, rows in enumerate((dirty.where(first), dirty)):
        rows.write.option("header", True).csv(f"{inbox}/delivery={number}")
        ingest_stream(spark, "oura", f"{inbox}/*", out, state).awaitTermination()
    return _sides(files.scan_curated(spark, out), files.scan_curated(spark, f"{out}_quarantine"))


