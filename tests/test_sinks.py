from __future__ import annotations

import json
import os
import time
from datetime import date

import pytest
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from nightly.operators import boosting
from nightly.plans import pipelines
from nightly.schema import schema_hash
from nightly.sinks import writers
from nightly.sources import files, text
from nightly.session import job, materialize, materialize_alone, scratch_root
from nightly.streaming.ingest import ingest_stream
from tests.helpers import daily, frame, record, sinusoid, utc

OURA = "sleep_id,user_id,bedtime_start,bedtime_end,duration_min,efficiency,is_long_nap,timezone\n"


def _oura(path, lines):
    with open(path, "w") as out:
        out.write(OURA + "".join(f"{line}\n" for line in lines))


def _night(i, efficiency="0.9", user="u1"):
    return f"n{i},{user},2024-01-{i:02d}T22:30:00,2024-01-{i + 1:02d}T06:30:00,{440 + i},{efficiency},false,America/Los_Angeles"


def test_curated_runs_and_pointer(spark, folder):
    out = f"{folder}/sleep"
    df = frame(spark, [record(), record(id="b")])
    first = writers.write_curated(df, out, now=utc(2024, 1, 1, 8))
    second = writers.write_curated(df.withColumn("more", F.lit(1)).limit(1), out, now=utc(2024, 1, 2, 8))
    assert (first.rows, second.rows) == (2, 1)
    doc = json.load(open(f"{folder}/VERSION.json"))
    assert doc["schema_hash"] == schema_hash() and f"{out}/{doc['last_partition']}" == second.path
    with pytest.raises(Exception):
        writers.write_curated(df, out, now=utc(2024, 1, 2, 8))
    back = files.scan_curated(spark, out)
    assert back.count() == 3 and "more" in back.columns
    pruned = files.scan_curated(spark, out, run_date="2024-01-02")
    assert pruned.count() == 1
    assert "PartitionFilters: [isnotnull(run_date" in pruned._jdf.queryExecution().executedPlan().toString()
    kept = files.scan_curated(spark, out, dedupe=True)
    assert sorted(r.id for r in kept.collect()) == ["a", "b"]
    # A later day wins over a later time of day.
    writers.write_curated(df.withColumn("source", F.lit("again")), out, now=utc(2024, 1, 3, 2))
    latest = files.scan_curated(spark, out, dedupe=True)
    assert {r.source for r in latest.collect()} == {"again"}
    assert files.list_runs(spark, out) == [f"run_date=2024-01-0{d}" for d in (1, 2, 3)]


def test_pointer_does_not_move_when_the_write_fails(spark, folder):
    df = frame(spark, [record()])
    writers.write_curated(df, f"{folder}/sleep", now=utc(2024, 1, 1))
    before = open(f"{folder}/VERSION.json").read()
    broken = df.withColumn("x", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception):
        writers.write_curated(broken, f"{folder}/sleep", now=utc(2024, 1, 3))
    assert open(f"{folder}/VERSION.json").read() == before


def test_features_document_and_newest_run(spark, folder):
    df = daily(spark, [1, 2]).withColumn("name", F.lit("Ann"))
    writers.write_features(df.limit(1), folder, now=utc(2024, 1, 1))
    done = writers.write_features(df, folder, scrub_fields=["name"], now=utc(2024, 1, 2))
    doc = json.load(open(f"{folder}/SCHEMA.json"))
    assert doc["rows"] == done.rows == 2 and doc["parquet_path"] == done.path and "name" in doc["columns"]
    newest = files.scan_run(spark, folder)
    assert newest.count() == 2 and {r.name for r in newest.collect()} != {"Ann"}
    assert files.scan_run(spark, folder, files.list_runs(spark, folder)[0]).count() == 1
    with pytest.raises(ValueError):
        files.scan_run(spark, folder, "absent")


def test_exports(spark, folder):
    df = spark.createDataFrame([(7.5, 0.82), (6.8, 0.88)], "sleep_hours double, efficiency double")
    done = writers.write_export(df, folder, "metrics", ["csv", "parquet"], now=utc(2024, 1, 2, 3, 4, 5))
    assert {os.path.basename(w.path) for w in done} == {"metrics_20240102_030405.csv", "metrics_20240102_030405.parquet"}
    for w in done:
        back = spark.read.option("header", True).format(w.path.rsplit(".")[-1]).load(w.path)
        assert back.count() == w.rows == 2 and back.columns == df.columns
    with pytest.raises(ValueError):
        writers.write_export(df, folder, "x", ["xlsx"])


def test_telemetry_appends_lines(spark, folder):
    for n in (1, 2):
        writers.write_telemetry(spark, folder, "ingest", start_time=time.time() - 1, rows_processed=n, metadata={"n": n})
    rows = spark.read.json(f"{folder}/telemetry").orderBy("rows_processed").collect()
    assert [r.rows_processed for r in rows] == [1, 2] and rows[0].duration_ms >= 1000 and rows[0].status == "success"


def test_reports_round_trip(spark, folder):
    rows = [("m", "t", (0.5, 0.1, None)), ("n", "t", (1.5, 0.2, 0.9))]
    df = spark.createDataFrame(rows, "model_name string, target string, metrics struct<mae:double,mape:double,coverage:double>")
    done = writers.write_reports(df, folder)
    assert done.rows == 2 and len(json.load(open(done.pointer))["artifacts"]) == 2
    with open(f"{folder}/other.json", "w") as out:
        out.write(json.dumps({"model": "old", "target": "t", "metrics": {"mae": 2}}, indent=2))
    back = {r.model: (r.mae, r.coverage) for r in files.scan_reports(spark, folder).collect()}
    assert back == {"m": (0.5, None), "n": (1.5, 0.9), "old": (2.0, None)}


def test_models_and_coefficients_are_saved(spark, folder):
    df = daily(spark, range(30)).withColumn("x", F.dayofmonth("date"))
    model, _ = boosting.gbt_fit(df, "v", n_estimators=2)
    writers.save_model(model, f"{folder}/gbt")
    assert GBTRegressionModel.load(f"{folder}/gbt").getNumTrees == 2
    assert writers.save_coefficients(df, f"{folder}/beta").rows == 30


def test_ingest_splits_and_strict_raises(spark, folder):
    _oura(f"{folder}/in.csv", [_night(1), _night(2), _night(3, "1.4"), _night(4)])
    done = pipelines.ingest(spark, "oura", f"{folder}/in.csv", f"{folder}/cur/sleep", telemetry=f"{folder}/log")
    assert done.rows == 3
    bad = spark.read.parquet(f"{folder}/cur/sleep_quarantine").collect()
    assert [(r.id, r.violations) for r in bad] == [("n3", ["efficiency_out_of_range"])]
    assert spark.read.json(f"{folder}/log/telemetry").first().rows_processed == 3
    with pytest.raises(ValueError, match="efficiency"):
        pipelines.ingest(spark, "oura", f"{folder}/in.csv", f"{folder}/strict/sleep", strict=True)
    assert not os.path.exists(f"{folder}/strict")
    masked = pipelines.ingest(spark, "oura", f"{folder}/in.csv", f"{folder}/local/sleep", local_only=True)
    assert "n1" not in {r.id for r in spark.read.parquet(masked.path).select("id").collect()}


def test_build_features_from_files(spark, folder):
    _oura(f"{folder}/in.csv", [_night(1), _night(2), _night(3)])
    pipelines.ingest(spark, "oura", f"{folder}/in.csv", f"{folder}/cur/sleep")
    with open(f"{folder}/hrv.csv", "w") as out:
        out.write("user_id,date,rmssd,sdnn\nu1,2024-01-03,75,95\n")
    with open(f"{folder}/screen.csv", "w") as out:
        out.write("user_id,timestamp\nu1,2024-01-02T23:30:00\n")
    done = pipelines.build_features(
        spark, f"{folder}/cur/sleep", f"{folder}/features", hrv=f"{folder}/hrv.csv", screen=f"{folder}/screen.csv"
    )
    rows = {r.date: r for r in files.scan_run(spark, f"{folder}/features").collect()}
    assert done.rows == 3 and rows[date(2024, 1, 3)].hrv_rmssd == 75.0
    assert rows[date(2024, 1, 2)].late_screen_flag is True and rows[date(2024, 1, 4)].hrv_rmssd is None


def test_train_writes_forecasts_and_reports(spark, folder):
    writers.write_curated(sinusoid(spark, 60), f"{folder}/cur/sleep")
    models = {"seasonal_arx": {}, "rolling_mean": {}, "naive_mean": {"enabled": False}, "unknown": {}}
    done = pipelines.train(spark, f"{folder}/cur/sleep", f"{folder}/out", models=models)
    assert done.rows == 2
    reports = {r.model: r for r in files.scan_reports(spark, f"{folder}/out/reports").collect()}
    assert set(reports) == {"seasonal_arx", "rolling_mean"} and all(r.mae >= 0 for r in reports.values())
    forecasts = spark.read.option("header", True).csv(f"{folder}/out/forecasts")
    assert forecasts.count() == 14 and {"model", "target", "prediction", "lower"} <= set(forecasts.columns)
    with pytest.raises(ValueError):
        pipelines.sweep(daily(spark, [1]), {"v": {}}, {"unknown": {}})


def test_analyze_writes_tables(spark, folder):
    values = [7 + (i % 7) / 10 + 0.01 * (i % 3) for i in range(60)]
    primary = daily(spark, values).withColumnRenamed("v", "sleep_hours")
    second = text.secondary_sessions(
        spark.createDataFrame([("01/01/2024 22:00:00", "02/01/2024 06:00:00")], "startDate string, endDate string")
    )
    row = pipelines.analyze(primary, folder, lags=7, horizon=3, secondary=second).first()
    assert row.next_date == date(2024, 3, 1) and 6 < row.next_value < 9 and row.seasonal_swing > 0
    tables = {n for n in os.listdir(f"{folder}/tables")}
    assert len(tables) == 9 and "secondary_describe" in tables
    ahead = spark.read.option("header", True).csv(f"{folder}/tables/primary_autoreg_forecast")
    assert ahead.count() == 3


def test_stream_processes_each_file_once(spark, folder):
    os.makedirs(f"{folder}/in")
    args = (spark, "oura", f"{folder}/in", f"{folder}/out", f"{folder}/ckpt")
    _oura(f"{folder}/in/a.csv", [_night(1), _night(2, "1.4")])
    ingest_stream(*args).awaitTermination(120)
    ingest_stream(*args).awaitTermination(120)
    _oura(f"{folder}/in/b.csv", [_night(3)])
    ingest_stream(*args).awaitTermination(120)
    good = spark.read.parquet(f"{folder}/out")
    assert sorted(r.id for r in good.collect()) == ["n1", "n3"]
    assert good.select(F.unix_micros("start_ts")).first()[0] > 0
    assert [r.id for r in spark.read.parquet(f"{folder}/out_quarantine").collect()] == ["n2"]


def test_a_row_sent_twice_is_curated_once(spark, folder):
    os.makedirs(f"{folder}/in")
    args = (spark, "oura", f"{folder}/in", f"{folder}/out", f"{folder}/ckpt")
    _oura(f"{folder}/in/a.csv", [_night(1), _night(2), _night(2), _night(9, "1.4")])
    ingest_stream(*args).awaitTermination(120)
    _oura(f"{folder}/in/b.csv", [_night(2), _night(3), _night(1, "0.5"), _night(9, "1.4")])
    ingest_stream(*args).awaitTermination(120)
    rows = spark.read.parquet(f"{folder}/out").collect()
    assert sorted((r.id, r.efficiency) for r in rows) == [("n1", 0.5), ("n1", 0.9), ("n2", 0.9), ("n3", 0.9)]
    assert [r.id for r in spark.read.parquet(f"{folder}/out_quarantine").collect()] == ["n9"]
    latest = files.scan_stream(spark, f"{folder}/out")
    assert sorted((r.id, r.efficiency) for r in latest.collect()) == [("n1", 0.5), ("n2", 0.9), ("n3", 0.9)]
    assert {"duration_zscore", "is_outlier_duration", "batch_id"} <= set(latest.columns)
    assert abs(latest.agg(F.sum("duration_zscore")).first()[0]) < 1e-9
    everything = files.scan_curated(spark, f"{folder}/out")
    assert everything.count() == 4 and dict(everything.dtypes)["batch_id"] == "bigint"


def test_columns_are_known_without_footers(spark, folder):
    out = f"{folder}/sleep"
    df = frame(spark, [record(), record(id="b")])
    for day in (1, 2):
        writers.write_curated(df, out, now=utc(2024, 1, day, 8))
    writers.write_curated(df.withColumn("more", F.lit(1)), out, now=utc(2024, 1, 3, 8))
    assert len([n for n in os.listdir(f"{out}/_schema") if n.endswith(".json")]) == 2
    # no job looks at the data before the scan itself
    broken = f"{out}/run_date=2024-01-04/run_id=1"
    os.makedirs(broken)
    with open(f"{broken}/part-0.parquet", "w") as f:
        f.write("no footer here")
    back = files.scan_curated(spark, out)
    assert "more" in back.columns and back.where("run_date < '2024-01-04'").count() == 6
    assert "mergeSchema" not in back._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(ValueError, match="more"):
        writers.write_curated(df.withColumn("more", F.lit("text")), out, now=utc(2024, 1, 5, 8))
        files.scan_curated(spark, out)
    with pytest.raises(ValueError, match="run folders"):
        df.write.parquet(f"{folder}/bare")
        files.scan_curated(spark, f"{folder}/bare", dedupe=True)


def test_jobs_clear_their_scratch_tables_and_check_signals(spark, folder):
    def tables():
        root = scratch_root(spark)
        return {n for n in os.listdir(root) if n.startswith("job-")} if os.path.isdir(root) else set()

    before = tables()
    _oura(f"{folder}/in.csv", [_night(1), _night(2), _night(3, "1.4")])
    assert pipelines.ingest(spark, "oura", f"{folder}/in.csv", f"{folder}/cur/sleep").rows == 2
    with open(f"{folder}/hrv.csv", "w") as out:
        out.write("user_id,date,rmssd,sdnn\nu1,2024-01-02,60,40\nu1,2024-01-02,61,40\n")
    args = (spark, f"{folder}/cur/sleep", f"{folder}/features")
    with pytest.raises(ValueError, match="several rows"):
        pipelines.build_features(*args, hrv=f"{folder}/hrv.csv", unique=True)
    assert pipelines.build_features(*args, hrv=f"{folder}/hrv.csv").rows == 3
    assert tables() == before


def test_a_written_table_leaves_no_shuffle_files(spark):
    def files_of_shuffles() -> set[str]:
        held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (held.apply(i).getName() for i in range(held.size())) if name.startswith("shuffle_")}

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files_of_shuffles(), spark.conf.get(key, None)
    df = spark.range(2000).groupBy((F.col("id") % 7).alias("k")).count()
    kept = materialize(df, "counts")
    until = time.time() + 5
    while files_of_shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not files_of_shuffles() - before
    assert spark.conf.get(key, None) == was
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, df.collect()))


def test_a_table_made_alone_is_all_that_stays(spark):
    def tables() -> set[str]:
        return set(os.listdir(scratch_root(spark))) if os.path.exists(scratch_root(spark)) else set()

    before = tables()
    step = lambda: materialize(spark.range(5), "step")
    assert materialize_alone(spark, lambda: materialize_alone(spark, step, "inner").union(step()), "outer").count() == 10
    assert {name.rsplit("-", 1)[0] for name in tables() - before} == {"outer"}
    before = tables()
    with pytest.raises(ZeroDivisionError):
        materialize_alone(spark, lambda: step() if 1 / 0 else None, "never")
    with job(spark):
        assert materialize_alone(spark, step, "inner").count() == 5
    assert tables() == before
