"""Writers. Data is committed first, pointers and documents follow it."""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from nightly.operators.privacy import SALT_ENV, scrub
from nightly.schema import schema_hash


@dataclass(frozen=True)
class Written:
    """Where a write went and how many rows it had."""

    path: str
    rows: int
    pointer: str | None = None


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Counts the rows during the write instead of in a second scan."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace one small file on the file system the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _parent(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[0]


def note_schema(df: DataFrame, path: str, partitions: Iterable[str]) -> None:
    """Keep the columns of a run in ``path/_schema``, one file per distinct schema, so that readers need no footers."""
    doc = {"columns": df.schema.jsonValue(), "partitions": list(partitions)}
    text = json.dumps(doc, sort_keys=True)
    write_text(df.sparkSession, f"{path.rstrip('/')}/_schema/{schema_hash(df.schema)}.json", text)


def write_curated(df: DataFrame, path: str, *, now: datetime | None = None) -> Written:
    """Add one dated run below ``path`` and move the version pointer to it.

    ``path/run_date=YYYY-MM-DD/run_id=HHMMSS...`` keeps every run apart, so a
    repeated run never mixes with an earlier one and dates prune on read.
    """
    spark = df.sparkSession
    stamp = now or _now()
    part = f"run_date={stamp:%Y-%m-%d}/run_id={stamp:%H%M%S%f}"
    counted, seen = _counted(df)
    counted.write.mode("errorifexists").parquet(f"{path}/{part}")
    note_schema(df, path, ["run_date", "run_id"])
    pointer = f"{_parent(path)}/VERSION.json"
    doc = {
        "last_run_ts": stamp.isoformat(),
        "schema_hash": schema_hash(),
        "last_partition": part,
    }
    write_text(spark, pointer, json.dumps(doc, indent=2))
    return Written(f"{path}/{part}", seen.get["rows"], pointer)


def write_features(
    df: DataFrame,
    path: str,
    *,
    scrub_fields: Iterable[str] | None = None,
    salt_env: str = SALT_ENV,
    now: datetime | None = None,
) -> Written:
    """Write the feature store and its `SCHEMA.json`, masked if fields are named."""
    stamp = f"{now or _now():%Y-%m-%dT%H%M%SZ}"
    fields = list(scrub_fields or [])
    if fields:
        df = scrub(df, fields, salt_env=salt_env)
    target = f"{path}/health_features_{stamp}.parquet"
    counted, seen = _counted(df)
    counted.write.mode("errorifexists").parquet(target)
    rows = seen.get["rows"]
    doc = {"generated_at": stamp, "rows": rows, "columns": df.columns, "parquet_path": target}
    write_text(df.sparkSession, f"{path}/SCHEMA.json", json.dumps(doc, indent=2))
    return Written(target, rows, f"{path}/SCHEMA.json")


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite") -> Written:
    """CSV with header."""
    counted, seen = _counted(df)
    counted.write.mode(mode).option("header", True).csv(path)
    return Written(path, seen.get["rows"])


def write_export(
    df: DataFrame, path: str, basename: str, formats: Iterable[str] = ("csv", "parquet"),
    *, now: datetime | None = None,
) -> list[Written]:
    """``basename_YYYYmmdd_HHMMSS.<format>`` for each format.

    Further formats are converted from the first one written, so the plan behind
    ``df`` runs once.
    """
    stamp = f"{now or _now():%Y%m%d_%H%M%S}"
    wanted = list(formats)
    unknown = sorted(set(wanted) - {"csv", "parquet"})
    if unknown:
        raise ValueError(f"unknown export formats {unknown}")
    source, done = df, []
    for fmt in sorted(set(wanted), reverse=True):
        target = f"{path}/{basename}_{stamp}.{fmt}"
        counted, seen = _counted(source)
        counted.write.format(fmt).option("header", True).save(target)
        done.append(Written(target, seen.get["rows"]))
        if fmt == "parquet":
            source = df.sparkSession.read.schema(df.schema).parquet(target)
    return done


def write_forecasts(
    df: DataFrame, path: str, fmt: str = "csv", *, mode: str = "overwrite"
) -> Written:
    """Forecast rows, one folder per model and target."""
    counted, seen = _counted(df)
    counted.write.mode(mode).partitionBy("model", "target").format(fmt).option("header", True).save(path)
    return Written(path, seen.get["rows"])


def write_reports(reports: DataFrame, path: str, *, mode: str = "overwrite") -> Written:
    """JSON reports, one folder per model and target, and `summary.json`.

    The summary has one entry per model and target with its mean metrics, also
    when there is a report per series.
    """
    spark = reports.sparkSession
    counted, seen = _counted(reports)
    counted.withColumns(
        {"_model": F.col("model_name"), "_target": F.col("target")}
    ).write.mode(mode).partitionBy("_model", "_target").json(path)
    written = (
        spark.read.schema(reports.schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "part-*.json")
        .json(path)
    )
    means = [F.avg(f"metrics.{m}").alias(m) for m in ("mae", "mape", "coverage")]
    rows = written.groupBy("model_name", "target").agg(*means).orderBy("model_name", "target")
    entries = [
        {
            "model_name": r.model_name,
            "target": r.target,
            "metrics": {"mae": r.mae, "mape": r.mape, "coverage": r.coverage},
        }
        for r in rows.collect()
    ]
    write_text(spark, f"{path}/summary.json", json.dumps({"artifacts": entries}, indent=2))
    return Written(path, seen.get["rows"], f"{path}/summary.json")


def write_telemetry(
    spark: SparkSession,
    path: str,
    event: str,
    *,
    start_time: float,
    rows_processed: int = 0,
    status: str = "success",
    error: str | None = None,
    metadata: Mapping[str, object] | None = None,
) -> None:
    """Append one JSON line about a run."""
    row = (
        _now().isoformat(),
        event,
        int((time.time() - start_time) * 1000),
        int(rows_processed),
        status,
        error,
        json.dumps(dict(metadata), default=str) if metadata else None,
    )
    schema = (
        "timestamp string, event string, duration_ms long, rows_processed long, "
        "status string, error string, metadata string"
    )
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(f"{path}/telemetry")


def save_model(model: MLWritable, path: str) -> None:
    """Spark ML model with its parameters."""
    model.write().overwrite().save(path)


def save_coefficients(df: DataFrame, path: str) -> Written:
    """Coefficient table of a keyed autoregression."""
    counted, seen = _counted(df)
    counted.write.mode("overwrite").parquet(path)
    return Written(path, seen.get["rows"])
