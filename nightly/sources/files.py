"""Scans over files that earlier runs wrote."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from nightly.functions.time import utc_wall
from nightly.operators.canonical import drop_repeats, zscore_duration

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("model_path", T.StringType()),
        T.StructField("forecast_path", T.StringType()),
        T.StructField(
            "metrics",
            T.StructType(
                [T.StructField(n, T.DoubleType()) for n in ("mae", "mape", "coverage")]
            ),
        ),
    ]
)


# Folders of runs, in the order of their runs, and how they are read.
RUN_FOLDERS = {"run_date": T.StringType(), "run_id": T.StringType(), "batch_id": T.LongType()}


def noted_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Union of the columns that the writers noted in ``path/_schema``, run folders last; None if they noted nothing.

    There is one small file per distinct schema, however many runs there are. A column of two types is an error.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_schema")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json"))
    found: dict[str, T.StructField] = {}
    folders: dict[str, None] = {}
    for name in names:
        doc = json.loads(spark.read.text(f"{path.rstrip('/')}/_schema/{name}", wholetext=True).first()["value"])
        folders |= dict.fromkeys(doc["partitions"])
        for f in T.StructType.fromJson(doc["columns"]).fields:
            known = found.setdefault(f.name, T.StructField(f.name, f.dataType, True))
            if known.dataType != f.dataType:
                raise ValueError(f"column {f.name} is {known.dataType.simpleString()} and {f.dataType.simpleString()} under {path}")
    if not names:
        return None
    return T.StructType([*found.values(), *[T.StructField(c, RUN_FOLDERS[c]) for c in folders]])


def scan_curated(
    spark: SparkSession, path: str, *, run_date: str | None = None, dedupe: bool = False, merge: bool = True
) -> DataFrame:
    """Every Parquet file below ``path``, columns matched by name.

    The columns of all runs are those their writers noted, so no footer is read to find them. Where nothing was noted,
    ``merge`` takes the columns of all files, which reads every footer; without it those of one file count. The folders of
    runs become columns (`run_date`, `run_id`: text; `batch_id` of a stream: number), and a filter on the date prunes files.
    ``dedupe`` keeps the latest run, or batch, of every id.
    """
    schema = noted_schema(spark, path)
    if schema is None:
        found = spark.read.option("mergeSchema", merge).parquet(path)
        schema = T.StructType([T.StructField(f.name, RUN_FOLDERS.get(f.name, f.dataType)) for f in found.schema.fields])
    df = spark.read.schema(schema).parquet(path)
    if run_date is not None:
        df = df.where(F.col("run_date") == F.lit(run_date))
    if dedupe:
        order = [c for c in RUN_FOLDERS if c in df.columns]
        if not order:
            raise ValueError(f"no run folders under {path} to tell the latest row of an id")
        df = drop_repeats(df, ["id"], F.struct(*order))
    return df


def scan_stream(spark: SparkSession, path: str, *, dedupe: bool = True) -> DataFrame:
    """What a stream curated, the latest version of every night, with the duration z-score of the whole table."""
    return zscore_duration(scan_curated(spark, path, dedupe=dedupe))


def curated_sleep(spark: SparkSession, path: str, **options) -> DataFrame:
    """Curated sessions as the feature store reads them: dated, user id as string."""
    df = scan_curated(spark, path, **{"merge": False, **options})
    if "start_ts" not in df.columns:
        raise ValueError("curated data must have a start_ts column")
    day = F.col("date") if "date" in df.columns else utc_wall(df, "start_ts")
    return df.withColumns({"date": day.cast("date"), "user_id": F.col("user_id").cast("string")})


def _json_reports(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    raw = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .schema(REPORT_SCHEMA)
        .json(path, multiLine=multi_line)
    )
    return raw.withColumn("_path", F.input_file_name())


def scan_reports(spark: SparkSession, path: str, *, multi_line: bool | None = None) -> DataFrame:
    """Model reports (JSON files, `summary.json` left out) -> one row per report.

    Every line of a file may be a report, as in the files written here, or the whole
    file is one indented document. By default a file with a line that is a report is
    read by lines and any other as a document; ``multi_line`` fixes one of the two.
    """
    if multi_line is None:
        lines = _json_reports(spark, path, False).where(F.coalesce("model_name", "model", "target").isNotNull())
        by_line = lines.select("_path").distinct()
        raw = lines.unionByName(_json_reports(spark, path, True).join(by_line, "_path", "left_anti"))
    else:
        raw = _json_reports(spark, path, multi_line)
    name = F.element_at(F.split("_path", "/"), -1)
    return raw.select(
        name.alias("file"),
        F.coalesce("model_name", "model").alias("model"),
        "target",
        "metrics.mae",
        "metrics.mape",
        "metrics.coverage",
    ).where(F.col("file") != "summary.json")


def list_runs(spark: SparkSession, path: str) -> list[str]:
    """Names of the run folders or files directly below ``path``, sorted."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(n for n in names if not n.startswith(("_", ".")) and not n.endswith(".json"))


def scan_run(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """One run below ``path``: the named one, or the last by name."""
    runs = list_runs(spark, path)
    if not runs:
        raise ValueError(f"no runs under {path}")
    if run is not None and run not in runs:
        raise ValueError(f"no run {run!r} under {path}")
    return spark.read.parquet(f"{path}/{run or runs[-1]}")
