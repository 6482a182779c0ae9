"""Incremental ingest of vendor files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from nightly.functions.frame import require_columns
from nightly.operators.canonical import (
    VENDOR_SPECS,
    canonicalize,
    clip_duration,
    normalize_timestamps,
    quarantine_split,
    weekend_flag,
)
from nightly.sinks.writers import note_schema


def stream_vendor(spark: SparkSession, source: str, path: str, header: list[str] | None = None) -> DataFrame:
    """File stream of vendor CSVs with canonical columns.

    A stream has a fixed schema and CSV binds it by position, so ``header`` gives
    the column order of the files; the vendor's own order is the default.
    """
    columns = header or list(VENDOR_SPECS[source])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    require_columns(raw, VENDOR_SPECS[source], source)
    return canonicalize(raw, source)


# A row that was sent again is known again for so long after it first arrived.
REPEATS = "30 days"


def drop_resent(stream: DataFrame, within: str = REPEATS) -> DataFrame:
    """Rows that are equal in all columns to one that arrived before, in any batch, are taken once.

    The state holds one 128-bit print per row and leaves out what arrived longer than ``within`` ago. The clock is that of the
    batches, which a batch that is run again finds in the checkpoint, so no row is ever late and none is dropped for its age. A
    night that was sent again with other values is another row; readers keep its latest version.
    """
    row = F.to_json(F.struct(*stream.columns), {"ignoreNullFields": "false"})
    timed = stream.withColumns({"_print": F.unhex(F.md5(row)), "_arrived": F.current_timestamp()})
    return timed.withWatermark("_arrived", within).dropDuplicatesWithinWatermark(["_print"]).drop("_print", "_arrived")


def ingest_stream(
    spark: SparkSession,
    source: str,
    path: str,
    out: str,
    checkpoint: str,
    *,
    header: list[str] | None = None,
    repeats: str | None = REPEATS,
) -> StreamingQuery:
    """Process all files that have not been seen yet, then stop.

    Row-wise work and, unless ``repeats`` is None, dropping rows that were sent before. The duration z-score needs the whole
    table: `sources.files.scan_stream` adds it. A batch that is run again after a failure replaces its own folder, so rows
    are written once.
    """
    stream = stream_vendor(spark, source, path, header)
    if repeats is not None:
        stream = drop_resent(stream, repeats)
    ready = weekend_flag(normalize_timestamps(clip_duration(stream)))

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            good, bad = quarantine_split(batch)
            good.write.mode("overwrite").parquet(f"{out}/batch_id={number}")
            bad.write.mode("overwrite").parquet(f"{out.rstrip('/')}_quarantine/batch_id={number}")
            note_schema(good, out, ["batch_id"])
        finally:
            batch.unpersist()

    writer = ready.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
