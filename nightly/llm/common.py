"""Helpers of the text operators: folds, registration, files every executor can reach."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from nightly.session import materialize

# Rows handed to a Python worker at once; texts can be long.
ARROW_ROWS = "2000"

# What operators keep in a Python worker from task to task, by operator.
WORKER_CACHES: dict[str, dict] = {}


def clear_worker(keep: str | None = None) -> None:
    """At the start of a task: free what operators other than ``keep`` left in this worker, which outlives their stages."""
    left = [held for name, held in WORKER_CACHES.items() if name != keep and held]
    if left:
        for held in left:
            held.clear()
        pa.default_memory_pool().release_unused()


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (spark, folder) under its own name, with its SQL if there is one."""

    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def small_batches(spark: SparkSession, megabytes: int = 16) -> None:
    """Hand Arrow batches of at most so many bytes to Python workers, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def merge_rows(found: DataFrame, merge: Callable, name: str, fan_in: int = 16) -> Row | None:
    """Merge summaries, one row per task, ``fan_in`` at a time until one row is left; no task sees more of them at once.

    ``merge`` is a function for ``mapInArrow`` that makes one row of a partition's rows in the same schema.
    """
    found = materialize(found, name)
    while (rows := found.count()) > 1:
        found = materialize(found.repartition(-(-rows // fan_in)).mapInArrow(merge, found.schema), name)
    return found.first()


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def bounded_ids(df: DataFrame, rows: int, seed: int) -> DataFrame:
    """At most ``rows`` distinct ids, the ones with the smallest seeded hash, so every run takes the same."""
    ids = df.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
    return ids.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder that driver and executors share (file:, hdfs:, s3:, gs: or a plain path)."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def put_file(uri: str, tmp: str, name: str, parts: list[bytes]) -> None:
    """Write under a temporary name and rename, so that readers and repeated attempts see whole files only."""
    fs, folder = filesystem(uri)
    fs.create_dir(folder, recursive=True)
    with fs.open_output_stream(f"{folder}/{tmp}", compression=None) as out:
        for part in parts:
            out.write(part)
    fs.move(f"{folder}/{tmp}", f"{folder}/{name}")


# Ranges a table is cut into at most, which is what a shuffle can deal out, and keys that are looked at for it at most.
MAX_RANGES, MAX_SAMPLE = 20_000, 320_000


def range_bounds(df: DataFrame, key: str, size: Column, shard_bytes: int, per_shard: int = 64) -> list[int]:
    """Upper keys of all ranges but the last, a function of the table alone.

    Keys are taken by hash, about ``per_shard`` for every ``shard_bytes`` of content and no more than about MAX_SAMPLE of the
    whole table, so ranges differ little in size and the same table is cut alike on every run. There are at most MAX_RANGES;
    in a larger table they hold more than ``shard_bytes``. A range of one key is not cut further.
    """
    size = F.coalesce(size, F.lit(0)).cast("long") + 64
    total = df.agg(F.count(key).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    shards = min(-(-total["b"] // shard_bytes), MAX_RANGES)
    if shards < 2:
        return []
    share = min(1.0, min(shards * per_shard, MAX_SAMPLE) / max(1, total["n"]))
    chance = F.shiftrightunsigned(F.xxhash64(key), 33) / float(1 << 31)
    got = df.where(F.col(key).isNotNull() & (chance < share)).select(F.col(key).alias("k"), size.alias("b")).toPandas()
    if got.empty:
        return []
    got = got.sort_values(["k", "b"])
    at = got["b"].cumsum().to_numpy()
    cuts = np.searchsorted(at, at[-1] * np.arange(1, shards) / shards)
    return sorted({int(x) for x in got["k"].to_numpy()[cuts]})


def ranges_of(keys: pa.Array, edges: np.ndarray) -> np.ndarray:
    """Numbers of the ranges of a batch of keys; NULL keys are in the first."""
    return np.where(keys.is_valid().to_numpy(zero_copy_only=False), np.searchsorted(edges, keys.fill_null(0).to_numpy()), 0).astype(np.int32)


def range_of(key: str, bounds: list[int]) -> Column:
    """Number of the range a key falls in; NULL keys are in the first."""
    edges = np.array(bounds, dtype=np.int64)

    @F.pandas_udf("int")
    def of(keys: pd.Series) -> pd.Series:
        known = keys.notna().to_numpy()
        out = np.zeros(len(keys), np.int32)
        out[known] = np.searchsorted(edges, keys[known].astype("int64").to_numpy())
        return pd.Series(out)

    return of(key)
