"""Ordered row windows that survive a key holding a large part of all rows.

A window partitioned by user puts all rows of one user into one task. That is
the right plan while every user is small, and the wrong one as soon as a single
user holds a third of the table. `spread` measures the rows per key with one
aggregate job. If no key is large, the operators below plan one ordinary window
and one shuffle. Otherwise the rows of the large keys are range-partitioned by
key and order into chunks of about `max_rows` rows, and each chunk gets the few
preceding rows that its first rows look back on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, Window as W
from pyspark.sql.window import WindowSpec

from nightly.functions.frame import join_keys, over_keys
from nightly.session import materialize

MAX_ROWS = 2_000_000
# A key counts as large only above 1/MAX_HOT_KEYS of all rows, so there are
# fewer than MAX_HOT_KEYS large keys and their table can be broadcast.
MAX_HOT_KEYS = 20_000
# Days of whole series per task, which bounds the memory of the sorts over them.
TASK_DAYS = 500_000

Columns = Callable[[WindowSpec], Sequence[Column]]


@dataclass(frozen=True)
class Spread:
    """Measured key sizes: `hot` holds the large keys, None if there are none."""

    keys: tuple[str, ...]
    rows: int
    max_rows: int
    hot: DataFrame | None

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of ordinary keys and rows of large keys."""
        table = F.broadcast(self.hot.select(*self.keys))
        same = F.lit(True)  # NULL is a key like any other
        for k in self.keys:
            same = same & df[k].eqNullSafe(table[k])
        return df.join(table, same, "left_anti"), df.join(table, same, "left_semi")


def spread(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_ROWS) -> Spread:
    """Count rows per key and find the keys above the threshold."""
    keys = tuple(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, largest = counts.agg(F.sum("_n"), F.max("_n")).first()
    limit = max(max_rows, (total or 0) // MAX_HOT_KEYS)
    if (largest or 0) <= limit:
        return Spread(keys, total or 0, limit, None)
    return Spread(keys, total, limit, materialize(counts.where(F.col("_n") > limit), "large-keys"))


def series_tasks(df: DataFrame, keys: Sequence[str], date: str = "date") -> int:
    """Tasks for every day of the series in ``df``, from the first to the last of each, found by one job over keys and dates."""
    if not keys:
        return 1
    day = F.col(date).cast("date")
    ends = df.groupBy(*keys).agg(F.min(day).alias("_first"), F.max(day).alias("_last"))
    days = ends.agg(F.sum(F.date_diff("_last", "_first") + 1)).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-days // TASK_DAYS))


def by_series(df: DataFrame, keys: Sequence[str], tasks: int) -> DataFrame:
    """Whole series dealt to ``tasks`` tasks.

    A window over the keys shuffles by itself, but into as many bytes a task as adaptive execution aims at, before the days that
    are missing are made and sorted. Their number is what a task must have room for, so it says how many tasks there are.
    """
    return df.repartition(tasks, *keys) if keys else df


def _nulls_last(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def _chunked(df: DataFrame, found: Spread, order: Sequence[str]) -> DataFrame:
    """Rows of the large keys with a fixed `_chunk` number that follows the order.

    The chunk is the number of a range partition. It is written down, because
    partition ids may change when a lost task is run again.
    """
    sizes = found.hot.agg(F.sum("_n")).first()[0]
    parts = max(2, -(-int(sizes) // found.max_rows))
    ranged = df.repartitionByRange(parts, *found.keys, *_nulls_last(order))
    return materialize(ranged.withColumn("_chunk", F.spark_partition_id()), "chunks")


def _chunk_table(chunks: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """One row per key and chunk with totals of all earlier chunks of the key.

    A range partition holds the end of one key, whole keys and the start of the
    next, so there are at most (chunks + large keys) rows here, both bounded by
    MAX_HOT_KEYS: small enough to broadcast whatever the size of the data.
    """
    totals = chunks.groupBy(*keys, "_chunk").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()]
    )
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    return totals.select(
        *keys,
        "_chunk",
        "_rows",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in sums],
    )


def row_windows(
    df: DataFrame,
    columns: Columns,
    *,
    keys: Sequence[str],
    order: Sequence[str],
    lookback: int,
    found: Spread | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add window columns whose frames reach at most ``lookback`` rows back.

    ``columns`` gets the window of one series and returns aliased columns.
    Without keys all rows are one series.
    """
    if not keys:
        one = df.withColumn("_all", F.lit(0))
        return row_windows(
            one, columns, keys=["_all"], order=order, lookback=lookback, max_rows=max_rows
        ).drop("_all")
    found = found or spread(df, keys, max_rows)
    series = over_keys(keys).orderBy(*_nulls_last(order))
    if found.hot is None:
        return df.select("*", *columns(series))

    small, large = found.split(df)
    chunks = _chunked(large, found, order)
    part = W.partitionBy(*keys, "_chunk").orderBy(*_nulls_last(order))
    table = _chunk_table(chunks, keys, {})

    # The last rows of a chunk, each with its distance to the end of the chunk.
    # Every chunk has a row, so at most ``lookback`` later chunks can need them.
    ahead = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(1, lookback)
    later = F.collect_list(F.struct(F.col("_chunk").alias("to"), F.col("_offset").alias("start"))).over(ahead)
    near = F.filter("_later", lambda x: x["start"] - F.col("_offset") - F.col("_rows") < lookback)
    targets = table.withColumn("_later", later).withColumn("_later", near)
    tails = join_keys(
        chunks.withColumn("_pos", F.row_number().over(part) - 1), F.broadcast(targets), [*keys, "_chunk"]
    ).where(F.col("_rows") - F.col("_pos") <= lookback)
    halo = (
        tails.select(*df.columns, (F.col("_offset") + F.col("_pos")).alias("_at"), F.explode("_later").alias("_to"))
        .where(F.col("_to.start") - F.col("_at") <= lookback)
        .select(*df.columns, F.col("_to.to").alias("_chunk"), F.lit(True).alias("_halo"))
    )
    padded = chunks.withColumn("_halo", F.lit(False)).unionByName(halo)
    done = padded.select("*", *columns(part)).where(~F.col("_halo")).drop("_chunk", "_halo")
    plain = small.select("*", *columns(series))
    return plain.unionByName(done)


def running_totals(
    df: DataFrame,
    sums: dict[str, Column],
    *,
    keys: Sequence[str],
    order: Sequence[str],
    found: Spread | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Add running sums in order within each key, one column per entry of ``sums``.

    With ``{"position": lit(1)}`` this numbers the rows of every key. Without
    keys all rows are one series.
    """
    if not keys:
        one = df.withColumn("_all", F.lit(0))
        return running_totals(one, sums, keys=["_all"], order=order, max_rows=max_rows).drop("_all")
    found = found or spread(df, keys, max_rows)

    def cumulated(window: WindowSpec) -> list[Column]:
        frame = window.rowsBetween(W.unboundedPreceding, 0)
        return [F.sum(c).over(frame).alias(n) for n, c in sums.items()]

    series = over_keys(keys).orderBy(*_nulls_last(order))
    if found.hot is None:
        return df.select("*", *cumulated(series))

    small, large = found.split(df)
    chunks = _chunked(large, found, order)
    table = _chunk_table(chunks, keys, sums)
    part = W.partitionBy(*keys, "_chunk").orderBy(*_nulls_last(order))
    local = join_keys(chunks.select("*", *cumulated(part)), F.broadcast(table), [*keys, "_chunk"])
    done = local.select(*df.columns, *[(F.col(n) + F.col(f"_b_{n}")).alias(n) for n in sums])
    return small.select("*", *cumulated(series)).unionByName(done)
