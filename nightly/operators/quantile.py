"""Exact interpolated quantiles without gathering a group in one task.

Spark's `percentile` keeps every distinct value of a group in one buffer. Here a
mergeable sketch first brackets each wanted quantile, one more pass counts the
rows outside the brackets as blocks and the values inside one by one, and the
exact order statistic is read off the running counts. What one task sees of a
group is the few values inside the brackets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from nightly.functions.frame import as_double, attach_stats
from nightly.operators.skew import running_totals
from nightly.session import materialize

ACCURACY = 50_000
# The sketch is off by at most n/ACCURACY ranks on either side.
MARGIN = 4 / ACCURACY


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], *, keys: Sequence[str] = ()
) -> DataFrame:
    """One row per key with the quantiles as array column ``quantiles``.

    Linear interpolation between order statistics; NULL and NaN are left out,
    and the array follows ``probs``, which must be sorted.
    """
    if list(probs) != sorted(probs):
        raise ValueError("probs must be sorted")
    keys = list(keys)
    rows = df.select(*keys, as_double(df, value).alias("_v")).where(F.col("_v").isNotNull())

    wanted = [max(0.0, p - MARGIN) for p in probs] + [min(1.0, p + MARGIN) for p in probs]
    found = rows.groupBy(*keys).agg(
        F.count("_v").alias("_n"),
        F.min("_v").alias("_min"),
        F.max("_v").alias("_max"),
        F.percentile_approx("_v", wanted, ACCURACY).alias("_b"),
    )
    # Small groups are bracketed by their whole range.
    small = F.col("_n") <= ACCURACY
    k = len(probs)
    lows = [F.when(small, F.col("_min")).otherwise(F.col("_b")[i]) for i in range(k)]
    highs = [F.when(small, F.col("_max")).otherwise(F.col("_b")[k + i]) for i in range(k)]
    bounds = found.select(*keys, "_n", F.array(*lows).alias("_lo"), F.array(*highs).alias("_hi"))

    placed = attach_stats(rows, bounds, keys)
    inside = F.lit(False)
    slot = F.lit(0)
    for i in range(k):
        inside = inside | F.col("_v").between(F.col("_lo")[i], F.col("_hi")[i])
        slot = slot + (F.col("_v") >= F.col("_lo")[i]).cast("int")
    tally = (
        placed.select(*keys, "_n", slot.alias("_slot"), F.when(inside, F.col("_v")).alias("_v"))
        .groupBy(*keys, "_slot", "_v")
        .agg(F.count(F.lit(1)).alias("_c"), F.max("_n").alias("_n"))
    )
    # Within a slot the block of rows outside the brackets comes last. The tally is
    # far smaller than the rows; should a group of it still be large, the running
    # totals are taken in chunks.
    ranked = running_totals(
        materialize(tally, "tally"), {"_end": F.col("_c")}, keys=keys, order=["_slot", "_v"]
    ).withColumn("_start", F.col("_end") - F.col("_c"))

    def at_rank(rank):
        hit = (F.col("_start") <= rank) & (rank < F.col("_end"))
        return F.max(F.when(hit, F.coalesce(F.col("_v"), F.raise_error(F.lit("quantile bracket missed")).cast("double"))))

    picks = []
    for i, p in enumerate(probs):
        target = F.lit(float(p)) * (F.col("_n") - 1)
        picks += [
            at_rank(F.floor(target)).alias(f"_a{i}"),
            at_rank(F.ceil(target)).alias(f"_z{i}"),
        ]
    out = ranked.groupBy(*keys).agg(F.max("_n").alias("_n"), *picks)
    result = []
    for i, p in enumerate(probs):
        target = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = F.col(f"_a{i}"), F.col(f"_z{i}")
        result.append(low + (high - low) * (target - F.floor(target)))
    return out.select(*keys, F.col("_n").alias("n"), F.array(*result).alias("quantiles"))
