"""Profiles of a table and summary statistics of nights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from nightly.functions.frame import as_double, attach_stats, numeric_columns
from nightly.functions.time import EPOCH, is_weekend, seconds_between, to_utc_wall, utc_wall
from nightly.operators.quantile import ACCURACY, MARGIN, exact_quantiles
from nightly.operators.skew import running_totals
from nightly.session import materialize

WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
QUARTILES = (0.25, 0.5, 0.75)
SHORT_NIGHT = 5.0
LONG_NIGHT = 9.0


def headline_metrics(df: DataFrame, value: str = "sleep_hours", keys: Sequence[str] = ()) -> DataFrame:
    """Nights, mean, median and sample deviation."""
    v = as_double(df, value)
    basic = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("nights"),
        F.avg(v).alias("mean_hours"),
        F.stddev_samp(v).alias("std_hours"),
    )
    middle = exact_quantiles(df, value, [0.5], keys=keys)
    median = middle.select(*keys, F.col("quantiles")[0].alias("median_hours"))
    return attach_stats(basic, median, keys)


def shortest_night(
    df: DataFrame, value: str = "sleep_hours", tie: Sequence[str] = ("date",), keys: Sequence[str] = ()
) -> DataFrame:
    """The row with the least value; the first by ``tie`` among equals."""
    known = df.where(F.col(value).isNotNull())
    rank = F.struct(F.col(value), *[F.col(c) for c in tie])
    row = F.struct(*[F.col(c) for c in tie], F.col(value))
    best = known.groupBy(*keys).agg(F.min_by(row, rank).alias("_row"))
    return best.select(*keys, "_row.*")


def night_counts(df: DataFrame, value: str = "sleep_hours", keys: Sequence[str] = ()) -> DataFrame:
    """Nights under five and over nine hours."""
    return df.groupBy(*keys).agg(
        F.count_if(F.col(value) < SHORT_NIGHT).alias("short_nights"),
        F.count_if(F.col(value) > LONG_NIGHT).alias("long_nights"),
    )


def healthy_ratio(df: DataFrame, value: str = "sleep_hours", keys: Sequence[str] = ()) -> DataFrame:
    """Share of nights of seven to nine hours; unknown nights count as outside."""
    inside = F.coalesce(F.col(value).between(7.0, 9.0), F.lit(False))
    return df.groupBy(*keys).agg(F.avg(inside.cast("double")).alias("healthy_ratio"))


def weekend_share(df: DataFrame, flag: str = "is_weekend", keys: Sequence[str] = ()) -> DataFrame:
    """Percentage of weekend rows."""
    return df.groupBy(*keys).agg((F.avg(F.col(flag).cast("double")) * 100.0).alias("weekend_pct"))


def weekend_gap(
    df: DataFrame, value: str = "sleep_hours", date: str = "date", keys: Sequence[str] = ()
) -> DataFrame:
    """Distance of the weekend mean from the weekday mean, 0 if one side is absent."""
    rest = is_weekend(utc_wall(df, date) if date == "start_ts" else F.col(date))
    gap = F.avg(F.when(rest, F.col(value))) - F.avg(F.when(~rest, F.col(value)))
    return df.groupBy(*keys).agg(F.coalesce(F.abs(gap), F.lit(0.0)).alias("weekend_gap"))


def weekday_matrix(df: DataFrame, value: str = "sleep_hours", date: str = "date") -> DataFrame:
    """Count, mean and sample deviation per weekday; absent weekdays appear with NULLs."""
    spark = df.sparkSession
    names = spark.range(len(WEEKDAYS)).select(
        F.col("id").cast("int").alias("day_no"),
        F.array(*[F.lit(d) for d in WEEKDAYS])[F.col("id").cast("int")].alias("weekday"),
    )
    v = as_double(df, value)
    stats = df.groupBy(F.weekday(F.col(date)).alias("day_no")).agg(
        F.count(v).alias("nights"), F.avg(v).alias("avg_hours"), F.stddev_samp(v).alias("std_hours")
    )
    return names.join(stats, "day_no", "left").orderBy("day_no")


def value_counts(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """Frequency and share of every non-NULL value, most frequent first."""
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(*keys, column)
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    total = counts.groupBy(*keys).agg(F.sum("cnt").alias("_total"))
    shares = attach_stats(counts, total, keys).withColumn("share", F.col("cnt") / F.col("_total"))
    return shares.drop("_total").orderBy(F.desc("cnt"), *keys, column)


def mean_by(df: DataFrame, category: str, value: str) -> DataFrame:
    """Mean of a value per category, rows without category left out."""
    known = df.where(F.col(category).isNotNull())
    return known.groupBy(category).agg(
        F.avg(as_double(df, value)).alias(f"mean_{value}"), F.count(F.lit(1)).alias("cnt")
    )


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Equal-width right-closed bins over the range of the values, empty ones included.

    If all values are equal, the range is widened by 0.1 % of the value on both
    sides (0.001 at zero).
    """
    v = as_double(df, value)
    rows = df.select(v.alias("_v")).where(F.col("_v").isNotNull())
    pad = F.when(F.col("_a") == 0, 0.001).otherwise(F.abs("_a") * 0.001)
    flat = F.col("_a") == F.col("_b")
    edge = rows.agg(F.min("_v").alias("_a"), F.max("_v").alias("_b")).select(
        F.when(flat, F.col("_a") - pad).otherwise(F.col("_a")).alias("_lo"),
        F.when(flat, F.col("_b") + pad).otherwise(F.col("_b")).alias("_hi"),
    )
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    place = F.greatest(F.lit(0), F.ceil((F.col("_v") - F.col("_lo")) / width).cast("int") - 1)
    counts = (
        attach_stats(rows, edge, ())
        .groupBy(F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("counts"))
    )
    frame = attach_stats(
        df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")), edge, ()
    )
    lower = F.col("_lo") + F.col("bin") * width
    upper = F.col("_lo") + (F.col("bin") + 1) * width
    return (
        frame.join(counts, "bin", "left")
        .select(
            "bin",
            lower.alias("lower"),
            upper.alias("upper"),
            ((lower + upper) / 2.0).alias("midpoint"),
            F.coalesce("counts", F.lit(0)).alias("counts"),
        )
        .orderBy("bin")
    )


def box_stats(df: DataFrame, value: str, keys: Sequence[str] = (), *, approx: bool = False) -> DataFrame:
    """Quartiles, extremes and 1.5-IQR whisker limits.

    ``approx`` answers from one sketch pass instead of the exact quantiles.
    """
    v = as_double(df, value)
    ends = df.groupBy(*keys).agg(F.min(v).alias("min"), F.max(v).alias("max"))
    if approx:
        quart = df.groupBy(*keys).agg(
            F.count(v).alias("n"), F.percentile_approx(v, list(QUARTILES), 10000).alias("quantiles")
        )
    else:
        quart = exact_quantiles(df, value, QUARTILES, keys=keys)
    q = F.col("quantiles")
    both = attach_stats(quart, ends, keys)
    spread = q[2] - q[0]
    return both.select(
        *keys,
        "n",
        "min",
        q[0].alias("q1"),
        q[1].alias("median"),
        q[2].alias("q3"),
        "max",
        (q[0] - 1.5 * spread).alias("fence_low"),
        (q[2] + 1.5 * spread).alias("fence_high"),
    )


def kde_density(
    df: DataFrame, value: str, grid: int = 200, cut: float = 3.0, *, bins: int | None = 4096
) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth h on an even grid.

    The grid reaches ``cut`` bandwidths past the extremes. Every value is shared between the two nearest of ``bins`` + 1 even
    places, in proportion to its distance, an aggregate that is combined before its shuffle; the places then add their kernels
    to the grid points. So the work after the scan does not depend on the data, and with places d apart the density is off by
    at most d^2 / (8 h^3 sqrt(2 pi)). With ``bins=None`` it is exact and every distinct value adds its own kernel.
    """
    v = as_double(df, value)
    moments = df.agg(
        F.count(v).alias("_n"),
        (F.stddev_samp(v) * F.pow(F.count(v).cast("double"), F.lit(-0.2))).alias("_h"),
        F.min(v).alias("_a"),
        F.max(v).alias("_b"),
    )
    known = df.select(v.alias("_v")).where(F.col("_v").isNotNull())
    if bins is None:
        ready = attach_stats(known.groupBy("_v").agg(F.count(F.lit(1)).cast("double").alias("_c")), moments, ())
        ready = ready.where(F.col("_h") > 0)
    else:
        width = (F.col("_b") - F.col("_a")) / F.lit(float(bins))
        placed = attach_stats(known, moments, ()).where(F.col("_h") > 0)
        placed = placed.withColumn("_p", F.least((F.col("_v") - F.col("_a")) / width, F.lit(float(bins))))
        low = F.least(F.floor("_p"), F.lit(bins - 1))
        # Both shares of a value are sums over its lower place, so no row is made twice.
        sums = placed.groupBy(low.alias("_i"), "_n", "_h", "_a", "_b").agg(
            F.sum(1 - (F.col("_p") - low)).alias("_w0"), F.sum(F.col("_p") - low).alias("_w1")
        )
        both = F.inline(F.array(
            F.struct(F.col("_i").alias("_j"), F.col("_w0").alias("_w")),
            F.struct((F.col("_i") + 1).alias("_j"), F.col("_w1").alias("_w")),
        ))
        places = sums.select("_n", "_h", "_a", "_b", both).groupBy("_j", "_n", "_h", "_a", "_b").agg(F.sum("_w").alias("_c"))
        ready = places.withColumn("_v", F.col("_a") + F.col("_j") * width)
    start = F.col("_a") - cut * F.col("_h")
    step = (F.col("_b") - F.col("_a") + 2 * cut * F.col("_h")) / F.lit(float(grid - 1))
    x = start + F.col("point") * step
    points = ready.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    u = (x - F.col("_v")) / F.col("_h")
    kernel = F.exp(-0.5 * u * u) * F.col("_c")
    return (
        points.withColumns({"_x": x, "_k": kernel})
        .groupBy("point")
        .agg(F.max("_x").alias("x"), F.sum("_k").alias("_s"), F.max("_n").alias("_n"), F.max("_h").alias("_h"))
        .select(
            "point", "x", (F.col("_s") / (F.col("_n") * F.col("_h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density")
        )
    )


def profile_summary(df: DataFrame) -> DataFrame:
    """Rows, columns and repeated rows (NULL equals NULL) as ``(metric, value)``."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    sums = copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("kinds")
    )
    metrics = F.array(
        F.struct(F.lit("rows").alias("metric"), F.col("rows").alias("value")),
        F.struct(F.lit("columns").alias("metric"), F.lit(len(df.columns)).cast("long").alias("value")),
        F.struct(F.lit("duplicates").alias("metric"), (F.col("rows") - F.col("kinds")).alias("value")),
    )
    return sums.select(F.inline(metrics))


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing values per column in one pass, as ``(column, missing)``."""
    def missing(name: str):
        gone = F.col(name).isNull()
        real = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
        return gone | F.isnan(name) if real else gone

    counts = df.agg(*[F.count_if(missing(c)).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in df.columns]
    )
    return counts.select(F.inline(pairs))


def describe_table(df: DataFrame) -> DataFrame:
    """`profile_summary`, and the missing counts if any value is missing."""
    missing = missing_counts(df)
    some = missing.agg(F.sum("missing").alias("_any"))
    listed = attach_stats(missing, some, ()).where(F.col("_any") > 0).drop("_any")
    return profile_summary(df).unionByName(listed, allowMissingColumns=True)


def _value_text(df: DataFrame, name: str):
    """Value as text; NaN is missing and -0.0 is 0.0."""
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return (as_double(df, name) + F.lit(0.0)).cast("string")
    return F.col(name).cast("string")


def _long(df: DataFrame, columns: Sequence[str], text: bool) -> DataFrame:
    """``(column, value)``, one row per cell, within the scan."""
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                (_value_text(df, c) if text else as_double(df, c)).alias("value"),
            )
            for c in columns
        ]
    )
    return df.select(F.inline(cells))


def _brackets(n: int, low: float, high: float, sketch: list[float]) -> list[tuple[float, float]]:
    """Disjoint ranges of values that hold the quartiles of a column; all values of a short one."""
    if n <= ACCURACY:
        return [(low, high)]
    half = len(sketch) // 2
    merged: list[tuple[float, float]] = []
    for lo, hi in sorted(zip(sketch[:half], sketch[half:])):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, one row per column.

    Two scans, however many columns. The first takes one mergeable state a column, a sketch that brackets the quartiles with
    it; the second counts what lies below the brackets while it writes, value by value, the few cells inside them. The state
    of a column, a dozen numbers, is what the driver holds.
    """
    columns = list(columns or numeric_columns(df))
    rows = df.select(*[as_double(df, c).alias(f"_{i}") for i, c in enumerate(columns)])
    wanted = [p - MARGIN for p in QUARTILES] + [p + MARGIN for p in QUARTILES]
    states = rows.agg(*[
        F.struct(
            F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"),
            F.percentile_approx(c, wanted, ACCURACY).alias("sketch"),
        ).alias(c) for c in rows.columns
    ]).first()
    basic = "_i int, column string, count long, mean double, std double, min double, max double"
    found = [(i, c, *list(states[i])[:5]) for i, c in enumerate(columns)]
    ranges = {i: _brackets(s["n"], s["min"], s["max"], s["sketch"]) for i, s in enumerate(states) if s["n"]}

    below = [
        F.count_if(F.col(f"_{i}") < lo).alias(f"{i}_{k}") for i, held in ranges.items() for k, (lo, _) in enumerate(held)
    ]
    cells = F.array(*[
        F.when(F.col(f"_{i}").between(lo, hi), F.struct(F.lit(i).alias("_i"), F.lit(k).alias("_k"), (F.col(f"_{i}") + F.lit(0.0)).alias("_v")))
        for i, held in ranges.items() for k, (lo, hi) in enumerate(held)
    ])
    summary = df.sparkSession.createDataFrame(found, basic)
    none = F.lit(None).cast("double")
    if not ranges:
        return summary.select("column", "count", "mean", "std", "min", none.alias("q25"), none.alias("q50"), none.alias("q75"), "max")
    seen = Observation()
    inside = rows.observe(seen, *below).select(F.explode(F.filter(cells, lambda x: x.isNotNull())).alias("c"))
    tally = materialize(inside.groupBy("c._i", "c._k", "c._v").agg(F.count(F.lit(1)).alias("_c")), "tally")
    counted = seen.get
    starts = [(i, k, counted[f"{i}_{k}"], states[i]["n"]) for i, held in ranges.items() for k in range(len(held))]
    base = F.broadcast(df.sparkSession.createDataFrame(starts, "_i int, _k int, _below long, _n long"))  # a few rows a column
    ranked = running_totals(tally, {"_end": F.col("_c")}, keys=["_i", "_k"], order=["_v"]).join(base, ["_i", "_k"])
    ranked = ranked.withColumns({"_end": F.col("_below") + F.col("_end"), "_start": F.col("_below") + F.col("_end") - F.col("_c")})
    picks = []
    for j, p in enumerate(QUARTILES):
        target = F.lit(p) * (F.col("_n") - 1)
        for name, rank in ((f"_a{j}", F.floor(target)), (f"_z{j}", F.ceil(target))):
            picks.append(F.max(F.when((F.col("_start") <= rank) & (rank < F.col("_end")), F.col("_v"))).alias(name))
    picked = ranked.groupBy("_i").agg(F.max("_n").alias("_n"), *picks)
    quarts = []
    for j, (name, p) in enumerate(zip(("q25", "q50", "q75"), QUARTILES)):
        target = F.lit(p) * (F.col("_n") - 1)
        low, high = (F.coalesce(F.col(f"{c}{j}"), F.raise_error(F.lit("quantile bracket missed")).cast("double")) for c in ("_a", "_z"))
        quarts.append((low + (high - low) * (target - F.floor(target))).alias(name))
    return summary.join(picked.select("_i", *quarts), "_i", "left").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per column.

    Among equally frequent values the first in order is the top.
    """
    columns = list(
        columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    )
    counts = _long(df, columns, text=True).groupBy("column", "value").agg(F.count("value").alias("_c"))
    # The most frequent value, and the least value among those: two aggregates
    # with partial results, no ordering of the values.
    top = counts.where(F.col("value").isNotNull())
    best = top.groupBy("column").agg(F.max("_c").alias("freq"))
    named = attach_stats(top, best, ["column"]).where(F.col("_c") == F.col("freq"))
    first = named.groupBy("column").agg(F.min("value").alias("top"), F.max("freq").alias("freq"))
    sizes = counts.groupBy("column").agg(
        F.sum("_c").alias("count"), F.count("value").alias("unique")
    )
    return sizes.join(first, "column", "left").select("column", "count", "unique", "top", "freq")


def describe_datetime(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, extremes and quartiles of time columns, as UTC wall times."""
    epoch = F.expr(EPOCH)
    micros = [
        (seconds_between(utc_wall(df, c), epoch) * F.lit(1000000)).cast("double").alias(c)
        for c in columns
    ]
    numbers = describe_numeric(df.select(*micros), columns).drop("std")
    stamps = [c for c in numbers.columns if c not in ("column", "count")]
    return numbers.select(
        "column",
        "count",
        *[to_utc_wall(F.timestamp_micros(F.col(c).cast("long"))).alias(c) for c in stamps],
    )


def distinct_counts(
    df: DataFrame, columns: Sequence[str] | None = None, *, approx: bool = False
) -> DataFrame:
    """Distinct non-NULL values per column as ``(column, distinct)``."""
    columns = list(columns or df.columns)
    if approx:
        counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        pairs = F.array(
            *[F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct")) for c in columns]
        )
        return counts.select(F.inline(pairs))
    cells = _long(df, columns, text=True).where(F.col("value").isNotNull()).distinct()
    return cells.groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))


def dedupe_rows(df: DataFrame) -> DataFrame:
    """One row of every group of equal rows; copies collapse before the shuffle."""
    return df.dropDuplicates()
