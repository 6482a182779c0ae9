"""Windows over large keys: the chunked path must give the plain path's rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F, Window as W

from nightly.operators.circadian import circadian_features
from nightly.operators.series import acf, healthy_streak
from nightly.operators.skew import row_windows, running_totals, spread


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, many rows share their first order column."""
    rng = random.Random(3)
    rows = []
    for n in range(900):
        key = "hot" if rng.random() < 0.7 else f"k{rng.randrange(12)}"
        value = None if rng.random() < 0.1 else round(rng.uniform(0, 10), 3)
        rows.append((key, rng.randrange(40), n, value))
    return spark.createDataFrame(rows, "k string, a int, b int, v double").cache()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("max_rows", [10, 60, 200])
def test_row_windows_match_plain_windows(skewed, max_rows):
    def columns(w):
        return [
            F.sum("v").over(w.rowsBetween(-29, 0)).alias("s"),
            F.count("v").over(w.rowsBetween(-6, 0)).alias("c"),
            F.lag("b", 20).over(w).alias("l"),
        ]

    found = spread(skewed, ["k"], max_rows)
    assert found.hot is not None
    got = row_windows(
        skewed, columns, keys=["k"], order=["a", "b"], lookback=29, max_rows=max_rows
    )
    plain = W.partitionBy("k").orderBy("a", "b")
    want = skewed.select("*", *columns(plain))
    assert got.columns == want.columns
    rounded = [F.round(c, 9).alias(c) if c == "s" else F.col(c) for c in want.columns]
    assert _rows(got.select(*rounded)) == _rows(want.select(*rounded))


def test_row_windows_chunks_are_bounded(skewed):
    sizes = []

    def columns(w):
        return [F.count(F.lit(1)).over(w.rowsBetween(W.unboundedPreceding, 0)).alias("n")]

    got = row_windows(skewed, columns, keys=["k"], order=["a", "b"], lookback=5, max_rows=60)
    sizes = got.groupBy("k").agg(F.max("n")).collect()
    # The running count restarts in every chunk, so no window saw the whole key.
    assert max(r[1] for r in sizes) < 0.5 * skewed.where("k = 'hot'").count()


@pytest.mark.parametrize("max_rows", [25, 100])
def test_running_totals_match_plain_windows(skewed, max_rows):
    sums = {"pos": F.lit(1), "half": (F.col("b") % 2).cast("long")}
    got = running_totals(skewed, sums, keys=["k"], order=["a", "b"], max_rows=max_rows)
    w = W.partitionBy("k").orderBy("a", "b").rowsBetween(W.unboundedPreceding, 0)
    want = skewed.select("*", *[F.sum(c).over(w).alias(n) for n, c in sums.items()])
    assert _rows(got) == _rows(want)


def test_without_keys_all_rows_are_one_series(skewed):
    got = running_totals(skewed, {"pos": F.lit(1)}, keys=[], order=["a", "b"], max_rows=100)
    assert sorted(r.pos for r in got.collect()) == list(range(1, 901))


def test_no_large_key_means_one_shuffle_and_no_copy(skewed):
    got = row_windows(
        skewed, lambda w: [F.lag("b", 1).over(w).alias("l")], keys=["k"], order=["a", "b"], lookback=1
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Union" not in plan


def test_streak_and_acf_on_large_keys(skewed):
    keyed = dict(keys=["k"], order=["a", "b"])
    small = healthy_streak(skewed, "v", bounds=(2.0, 9.0), **keyed)
    large = healthy_streak(skewed, "v", bounds=(2.0, 9.0), max_rows=50, **keyed)
    assert _rows(small) == _rows(large)
    one = acf(skewed, "v", 5, keys=[], order=["a", "b"])
    two = acf(skewed, "v", 5, keys=[], order=["a", "b"], max_rows=100)
    for a, b in zip(one.orderBy("lag").collect(), two.orderBy("lag").collect()):
        assert a.acf == pytest.approx(b.acf) and a.band == pytest.approx(b.band)


def test_circadian_features_on_large_keys(spark):
    from tests.helpers import sinusoid

    df = sinusoid(spark, 120)
    plain = circadian_features(df)
    split = circadian_features(df, found=spread(df, ["user_id"], 25))
    columns = [c for c in plain.columns if c not in ("start_ts", "end_ts")]
    a = plain.select(*columns).orderBy("id").collect()
    b = split.select(*columns).orderBy("id").collect()
    for x, y in zip(a, b, strict=True):
        for c in columns:
            assert x[c] == (pytest.approx(y[c]) if isinstance(x[c], float) else y[c]), c
