from __future__ import annotations

import random

import numpy as np
import pytest

from nightly.operators import quantile
from nightly.operators.profile import box_stats


@pytest.mark.parametrize("accuracy", [50_000, 100])
@pytest.mark.parametrize("kind", ["uniform", "few", "heavy"])
def test_exact_for_small_and_bracketed_groups(spark, monkeypatch, accuracy, kind):
    """With accuracy 100 a group of 5000 values takes the bracketed way."""
    monkeypatch.setattr(quantile, "ACCURACY", accuracy)
    monkeypatch.setattr(quantile, "MARGIN", 4 / accuracy)
    rng = random.Random(5)
    make = {
        "uniform": lambda: rng.uniform(-5, 5),
        "few": lambda: float(rng.randrange(4)),
        "heavy": lambda: rng.lognormvariate(0, 3),
    }[kind]
    values = [make() for _ in range(5000)]
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    row = quantile.exact_quantiles(df, "v", probs).first()
    assert row.n == 5000
    assert row.quantiles == pytest.approx(list(np.quantile(values, probs)))


def test_keyed_and_tiny_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 4.0), ("c", None)], "k string, v double")
    got = {r.k: r.quantiles for r in quantile.exact_quantiles(df, "v", [0.25, 0.5], keys=["k"]).collect()}
    assert got == {"a": [1.0, 1.0], "b": [2.5, 3.0]}


def test_probs_must_be_sorted(spark):
    with pytest.raises(ValueError):
        quantile.exact_quantiles(spark.range(3), "id", [0.5, 0.1])


def test_box_stats_exact_and_approximate_agree_on_small_data(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    exact = box_stats(df, "v").first()
    rough = box_stats(df, "v", approx=True).first()
    assert (exact.q1, exact.median, exact.q3) == (25.0, 50.0, 75.0)
    assert (rough.q1, rough.median, rough.q3) == (25.0, 50.0, 75.0)
    assert (exact.fence_low, exact.fence_high) == (-50.0, 150.0)
