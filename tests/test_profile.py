from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from nightly.operators import profile, scenarios
from tests.helpers import by, daily


def test_headline_of_one_and_no_rows(spark):
    row = profile.headline_metrics(daily(spark, [7.0]), "v").first()
    assert (row.nights, row.mean_hours, row.median_hours, row.std_hours) == (1, 7.0, 7.0, None)
    empty = profile.headline_metrics(daily(spark, [7.0]).where("false"), "v").first()
    assert empty.nights == 0 and empty.median_hours is None


def test_shortest_night_takes_the_first_of_equals(spark):
    row = profile.shortest_night(daily(spark, [7, 4, None, 4]), "v").first()
    assert (row.date, row.v) == (date(2024, 1, 2), 4.0)


def test_bounds_of_counts_and_ratio(spark):
    df = daily(spark, [4.99, 5, 7, 9, 9.01, None])
    assert tuple(profile.night_counts(df, "v").first()) == (1, 1)
    assert profile.healthy_ratio(df, "v").first()[0] == pytest.approx(2 / 6)


def test_weekend_gap_without_weekend_is_zero(spark):
    assert profile.weekend_gap(daily(spark, [7, 8]), "v").first()[0] == 0.0
    assert profile.weekend_gap(daily(spark, [7, 7, 7, 7, 7, 9, 9]), "v").first()[0] == 2.0


def test_weekday_matrix_lists_absent_days(spark):
    rows = profile.weekday_matrix(daily(spark, [7, 8]), "v").collect()
    assert [r.weekday for r in rows] == list(profile.WEEKDAYS)
    assert rows[0].avg_hours == 7.0 and rows[6].nights is None


def test_value_counts_leave_nulls_out(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "s string")
    assert [tuple(r) for r in profile.value_counts(df, "s").collect()] == [("a", 2, 2 / 3), ("b", 1, 1 / 3)]


@pytest.mark.parametrize("bins", [2, 5, 20])
def test_histogram_matches_pandas_cut(spark, bins):
    values = np.random.default_rng(4).gamma(2.0, 2.0, 300).round(2)
    want = pd.cut(pd.Series(values), bins=bins).value_counts().sort_index().tolist()
    rows = profile.histogram(daily(spark, values), "v", bins).collect()
    assert [r.counts for r in rows] == want
    assert rows[0].lower == values.min() and rows[-1].upper == pytest.approx(values.max())


@pytest.mark.parametrize("value", [5.0, 0.0])
def test_histogram_of_equal_values(spark, value):
    rows = profile.histogram(daily(spark, [value] * 3), "v", 4).collect()
    assert sum(r.counts for r in rows) == 3
    assert rows[0].lower < value < rows[-1].upper


def test_kde_matches_a_numpy_model(spark):
    values = np.array([1.0, 2.0, 2.0, 4.0, 7.0])
    h = values.std(ddof=1) * len(values) ** -0.2
    for r in profile.kde_density(daily(spark, values), "v", grid=20, bins=None).collect():
        want = np.exp(-0.5 * ((r.x - values) / h) ** 2).sum() / (len(values) * h * np.sqrt(2 * np.pi))
        assert r.density == pytest.approx(want)
    assert profile.kde_density(daily(spark, [3.0, 3.0]), "v").count() == 0


@pytest.mark.parametrize("bins", [16, 100, 4096])
def test_binned_kde_keeps_its_bound(spark, bins):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.normal(5, 1, 300), rng.normal(9, 0.3, 200), [2.0, 12.0]])
    df = daily(spark, [*values, None])
    exact = {r.point: r.density for r in profile.kde_density(df, "v", bins=None).collect()}
    h = values.std(ddof=1) * len(values) ** -0.2
    bound = ((values.max() - values.min()) / bins) ** 2 / (8 * h**3 * np.sqrt(2 * np.pi))
    got = profile.kde_density(df, "v", bins=bins)
    off = max(abs(r.density - exact[r.point]) for r in got.collect())
    assert off <= bound + 1e-12 and len(exact) == 200


def test_rows_of_the_binned_kde_do_not_grow_with_the_values(spark):
    plan = profile.kde_density(spark.range(100_000).selectExpr("id / 7.0D as v"), "v", bins=50)
    made = plan.agg(F.max("density")).first()[0]
    assert made > 0
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "keys=[_v" not in text


def test_profile_counts_copies_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert {r.metric: r.value for r in profile.profile_summary(df).collect()} == {"rows": 3, "columns": 2, "duplicates": 1}
    table = profile.describe_table(df).collect()
    assert {r.column: r.missing for r in table if r.column} == {"a": 0, "b": 2}
    assert len(profile.describe_table(df.select("a")).collect()) == 3
    assert profile.dedupe_rows(df).count() == 2


def test_describe(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 3.0), ("y", None), (None, 5.0)], "s string, v double")
    n = profile.describe_numeric(df).first()
    assert (n["count"], n["mean"], n["std"], n["min"], n["q25"], n["q50"], n["q75"], n["max"]) == (3, 3.0, 2.0, 1.0, 2.0, 3.0, 4.0, 5.0)
    c = profile.describe_categorical(df).first()
    assert (c["count"], c["unique"], c["top"], c["freq"]) == (3, 2, "y", 2)
    tie = spark.createDataFrame([("b",), ("a",)], "s string")
    assert profile.describe_categorical(tie).first()["top"] == "a"
    assert {r[0]: r[1] for r in profile.distinct_counts(df).collect()} == {"s": 2, "v": 3}
    assert {r[0]: r[1] for r in profile.distinct_counts(df, approx=True).collect()} == {"s": 2, "v": 3}


def test_describe_datetime(spark):
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in (1, 2, 4)], "t timestamp_ntz")
    row = profile.describe_datetime(df, ["t"]).first()
    assert row["count"] == 3 and row["min"] == datetime(2024, 1, 1) and row["q50"] == datetime(2024, 1, 2)
    assert "std" not in row.asDict()


def test_scenarios_never_go_below_zero(spark):
    df = spark.createDataFrame([("a", 7.0), ("a", 8.0), ("b", 0.5)], "user_id string, sleep_hours double")
    got = {(r.user_id, r.shift_min, r.caffeine): r.projected_hours for r in scenarios.whatif_scenarios(df, [(120, True), (-60, False)]).collect()}
    assert got[("a", 120, True)] == pytest.approx(6.2) and got[("a", -60, False)] == 8.0
    assert got[("b", 120, True)] == 0.0
    default = scenarios.whatif_scenarios(df.drop("sleep_hours"), [(0, False)]).first()
    assert default.projected_hours == 7.0


def test_coach_rules_and_defaults(spark):
    df = daily(spark, [6, 6, 6, 6, 6, 9, 9], key="u").withColumnsRenamed({"v": "sleep_hours", "k": "user_id"})
    row = scenarios.coach_rules(df).first()
    assert [i.triggered for i in row.insights] == [True, False, True]
    assert row.insights[0].text == scenarios.COACH_TEXTS["average_sleep"][0]
    bare = scenarios.coach_rules(df.select("user_id", "date"), top=2).first()
    assert [i.triggered for i in bare.insights] == [False, False]
    assert by(scenarios.coach_levels(df), "user_id")["u"].weekend_gap == 3.0


def test_describe_takes_two_scans(spark, folder, monkeypatch):
    monkeypatch.setattr(profile, "ACCURACY", 1000)
    monkeypatch.setattr(profile, "MARGIN", 4 / 1000)
    rng = np.random.default_rng(2)
    data = {"a": rng.normal(0, 1, 5000), "b": rng.integers(0, 4, 5000).astype(float), "c": np.full(5000, 2.5), "d": rng.exponential(3, 5000), "e": rng.normal(0, 1, 5000)}
    data["d"][::3] = np.nan
    data["e"][5:] = np.nan
    frame = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in zip(*data.values())], ", ".join(f"{c} double" for c in data))
    frame.withColumn("none", F.lit(None).cast("double")).repartition(4).write.parquet(f"{folder}/wide-table")
    df = spark.read.parquet(f"{folder}/wide-table")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsList().size()
    got = {r["column"]: r for r in profile.describe_numeric(df).collect()}
    runs = store.executionsList()
    scans = sum(runs.apply(i).physicalPlanDescription().count("wide-table") > 0 for i in range(before, runs.size()))
    assert scans == 2
    for c, v in data.items():
        v = v[~np.isnan(v)]
        want = [len(v), v.mean(), v.std(ddof=1), v.min(), *np.quantile(v, [0.25, 0.5, 0.75]), v.max()]
        np.testing.assert_allclose(list(got[c])[1:], want, atol=1e-9)
    assert got["none"]["count"] == 0 and got["none"]["q50"] is None
    assert profile.describe_numeric(df.select("none")).first()["q25"] is None
