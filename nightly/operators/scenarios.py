"""What-if projections and coaching rules per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from nightly.functions.time import is_weekend

HOURS_PER_SHIFTED_HOUR = -0.5
CAFFEINE_HOURS = -0.3
DEFAULT_SLEEP = 7.0

# Rule -> (message if triggered, message if not).
COACH_TEXTS = {
    "average_sleep": (
        "You sleep less than 7 hours a night on average: try going to bed half an hour sooner.",
        "You reach 7 hours a night on average: keep going.",
    ),
    "sleep_debt": (
        "More than 2 hours of sleep are missing over the last week: plan a long night.",
        "Little sleep is missing over the last week.",
    ),
    "weekend_gap": (
        "Nights at weekends and on working days differ by over 1.5 hours: get up at more even times.",
        "Nights at weekends and on working days are much alike.",
    ),
}


def _mean(df: DataFrame, column: str, default: float):
    return F.coalesce(F.avg(column), F.lit(default)) if column in df.columns else F.lit(default)


def whatif_scenarios(
    df: DataFrame, scenarios: Sequence[tuple[int, bool]], *, keys: Sequence[str] = ("user_id",)
) -> DataFrame:
    """Projected sleep per user for each (bedtime shift in minutes, caffeine) pair, never below 0."""
    listed = F.array(
        *[
            F.struct(F.lit(int(m)).alias("shift_min"), F.lit(bool(c)).alias("caffeine"))
            for m, c in scenarios
        ]
    )
    means = df.groupBy(*keys).agg(_mean(df, "sleep_hours", DEFAULT_SLEEP).alias("baseline_hours"))
    rows = means.select(*keys, "baseline_hours", F.inline(listed))
    delta = F.col("shift_min") / F.lit(60.0) * HOURS_PER_SHIFTED_HOUR + F.when(
        F.col("caffeine"), CAFFEINE_HOURS
    ).otherwise(0.0)
    return rows.withColumn("delta_hours", delta).withColumn(
        "projected_hours", F.greatest(F.lit(0.0), F.col("baseline_hours") + F.col("delta_hours"))
    )


def coach_levels(df: DataFrame, *, keys: Sequence[str] = ("user_id",), date: str = "date") -> DataFrame:
    """The three numbers behind the rules; absent columns have neutral defaults."""
    gap = F.lit(0.0)
    if "sleep_hours" in df.columns:
        rest = is_weekend(F.col(date))
        sides = F.avg(F.when(rest, F.col("sleep_hours"))) - F.avg(F.when(~rest, F.col("sleep_hours")))
        gap = F.coalesce(F.abs(sides), F.lit(0.0))
    return df.groupBy(*keys).agg(
        _mean(df, "sleep_hours", DEFAULT_SLEEP).alias("average_sleep"),
        _mean(df, "sleep_debt_roll7", 0.0).alias("sleep_debt"),
        gap.alias("weekend_gap"),
    )


def coach_rules(
    df: DataFrame, *, keys: Sequence[str] = ("user_id",), date: str = "date", top: int = 3
) -> DataFrame:
    """Per user the first ``top`` insights as array of (rule, triggered, text)."""
    tests = {
        "average_sleep": F.col("average_sleep") < 7.0,
        "sleep_debt": F.col("sleep_debt") > 2.0,
        "weekend_gap": F.col("weekend_gap") > 1.5,
    }
    insights = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                hit.alias("triggered"),
                F.when(hit, COACH_TEXTS[rule][0]).otherwise(COACH_TEXTS[rule][1]).alias("text"),
            )
            for rule, hit in tests.items()
        ]
    )
    levels = coach_levels(df, keys=keys, date=date)
    return levels.withColumn("insights", F.slice(insights, 1, top))
