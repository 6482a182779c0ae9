"""DuckDB forms of the bindings in `bind.py`, as named table expressions."""

from __future__ import annotations

import re


def r6(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE) + 1e-9, 6) + 0.0 AS {name}"


CTES: dict[str, str] = {
    "sessions": """
        SELECT 'ev_' || event_id AS id, 'u' || user_id AS user_id, ts AS start_ts,
               ts + to_minutes(CAST(floor(60 + 5 * value) AS BIGINT)) AS end_ts,
               60 + 5 * value AS duration_min,
               CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) / 100 AS efficiency,
               event_type = 'view' AS is_nap,
               CASE user_id % 3 WHEN 0 THEN 'UTC' WHEN 1 THEN 'America/Los_Angeles' ELSE 'Europe/London' END AS tz,
               CASE event_type WHEN 'click' THEN 'oura' WHEN 'purchase' THEN 'fitbit' ELSE 'apple_health' END AS source
        FROM events""",
    "utc": """
        SELECT id, user_id, timezone('UTC', timezone(tz, start_ts)) AS start_ts,
               timezone('UTC', timezone(tz, end_ts)) AS end_ts, duration_min, efficiency, is_nap, tz, source
        FROM sessions""",
    "clipped": """
        SELECT id, user_id, start_ts, end_ts,
               least(greatest(duration_min, 120.0), 720.0) AS duration_min, efficiency, is_nap, tz, source,
               duration_min < 120.0 OR duration_min > 720.0 AS duration_was_clipped,
               isodow(start_ts) >= 6 AS is_weekend
        FROM utc""",
    "spread": "SELECT avg(duration_min) AS mu, stddev_pop(duration_min) AS sd FROM clipped",
    "norm": """
        SELECT c.*, (c.duration_min - s.mu) / s.sd AS duration_zscore,
               abs((c.duration_min - s.mu) / s.sd) >= 3 AS is_outlier_duration
        FROM clipped c, spread s""",
    "nights": "SELECT *, CAST(start_ts AS DATE) AS date, duration_min / 60 AS sleep_hours FROM norm",
    "circ0": """
        SELECT *, isodow(start_ts) - 1 AS day_of_week, month(start_ts) AS month,
               greatest(0.0, 8.0 - sleep_hours) AS deficit,
               hour(start_ts + to_microseconds(CAST(round(duration_min * 30000000) AS BIGINT)))
                 + minute(start_ts + to_microseconds(CAST(round(duration_min * 30000000) AS BIGINT))) / 60.0
                 AS midpoint_hour_local
        FROM nights""",
    "circ": """
        SELECT *, avg(sleep_hours) OVER w7 AS sleep_hours_roll7, avg(sleep_hours) OVER w14 AS sleep_hours_roll14,
               avg(efficiency) OVER w7 AS efficiency_roll7, avg(efficiency) OVER w14 AS efficiency_roll14,
               sum(deficit) OVER w7 AS sleep_debt_roll7, sum(deficit) OVER w14 AS sleep_debt_roll14,
               abs(midpoint_hour_local - avg(midpoint_hour_local) OVER w7) AS social_jetlag
        FROM circ0
        WINDOW w7 AS (PARTITION BY user_id ORDER BY start_ts, id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               w14 AS (PARTITION BY user_id ORDER BY start_ts, id ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
    "hrv": """
        SELECT 'u' || user_id AS user_id, CAST(ts AS DATE) AS date, avg(value) AS hrv_rmssd, max(value) AS hrv_sdnn
        FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""",
    "steps": """
        SELECT 'u' || user_id AS user_id, CAST(ts AS DATE) AS date, CAST(sum(floor(value)) AS BIGINT) AS steps
        FROM events WHERE event_type = 'click' GROUP BY 1, 2""",
    "tags": """
        SELECT 'u' || user_id AS user_id, CAST(ts AS DATE) AS date,
               bool_or(event_type = 'click') AS caffeine, bool_or(event_type = 'purchase') AS alcohol,
               bool_or(event_type = 'view') AS late_meal, bool_or(event_type = 'error') AS work_travel
        FROM events GROUP BY 1, 2""",
    "screen": """
        SELECT 'u' || user_id AS user_id, CAST(ts AS DATE) AS date,
               CAST(count(*) FILTER (hour(ts) >= 22) AS BIGINT) AS late_minutes,
               CAST(count(ts) AS BIGINT) AS total_events,
               count(*) FILTER (hour(ts) >= 22) > 0 AS late_screen_flag,
               CAST(count(*) FILTER (hour(ts) >= 22) AS BIGINT) AS late_events
        FROM events GROUP BY 1, 2""",
    "daily": """
        SELECT CAST(l_shipdate AS DATE) AS date, avg(l_quantity * 0.3) AS sleep_hours FROM lineitem GROUP BY 1""",
    "sdaily": """
        SELECT l_suppkey AS series, CAST(l_shipdate AS DATE) AS date, avg(l_quantity * 0.3) AS sleep_hours
        FROM lineitem GROUP BY 1, 2""",
    "udaily": "SELECT user_id, date, avg(sleep_hours) AS sleep_hours FROM nights GROUP BY 1, 2",
    "sdense": """
        SELECT g.series, g.date, d.sleep_hours
        FROM (SELECT series, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
              FROM sdaily GROUP BY series) g
        LEFT JOIN sdaily d ON d.series = g.series AND d.date = g.date""",
    "sknown": """
        SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) AS pos FROM sdense""",
    "sframed": """
        SELECT *, last_value(CASE WHEN sleep_hours IS NOT NULL THEN pos END IGNORE NULLS) OVER p AS pp,
               last_value(sleep_hours IGNORE NULLS) OVER p AS pv,
               first_value(CASE WHEN sleep_hours IS NOT NULL THEN pos END IGNORE NULLS) OVER n AS np,
               first_value(sleep_hours IGNORE NULLS) OVER n AS nv
        FROM sknown
        WINDOW p AS (PARTITION BY series ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               n AS (PARTITION BY series ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "sregular": """
        SELECT series, date, pos,
               CASE WHEN sleep_hours IS NOT NULL THEN sleep_hours WHEN pv IS NULL THEN nv WHEN nv IS NULL THEN pv
                    ELSE pv + (nv - pv) * (pos - pp) / CAST(np - pp AS DOUBLE) END AS sleep_hours
        FROM sframed""",
    "ddense": """
        SELECT g.date, d.sleep_hours, row_number() OVER (ORDER BY g.date) AS pos
        FROM (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM daily) g
        LEFT JOIN daily d ON d.date = g.date""",
    "dframed": """
        SELECT *, last_value(CASE WHEN sleep_hours IS NOT NULL THEN pos END IGNORE NULLS) OVER p AS pp,
               last_value(sleep_hours IGNORE NULLS) OVER p AS pv,
               first_value(CASE WHEN sleep_hours IS NOT NULL THEN pos END IGNORE NULLS) OVER n AS np,
               first_value(sleep_hours IGNORE NULLS) OVER n AS nv
        FROM ddense
        WINDOW p AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               n AS (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
    "dregular": """
        SELECT date, coalesce(sleep_hours, pv + (nv - pv) * (pos - pp) / CAST(nullif(np - pp, 0) AS DOUBLE)) AS sleep_hours
        FROM dframed""",
    "sdec0": """
        SELECT series, date, pos - 1 AS rn, sleep_hours AS observed, count(*) OVER (PARTITION BY series) AS n,
               CASE WHEN count(*) OVER c = 7 THEN avg(sleep_hours) OVER c END AS trend
        FROM sregular
        WINDOW c AS (PARTITION BY series ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
    "sdec1": """
        SELECT series, rn % 7 AS slot, avg(observed - trend) AS m FROM sdec0 WHERE n >= 14 GROUP BY 1, 2""",
    "sdec": """
        SELECT d.series, d.date, d.observed, d.trend, p.m - c.c AS seasonal,
               d.observed - d.trend - (p.m - c.c) AS resid
        FROM sdec0 d JOIN sdec1 p ON p.series = d.series AND p.slot = d.rn % 7
        JOIN (SELECT series, avg(m) AS c FROM sdec1 GROUP BY 1) c ON c.series = d.series
        WHERE d.n >= 14""",
    "usplit": """
        SELECT *, rn > n_train AS is_test FROM (
          SELECT user_id, date, sleep_hours, rn, n,
                 CAST(least(n, greatest(n - least(7, greatest(1, n // 3)), n - 30)) AS BIGINT) AS n_train
          FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date) AS rn,
                       count(*) OVER (PARTITION BY user_id) AS n FROM udaily))""",
    "uroll": """
        SELECT t.user_id, t.date, l.level AS prediction, l.level - 0.5 AS lower, l.level + 0.5 AS upper,
               t.sleep_hours AS actual
        FROM usplit t LEFT JOIN (SELECT user_id, avg(sleep_hours) AS level FROM usplit
                                 WHERE NOT is_test AND rn > n_train - 7 GROUP BY 1) l ON l.user_id = t.user_id
        WHERE t.is_test""",
    "ar1": """
        SELECT series, regr_intercept(y, x) AS intercept, regr_slope(y, x) AS slope,
               CAST(regr_count(y, x) AS BIGINT) AS pairs, arg_max(y, date) AS last_value, max(date) AS last_date
        FROM (SELECT series, date, sleep_hours AS y,
                     lag(sleep_hours) OVER (PARTITION BY series ORDER BY date) AS x FROM sregular)
        GROUP BY series""",
}


def compose(body: str) -> str:
    """The query with the table expressions it needs in front."""
    need: list[str] = []

    def visit(text: str) -> None:
        for name, cte in CTES.items():
            if name not in need and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                visit(cte)
                if name not in need:
                    need.append(name)

    visit(body)
    if not need:
        return body.strip()
    head = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in need)
    return f"WITH {head}\n{body.strip()}"
