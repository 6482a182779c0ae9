"""Aggregates, joins and row windows over nights."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bind
from catalog.bind import plain
from catalog.registry import query
from catalog.tables_sql import r6
from nightly.functions.time import to_utc_wall
from nightly.operators import baselines, canonical, circadian, fuse, profile, scenarios, series
from nightly.sources.text import secondary_sessions

BASE = "n.id, n.user_id, n.date, round(n.sleep_hours + 1e-9, 6) + 0.0 AS sleep_hours"


def _base(spark, sf):
    return bind.nights(spark, sf).select("id", "user_id", "date", "sleep_hours")


@query(
    f"""SELECT {BASE}, round(s.hrv_rmssd + 1e-9, 6) + 0.0 AS hrv_rmssd, round(s.hrv_sdnn + 1e-9, 6) + 0.0 AS hrv_sdnn
        FROM nights n LEFT JOIN hrv s ON s.user_id = n.user_id AND s.date = n.date"""
)
def fuse_hrv(spark, sf):
    return plain(fuse.fuse(_base(spark, sf), bind.hrv(spark, sf)))


@query(f"SELECT {BASE}, s.steps FROM nights n LEFT JOIN steps s ON s.user_id = n.user_id AND s.date = n.date")
def fuse_steps(spark, sf):
    return plain(fuse.fuse(_base(spark, sf), bind.steps(spark, sf)))


@query(
    f"""SELECT {BASE}, s.caffeine, s.alcohol, s.late_meal, s.work_travel
        FROM nights n LEFT JOIN tags s ON s.user_id = n.user_id AND s.date = n.date"""
)
def fuse_tags(spark, sf):
    return plain(fuse.fuse(_base(spark, sf), bind.tags(spark, sf)))


@query(
    f"""SELECT {BASE}, s.late_minutes, s.total_events, s.late_screen_flag, s.late_events
        FROM nights n LEFT JOIN screen s ON s.user_id = n.user_id AND s.date = n.date"""
)
def fuse_screen(spark, sf):
    return plain(fuse.fuse(_base(spark, sf), bind.screen(spark, sf)))


def _baseline_sql(column: str) -> str:
    mean = f"CASE WHEN count({column}) OVER w >= 7 THEN avg({column}) OVER w END"
    std = f"CASE WHEN count({column}) OVER w >= 7 THEN stddev_pop({column}) OVER w END"
    z = f"coalesce(CASE WHEN {std} > 0 THEN ({column} - {mean}) / {std} END, 0)"
    return ", ".join(
        [r6(mean, f"{column}_baseline"), r6(std, f"{column}_baseline_std"), r6(z, f"{column}_zscore")]
    )


W30 = "WINDOW w AS (PARTITION BY user_id ORDER BY date, start_ts, id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"


@query(
    f"""SELECT id, user_id, date, {r6('duration_min', 'duration_min')}, {r6('efficiency', 'efficiency')}, is_weekend,
        {r6('sleep_hours', 'sleep_hours')}, {r6('hrv_rmssd', 'hrv_rmssd')}, {r6('hrv_sdnn', 'hrv_sdnn')}, steps,
        caffeine, alcohol, late_meal, work_travel, late_minutes, total_events, late_screen_flag, late_events,
        {_baseline_sql('sleep_hours')}, {_baseline_sql('hrv_rmssd')}, {_baseline_sql('hrv_sdnn')}, {_baseline_sql('steps')}
        FROM (SELECT n.id, n.user_id, n.date, n.start_ts, n.duration_min, n.efficiency, n.is_weekend, n.sleep_hours,
                     h.hrv_rmssd, h.hrv_sdnn, s.steps, t.caffeine, t.alcohol, t.late_meal, t.work_travel,
                     c.late_minutes, c.total_events, c.late_screen_flag, c.late_events
              FROM nights n LEFT JOIN hrv h ON h.user_id = n.user_id AND h.date = n.date
              LEFT JOIN steps s ON s.user_id = n.user_id AND s.date = n.date
              LEFT JOIN tags t ON t.user_id = n.user_id AND t.date = n.date
              LEFT JOIN screen c ON c.user_id = n.user_id AND c.date = n.date) {W30}"""
)
def feature_store(spark, sf):
    """The flagship: sessions, four signals and the personal baselines."""
    store = fuse.feature_store(bind.nights(spark, sf), bind.signals(spark, sf), extra=["id"], found=bind.user_spread(spark, sf))
    return plain(store)


@query(f"SELECT id, user_id, date, {_baseline_sql('sleep_hours')}, {_baseline_sql('efficiency')} FROM nights {W30}")
def personal_baselines(spark, sf):
    n = bind.nights(spark, sf).select("id", "user_id", "date", "start_ts", "sleep_hours", "efficiency")
    done = baselines.personal_baselines(
        n, order=["date", "start_ts", "id"], columns=["sleep_hours", "efficiency", "hrv_rmssd"],
        found=bind.user_spread(spark, sf),
    )
    return plain(done.drop("start_ts", "sleep_hours", "efficiency"))


ROLL = ["sleep_hours_roll7", "sleep_hours_roll14", "efficiency_roll7", "efficiency_roll14"]
DEBT = ["sleep_debt_roll7", "sleep_debt_roll14"]


@query(f"SELECT id, {', '.join(r6(c, c) for c in ROLL)} FROM circ")
def rolling_means(spark, sf):
    return plain(circadian.rolling_means(bind.normalized(spark, sf), found=bind.user_spread(spark, sf)).select("id", *ROLL))


@query(f"SELECT id, {', '.join(r6(c, c) for c in DEBT)} FROM circ")
def sleep_debt(spark, sf):
    return plain(circadian.sleep_debt(bind.normalized(spark, sf), found=bind.user_spread(spark, sf)).select("id", *DEBT))


@query(f"SELECT id, {r6('midpoint_hour_local', 'midpoint_hour_local')}, {r6('social_jetlag', 'social_jetlag')} FROM circ")
def social_jetlag(spark, sf):
    done = circadian.social_jetlag(bind.normalized(spark, sf), found=bind.user_spread(spark, sf))
    return plain(done.select("id", "midpoint_hour_local", "social_jetlag"))


CIRC = ["sleep_hours", *ROLL, *DEBT, "midpoint_hour_local", "social_jetlag"]


@query(
    f"""SELECT id, user_id, start_ts, date, day_of_week, month, is_weekend, {', '.join(r6(c, c) for c in CIRC)}
        FROM circ"""
)
def circadian_features(spark, sf):
    done = bind.circadian(spark, sf)
    return plain(done.select("id", "user_id", "start_ts", "date", "day_of_week", "month", "is_weekend", *CIRC))


@query(
    f"""SELECT user_id, CAST(max(len) AS BIGINT) AS best_streak FROM (
          SELECT user_id, run, count(*) FILTER (good) AS len FROM (
            SELECT user_id, good, sum(CASE WHEN good THEN 0 ELSE 1 END) OVER
                   (PARTITION BY user_id ORDER BY start_ts, id ROWS UNBOUNDED PRECEDING) AS run
            FROM (SELECT *, sleep_hours BETWEEN 7 AND 9 AS good FROM nights)) GROUP BY 1, 2) GROUP BY 1"""
)
def healthy_streak(spark, sf):
    done = series.healthy_streak(
        bind.nights(spark, sf), keys=["user_id"], order=["start_ts", "id"], found=bind.user_spread(spark, sf)
    )
    return plain(done)


@query(
    f"""SELECT id, user_id, start_ts, {r6('sleep_hours', 'sleep_hours')} FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY start_ts DESC, id DESC) AS r FROM nights) WHERE r <= 7"""
)
def last_n_per_user(spark, sf):
    done = series.last_rows(bind.nights(spark, sf), 7, keys=["user_id"], order=["start_ts", "id"])
    return plain(done.select("id", "user_id", "start_ts", "sleep_hours"))


@query("SELECT id, user_id, start_ts FROM norm ORDER BY user_id, start_ts")
def sorted_sessions(spark, sf):
    n = bind.normalized(spark, sf).select("id", "user_id", "start_ts")
    return plain(series.sort_sessions(n))


@query(
    """SELECT id, date, CAST(hour(start_ts) AS BIGINT) AS hour, CAST(minute(start_ts) AS BIGINT) AS minute,
       isodow(start_ts) - 1 AS day_of_week, dayname(start_ts) AS day_name, CAST(month(start_ts) AS BIGINT) AS month,
       isoyear(start_ts) || '-W' || lpad(CAST(week(start_ts) AS VARCHAR), 2, '0') AS iso_week FROM nights"""
)
def calendar_features(spark, sf):
    done = series.calendar_features(bind.normalized(spark, sf))
    return plain(done.select("id", "date", "hour", "minute", "day_of_week", "day_name", "month", "iso_week"))


@query(
    f"""SELECT count(*) AS nights, {r6('avg(sleep_hours)', 'mean_hours')}, {r6('stddev_samp(sleep_hours)', 'std_hours')},
        {r6('quantile_cont(sleep_hours, 0.5)', 'median_hours')} FROM nights"""
)
def headline_metrics(spark, sf):
    return plain(profile.headline_metrics(bind.nights(spark, sf)))


# A key that is NULL for the sessions of one vendor.
VENDOR = "CASE WHEN source <> 'oura' THEN source END"


def _by_vendor(spark, sf):
    return bind.nights(spark, sf).withColumn("vendor", F.expr(VENDOR))


@query(
    f"""SELECT {VENDOR} AS vendor, count(*) AS nights, {r6('avg(sleep_hours)', 'mean_hours')},
        {r6('stddev_samp(sleep_hours)', 'std_hours')}, {r6('quantile_cont(sleep_hours, 0.5)', 'median_hours')}
        FROM nights GROUP BY 1"""
)
def keyed_headline(spark, sf):
    return plain(profile.headline_metrics(_by_vendor(spark, sf), keys=["vendor"]))


@query(
    f"""SELECT id, {r6('(duration_min - avg(duration_min) OVER w) / stddev_pop(duration_min) OVER w', 'duration_zscore')},
        abs((duration_min - avg(duration_min) OVER w) / stddev_pop(duration_min) OVER w) >= 3 AS is_outlier_duration
        FROM nights WINDOW w AS (PARTITION BY {VENDOR})"""
)
def keyed_zscore(spark, sf):
    rows = _by_vendor(spark, sf).drop("duration_zscore", "is_outlier_duration")
    return plain(canonical.zscore_duration(rows, ["vendor"]).select("id", "duration_zscore", "is_outlier_duration"))


@query(
    """SELECT 'start_ts' AS "column", count(start_ts) AS count, date_trunc('minute', make_timestamp(CAST(avg(epoch_us(start_ts)) AS BIGINT))) AS mean,
        date_trunc('minute', min(start_ts)) AS min, date_trunc('minute', quantile_cont(start_ts, 0.25)) AS q25,
        date_trunc('minute', quantile_cont(start_ts, 0.5)) AS q50, date_trunc('minute', quantile_cont(start_ts, 0.75)) AS q75,
        date_trunc('minute', max(start_ts)) AS max FROM nights"""
)
def describe_datetime(spark, sf):
    done = profile.describe_datetime(bind.nights(spark, sf), ["start_ts"])
    stamps = [F.date_trunc("minute", c).cast("timestamp_ntz").alias(c) for c in ("mean", "min", "q25", "q50", "q75", "max")]
    return done.select("column", "count", *stamps)


@query(
    f"SELECT date, start_ts, id, {r6('sleep_hours', 'sleep_hours')} FROM nights ORDER BY sleep_hours, date, start_ts, id LIMIT 1"
)
def shortest_night(spark, sf):
    return plain(profile.shortest_night(bind.nights(spark, sf), tie=["date", "start_ts", "id"]))


@query(
    """SELECT user_id, count(*) FILTER (sleep_hours < 5) AS short_nights, count(*) FILTER (sleep_hours > 9) AS long_nights
       FROM nights GROUP BY 1"""
)
def night_counts(spark, sf):
    return plain(profile.night_counts(bind.nights(spark, sf), keys=["user_id"]))


@query(f"SELECT {r6('avg(CASE WHEN sleep_hours BETWEEN 7 AND 9 THEN 1.0 ELSE 0.0 END)', 'healthy_ratio')} FROM nights")
def healthy_ratio(spark, sf):
    return plain(profile.healthy_ratio(bind.nights(spark, sf)))


@query(f"SELECT {r6('avg(CASE WHEN is_weekend THEN 1.0 ELSE 0.0 END) * 100', 'weekend_pct')} FROM nights")
def weekend_share(spark, sf):
    return plain(profile.weekend_share(bind.nights(spark, sf)))


@query(
    f"""SELECT user_id, {r6('coalesce(abs(avg(sleep_hours) FILTER (isodow(date) >= 6) - avg(sleep_hours) FILTER (isodow(date) < 6)), 0)', 'weekend_gap')}
        FROM nights GROUP BY 1"""
)
def weekend_gap(spark, sf):
    return plain(profile.weekend_gap(bind.nights(spark, sf), keys=["user_id"]))


@query(
    f"""SELECT CAST(d.no AS BIGINT) AS day_no, d.weekday, s.nights, {r6('s.avg_hours', 'avg_hours')}, {r6('s.std_hours', 'std_hours')}
        FROM (VALUES (0,'Monday'),(1,'Tuesday'),(2,'Wednesday'),(3,'Thursday'),(4,'Friday'),(5,'Saturday'),(6,'Sunday')) d(no, weekday)
        LEFT JOIN (SELECT isodow(date) - 1 AS no, count(sleep_hours) AS nights, avg(sleep_hours) AS avg_hours,
                          stddev_samp(sleep_hours) AS std_hours FROM nights GROUP BY 1) s ON s.no = d.no"""
)
def weekday_matrix(spark, sf):
    return plain(profile.weekday_matrix(bind.nights(spark, sf)))


@query(
    f"SELECT source, count(*) AS cnt, {r6('count(*) / sum(count(*)) OVER ()', 'share')} FROM nights GROUP BY 1"
)
def value_counts(spark, sf):
    return plain(profile.value_counts(bind.nights(spark, sf), "source"))


@query(
    f"""SELECT o_orderpriority AS "sourceName", {r6("avg((epoch(date_trunc('second', l_shipdate)) - epoch(date_trunc('second', o_orderdate))) / 3600.0)", 'mean_hours')},
        count(*) AS cnt FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1"""
)
def mean_by_source(spark, sf):
    return plain(profile.mean_by(secondary_sessions(bind.secondary_text(spark, sf)), "sourceName", "hours"))


@query(
    f"""SELECT CAST(g.bin AS BIGINT) AS bin, {r6('e.a + g.bin * (e.b - e.a) / 20', 'lower')},
        {r6('e.a + (g.bin + 1) * (e.b - e.a) / 20', 'upper')}, {r6('e.a + (g.bin + 0.5) * (e.b - e.a) / 20', 'midpoint')},
        coalesce(c.counts, 0) AS counts
        FROM range(20) g(bin), (SELECT min(sleep_hours) AS a, max(sleep_hours) AS b FROM nights) e
        LEFT JOIN (SELECT greatest(0, ceil((sleep_hours - a) / ((b - a) / 20)) - 1) AS bin, count(*) AS counts
                   FROM nights, (SELECT min(sleep_hours) AS a, max(sleep_hours) AS b FROM nights) GROUP BY 1) c
        ON c.bin = g.bin"""
)
def histogram(spark, sf):
    return plain(profile.histogram(bind.nights(spark, sf), "sleep_hours", 20))


@query(
    f"""SELECT source, n, {r6('mn', 'min')}, {r6('q1', 'q1')}, {r6('q2', 'median')}, {r6('q3', 'q3')}, {r6('mx', 'max')},
        {r6('q1 - 1.5 * (q3 - q1)', 'fence_low')}, {r6('q3 + 1.5 * (q3 - q1)', 'fence_high')}
        FROM (SELECT source, count(sleep_hours) AS n, min(sleep_hours) AS mn, max(sleep_hours) AS mx,
                     quantile_cont(sleep_hours, 0.25) AS q1, quantile_cont(sleep_hours, 0.5) AS q2,
                     quantile_cont(sleep_hours, 0.75) AS q3 FROM nights GROUP BY 1)"""
)
def box_stats(spark, sf):
    return plain(profile.box_stats(bind.nights(spark, sf), "sleep_hours", ["source"]))


@query(
    f"""SELECT CAST(g.point AS BIGINT) AS point, {r6('m.a - 3 * m.h + g.point * (m.b - m.a + 6 * m.h) / 199', 'x')},
        {r6('sum(v.c * exp(-0.5 * pow((m.a - 3 * m.h + g.point * (m.b - m.a + 6 * m.h) / 199 - v.x) / m.h, 2))) / (any_value(m.n) * any_value(m.h) * sqrt(2 * pi()))', 'density')}
        FROM range(200) g(point), (SELECT sleep_hours AS x, count(*) AS c FROM nights GROUP BY 1) v,
             (SELECT count(*) AS n, stddev_samp(sleep_hours) * pow(count(*), -0.2) AS h, min(sleep_hours) AS a,
                     max(sleep_hours) AS b FROM nights) m
        GROUP BY g.point, m.a, m.b, m.h"""
)
def kde_density(spark, sf):
    """Exact: every distinct value adds its kernel."""
    return plain(profile.kde_density(bind.nights(spark, sf), "sleep_hours", bins=None))


@query(
    f"""SELECT CAST(g.point AS BIGINT) AS point, {r6('m.a - 3 * m.h + g.point * (m.b - m.a + 6 * m.h) / 199', 'x')},
        {r6('sum(v.c * exp(-0.5 * pow((m.a - 3 * m.h + g.point * (m.b - m.a + 6 * m.h) / 199 - (m.a + v.j * (m.b - m.a) / 64)) / m.h, 2))) / (any_value(m.n) * any_value(m.h) * sqrt(2 * pi()))', 'density')}
        FROM range(200) g(point),
             (SELECT j, sum(w) AS c FROM (SELECT unnest([i, i + 1]) AS j, unnest([1 - (p - i), p - i]) AS w
                FROM (SELECT (sleep_hours - a) / ((b - a) / 64) AS p, least(floor((sleep_hours - a) / ((b - a) / 64)), 63) AS i
                      FROM nights, (SELECT min(sleep_hours) AS a, max(sleep_hours) AS b FROM nights))) GROUP BY j) v,
             (SELECT count(*) AS n, stddev_samp(sleep_hours) * pow(count(*), -0.2) AS h, min(sleep_hours) AS a,
                     max(sleep_hours) AS b FROM nights) m
        GROUP BY g.point, m.a, m.b, m.h"""
)
def kde_binned(spark, sf):
    """Through 64 bins."""
    return plain(profile.kde_density(bind.nights(spark, sf), "sleep_hours", bins=64))


PROFILED = ["user_id", "efficiency", "is_nap", "tz", "source"]
DISTINCT = "SELECT DISTINCT user_id, efficiency, is_nap, tz, source FROM sessions"


@query(
    f"""SELECT 'rows' AS metric, count(*) AS value FROM sessions
        UNION ALL SELECT 'columns', 5
        UNION ALL SELECT 'duplicates', count(*) - (SELECT count(*) FROM ({DISTINCT})) FROM sessions"""
)
def profile_summary(spark, sf):
    return plain(profile.profile_summary(bind.sessions(spark, sf).select(*PROFILED)))


@query(DISTINCT)
def dedupe_rows(spark, sf):
    return plain(profile.dedupe_rows(bind.sessions(spark, sf).select(*PROFILED)), ).select(*PROFILED)


STORE = ["hrv_rmssd", "hrv_sdnn", "steps"]


def _wide(spark, sf):
    n = _base(spark, sf)
    return fuse.fuse(fuse.fuse(n, bind.hrv(spark, sf)), bind.steps(spark, sf))


@query(
    """SELECT unnest(['id', 'sleep_hours', 'hrv_rmssd', 'hrv_sdnn', 'steps']) AS "column",
              unnest([count(*) FILTER (n.id IS NULL), count(*) FILTER (n.sleep_hours IS NULL),
                      count(*) FILTER (h.hrv_rmssd IS NULL), count(*) FILTER (h.hrv_sdnn IS NULL),
                      count(*) FILTER (s.steps IS NULL)]) AS missing
       FROM nights n LEFT JOIN hrv h ON h.user_id = n.user_id AND h.date = n.date
       LEFT JOIN steps s ON s.user_id = n.user_id AND s.date = n.date"""
)
def missing_counts(spark, sf):
    return plain(profile.missing_counts(_wide(spark, sf).select("id", "sleep_hours", *STORE)))


def _describe_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS "count", {r6(f'avg({column})', 'mean')},
        {r6(f'stddev_samp({column})', 'std')}, {r6(f'min({column})', 'min')}, {r6(f'quantile_cont({column}, 0.25)', 'q25')},
        {r6(f'quantile_cont({column}, 0.5)', 'q50')}, {r6(f'quantile_cont({column}, 0.75)', 'q75')},
        {r6(f'max({column})', 'max')} FROM wide"""


@query(
    """SELECT * FROM (WITH wide AS (SELECT n.sleep_hours, n.efficiency, h.hrv_rmssd, CAST(s.steps AS DOUBLE) AS steps
         FROM nights n LEFT JOIN hrv h ON h.user_id = n.user_id AND h.date = n.date
         LEFT JOIN steps s ON s.user_id = n.user_id AND s.date = n.date) """
    + " UNION ALL ".join(_describe_sql(c) for c in ("sleep_hours", "efficiency", "hrv_rmssd", "steps"))
    + ")"
)
def describe_numeric(spark, sf):
    n = bind.nights(spark, sf).select("user_id", "date", "sleep_hours", "efficiency")
    wide = fuse.fuse(fuse.fuse(n, bind.hrv(spark, sf)), bind.steps(spark, sf))
    return plain(profile.describe_numeric(wide, ["sleep_hours", "efficiency", "hrv_rmssd", "steps"]))


def _category_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS "count", count(DISTINCT {column}) AS "unique",
        (SELECT {column} FROM sessions GROUP BY 1 ORDER BY count(*) DESC, {column} LIMIT 1) AS top,
        (SELECT count(*) FROM sessions GROUP BY {column} ORDER BY count(*) DESC LIMIT 1) AS freq FROM sessions"""


@query(" UNION ALL ".join(_category_sql(c) for c in ("id", "user_id", "tz", "source")))
def describe_categorical(spark, sf):
    return plain(profile.describe_categorical(bind.sessions(spark, sf), ["id", "user_id", "tz", "source"]))


@query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS "distinct" FROM sessions"""
        for c in ("id", "user_id", "duration_min", "efficiency", "is_nap", "tz", "source")
    )
)
def distinct_counts(spark, sf):
    s = bind.sessions(spark, sf)
    return plain(
        profile.distinct_counts(s, ["id", "user_id", "duration_min", "efficiency", "is_nap", "tz", "source"])
    )


SCENARIOS = [(shift, cup) for shift in (-120, -60, 0, 30, 120) for cup in (False, True)]


@query(
    f"""SELECT u.user_id, {r6('u.m', 'baseline_hours')}, s.shift_min, s.caffeine,
        {r6('-0.5 * s.shift_min / 60.0 - CASE WHEN s.caffeine THEN 0.3 ELSE 0.0 END', 'delta_hours')},
        {r6('greatest(0, u.m - 0.5 * s.shift_min / 60.0 - CASE WHEN s.caffeine THEN 0.3 ELSE 0.0 END)', 'projected_hours')}
        FROM (SELECT user_id, avg(sleep_hours) AS m FROM nights GROUP BY 1) u,
             (SELECT CAST(a AS BIGINT) AS shift_min, b AS caffeine FROM
              (SELECT unnest([-120, -60, 0, 30, 120]) AS a), (SELECT unnest([false, true]) AS b)) s"""
)
def whatif_scenarios(spark, sf):
    return plain(scenarios.whatif_scenarios(bind.nights(spark, sf), SCENARIOS))


def _coach_sql() -> str:
    tests = {"average_sleep": "average_sleep < 7", "sleep_debt": "sleep_debt > 2", "weekend_gap": "weekend_gap > 1.5"}
    parts = []
    for rule, test in tests.items():
        yes, no = scenarios.COACH_TEXTS[rule]
        parts.append(
            f"""SELECT user_id, '{rule}' AS rule, {test} AS triggered,
                CASE WHEN {test} THEN '{yes}' ELSE '{no}' END AS text FROM levels"""
        )
    return f"""SELECT * FROM (WITH levels AS (SELECT user_id, avg(sleep_hours) AS average_sleep, avg(sleep_debt_roll7) AS sleep_debt,
        coalesce(abs(avg(sleep_hours) FILTER (isodow(date) >= 6) - avg(sleep_hours) FILTER (isodow(date) < 6)), 0) AS weekend_gap
        FROM circ GROUP BY 1) {' UNION ALL '.join(parts)})"""


@query(_coach_sql())
def coach_rules(spark, sf):
    done = scenarios.coach_rules(bind.circadian(spark, sf))
    return done.select("user_id", F.inline("insights"))
