"""Daily series, detection and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import bind
from catalog.bind import plain
from catalog.registry import query
from catalog.tables_sql import r6
from nightly.operators import decompose, detect, forecast as fc, models, regress, series
from nightly.operators.skew import series_tasks
from nightly.session import materialize, scratch_path
from nightly.sinks.models import load_fitted, save_fitted

KEY = ["series"]


def _dense(spark, sf):
    tasks = series_tasks(bind.supplier_rows(spark, sf), KEY)
    return series.calendar_densify(bind.supplier_daily(spark, sf), keys=KEY, tasks=tasks)


def _regular(spark, sf):
    return series.regular_series(bind.supplier_rows(spark, sf), "sleep_hours", keys=KEY)


@query(
    f"""SELECT date, {r6('avg(duration_min / 60)', 'target')}, {r6('avg(efficiency)', 'efficiency')},
        {r6('avg(CASE WHEN is_nap THEN 1.0 ELSE 0.0 END)', 'is_nap')}, {r6('avg(duration_min)', 'duration_min')},
        {r6('avg(day_of_week)', 'day_of_week')}, {r6('avg(sleep_debt_roll7)', 'sleep_debt_roll7')} FROM circ GROUP BY 1"""
)
def target_daily(spark, sf):
    done = series.daily_target(
        bind.circadian(spark, sf), "target", column="duration_min", transform="minutes_to_hours"
    )
    return plain(
        done.select("date", "target", "efficiency", "is_nap", "duration_min", "day_of_week", "sleep_debt_roll7")
    )


@query(f"SELECT user_id, date, {r6('sleep_hours', 'sleep_hours')} FROM udaily")
def series_daily_mean(spark, sf):
    return plain(bind.user_daily(spark, sf))


@query(f"SELECT series, date, {r6('sleep_hours', 'sleep_hours')} FROM sdense")
def calendar_densify(spark, sf):
    return plain(_dense(spark, sf))


@query(f"SELECT series, date, {r6('pv', 'sleep_hours')} FROM sframed")
def forward_fill(spark, sf):
    return plain(series.forward_fill(_dense(spark, sf), ["sleep_hours"], keys=KEY))


@query(f"SELECT series, date, {r6('sleep_hours', 'sleep_hours')} FROM sregular")
def interpolate_linear(spark, sf):
    return plain(series.interpolate_linear(_dense(spark, sf), "sleep_hours", keys=KEY))


@query(f"SELECT series, date, {r6('sleep_hours', 'sleep_hours')} FROM sregular")
def regular_series(spark, sf):
    """Daily mean, densify and interpolate in one pass."""
    return plain(_regular(spark, sf))


@query(
    f"""SELECT series, date, {r6('last_value(efficiency IGNORE NULLS) OVER (PARTITION BY series ORDER BY date ROWS UNBOUNDED PRECEDING)', 'efficiency')}
        FROM (SELECT g.series, g.date, d.efficiency FROM sdense g LEFT JOIN (
                SELECT l_suppkey AS series, CAST(l_shipdate AS DATE) AS date, avg(l_discount) AS efficiency
                FROM lineitem GROUP BY 1, 2) d ON d.series = g.series AND d.date = g.date)"""
)
def exog_align(spark, sf):
    spine = _dense(spark, sf).select("series", "date")
    return plain(series.exog_align(spine, bind.supplier_rows(spark, sf), ["efficiency"], keys=KEY))


@query(
    f"""SELECT series, date, {r6('y_t', 'y_t')}, {r6('y_next', 'y_next')} FROM (
        SELECT series, date, sleep_hours AS y_t, lead(sleep_hours) OVER (PARTITION BY series ORDER BY date) AS y_next
        FROM sdaily) WHERE y_next IS NOT NULL"""
)
def lag_pairs(spark, sf):
    return plain(series.lag_pairs(bind.supplier_daily(spark, sf), "sleep_hours", keys=KEY))


def _acf_sql(lags: int) -> str:
    sums = ", ".join(
        f"sum(d * lag{k}) / sum(d * d) AS r{k}" for k in range(1, lags + 1)
    )
    lagged = ", ".join(f"lag(d, {k}) OVER (ORDER BY date) AS lag{k}" for k in range(1, lags + 1))
    rows = " UNION ALL ".join(f"SELECT CAST({k} AS BIGINT) AS lag, r{k} AS acf, n FROM s" for k in range(1, lags + 1))
    return f"""SELECT * FROM (WITH c AS (SELECT date, sleep_hours - avg(sleep_hours) OVER () AS d FROM daily),
        l AS (SELECT d, {lagged} FROM c), s AS (SELECT count(*) AS n, {sums} FROM l),
        r AS (SELECT CAST(0 AS BIGINT) AS lag, 1.0 AS acf, n FROM s UNION ALL {rows})
        SELECT lag, {r6('acf', 'acf')}, {r6('CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054 * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN acf * acf END) OVER (ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END', 'band')}
        FROM r)"""


@query(_acf_sql(30))
def acf(spark, sf):
    return plain(series.acf(bind.primary(spark, sf), "sleep_hours", 30))


@query(
    f"""SELECT series, date, {r6('observed', 'observed')}, {r6('trend', 'trend')}, {r6('seasonal', 'seasonal')},
        {r6('resid', 'resid')} FROM sdec"""
)
def seasonal_decompose(spark, sf):
    return plain(decompose.seasonal_decompose(_regular(spark, sf), "sleep_hours", 7, keys=KEY))


@query("SELECT user_id, date, CAST(rn AS BIGINT) AS rn, n_train, is_test FROM usplit")
def backtest_split(spark, sf):
    return plain(fc.backtest_split(bind.user_daily(spark, sf), keys=["user_id"]).drop("sleep_hours"))


@query(
    """SELECT user_id, CAST(last + step AS DATE) AS date, CAST(step AS BIGINT) AS step
       FROM (SELECT user_id, max(date) AS last FROM udaily GROUP BY 1), (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS step)"""
)
def forecast_calendar(spark, sf):
    return plain(series.forecast_calendar(bind.user_daily(spark, sf), 14, keys=["user_id"]))


@query(
    f"""SELECT user_id, date, round(sleep_hours + 1e-9, 6) + 0.0 AS history, CAST(NULL AS DOUBLE) AS forecast FROM usplit WHERE NOT is_test
        UNION ALL SELECT user_id, date, CAST(NULL AS DOUBLE), round(prediction + 1e-9, 6) + 0.0 FROM uroll"""
)
def history_plus_forecast(spark, sf):
    daily = bind.user_daily(spark, sf)
    split = fc.backtest_split(daily, keys=["user_id"])
    history = split.where(~F.col("is_test")).select("user_id", "date", F.col("sleep_hours").alias("history"))
    ahead = fc.rolling_mean_forecast(daily, "sleep_hours", keys=["user_id"])
    return plain(
        series.history_plus_forecast(
            history, ahead.select("user_id", "date", F.col("prediction").alias("forecast"))
        )
    )


@query(
    f"""SELECT series, date, {r6('sleep_hours', 'sleep_hours')}, position, {r6('jump', 'jump')} FROM (
          SELECT *, stddev_pop(jump) OVER (PARTITION BY series) AS sd FROM (
            SELECT *, row_number() OVER (PARTITION BY series ORDER BY date) - 1 AS position,
                   count(*) OVER (PARTITION BY series) AS n,
                   abs(sleep_hours - lag(sleep_hours) OVER (PARTITION BY series ORDER BY date)) AS jump FROM sdaily))
        WHERE n >= 10 AND jump >= CASE WHEN sd > 0 THEN 3.5 * sd ELSE 3.5 END"""
)
def change_points(spark, sf):
    return plain(detect.change_points(bind.supplier_daily(spark, sf), "sleep_hours", keys=KEY, penalty=3.5))


UF = """SELECT 'rolling_mean' AS model, 'sleep_hours' AS target, user_id, date, prediction, actual, actual - prediction AS residual
        FROM uroll"""


def _rolled(spark, sf):
    made = fc.rolling_mean_forecast(bind.user_daily(spark, sf), "sleep_hours", keys=["user_id"])
    return made.withColumns({"model": F.lit("rolling_mean"), "target": F.lit("sleep_hours")})


def _kept_residuals(spark, sf):
    """Residuals written once: the detectors read them several times."""
    made = detect.residuals(_rolled(spark, sf)).select("user_id", "date", "model", "residual")
    return materialize(made, "residuals")


@query(
    f"""SELECT user_id, date, {r6('residual', 'residual')}, abs(residual - mu) >= 3 * sd AND sd > 0 AS is_anomaly,
        'zscore' AS method, 3.0::DOUBLE AS threshold
        FROM (SELECT *, avg(residual) OVER () AS mu, stddev_pop(residual) OVER () AS sd FROM ({UF}))"""
)
def anomalies_zscore(spark, sf):
    made = _kept_residuals(spark, sf)
    return plain(detect.anomalies_zscore(made, keys=["model"]).drop("model"))


@query(
    f"""SELECT user_id, date, {r6('residual', 'residual')},
        (residual < q1 - 1.5 * (q3 - q1) OR residual > q3 + 1.5 * (q3 - q1)) AND q3 > q1 AS is_anomaly,
        'iqr' AS method, 1.5::DOUBLE AS threshold
        FROM ({UF}) r JOIN (SELECT model, quantile_cont(residual, 0.25) AS q1, quantile_cont(residual, 0.75) AS q3
                            FROM ({UF}) GROUP BY 1) q ON q.model = r.model"""
)
def anomalies_iqr(spark, sf):
    made = _kept_residuals(spark, sf)
    return plain(detect.anomalies_iqr(made, keys=["model"], threshold=1.5).drop("model"))


@query(f"SELECT user_id, date, {r6('residual', 'residual')} FROM ({UF})")
def residuals(spark, sf):
    return plain(detect.residuals(_rolled(spark, sf)).select("user_id", "date", "residual"))


@query(
    f"""SELECT series, {r6('intercept', 'intercept')}, {r6('slope', 'slope')}, pairs, {r6('last_value', 'last_value')},
        last_date FROM ar1"""
)
def ar1_ols(spark, sf):
    return plain(fc.ar1_fit(_regular(spark, sf), "sleep_hours", keys=KEY))


@query(
    f"""SELECT series, CAST(last_date + step AS DATE) AS date, CAST(step AS BIGINT) AS step,
        {r6('intercept * (1 - pow(slope, step)) / (1 - slope) + pow(slope, step) * last_value', 'forecast')}
        FROM ar1, (SELECT CAST(unnest(range(1, 15)) AS INTEGER) AS step)"""
)
def ar1_forecast(spark, sf):
    return plain(fc.ar1_forecast(_regular(spark, sf), "sleep_hours", 14, keys=KEY))


@query(
    f"""SELECT user_id, date, {r6('level', 'prediction')}, {r6('level - 0.5', 'lower')}, {r6('level + 0.5', 'upper')},
        {r6('sleep_hours', 'actual')}
        FROM (SELECT *, avg(CASE WHEN rn <= k THEN sleep_hours END) OVER (PARTITION BY user_id) AS level
              FROM (SELECT *, least(n, greatest(n - least(7, greatest(1, n // 3)), greatest(10, n - 30))) AS k FROM usplit))
        WHERE rn > k"""
)
def naive_mean_forecast(spark, sf):
    return plain(fc.naive_mean_forecast(bind.user_daily(spark, sf), "sleep_hours", keys=["user_id"]))


@query(
    f"""SELECT user_id, {r6('avg(sleep_hours)', 'level')}, max(date) AS last_date FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS r FROM udaily) WHERE r <= 7 GROUP BY 1"""
)
def baseline_rolling_mean(spark, sf):
    return plain(fc.last_rolling_mean(bind.user_daily(spark, sf), "sleep_hours", keys=["user_id"]))


@query(
    f"""SELECT user_id, date, {r6('prediction', 'prediction')}, {r6('lower', 'lower')}, {r6('upper', 'upper')},
        {r6('actual', 'actual')} FROM uroll"""
)
def rolling_mean_backtest(spark, sf):
    return plain(fc.rolling_mean_forecast(bind.user_daily(spark, sf), "sleep_hours", keys=["user_id"]))


@query(
    f"""SELECT u.user_id, u.date, {r6('u.prediction', 'prediction')}, {r6('d.sleep_hours', 'actual')}
        FROM uroll u LEFT JOIN udaily d ON d.user_id = u.user_id AND d.date = u.date"""
)
def forecast_vs_actual(spark, sf):
    daily = bind.user_daily(spark, sf)
    ahead = fc.rolling_mean_forecast(daily, "sleep_hours", keys=["user_id"]).drop("lower", "upper")
    return plain(fc.forecast_vs_actual(ahead, daily, "sleep_hours", keys=["user_id"]))


@query(
    f"""SELECT user_id, {r6('avg(abs(actual - prediction))', 'mae')},
        {r6('avg(abs(actual - prediction) / nullif(abs(actual), 0))', 'mape')},
        {r6('avg(CASE WHEN actual BETWEEN lower AND upper THEN 1.0 ELSE 0.0 END)', 'coverage')} FROM uroll GROUP BY 1"""
)
def backtest_metrics(spark, sf):
    return plain(fc.backtest_metrics(_rolled(spark, sf), ["user_id"]))


@query(
    f"""SELECT * FROM (WITH d AS (SELECT date, sleep_hours AS y, row_number() OVER (ORDER BY date) - 1 AS rn,
            lag(sleep_hours) OVER (ORDER BY date) AS x,
            CASE WHEN count(*) OVER c = 7 THEN avg(sleep_hours) OVER c END AS trend FROM dregular
            WINDOW c AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
          m AS (SELECT rn % 7 AS slot, avg(y - trend) AS m FROM d GROUP BY 1),
          f AS (SELECT regr_intercept(y, x) AS a, regr_slope(y, x) AS b, arg_max(y, date) AS v, max(date) AS last FROM d)
        SELECT CAST(f.last + 1 AS DATE) AS next_date, {r6('f.a + f.b * f.v', 'next_value')},
          {r6('(SELECT avg(trend) FROM d)', 'mean_trend')},
          {r6('(SELECT avg(abs(m.m - (SELECT avg(m) FROM m))) FROM d JOIN m ON m.slot = d.rn % 7)', 'seasonal_swing')} FROM f)"""
)
def run_summary(spark, sf):
    regular = series.regular_series(bind.primary(spark, sf), "sleep_hours")
    ahead = fc.ar1_forecast(regular, "sleep_hours", 14)
    return plain(fc.run_summary(ahead, decompose.seasonal_decompose(regular, "sleep_hours", 7)))


def _eliminated(equations: str, width: int) -> str:
    """Recursive table ``solved``: the equations (series, a) with a unit matrix on the left after ``width`` rounds."""
    return f"""e AS (SELECT series, 0 AS i, a FROM {equations} UNION ALL
          SELECT series, i + 1, list_transform(a, lambda r, j: CASE WHEN j = i + 1 THEN list_transform(r, lambda v: v / r[i + 1])
            ELSE list_transform(list_zip(r, a[i + 1]), lambda p: p[1] - r[i + 1] / a[i + 1][i + 1] * p[2]) END) FROM e WHERE i < {width}),
        solved AS (SELECT series, list_transform(a, lambda r: r[{width + 1}]) AS beta FROM e WHERE i = {width})"""


LAGS = 30
_AUTOREG = f"""WITH RECURSIVE ys AS (SELECT series, list(sleep_hours ORDER BY date) AS y, count(*) AS n, max(date) AS last
            FROM sregular GROUP BY series HAVING count(*) > {LAGS}),
        x AS (SELECT series, list_concat([list_transform(y[{LAGS + 1}:], lambda v: 1.0::DOUBLE)],
            list_transform(range(1, {LAGS + 1}), lambda k: y[{LAGS + 1} - k:n - k])) AS x, y[{LAGS + 1}:] AS y FROM ys),
        eq AS (SELECT series, list_transform(x, lambda u: list_transform(list_append(x, y), lambda v: list_dot_product(u, v))) AS a FROM x),
        {_eliminated("eq", LAGS + 1)}"""


@query(
    f"""SELECT * FROM ({_AUTOREG} SELECT series, term, round(beta[term + 1] + 1e-9, 6) + 0.0 AS coefficient
        FROM solved, (SELECT unnest(range(0, {LAGS + 1})) AS term))"""
)
def autoreg_fit(spark, sf):
    return plain(regress.autoreg_fit(_regular(spark, sf), "sleep_hours", LAGS, keys=KEY))


@query(
    f"""SELECT * FROM ({_AUTOREG}, w AS (SELECT s.series, 0 AS step, list_reverse(y) AS known, beta, last FROM solved s JOIN ys ON s.series = ys.series
            UNION ALL SELECT series, step + 1, list_prepend(beta[1] + list_dot_product(beta[2:], known[1:{LAGS}]), known[1:{LAGS}]), beta, last
            FROM w WHERE step < 14)
        SELECT series, CAST(last + step AS DATE) AS date, CAST(step AS BIGINT) AS step, round(known[1] + 1e-9, 6) + 0.0 AS forecast
        FROM w WHERE step > 0)"""
)
def autoreg_forecast(spark, sf):
    return plain(regress.autoreg_forecast(_regular(spark, sf), "sleep_hours", LAGS, 14, keys=KEY))


@query(
    f"""SELECT * FROM ({_AUTOREG}, f AS (SELECT series, date, sleep_hours AS actual, row_number() OVER o AS rn,
            list_reverse(list(sleep_hours) OVER (PARTITION BY series ORDER BY date ROWS BETWEEN {LAGS} PRECEDING AND 1 PRECEDING)) AS past
            FROM sregular WINDOW o AS (PARTITION BY series ORDER BY date))
        SELECT f.series, date, {r6('actual', 'actual')}, {r6('beta[1] + list_dot_product(beta[2:], past)', 'fitted')}
        FROM f JOIN solved ON f.series = solved.series WHERE rn > {LAGS})"""
)
def autoreg_fitted(spark, sf):
    return plain(regress.autoreg_fitted(_regular(spark, sf), "sleep_hours", LAGS, keys=KEY))


# One lag, one feature, differences over a week; gaps are filled from before.
def _arx(days: str) -> str:
    return f"""WITH RECURSIVE d AS ({days}),
        g AS (SELECT g.series, g.date, last_value(y IGNORE NULLS) OVER o AS y, last_value(x IGNORE NULLS) OVER o AS x
            FROM (SELECT series, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM d GROUP BY series) g
            LEFT JOIN d ON d.series = g.series AND d.date = g.date
            WINDOW o AS (PARTITION BY g.series ORDER BY g.date ROWS UNBOUNDED PRECEDING)),
        t AS (SELECT *, row_number() OVER o - 1 AS t, count(*) OVER (PARTITION BY series) AS n, y - lag(y, 7) OVER o AS dy, x - lag(x, 7) OVER o AS dx
            FROM g WHERE y IS NOT NULL WINDOW o AS (PARTITION BY series ORDER BY date)),
        r AS (SELECT *, lag(dy) OVER (PARTITION BY series ORDER BY date) AS dl,
            least(n, greatest(n - least(7, greatest(1, n // 3)), greatest(10, n - 30))) AS k FROM t),
        m AS (SELECT series, [[count(*), sum(dl), sum(dx), sum(dy)], [sum(dl), sum(dl * dl), sum(dl * dx), sum(dl * dy)],
              [sum(dx), sum(dx * dl), sum(dx * dx), sum(dx * dy)]]::DOUBLE[][] AS a, count(*) AS rows, sum(dy * dy) AS dd
            FROM r WHERE t >= 8 AND t < k GROUP BY series HAVING count(*) >= 5),
        {_eliminated("m", 3)},
        f AS (SELECT s.series, beta, sqrt(greatest(0, dd - list_dot_product(beta, list_transform(a, lambda v: v[4]))) / greatest(1, rows - 3)) AS sigma
            FROM solved s JOIN m ON s.series = m.series),
        h AS (SELECT series, avg(y) AS mean, list(y ORDER BY t DESC)[1:8] AS recent FROM r WHERE t < k GROUP BY series),
        p AS (SELECT r.series, r.date, r.t - k AS step, y, coalesce(dx, 0) AS dx FROM r WHERE t >= k),
        w AS (SELECT f.series, -1::BIGINT AS step, recent AS known, 0.0::DOUBLE AS shock, list_transform(range(7), lambda i: 0.0::DOUBLE) AS weight, 0.0::DOUBLE AS square
            FROM f JOIN h ON f.series = h.series
            UNION ALL SELECT o.series, o.step, list_prepend(known[7] + beta[1] + beta[2] * (known[1] - known[8]) + beta[3] * dx, known),
              o.shock, list_prepend(o.shock + weight[7], weight), square + (o.shock + weight[7]) ** 2
            FROM (SELECT w.series, w.step + 1 AS step, known, CASE WHEN w.step < 0 THEN 1.0 ELSE beta[2] * shock END AS shock, weight, square, beta
                  FROM w JOIN f ON w.series = f.series) o JOIN p ON p.series = o.series AND p.step = o.step),
        z AS (SELECT p.series, p.date, coalesce(known[1], mean) AS prediction, coalesce(1.959963984540054 * sigma * sqrt(square), 0.5) AS half, y AS actual
            FROM p JOIN h ON h.series = p.series LEFT JOIN w ON w.series = p.series AND w.step = p.step LEFT JOIN f ON f.series = p.series)"""


_SUPPLIER_DAYS = """SELECT l_suppkey AS series, CAST(l_shipdate AS DATE) AS date, avg(l_quantity * 0.3) AS y, avg(l_discount) AS x
            FROM lineitem GROUP BY 1, 2"""


@query(
    f"""SELECT * FROM ({_arx(_SUPPLIER_DAYS)} SELECT series, date, {r6('prediction', 'prediction')}, {r6('prediction - half', 'lower')},
        {r6('prediction + half', 'upper')}, {r6('actual', 'actual')} FROM z)"""
)
def seasonal_arx_forecast(spark, sf):
    return plain(
        regress.seasonal_arx_forecast(
            bind.supplier_rows(spark, sf), "sleep_hours", keys=KEY, exog=["efficiency"]
        )
    )


def _user_target(spark, sf):
    daily = series.daily_target(
        bind.circadian(spark, sf), "target", column="duration_min", transform="minutes_to_hours", keys=["user_id"]
    )
    return materialize(daily, "daily")


@query()
def gbt_backtest(spark, sf):
    """One model of boosted trees over the daily rows of all users, scored from its saved copy."""
    daily = _user_target(spark, sf)
    fitted = models.fit("gbt", daily, "target", keys=["user_id"], learning_rate=0.1, max_depth=3, n_estimators=100)
    path = save_fitted(spark, fitted, scratch_path(spark, "gbt"))
    return plain(models.score(load_fitted(spark, path), daily))


_USER_DAYS = """SELECT user_id AS series, date, avg(duration_min / 60) AS y, avg(efficiency) AS x FROM circ GROUP BY 1, 2"""


@query(
    f"""SELECT * FROM ({_arx(_USER_DAYS)}, f4 AS (
          SELECT 'seasonal_arx' AS model, series AS user_id, date, prediction, prediction - half AS lower, prediction + half AS upper, actual FROM z
          UNION ALL SELECT 'rolling_mean', user_id, date, prediction, lower, upper, actual FROM uroll
          UNION ALL SELECT 'flat', user_id, date, prediction, NULL, NULL, actual FROM uroll
          UNION ALL SELECT 'naive_mean', user_id, date, level, level - 0.5, level + 0.5, sleep_hours
          FROM (SELECT *, avg(CASE WHEN rn <= k THEN sleep_hours END) OVER (PARTITION BY user_id) AS level
                FROM (SELECT *, least(n, greatest(n - least(7, greatest(1, n // 3)), greatest(10, n - 30))) AS k FROM usplit)) WHERE rn > k),
        j AS (SELECT user_id, count(*) AS jumps FROM (SELECT *, stddev_pop(jump) OVER (PARTITION BY user_id) AS sd FROM (
              SELECT *, count(*) OVER (PARTITION BY user_id) AS n,
                abs(sleep_hours - lag(sleep_hours) OVER (PARTITION BY user_id ORDER BY date)) AS jump FROM udaily))
            WHERE n >= 10 AND jump >= CASE WHEN sd > 0 THEN 5 * sd ELSE 5 END GROUP BY 1)
        SELECT f4.user_id, model AS model_name, 'sleep_hours' AS target, {r6('avg(abs(actual - prediction))', 'mae')},
          {r6('avg(abs(actual - prediction) / nullif(abs(actual), 0))', 'mape')},
          {r6('avg(CASE WHEN lower IS NULL THEN NULL WHEN actual BETWEEN lower AND upper THEN 1.0 ELSE 0.0 END)', 'coverage')},
          coalesce(any_value(jumps), 0)::BIGINT AS change_points, count(*) AS test_days
        FROM f4 LEFT JOIN j ON j.user_id = f4.user_id GROUP BY f4.user_id, model)"""
)
def train_sweep(spark, sf):
    """Metrics, change points and anomalies of every user and model, each scored from its saved coefficients."""
    from nightly.plans.pipelines import TARGETS, sweep, sweep_reports

    chosen = {"seasonal_arx": {"exog": ["efficiency"]}, "rolling_mean": {}, "naive_mean": {}, "flat": {}}
    keys = ["user_id"]
    made, daily = sweep(bind.circadian(spark, sf), TARGETS, chosen, keys=keys, save_to=scratch_path(spark, "models"))
    reports = sweep_reports(materialize(made, "forecast"), daily, keys=keys)
    return plain(
        reports.select(
            "user_id",
            "model_name",
            "target",
            "metrics.mae",
            "metrics.mape",
            "metrics.coverage",
            F.size("change_points").alias("change_points"),
            F.size("anomalies").alias("test_days"),
        )
    )
