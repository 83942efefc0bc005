"""Queries of the pattern, anomaly and forecast family (H), streams (K) and weather relation (L)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayspan.functions import columns as C
from wayspan.operators import anomaly, enrich, forecast, patterns, stats
from wayspan.plans.cleaning import WEATHER_SQL, scratch
from wayspan.plans.registry import normal_quantile_sql, query
from wayspan.plans.tables import readings, route_table, shipments, table, weather_table
from wayspan.streaming import feed as streams

HOURS_SQL = "hh AS (SELECT CAST(unnest(generate_series(0, 23)) AS INTEGER) AS hour)"
DAYS_SQL = "dd AS (SELECT unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']) AS day_of_week)"
CODES_SQL = "rc AS (SELECT DISTINCT route_code FROM r)"


@query("h1_hour_weekday_means", f"""WITH {HOURS_SQL}, {DAYS_SQL}, {CODES_SQL}, m AS (SELECT route_code, day_of_week, hour, avg(avg_speed) AS avg_speed FROM r GROUP BY ALL)
SELECT rc.route_code, dd.day_of_week, hh.hour, m.avg_speed FROM rc CROSS JOIN dd CROSS JOIN hh
LEFT JOIN m ON m.route_code = rc.route_code AND m.day_of_week = dd.day_of_week AND m.hour = hh.hour""", doubles="avg_speed")
def _(spark, d):
    return patterns.hour_weekday_means(readings(spark, d))


CELL_SQL = """SELECT route_code, CAST(date AS VARCHAR) AS date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
CAST((day(date) + isodow(date_trunc('month', date)) - 2) // 7 AS INTEGER) AS grid_row, CAST(isodow(date) - 1 AS INTEGER) AS grid_col, isodow(date) >= 6 AS is_weekend,
CAST(weekofyear(date) AS INTEGER) AS week_of_year, avg_speed FROM m"""


@query("h2_calendar_cells", f"WITH m AS (SELECT route_code, date, avg(avg_speed) AS avg_speed FROM s GROUP BY ALL) {CELL_SQL}", needs="s", doubles="avg_speed")
def _(spark, d):
    return patterns.calendar_cells(shipments(spark, d))


@query("h2_calendar_cells_last_hour", f"""WITH h AS (SELECT route_code, date, hour, avg(avg_speed) AS v FROM r GROUP BY ALL),
m AS (SELECT route_code, date, arg_max(v, hour) AS avg_speed FROM h GROUP BY ALL) {CELL_SQL}""", doubles="avg_speed")
def _(spark, d):
    return patterns.calendar_cells(readings(spark, d), last_hour=True)


KEPT_SQL = """
h AS (SELECT route_code, timestamp AS t, avg(avg_speed) AS v FROM r GROUP BY ALL),
sp AS (SELECT route_code, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS t FROM (SELECT route_code, min(t) AS lo, max(t) AS hi FROM h GROUP BY 1)),
j AS (SELECT sp.route_code, sp.t, h.v FROM sp LEFT JOIN h ON h.route_code = sp.route_code AND h.t = sp.t),
f1 AS (SELECT route_code, t, last_value(v IGNORE NULLS) OVER (PARTITION BY route_code ORDER BY t ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS v FROM j),
f2 AS (SELECT route_code, t, first_value(v IGNORE NULLS) OVER (PARTITION BY route_code ORDER BY t ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS v FROM f1),
x AS (SELECT route_code, t, v, row_number() OVER (PARTITION BY route_code ORDER BY t) - 1 AS i, count(*) OVER (PARTITION BY route_code) AS n FROM f2 WHERE v IS NOT NULL)"""
DECOMP_SQL = f"""{KEPT_SQL},
y AS (
  SELECT *, CASE WHEN i >= 84 AND i < n - 84 THEN (sum(v) OVER (PARTITION BY route_code ORDER BY i ROWS BETWEEN 83 PRECEDING AND 83 FOLLOWING)
         + 0.5e0 * (lag(v, 84) OVER (PARTITION BY route_code ORDER BY i) + lead(v, 84) OVER (PARTITION BY route_code ORDER BY i))) / 168e0 END AS rt
  FROM x WHERE n >= 336),
ln AS (
  SELECT route_code, regr_slope(rt, i) FILTER (WHERE i >= 84 AND i < 252) AS s0, regr_intercept(rt, i) FILTER (WHERE i >= 84 AND i < 252) AS i0,
         regr_slope(rt, i) FILTER (WHERE i >= n - 252 AND i < n - 84) AS s1, regr_intercept(rt, i) FILTER (WHERE i >= n - 252 AND i < n - 84) AS i1
  FROM y GROUP BY route_code),
tr AS (SELECT y.*, CASE WHEN i < 84 THEN i0 + s0 * i WHEN i >= n - 84 THEN i1 + s1 * i ELSE rt END AS trend, i % 168 AS phase FROM y JOIN ln USING (route_code)),
ph AS (SELECT route_code, phase, m - avg(m) OVER (PARTITION BY route_code) AS seasonal FROM (SELECT route_code, phase, avg(v - trend) AS m FROM tr GROUP BY ALL)),
dec AS (SELECT tr.route_code, CAST(t AS VARCHAR) AS timestamp, i AS idx, CAST(tr.phase AS INTEGER) AS phase, v AS observed, trend, seasonal, v - trend - seasonal AS resid
        FROM tr JOIN ph ON ph.route_code = tr.route_code AND ph.phase = tr.phase)"""


@query("h3_decomposition", f"WITH {DECOMP_SQL} SELECT * FROM dec", doubles="observed trend seasonal resid", digits=5)
def _(spark, d):
    return forecast.decomposition(readings(spark, d))


@query("h3_decomposition_status", f"""WITH {KEPT_SQL}, k AS (SELECT route_code, count(*) AS n_hours FROM x GROUP BY 1), w AS (SELECT route_code, count(*) AS n_rows FROM r GROUP BY 1)
SELECT route_code, n_rows, coalesce(n_hours, 0) AS n_hours, CASE WHEN n_rows < 168 THEN 'too_few_rows' WHEN coalesce(n_hours, 0) < 336 THEN 'too_few_hours' ELSE 'ok' END AS status
FROM w LEFT JOIN k USING (route_code)""", needs="u")
def _(spark, d):
    return forecast.decomposition_status(readings(spark, d, "user_id"))


BAND_SQL = "mean - coalesce(std, 0) AS lower, mean + coalesce(std, 0) AS upper"


@query("h4_hour_profiles", f"""WITH {HOURS_SQL}, {CODES_SQL}, m AS (SELECT route_code, hour, avg(avg_speed) AS mean, stddev(avg_speed) AS std, count(*) AS count FROM r GROUP BY ALL)
SELECT rc.route_code, hh.hour, mean, std, count, {BAND_SQL} FROM rc CROSS JOIN hh LEFT JOIN m ON m.route_code = rc.route_code AND m.hour = hh.hour""",
       needs="u", doubles="mean std lower upper")
def _(spark, d):
    return patterns.hour_profiles(readings(spark, d, "user_id"))


@query("h5_route_correlations", """
WITH m AS (SELECT route_code, timestamp, avg(avg_speed) AS v FROM r GROUP BY ALL)
SELECT a.route_code AS route_a, b.route_code AS route_b, CASE WHEN count(*) > 1 THEN corr(a.v, b.v) END AS correlation FROM m a JOIN m b USING (timestamp) GROUP BY ALL""",
       doubles="correlation")
def _(spark, d):
    return patterns.route_correlations(readings(spark, d))


RANK_SQL = """hr AS (SELECT hour, route_code, v AS avg_speed, CAST(row_number() OVER (PARTITION BY hour ORDER BY v DESC, route_code) AS INTEGER) AS rank
FROM (SELECT hour, route_code, avg(avg_speed) AS v FROM r GROUP BY ALL))"""


@query("h6_hourly_ranking", f"WITH {RANK_SQL} SELECT * FROM hr", needs="u", doubles="avg_speed")
def _(spark, d):
    return patterns.hourly_ranking(readings(spark, d, "user_id"))


@query("h7_hourly_rank_volatility", f"""WITH {RANK_SQL} SELECT route_code, avg(rank) AS avg_rank, stddev_pop(rank) AS std_rank, min(rank) AS min_rank, max(rank) AS max_rank,
max(rank) - min(rank) AS rank_range FROM hr GROUP BY route_code""", needs="u", doubles="avg_rank std_rank")
def _(spark, d):
    return patterns.hourly_rank_volatility(readings(spark, d, "user_id"))


def scaled_sql(columns: list[str]) -> str:
    return ", ".join(f"CASE WHEN max({c}) OVER () = min({c}) OVER () THEN {c} - min({c}) OVER () ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END AS {c}" for c in columns)


@query("h8_route_profiles", f"""WITH m AS (SELECT route_code, avg(avg_speed) AS avg_speed, avg(duration) AS duration, avg(distance) AS distance, variance(avg_speed) AS speed_variance,
stddev(avg_speed) AS speed_std, min(avg_speed) AS speed_min, max(avg_speed) AS speed_max FROM s GROUP BY route_code) SELECT route_code, {scaled_sql(list(patterns.METRICS))} FROM m""",
       needs="s", doubles=" ".join(patterns.METRICS))
def _(spark, d):
    return patterns.route_profiles(shipments(spark, d))


@query("h9_route_radar", f"""WITH m AS (SELECT route_code, avg(avg_speed) AS mean_speed, 1 / (1 + stddev(avg_speed) / avg(avg_speed)) AS consistency,
avg(avg_speed) FILTER (WHERE hour IN (7, 8, 9, 17, 18, 19)) AS peak_speed, avg(avg_speed) FILTER (WHERE hour BETWEEN 10 AND 16) AS offpeak_speed,
avg(avg_speed) FILTER (WHERE is_weekend) AS weekend_speed FROM r GROUP BY route_code)
SELECT route_code, {scaled_sql(list(patterns.RADAR))} FROM m""", needs="u", doubles=" ".join(patterns.RADAR))
def _(spark, d):
    return patterns.route_radar(readings(spark, d, "user_id"))


def histogram_sql(source: str, column: str) -> str:
    return f"""SELECT g.route_code, CAST(b AS INTEGER) AS bin, coalesce(c, 0) AS count,
  CASE WHEN hi = lo THEN lo - 0.5e0 ELSE lo END + CASE WHEN hi = lo THEN 1e0 ELSE hi - lo END / 30 * b AS bin_start,
  CASE WHEN hi = lo THEN lo - 0.5e0 ELSE lo END + CASE WHEN hi = lo THEN 1e0 ELSE hi - lo END / 30 * (b + 1) AS bin_end
FROM (SELECT route_code, min({column}) AS lo, max({column}) AS hi FROM {source} GROUP BY 1) g CROSS JOIN (SELECT unnest(generate_series(0, 29)) AS b)
LEFT JOIN (
  SELECT t.route_code, CASE WHEN hi = lo THEN 15 ELSE least(CAST(floor(({column} - lo) / (hi - lo) * 30) AS INTEGER), 29) END AS b, count(*) AS c
  FROM {source} t JOIN (SELECT route_code, min({column}) AS lo, max({column}) AS hi FROM {source} GROUP BY 1) e ON e.route_code = t.route_code GROUP BY 1, 2) k
  ON k.route_code = g.route_code AND k.b = g.b"""


HIST_SQL = "\n".join(f"SELECT *, '{c}' AS measure FROM ({histogram_sql('s', c)}) {u}".replace("k.b = g.b", "k.b = b") for c, u in (("avg_speed", "UNION ALL"), ("duration", "")))


@query("h10_marginal_histograms", HIST_SQL.replace("(SELECT unnest(generate_series(0, 29)) AS b)", "(SELECT unnest(generate_series(0, 29)) AS bb)")
       .replace("CAST(b AS INTEGER) AS bin", "CAST(bb AS INTEGER) AS bin").replace("/ 30 * b AS", "/ 30 * bb AS").replace("(b + 1)", "(bb + 1)").replace("k.b = b", "k.b = bb"),
       needs="s", doubles="bin_start bin_end")
def _(spark, d):
    return patterns.marginal_histograms(shipments(spark, d))


@query("h10_speed_duration_points", "SELECT route_code, avg_speed, duration FROM s", needs="s", doubles="avg_speed")
def _(spark, d):
    return patterns.speed_duration_points(shipments(spark, d))


@query("h11_speed_by_band", """SELECT route_code, time_category, count(*) AS count, avg(avg_speed) AS mean, quantile_cont(avg_speed, 0.25) AS p25, median(avg_speed) AS median,
quantile_cont(avg_speed, 0.75) AS p75 FROM r GROUP BY ALL""", doubles="mean p25 median p75")
def _(spark, d):
    return patterns.speed_by_band(readings(spark, d))


@query("h11_speed_by_chart_band", """SELECT route_code, CASE WHEN hour BETWEEN 6 AND 9 THEN 'morning_rush' WHEN hour BETWEEN 10 AND 15 THEN 'midday' WHEN hour BETWEEN 16 AND 19 THEN 'evening_rush' ELSE 'night' END AS time_category,
count(*) AS count, avg(avg_speed) AS mean, quantile_cont(avg_speed, 0.25) AS p25, median(avg_speed) AS median, quantile_cont(avg_speed, 0.75) AS p75 FROM r GROUP BY ALL""", doubles="mean p25 median p75")
def _(spark, d):
    return patterns.speed_by_band(readings(spark, d), chart_bands=True)


@query("h12_cdf_points", "SELECT route_code, avg_speed, row_number() OVER (PARTITION BY route_code ORDER BY avg_speed) / CAST(count(*) OVER (PARTITION BY route_code) AS DOUBLE) AS cdf FROM r", doubles="avg_speed cdf")
def _(spark, d):
    return patterns.cdf_points(readings(spark, d), expand=True)


@query("h12_cdf_markers", """WITH o AS (SELECT route_code, avg_speed, row_number() OVER (PARTITION BY route_code ORDER BY avg_speed) - 1 AS i, count(*) OVER (PARTITION BY route_code) AS n FROM s)
SELECT route_code, p AS share, avg_speed FROM o, (SELECT unnest([0.25e0, 0.5e0, 0.75e0]) AS p) WHERE i = floor(p * n)""", needs="s", doubles="share avg_speed")
def _(spark, d):
    return patterns.cdf_markers(shipments(spark, d))


CONTROL_SQL = """cc AS (SELECT event_id, route_code, avg_speed, avg(avg_speed) OVER (PARTITION BY route_code) AS mu, stddev(avg_speed) OVER (PARTITION BY route_code) AS sd FROM r),
cf AS (SELECT *, coalesce(avg_speed > mu + 3 * sd OR avg_speed < mu - 3 * sd, false) AS bad FROM cc)"""


@query("h13_control_chart", f"WITH {CONTROL_SQL} SELECT event_id, route_code, mu AS mean_speed, mu + 3 * sd AS ucl, mu - 3 * sd AS lcl, mu + 2 * sd AS uwl, mu - 2 * sd AS lwl, bad AS is_anomaly FROM cf",
       doubles="mean_speed ucl lcl uwl lwl")
def _(spark, d):
    return anomaly.control_chart(readings(spark, d)).select("event_id", "route_code", "mean_speed", "ucl", "lcl", "uwl", "lwl", "is_anomaly")


@query("h13_control_summary", f"WITH {CONTROL_SQL} SELECT route_code, count(*) AS n_rows, count(*) FILTER (WHERE bad) AS n_anomalies, count(*) FILTER (WHERE bad) * 100e0 / count(*) AS anomaly_pct FROM cf GROUP BY 1",
       doubles="anomaly_pct")
def _(spark, d):
    return anomaly.control_summary(readings(spark, d))


CONTEXT_SQL = """cx AS (SELECT *, avg(avg_speed) OVER (PARTITION BY route_code, hour, day_of_week) AS expected_speed, stddev(avg_speed) OVER (PARTITION BY route_code, hour, day_of_week) AS context_std FROM r),
dv AS (SELECT *, avg_speed - expected_speed AS deviation FROM cx)"""


def timeline_sql() -> str:
    return f"""WITH {CONTEXT_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY route_code ORDER BY ts, event_id) AS i, count(*) OVER (PARTITION BY route_code) AS n,
  stddev(deviation) OVER (PARTITION BY route_code) AS sd FROM dv),
ma AS (SELECT a.event_id, avg(b.deviation) AS m FROM o a JOIN o b ON b.route_code = a.route_code
   AND b.i BETWEEN a.i - (least(168, a.n) - 1 - (least(168, a.n) - 1) // 2) AND a.i + (least(168, a.n) - 1) // 2 GROUP BY 1)
SELECT o.event_id, route_code, expected_speed, deviation, ma.m AS deviation_ma, coalesce(abs(deviation) > 3 * sd, false) AS is_anomaly FROM o JOIN ma USING (event_id)"""


@query("h14_deviation_timeline", timeline_sql(), doubles="expected_speed deviation deviation_ma", digits=5)
def _(spark, d):
    out = anomaly.deviation_timeline(readings(spark, d), order=["ts", "event_id"])
    return out.select("event_id", "route_code", "expected_speed", "deviation", "deviation_ma", "is_anomaly")


@query("h14_deviation_timeline_short", timeline_sql(), needs="u", doubles="expected_speed deviation deviation_ma", digits=5)
def _(spark, d):
    out = anomaly.deviation_timeline(readings(spark, d, "user_id"), order=["ts", "event_id"])
    return out.select("event_id", "route_code", "expected_speed", "deviation", "deviation_ma", "is_anomaly")


@query("h15_anomaly_scatter", f"WITH {CONTEXT_SQL} SELECT event_id, route_code, expected_speed, deviation, deviation / CASE WHEN context_std = 0 THEN 1 ELSE context_std END AS deviation_sigma FROM dv",
       doubles="expected_speed deviation deviation_sigma", digits=5)
def _(spark, d):
    return anomaly.anomaly_scatter(readings(spark, d)).select("event_id", "route_code", "expected_speed", "deviation", "deviation_sigma")


@query("h15_anomaly_share", f"""WITH {CONTEXT_SQL}, k AS (SELECT coalesce(abs(deviation / CASE WHEN context_std = 0 THEN 1 ELSE context_std END) > 3, false) AS bad FROM dv)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE bad) AS n_anomalies, count(*) FILTER (WHERE bad) * 100e0 / count(*) AS anomaly_pct FROM k""", doubles="anomaly_pct")
def _(spark, d):
    return anomaly.anomaly_share(readings(spark, d))


@query("h16_outlier_summary", f"""WITH {CONTEXT_SQL}, k AS (SELECT *, deviation / nullif(context_std, 0) AS ds FROM dv)
SELECT CAST(timestamp AS VARCHAR) AS timestamp, route_code, coalesce(label_short, route_code) AS route_label, hour, day_of_week, round_even(avg_speed, 3) AS avg_speed,
       round_even(expected_speed, 3) AS expected_speed, round_even(deviation, 3) AS deviation, round_even(ds, 3) AS deviation_sigma
FROM k LEFT JOIN routes USING (route_code) WHERE abs(ds) >= 2.5e0 ORDER BY round(abs(ds), 9) DESC, ts, event_id LIMIT 20""", needs="r routes",
       doubles="avg_speed expected_speed deviation deviation_sigma", digits=3)
def _(spark, d):
    return anomaly.outlier_summary(readings(spark, d), route_table(spark, d), threshold=2.5, tie_break=["ts", "event_id"])


@query("h17_residual_summary")
def _(spark, d):
    return stats.residual_analysis(readings(spark, d))["summary"]


@query("h17_residual_histogram", f"WITH {DECOMP_SQL}, z AS (SELECT route_code, resid FROM dec), h30 AS ({histogram_sql('z', 'resid')}) SELECT route_code, sum(count)::BIGINT AS n, count(*) AS bins FROM h30 GROUP BY 1"
       .replace("(SELECT unnest(generate_series(0, 29)) AS b)", "(SELECT unnest(generate_series(0, 29)) AS bb)").replace("CAST(b AS INTEGER) AS bin", "CAST(bb AS INTEGER) AS bin")
       .replace("/ 30 * b AS", "/ 30 * bb AS").replace("(b + 1)", "(bb + 1)").replace("k.b = g.b", "k.b = bb"))
def _(spark, d):
    # float noise may move a value over a bin edge, so totals are compared
    hist = stats.residual_analysis(readings(spark, d))["histogram"]
    return hist.groupBy("route_code").agg(F.sum("count").alias("n"), F.count(F.lit(1)).alias("bins"))


@query("h17_residual_acf", f"""WITH {DECOMP_SQL}, c AS (SELECT route_code, idx, resid - avg(resid) OVER (PARTITION BY route_code) AS c FROM dec),
k AS (SELECT unnest(generate_series(0, 24)) AS lag)
SELECT a.route_code, CAST(lag AS INTEGER) AS lag, sum(a.c * b.c) / any_value(v) AS acf FROM c a CROSS JOIN k JOIN c b ON b.route_code = a.route_code AND b.idx = a.idx - lag
JOIN (SELECT route_code, sum(c * c) AS v FROM c GROUP BY 1) t ON t.route_code = a.route_code GROUP BY 1, 2""", doubles="acf")
def _(spark, d):
    return stats.residual_analysis(readings(spark, d))["acf"]


@query("h17_residual_spread", f"WITH {DECOMP_SQL} SELECT route_code, avg(resid) AS mean, stddev(resid) AS std, count(*) AS n FROM dec GROUP BY 1", doubles="mean std", digits=5)
def _(spark, d):
    # the test on the residuals has no SQL counterpart; h17_residual_summary runs it
    return stats.residual_analysis(readings(spark, d))["summary"].select("route_code", "mean", "std", "n")


@query("h17_residual_qq", f"""WITH {DECOMP_SQL},
o AS (SELECT route_code, resid AS x, row_number() OVER (PARTITION BY route_code ORDER BY resid) AS i, count(*) OVER (PARTITION BY route_code) AS n FROM dec),
p AS (SELECT *, CASE WHEN i = n THEN pow(0.5e0, 1e0 / n) WHEN i = 1 THEN 1 - pow(0.5e0, 1e0 / n) ELSE (i - 0.3175e0) / (n + 0.365e0) END AS p FROM o)
SELECT route_code, {normal_quantile_sql('p')} AS theoretical, x AS ordered FROM p""", doubles="theoretical ordered", digits=5)
def _(spark, d):
    return stats.residual_analysis(readings(spark, d))["qq"]


@query("h18_forecast", """
WITH c AS (SELECT route_code, hour, day_of_week, avg(avg_speed) AS m, stddev(avg_speed) AS s, count(*) AS n FROM r GROUP BY ALL),
a AS (SELECT route_code, max(timestamp) AS last, avg(avg_speed) AS m, stddev(avg_speed) AS s FROM r GROUP BY 1),
g AS (SELECT route_code, m AS ma, s AS sa, unnest(generate_series(last + INTERVAL 1 HOUR, last + INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS t FROM a),
e AS (SELECT g.route_code, t, CASE WHEN c.n IS NULL THEN ma ELSE c.m END AS f, CASE WHEN c.n IS NULL THEN sa ELSE c.s / sqrt(c.n) END AS er, c.n IS NULL AS fb
      FROM g LEFT JOIN c ON c.route_code = g.route_code AND c.hour = hour(t) AND c.day_of_week = dayname(t))
SELECT route_code, CAST(t AS VARCHAR) AS timestamp, f AS forecast, f - 1.96e0 * er AS ci_lower, f + 1.96e0 * er AS ci_upper, fb AS is_fallback FROM e""",
       needs="u", doubles="forecast ci_lower ci_upper")
def _(spark, d):
    return forecast.forecast(readings(spark, d, "user_id"))


@query("h18_recent_readings", "SELECT event_id, route_code FROM (SELECT *, max(timestamp) OVER (PARTITION BY route_code) AS last FROM r) WHERE timestamp >= last - INTERVAL 48 HOUR")
def _(spark, d):
    return forecast.recent_readings(readings(spark, d)).select("event_id", "route_code")


@query("h19_typical_days", f"""WITH {HOURS_SQL}, rd AS (SELECT DISTINCT route_code, day_of_week FROM r), m AS (SELECT route_code, day_of_week, hour, avg(avg_speed) AS mean, stddev(avg_speed) AS std FROM r GROUP BY ALL)
SELECT rd.route_code, rd.day_of_week, hh.hour, mean, std, {BAND_SQL} FROM rd CROSS JOIN hh LEFT JOIN m ON m.route_code = rd.route_code AND m.day_of_week = rd.day_of_week AND m.hour = hh.hour""",
       doubles="mean std lower upper")
def _(spark, d):
    return patterns.typical_days(readings(spark, d))


TYPICAL_SQL = """l AS (SELECT *, max(date) OVER (PARTITION BY route_code) AS ref_date FROM r),
ty AS (SELECT route_code, hour, avg(avg_speed) AS tm, stddev(avg_speed) AS ts2 FROM l WHERE dayname(date) = dayname(ref_date) AND date <> ref_date GROUP BY ALL),
cur AS (SELECT l.event_id, l.route_code, l.hour, l.ref_date, l.avg_speed, tm, ts2 FROM l LEFT JOIN ty ON ty.route_code = l.route_code AND ty.hour = l.hour WHERE l.date = ref_date)"""


@query("h20_current_vs_typical", f"""WITH {TYPICAL_SQL} SELECT event_id, route_code, hour, CAST(ref_date AS VARCHAR) AS ref_date, tm AS typical_mean, ts2 AS typical_std, avg_speed - tm AS deviation,
coalesce(abs(avg_speed - tm) > 2 * ts2, false) AS is_anomaly FROM cur""", doubles="typical_mean typical_std deviation")
def _(spark, d):
    out = anomaly.current_vs_typical(readings(spark, d))
    return out.select("event_id", "route_code", "hour", "ref_date", "typical_mean", "typical_std", "deviation", "is_anomaly")


@query("h21_monthly_stats", "SELECT route_code, strftime(date, '%Y-%m') AS month_name, avg(avg_speed) AS mean, stddev(avg_speed) AS std, count(*) AS count FROM s GROUP BY ALL", needs="s", doubles="mean std")
def _(spark, d):
    return patterns.monthly_stats(shipments(spark, d))


LAG_SQL = """m AS (SELECT route_code, timestamp AS t, avg(avg_speed) AS v FROM r GROUP BY ALL),
pr AS (SELECT a.route_code AS route_a, b.route_code AS route_b, t, a.v AS va, b.v AS vb, row_number() OVER (PARTITION BY a.route_code, b.route_code ORDER BY t) AS i,
              count(*) OVER (PARTITION BY a.route_code, b.route_code) AS n FROM m a JOIN m b USING (t) WHERE a.route_code <> b.route_code),
lg AS (SELECT x.route_a, x.route_b, CAST(k AS INTEGER) AS lag, CASE WHEN count(*) > 1 THEN corr(x.va, y.vb) END AS correlation
       FROM pr x CROSS JOIN (SELECT unnest(generate_series(-24, 24)) AS k) JOIN pr y ON y.route_a = x.route_a AND y.route_b = x.route_b AND y.i = x.i + k
       WHERE x.n >= 24 GROUP BY ALL)"""


@query("h22_lag_correlations", f"WITH {LAG_SQL} SELECT * FROM lg", doubles="correlation")
def _(spark, d):
    return forecast.lag_correlations(readings(spark, d))


@query("h22_best_lags", f"""WITH {LAG_SQL} SELECT route_a, route_b, lag AS best_lag, correlation AS best_correlation FROM (
SELECT *, row_number() OVER (PARTITION BY route_a, route_b ORDER BY round(abs(correlation), 9) DESC, lag) AS rn FROM lg WHERE correlation IS NOT NULL) WHERE rn = 1""", doubles="best_correlation")
def _(spark, d):
    return forecast.best_lags(forecast.lag_correlations(readings(spark, d)))


@query("h22_lag_correlations_hours", """
WITH m AS (SELECT route_code, timestamp AS t, avg(avg_speed) AS v FROM r GROUP BY ALL),
p AS (SELECT a.route_code AS route_a, b.route_code AS route_b FROM m a JOIN m b ON a.t = b.t AND a.route_code <> b.route_code GROUP BY ALL HAVING count(*) >= 24),
c AS (SELECT a.route_code AS route_a, b.route_code AS route_b, date_diff('hour', a.t, b.t) AS lag, CASE WHEN count(*) > 1 AND var_pop(a.v) > 1e-9 AND var_pop(b.v) > 1e-9 THEN corr(a.v, b.v) END AS correlation
  FROM m a JOIN m b ON a.route_code <> b.route_code AND b.t BETWEEN a.t - INTERVAL 24 HOUR AND a.t + INTERVAL 24 HOUR GROUP BY ALL)
SELECT route_a, route_b, CAST(k AS INTEGER) AS lag, correlation FROM (SELECT *, unnest(range(-24, 25)) AS k FROM p) p LEFT JOIN c ON c.route_a = p.route_a AND c.route_b = p.route_b AND c.lag = p.k""".replace("SELECT route_a, route_b, CAST(k", "SELECT p.route_a, p.route_b, CAST(k"), doubles="correlation")
def _(spark, d):
    return forecast.lag_correlations(readings(spark, d), regularize=True)


@query("h22_lag_correlations_pairs", f"WITH {LAG_SQL} SELECT * FROM lg WHERE (least(route_a, route_b), greatest(route_a, route_b)) IN (SELECT DISTINCT least(u.event_type, v.event_type), greatest(u.event_type, v.event_type) FROM events u JOIN events v ON v.user_id = u.user_id + 1 AND u.event_type <> v.event_type AND u.event_type[1] = 'p')", doubles="correlation")
def _(spark, d):
    """Pairs of event types, one with a p, that two neighbouring users have."""
    events = table(spark, d, "events").select("user_id", "event_type").distinct()
    other = events.select((F.col("user_id") - 1).alias("user_id"), F.col("event_type").alias("route_b"))
    pairs = events.filter("startswith(event_type, 'p')").withColumnRenamed("event_type", "route_a").join(other, "user_id").select("route_a", "route_b").distinct()
    return forecast.lag_correlations(readings(spark, d), pairs=pairs)


@query("h23_best_hours", """WITH m AS (SELECT route_code, hour, avg(avg_speed) AS v FROM r GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY route_code ORDER BY v DESC, hour) AS x, row_number() OVER (PARTITION BY route_code ORDER BY v, hour) AS y FROM m)
SELECT a.route_code, coalesce(label_short, a.route_code) AS route_label, a.hour AS best_hour, a.v AS best_speed, c.hour AS worst_hour, c.v AS worst_speed, a.v - c.v AS speed_range
FROM b a JOIN b c ON c.route_code = a.route_code AND a.x = 1 AND c.y = 1 LEFT JOIN routes ON routes.route_code = a.route_code""", needs="r routes", doubles="best_speed worst_speed speed_range")
def _(spark, d):
    return patterns.best_hours(readings(spark, d), route_table(spark, d))


@query("h23_hourly_speeds", "SELECT route_code, hour, avg(avg_speed) AS avg_speed FROM r GROUP BY ALL", needs="u", doubles="avg_speed")
def _(spark, d):
    return patterns.hourly_speeds(readings(spark, d, "user_id"))


LINKED_SQL = "WITH p AS (SELECT * FROM r WHERE route_code IS NOT NULL)"


@query("h24_linked_series", f"{LINKED_SQL} SELECT route_code, CAST(timestamp AS VARCHAR) AS timestamp, avg_speed, duration, distance FROM p", needs="u", doubles="avg_speed")
def _(spark, d):
    return patterns.linked_views(readings(spark, d, "user_id"))[0]


@query("h24_linked_boxes", f"""{LINKED_SQL} SELECT route_code, min(avg_speed) AS min, quantile_cont(avg_speed, 0.25) AS p25, median(avg_speed) AS median, quantile_cont(avg_speed, 0.75) AS p75, max(avg_speed) AS max FROM p GROUP BY 1""",
       needs="u", doubles="min p25 median p75 max")
def _(spark, d):
    return patterns.linked_views(readings(spark, d, "user_id"))[1]


@query("h24_linked_profile", f"{LINKED_SQL} SELECT route_code, hour, avg(avg_speed) AS mean, stddev(avg_speed) AS std FROM p GROUP BY ALL", needs="u", doubles="mean std")
def _(spark, d):
    return patterns.linked_views(readings(spark, d, "user_id"))[2]


def summary_sql(source: str, label: str) -> str:
    stats_cols = {"avg_speed": "avg(avg_speed)", "std_speed": "stddev(avg_speed)", "min_speed": "min(avg_speed)", "max_speed": "max(avg_speed)", "median_speed": "median(avg_speed)",
                  "p25_speed": "quantile_cont(avg_speed, 0.25)", "p75_speed": "quantile_cont(avg_speed, 0.75)", "avg_duration": "avg(duration)"}
    cols = ", ".join(f"round_even({e}, 2) AS {n}" for n, e in stats_cols.items())
    share = "round_even(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100, 2)"
    return f"SELECT route_code, {label} AS route_label, count(*) AS observations, {cols}, {share} AS completeness_pct, {share} AS row_share_pct FROM {source} GROUP BY ALL"


SUMMARY = "avg_speed std_speed min_speed max_speed median_speed p25_speed p75_speed avg_duration completeness_pct row_share_pct"


def bucket_sql(expr: str, step: str, source: str) -> str:
    return f"""WITH b AS (SELECT route_code, {expr} AS bk, avg(avg_speed) AS avg_speed, avg(duration) AS duration FROM {source} GROUP BY ALL),
sp AS (SELECT route_code, CAST(unnest(generate_series(lo, hi, INTERVAL {step})) AS DATE) AS bk FROM (SELECT route_code, CAST(min(bk) AS TIMESTAMP) AS lo, CAST(max(bk) AS TIMESTAMP) AS hi FROM b GROUP BY 1)),
z AS (SELECT sp.route_code, b.avg_speed, b.duration FROM sp LEFT JOIN b ON b.route_code = sp.route_code AND b.bk = sp.bk)"""


@query("h25_summary_hourly", summary_sql("(SELECT r.*, label_short FROM r LEFT JOIN routes USING (route_code))", "coalesce(label_short, route_code)").replace("GROUP BY ALL", "GROUP BY route_code, coalesce(label_short, route_code)"),
       needs="r routes", doubles=SUMMARY, digits=2)
def _(spark, d):
    return patterns.summary_table(readings(spark, d), route_table(spark, d), level="H")


@query("h25_summary_daily", f"{bucket_sql('date', '1 DAY', 's')} {summary_sql('z', 'route_code').replace('GROUP BY ALL', 'GROUP BY route_code')}", needs="s", doubles=SUMMARY, digits=2)
def _(spark, d):
    return patterns.summary_table(shipments(spark, d), level="D")


WEEKS_SQL = "(SELECT * FROM s WHERE timestamp >= TIMESTAMP '1996-03-05' AND timestamp <= TIMESTAMP '1999-10-20')"


@query("h25_summary_weekly", f"""{bucket_sql("CAST(date_trunc('week', date) + INTERVAL 6 DAY AS DATE)", '7 DAY', WEEKS_SQL)}
{summary_sql('z', 'route_code').replace('GROUP BY ALL', 'GROUP BY route_code')}""", needs="s", doubles=SUMMARY, digits=2)
def _(spark, d):
    return patterns.summary_table(shipments(spark, d), level="W", start="1996-03-05", end="1999-10-20")


@query("h26_date_spine", "SELECT strftime(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)), '%Y-%m-%d') AS date FROM s", needs="s")
def _(spark, d):
    return patterns.date_spine(shipments(spark, d))


@query("h27_route_options", "SELECT coalesce(label_short, route_code) AS route_label, route_code FROM (SELECT DISTINCT route_code FROM r) LEFT JOIN routes USING (route_code)", needs="r routes")
def _(spark, d):
    return enrich.route_options(readings(spark, d), route_table(spark, d))


@query("h28_bucket_means", """SELECT 'H' AS level, route_code, CAST(timestamp AS VARCHAR) AS bucket, avg(avg_speed) AS avg_speed, avg(duration) AS duration, avg(distance) AS distance FROM r GROUP BY ALL
UNION ALL SELECT 'D', route_code, CAST(CAST(date AS TIMESTAMP) AS VARCHAR), avg(avg_speed), avg(duration), avg(distance) FROM r GROUP BY ALL
UNION ALL SELECT 'W', route_code, CAST(CAST(date_trunc('week', date) + INTERVAL 6 DAY AS TIMESTAMP) AS VARCHAR), avg(avg_speed), avg(duration), avg(distance) FROM r GROUP BY ALL""",
       doubles="avg_speed duration distance")
def _(spark, d):
    df = readings(spark, d)
    parts = [patterns.bucket_means(df, level).withColumn("level", F.lit(level)) for level in ("H", "D", "W")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- K, L ---------------------------------------------------------------------------------------------

def _stream(spark, d):
    """The events file of the folder, as a stream of readings."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    raw = streams.file_stream(spark, f"{d}/event[s].parquet", schema)
    k = F.get_json_object("props", "$.k").cast("int")
    return raw.select("event_id", "ts", F.col("event_type").alias("route_code"), C.speed_kmh("value", k + 10).alias("avg_speed"))


@query("k1_stream_dedup", "SELECT DISTINCT route_code, CAST(timestamp AS VARCHAR) AS hour_bucket FROM r")
def _(spark, d):
    path = scratch(spark, "dedup")
    streams.run_available(streams.dedup_hourly(_stream(spark, d)), path, path + "-state")
    return spark.read.parquet(path).select("route_code", F.col("hour_bucket").cast("string").alias("hour_bucket"))


@query("k1_stream_cleaned_feed", """
WITH a AS (SELECT event_id, ts, route_code, timestamp AS h, ts >= (SELECT max(ts) FROM r) - INTERVAL 24 HOUR AS recent FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY h, route_code, recent ORDER BY ts, event_id) AS rn FROM a)
SELECT event_id, route_code, CAST(h AS VARCHAR) AS hour_bucket FROM k WHERE recent OR rn = 1""")
def _(spark, d):
    stream, path = _stream(spark, d), scratch(spark, "cleaned")
    streams.run_available(streams.first_of_hour(stream, ["ts", "event_id"]), path, path + "-state")
    rows = readings(spark, d).select("event_id", "ts", "route_code", "avg_speed")
    found = streams.cleaned_feed(spark, rows, path, path + "-state", ["ts", "event_id"])
    return found.select("event_id", "route_code", F.date_trunc("hour", "ts").cast("string").alias("hour_bucket"))


@query("k2_stream_hourly_speed", """SELECT route_code, CAST(timestamp AS VARCHAR) AS hour_start, avg(avg_speed) AS avg_speed, count(*) AS readings FROM r
WHERE timestamp + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 24 HOUR FROM r) GROUP BY ALL""", doubles="avg_speed")
def _(spark, d):
    path = scratch(spark, "hourly")
    streams.run_available(streams.hourly_speed(_stream(spark, d)), path, path + "-state")
    return spark.read.parquet(path).withColumn("hour_start", F.col("hour_start").cast("string"))


@query("k2_stream_hourly_speed_all", "SELECT route_code, CAST(timestamp AS VARCHAR) AS hour_start, avg(avg_speed) AS avg_speed, count(*) AS readings FROM r GROUP BY ALL", doubles="avg_speed")
def _(spark, d):
    path = scratch(spark, "hourly")
    streams.run_available(streams.hourly_speed(_stream(spark, d)), path, path + "-state")
    hours = spark.read.parquet(path).unionByName(streams.open_hours(spark, path + "-state"))
    return hours.withColumn("hour_start", F.col("hour_start").cast("string"))


@query("l1_weather_relation", f"""WITH {WEATHER_SQL}
SELECT count(*) AS observations, corr(CAST(temp AS DOUBLE), avg_speed) AS temp_corr, corr(CAST(humidity AS DOUBLE), avg_speed) AS humidity_corr, corr(CAST(aqi AS DOUBLE), avg_speed) AS aqi_corr
FROM r LEFT JOIN w USING (route_code)""", doubles="temp_corr humidity_corr aqi_corr")
def _(spark, d):
    return enrich.weather_relation(enrich.with_weather(readings(spark, d), weather_table(spark, d)))


@query("l1_speed_by_rain", f"""WITH {WEATHER_SQL}
SELECT coalesce(CASE WHEN lower(rsi_flag) LIKE 'no precipitation%' THEN '' ELSE rsi_flag END, '') AS rsi_flag, count(*) AS observations, avg(avg_speed) AS avg_speed
FROM r LEFT JOIN w USING (route_code) GROUP BY 1""", doubles="avg_speed")
def _(spark, d):
    return enrich.speed_by_rain(enrich.with_weather(readings(spark, d), weather_table(spark, d)))
