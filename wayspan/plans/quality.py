"""Queries of the data quality (F) and statistical test (G) families."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayspan.functions import tails
from wayspan.operators import quality, stats
from wayspan.plans.registry import normal_quantile_sql, poly_sql, query
from wayspan.plans.scoring import METHODS_SQL
from wayspan.plans.tables import readings, shipments

COVER_SQL = """
span AS (SELECT date_diff('hour', min(timestamp), max(timestamp)) + 1 AS h FROM r),
seen AS (SELECT route_code, hour, count(DISTINCT date) AS c FROM r GROUP BY ALL),
cov AS (
  SELECT a.route_code, CAST(hh AS INTEGER) AS hour, coalesce(c, 0) / (h / 24e0) * 100 AS completeness_pct,
         CAST(floor(h / 24e0) AS INTEGER) AS expected_count, coalesce(c, 0) AS actual_count
  FROM (SELECT DISTINCT route_code FROM r) a CROSS JOIN (SELECT unnest(generate_series(0, 23)) AS hh) CROSS JOIN span
  LEFT JOIN seen ON seen.route_code = a.route_code AND seen.hour = hh)"""
QUALITY_SQL = """
zq AS (SELECT *, coalesce(abs((avg_speed - avg(avg_speed) OVER ()) / stddev(avg_speed) OVER ()) > 3, false) AS bad FROM r),
sp AS (SELECT min(timestamp) AS lo, max(timestamp) AS hi, date_diff('hour', min(timestamp), max(timestamp)) + 1 AS h, count(*) AS n,
              count(DISTINCT route_code) AS k, count(*) FILTER (WHERE bad) AS nb FROM zq),
fu AS (SELECT count(*) AS full_routes FROM (SELECT route_code, count(*) AS n FROM r GROUP BY 1) t, sp WHERE t.n / CAST(sp.h AS DOUBLE) > 0.8e0),
qm AS (
  SELECT n * 100e0 / (h * k) AS completeness, nb * 100e0 / n AS outlier_rate, strftime(lo, '%Y-%m-%d') AS start_date, strftime(hi, '%Y-%m-%d') AS end_date,
         CAST(date_diff('hour', lo, hi) // 24 AS INTEGER) AS total_days, k AS total_routes, full_routes AS sufficient_data_routes, k - full_routes AS insufficient_data_routes
  FROM sp, fu)"""


@query("f1_sample_sizes", "SELECT route_code, count(*) AS n_rows, count(*) / (sum(count(*)) OVER () / CAST(count(*) OVER () AS DOUBLE)) * 100 AS completeness_pct FROM s GROUP BY route_code", needs="s", doubles="completeness_pct")
def _(spark, d):
    return quality.sample_sizes(shipments(spark, d))


@query("f1_sample_bias", """SELECT stddev(n) / avg(n) AS bias_metric, variance(n) AS sample_size_variance,
CASE WHEN stddev(n) / avg(n) > 0.2e0 THEN 'high' WHEN stddev(n) / avg(n) > 0.1e0 THEN 'medium' END AS severity FROM (SELECT route_code, count(*) AS n FROM s GROUP BY 1)""",
       needs="s", doubles="bias_metric sample_size_variance")
def _(spark, d):
    return quality.sample_bias(shipments(spark, d))


@query("f2_coverage", f"WITH {COVER_SQL} SELECT * FROM cov", doubles="completeness_pct")
def _(spark, d):
    return quality.coverage(readings(spark, d))


@query("f3_low_coverage_routes", f"WITH {COVER_SQL} SELECT route_code, avg(completeness_pct) AS completeness_pct FROM cov GROUP BY 1 HAVING avg(completeness_pct) < 80", needs="u", doubles="completeness_pct")
def _(spark, d):
    return quality.low_coverage_routes(readings(spark, d, "user_id"))


@query("f4_missing_patterns", """
WITH seen AS (SELECT hour, day_of_week, count(DISTINCT route_code) AS c FROM r GROUP BY ALL), e AS (SELECT count(DISTINCT route_code) AS k FROM r)
SELECT CAST(hh AS INTEGER) AS hour, dn AS day_of_week, k AS expected_routes, coalesce(c, 0) AS actual_routes, (k - coalesce(c, 0)) * 100e0 / k AS missing_pct,
       (k - coalesce(c, 0)) * 100e0 / k > 20 AS is_systematic
FROM e CROSS JOIN (SELECT unnest(generate_series(0, 23)) AS hh)
CROSS JOIN (SELECT unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']) AS dn)
LEFT JOIN seen ON seen.hour = hh AND seen.day_of_week = dn""", needs="u", doubles="missing_pct")
def _(spark, d):
    return quality.missing_patterns(readings(spark, d, "user_id"))


@query("f5_quality_metrics", f"WITH {QUALITY_SQL} SELECT * FROM qm", doubles="completeness outlier_rate")
def _(spark, d):
    return quality.quality_metrics(readings(spark, d))


@query("f6_distance_consistency", """SELECT route_code, avg(distance) AS mean, stddev(distance) AS std, min(distance) AS min, max(distance) AS max, max(distance) - min(distance) AS range,
stddev(distance) / avg(distance) AS cv, coalesce(stddev(distance) / avg(distance) > 0.05e0, false) AS is_inconsistent FROM s GROUP BY route_code""", needs="s", doubles="mean std min max range cv")
def _(spark, d):
    return quality.distance_consistency(shipments(spark, d))


@query("f7_dead_hours", f"WITH {COVER_SQL} SELECT hour, avg(completeness_pct) AS completeness_pct FROM cov GROUP BY hour HAVING avg(completeness_pct) < 90", needs="u", doubles="completeness_pct")
def _(spark, d):
    return quality.dead_hours(readings(spark, d, "user_id"))


@query("f8_recommendations")
def _(spark, d):
    return quality.recommendations(readings(spark, d, "user_id"))


@query("f8_recommendation_rules", f"""WITH {QUALITY_SQL}, {COVER_SQL}, {METHODS_SQL},
b AS (SELECT stddev(n) / avg(n) AS cv FROM (SELECT route_code, count(*) AS n FROM r GROUP BY 1)),
a AS (SELECT corr(x.ar, y.ar) AS rho FROM mr x JOIN mr y USING (route_code) WHERE x.method = 'rolling' AND y.method = 'percentile'),
dh AS (SELECT count(*) AS k FROM (SELECT hour FROM cov GROUP BY hour HAVING avg(completeness_pct) < 90)),
f AS (
  SELECT 'missing_data_bias' AS type, CASE WHEN cv > 0.2e0 THEN 'high' ELSE 'medium' END AS severity FROM b WHERE cv > 0.1e0
  UNION ALL SELECT 'low_completeness', 'high' FROM qm WHERE completeness < 80 UNION ALL SELECT 'high_outlier_rate', 'medium' FROM qm WHERE outlier_rate > 5
  UNION ALL SELECT 'scoring_method_disagreement', 'medium' FROM a WHERE rho < 0.9e0
  UNION ALL SELECT 'systematic_collection_failure', 'high' FROM dh WHERE k > 0)
SELECT * FROM f UNION ALL SELECT 'no_issues', 'low' WHERE NOT EXISTS (SELECT 1 FROM f)""", needs="u")
def _(spark, d):
    # the normality rule has no SQL counterpart; f8_recommendations runs it
    return quality.recommendations(readings(spark, d, "user_id"), skip=("non_normal_distribution",)).select("type", "severity")


# --- G ------------------------------------------------------------------------------------------

@query("g1_g2_normality")
def _(spark, d):
    return stats.normality(readings(spark, d))


@query("g3_stationarity")
def _(spark, d):
    return stats.stationarity(readings(spark, d), order=["ts", "event_id"])


LAGS_SQL = ", ".join(f"sum(c * l{k}) AS s{k}" for k in range(1, 25))
LAG_COLS = ", ".join(f"lag(c, {k}) OVER (PARTITION BY route_code ORDER BY ts, event_id) AS l{k}" for k in range(1, 25))


@query("g4_autocorrelation", f"""
WITH c AS (SELECT route_code, ts, event_id, avg_speed - avg(avg_speed) OVER (PARTITION BY route_code) AS c, count(*) OVER (PARTITION BY route_code) AS n FROM r),
l AS (SELECT route_code, n, c, {LAG_COLS} FROM c),
t AS (SELECT route_code, max(n) AS n, sum(c * c) AS s0, {LAGS_SQL} FROM l GROUP BY route_code)
SELECT route_code, CAST(k AS INTEGER) AS lag, CASE WHEN n >= 25 THEN [s0, {', '.join(f's{k}' for k in range(1, 25))}][k + 1] / s0 END AS acf
FROM t, (SELECT unnest(generate_series(0, 24)) AS k)""", doubles="acf")
def _(spark, d):
    return stats.autocorrelation(readings(spark, d), order=["ts", "event_id"])


@query("g4_autocorrelation_hours", """
WITH h AS (SELECT route_code, timestamp AS t, avg(avg_speed) AS x FROM r GROUP BY ALL),
c AS (SELECT route_code, t, x - avg(x) OVER (PARTITION BY route_code) AS c, count(*) OVER (PARTITION BY route_code) AS n FROM h),
s AS (SELECT a.route_code, k, sum(a.c * b.c) AS s FROM (SELECT *, unnest(range(0, 25)) AS k FROM c) a JOIN c b ON b.route_code = a.route_code AND b.t = a.t + to_hours(CAST(k AS INTEGER)) GROUP BY ALL),
g AS (SELECT route_code, max(n) AS n, sum(c * c) AS s0, unnest(range(0, 25)) AS k FROM c GROUP BY route_code)
SELECT g.route_code, CAST(g.k AS INTEGER) AS lag, CASE WHEN n >= 25 AND s0 <> 0 THEN coalesce(s, 0) / s0 END AS acf FROM g LEFT JOIN s ON s.route_code = g.route_code AND s.k = g.k""", needs="u", doubles="acf")
def _(spark, d):
    return stats.autocorrelation(readings(spark, d, "user_id"), regularize=True)


@query("g3_stationarity_hours", """
WITH h AS (SELECT route_code, timestamp AS t, avg(avg_speed) AS x FROM r GROUP BY ALL),
s AS (SELECT a.route_code, a.x - avg(a.x) OVER (PARTITION BY a.route_code) AS x, b.x - a.x AS d FROM h a JOIN h b ON b.route_code = a.route_code AND b.t = a.t + INTERVAL 1 HOUR),
m AS (SELECT route_code, count(*) AS n, regr_slope(d, x) AS b, regr_sxx(d, x) AS sxx, regr_syy(d, x) - regr_sxy(d, x) * regr_sxy(d, x) / regr_sxx(d, x) AS ssr FROM s GROUP BY route_code),
k AS (SELECT route_code FROM h GROUP BY route_code HAVING count(*) >= 12)
SELECT route_code, b / sqrt(ssr / (n - 2) / sxx) AS adf_statistic, n AS n_obs, CAST(0 AS INTEGER) AS used_lag FROM m JOIN k USING (route_code)""", doubles="adf_statistic")
def _(spark, d):
    # without lagged steps, which is the regression that SQL can tell; the tests compare the choice of lags and the p-value
    found = stats.stationarity(readings(spark, d), regularize=True, lags=0)
    return found.select("route_code", "adf_statistic", "n_obs", "used_lag")


@query("g5_variance_homogeneity", """
WITH z AS (SELECT route_code, abs(avg_speed - median(avg_speed) OVER (PARTITION BY route_code)) AS z FROM r),
g AS (SELECT route_code, count(*) AS n, avg(z) AS m, sum(z) AS sz FROM z GROUP BY route_code HAVING count(*) >= 2),
w AS (SELECT sum((z - m) * (z - m)) AS within FROM z JOIN g USING (route_code)),
b AS (SELECT count(*) AS k, sum(n) AS nn, sum(n * m * m) - sum(sz) * sum(sz) / sum(n) AS between_ss FROM g)
SELECT (nn - k) * between_ss / ((k - 1) * within) AS levene_statistic, k AS n_routes, CAST(nn AS BIGINT) AS n_rows FROM b, w""", needs="u", doubles="levene_statistic", digits=5)
def _(spark, d):
    # the p-value has no SQL counterpart; the tests check it
    return stats.variance_homogeneity(readings(spark, d, "user_id")).select("levene_statistic", "n_routes", "n_rows")


@query("g5_route_variances", "SELECT route_code, variance(avg_speed) AS variance FROM r GROUP BY route_code", doubles="variance")
def _(spark, d):
    return stats.route_variances(readings(spark, d))


@query("g1_shapiro_statistic", f"""
WITH o AS (SELECT route_code, avg_speed AS x, row_number() OVER (PARTITION BY route_code ORDER BY avg_speed) AS i, count(*) OVER (PARTITION BY route_code) AS n FROM r),
p AS (SELECT *, (i - 0.375e0) / (n + 0.25e0) AS p FROM o WHERE n > 5), m AS (SELECT *, {normal_quantile_sql('p')} AS m FROM p),
g AS (SELECT route_code, max(n) AS n, sum(m * m) AS s2, max(CASE WHEN i = n THEN m END) AS m1, max(CASE WHEN i = n - 1 THEN m END) AS m2, 1 / sqrt(max(n)) AS u, var_pop(x) * count(*) AS ssx FROM m GROUP BY 1),
a AS (SELECT *, {poly_sql('u', tails.ROYSTON_LAST)} + m1 / sqrt(s2) AS a1, {poly_sql('u', tails.ROYSTON_NEXT)} + m2 / sqrt(s2) AS a2 FROM g),
f AS (SELECT *, sqrt((s2 - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * a1 * a1 - 2 * a2 * a2)) AS sc FROM a),
t AS (SELECT m.route_code, sum(CASE WHEN i = f.n THEN a1 * x WHEN i = f.n - 1 THEN a2 * x WHEN i = 1 THEN -a1 * x WHEN i = 2 THEN -a2 * x ELSE m * x / sc END) AS top, any_value(ssx) AS ssx
      FROM m JOIN f USING (route_code) GROUP BY 1)
SELECT route_code, top * top / ssx AS shapiro_statistic FROM t""", doubles="shapiro_statistic")
def _(spark, d):
    return stats.normality(readings(spark, d)).select("route_code", "shapiro_statistic")


@query("g6_power_analysis")
def _(spark, d):
    return stats.power_analysis(readings(spark, d, "user_id"))


@query("g6_power_sufficient", "SELECT route_code, count(*) AS sample_size, 63.765610e0 AS required_sample_size, CASE WHEN count(*) >= 2 THEN count(*) >= 64 END AS is_sufficient FROM r GROUP BY route_code",
       needs="u", doubles="required_sample_size", digits=4)
def _(spark, d):
    # the achieved power has no SQL counterpart; the tests check it
    return stats.power_analysis(readings(spark, d, "user_id")).drop("actual_power")


QQ_SQL = f"""o AS (SELECT route_code, avg_speed AS x, row_number() OVER (PARTITION BY route_code ORDER BY avg_speed) AS i, count(*) OVER (PARTITION BY route_code) AS n FROM r),
p AS (SELECT *, CASE WHEN i = n THEN pow(0.5e0, 1e0 / n) WHEN i = 1 THEN 1 - pow(0.5e0, 1e0 / n) ELSE (i - 0.3175e0) / (n + 0.365e0) END AS p FROM o WHERE n >= 3),
qq AS (SELECT route_code, {normal_quantile_sql('p')} AS theoretical, x AS ordered FROM p)"""


@query("g7_qq_points", f"WITH {QQ_SQL} SELECT * FROM qq", doubles="theoretical ordered")
def _(spark, d):
    return stats.qq_points(readings(spark, d))


@query("g7_qq_lines", f"WITH {QQ_SQL} SELECT route_code, regr_slope(ordered, theoretical) AS slope, regr_intercept(ordered, theoretical) AS intercept, corr(ordered, theoretical) AS r, count(*) AS n FROM qq GROUP BY 1",
       doubles="slope intercept r")
def _(spark, d):
    return stats.qq_lines(stats.qq_points(readings(spark, d)))


@query("g8_residual_diagnostics", """
WITH a AS (SELECT event_id, route_code, avg_speed, avg(avg_speed) OVER (PARTITION BY route_code, hour, day_of_week) AS fitted FROM r),
b AS (SELECT *, avg_speed - fitted AS residual FROM a), c AS (SELECT *, stddev(residual) OVER (PARTITION BY route_code) AS sd FROM b)
SELECT event_id, route_code, fitted, residual, residual / sd AS std_residual, sqrt(abs(round(residual / sd, 9))) AS sqrt_std_residual FROM c""",
       doubles="fitted residual std_residual sqrt_std_residual", digits=4)
def _(spark, d):
    out = stats.residual_diagnostics(readings(spark, d)).select("event_id", "route_code", "fitted", "residual", "std_residual")
    return out.withColumn("sqrt_std_residual", F.sqrt(F.abs(F.round("std_residual", 9))))
