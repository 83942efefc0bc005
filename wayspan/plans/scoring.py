"""Queries of the score family (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wayspan.functions import draws
from wayspan.operators import clean, scoring
from wayspan.plans.registry import query
from wayspan.plans.tables import raw_readings, readings, shipments

RAW_SQL = """
raw AS (
  SELECT event_id, ts, route_code, date, time, hour, duration, distance,
         CASE WHEN event_id % 37 <> 0 THEN avg_speed END AS avg_speed
  FROM (SELECT event_id, ts, route_code, date, time, hour, duration, distance, avg_speed FROM r
        UNION ALL
        SELECT event_id + 100000000, ts, route_code, date, time, hour, duration, distance, avg_speed FROM r WHERE event_id % 10 = 0)
), c1 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY route_code, date, hour, duration, distance ORDER BY ts, event_id) AS rn FROM raw)
  WHERE rn = 1
)"""


def points_sql(source: str, by: str = "") -> str:
    """CTEs ``agg`` and ``pts``: daily means and centred points over ``source``."""
    lead = f"{by}, " if by else ""
    return f"""
agg AS (SELECT {lead}date, route_code, avg(avg_speed) AS m FROM {source} GROUP BY {lead}date, route_code),
pts AS (
  SELECT {lead}date, route_code, m, rk, n,
         CASE WHEN n = 1 THEN 0.5e0 ELSE n / 2e0 - (rk - 1) * CAST(n AS DOUBLE) / (n - 1) END AS points
  FROM (SELECT *, row_number() OVER (PARTITION BY {lead}date ORDER BY m DESC, route_code) AS rk,
               count(*) OVER (PARTITION BY {lead}date) AS n FROM agg))"""


def score_sql(source: str, days: int = 10) -> str:
    """CTE ``sc``: rolling score of all routes over ``source``."""
    return f"""{points_sql(source)},
sc AS (
  SELECT a.route_code, round_even(coalesce(t.p, 0), 1) AS points, round(coalesce(t.p, 0), 9) AS raw_points
  FROM (SELECT DISTINCT route_code FROM {source}) a LEFT JOIN (
    SELECT route_code, sum(points) AS p FROM pts, (SELECT max(date) AS ref FROM {source})
    WHERE date >= ref - {days} AND date < ref GROUP BY route_code) t USING (route_code))"""


def avg_rank_sql(value: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    tie = f"PARTITION BY {by + ', ' if by else ''}{value}"
    return f"(rank() OVER ({part}ORDER BY {value}) + (count(*) OVER ({tie}) - 1) / 2e0)"


@query("e1_daily_aggregate", f"""
WITH {RAW_SQL}, g AS (SELECT date, max(CASE WHEN avg_speed IS NULL THEN 1 ELSE 0 END) AS gap FROM raw GROUP BY date),
f AS (SELECT raw.date, route_code, duration, distance, CASE WHEN gap = 1 THEN 60e0 * distance / duration ELSE avg_speed END AS v
      FROM raw JOIN g USING (date))
SELECT CAST(date AS VARCHAR) AS date, route_code, min(duration) AS duration_min, avg(duration) AS duration_mean, max(duration) AS duration_max,
       min(distance) AS distance_min, avg(distance) AS distance_mean, max(distance) AS distance_max,
       min(v) AS avg_speed_min, avg(v) AS avg_speed_mean, max(v) AS avg_speed_max
FROM f GROUP BY date, route_code
""", doubles="duration_mean distance_mean avg_speed_min avg_speed_mean avg_speed_max")
def _(spark, d):
    return scoring.daily_aggregate(raw_readings(spark, d))


@query("e2_daily_points", f"WITH {points_sql('r')} SELECT CAST(date AS VARCHAR) AS date, route_code, rk AS rank, points FROM pts", doubles="points")
def _(spark, d):
    return scoring.daily_points(readings(spark, d)).select("date", "route_code", "rank", "points")


@query("e3_rolling_score", f"WITH {RAW_SQL}, c4 AS (SELECT * FROM c1 WHERE avg_speed IS NOT NULL), {score_sql('c4')} SELECT * FROM sc",
       doubles="points raw_points")
def _(spark, d):
    return scoring.rolling_score(clean.preprocess(raw_readings(spark, d), ["ts", "event_id"]))


@query("e3_rolling_score_shipments", f"""
WITH {points_sql('s')}
SELECT a.route_code, round_even(coalesce(t.p, 0), 1) AS points FROM (SELECT DISTINCT route_code FROM s) a LEFT JOIN (
  SELECT route_code, sum(points) AS p FROM pts WHERE date >= DATE '2000-01-01' - 30 AND date < DATE '2000-01-01' GROUP BY route_code) t USING (route_code)
""", needs="s", doubles="points", digits=1)
def _(spark, d):
    return scoring.rolling_score(shipments(spark, d), ref_date="2000-01-01", days=30).select("route_code", "points")


EVOLUTION_SQL = f"""{points_sql('r')},
days AS (SELECT CAST(unnest(generate_series(min(timestamp), max(timestamp), INTERVAL 1 DAY)) AS DATE) AS date FROM r),
grid AS (SELECT days.date, a.route_code FROM days, (SELECT DISTINCT route_code FROM r) a),
roll AS (
  SELECT g.date, g.route_code, round(coalesce(sum(p.points) OVER (PARTITION BY g.route_code ORDER BY g.date ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 0), 9) AS raw
  FROM grid g LEFT JOIN pts p ON p.date = g.date AND p.route_code = g.route_code),
evo AS (SELECT date, route_code, row_number() OVER (PARTITION BY date ORDER BY raw DESC, route_code) AS rank, round_even(raw, 1) AS points FROM roll)"""


@query("e4_ranking_evolution", f"WITH {EVOLUTION_SQL} SELECT CAST(date AS VARCHAR) AS date, route_code, rank, points FROM evo", doubles="points")
def _(spark, d):
    return scoring.ranking_evolution(readings(spark, d))


@query("e5_rank_volatility", f"""WITH {EVOLUTION_SQL}
SELECT route_code, avg(rank) AS avg_rank, stddev(rank) AS std_rank, min(rank) AS min_rank, max(rank) AS max_rank,
       max(rank) - min(rank) AS rank_range FROM evo GROUP BY route_code""", doubles="avg_rank std_rank")
def _(spark, d):
    return scoring.rank_volatility(scoring.ranking_evolution(readings(spark, d)))


@query("e6_percentile_score", f"""
SELECT route_code, {avg_rank_sql('m')} / count(*) OVER () * 100 AS percentile_score
FROM (SELECT route_code, avg(avg_speed) AS m FROM r GROUP BY route_code)""", needs="u", doubles="percentile_score")
def _(spark, d):
    return scoring.percentile_score(readings(spark, d, "user_id"))


@query("e7_zscore_score", """
SELECT route_code, (m - avg(m) OVER ()) / stddev(m) OVER () AS zscore FROM (SELECT route_code, avg(avg_speed) AS m FROM r GROUP BY route_code)""",
       needs="u", doubles="zscore")
def _(spark, d):
    return scoring.zscore_score(readings(spark, d, "user_id"))


@query("e8_median_score", "SELECT route_code, median(avg_speed) AS median_speed FROM r GROUP BY route_code", needs="u", doubles="median_speed")
def _(spark, d):
    return scoring.median_score(readings(spark, d, "user_id"))


@query("e9_score_vs_speed", f"""
WITH {score_sql('r')}, j AS (SELECT points, m FROM sc JOIN (SELECT route_code, avg(avg_speed) AS m FROM r GROUP BY route_code) USING (route_code)),
k AS (SELECT points, m, {avg_rank_sql('points')} AS r1, {avg_rank_sql('m')} AS r2 FROM j)
SELECT corr(points, m) AS pearson_correlation, corr(r1, r2) AS spearman_correlation, count(*) AS n_routes FROM k""",
       needs="u", doubles="pearson_correlation spearman_correlation")
def _(spark, d):
    # the p-values have no SQL counterpart; the tests check them
    return scoring.score_vs_speed(readings(spark, d, "user_id")).select("pearson_correlation", "spearman_correlation", "n_routes")


@query("e10_outlier_sensitivity", f"""
WITH z AS (SELECT *, abs((avg_speed - avg(avg_speed) OVER ()) / stddev(avg_speed) OVER ()) > 3 AS bad FROM r),
b AS (WITH {score_sql('z')} SELECT route_code, points FROM sc),
good AS (SELECT * FROM z WHERE NOT bad),
f AS (WITH {score_sql('good')} SELECT route_code, points FROM sc),
k AS (SELECT {avg_rank_sql('p1')} AS r1, {avg_rank_sql('p2')} AS r2 FROM (SELECT b.points AS p1, f.points AS p2 FROM b JOIN f USING (route_code)))
SELECT corr(r1, r2) AS rank_correlation, (SELECT count(*) FROM z WHERE bad) AS n_outliers_removed FROM k""",
       needs="u", doubles="rank_correlation")
def _(spark, d):
    return scoring.outlier_sensitivity(readings(spark, d, "user_id")).select("rank_correlation", "n_outliers_removed")


WINDOWS_SQL = f"""{points_sql('r')},
wins AS (SELECT unnest([5, 10, 15, 20, 30]) AS w),
ws AS (
  SELECT w, a.route_code, round_even(coalesce(sum(p.points), 0), 1) AS score
  FROM wins, (SELECT DISTINCT route_code FROM r) a, (SELECT max(date) AS ref FROM r) LEFT JOIN pts p
    ON p.route_code = a.route_code AND p.date >= ref - w AND p.date < ref
  GROUP BY w, a.route_code),
wr AS (SELECT w, route_code, {avg_rank_sql('score', 'w')} AS ar FROM ws),
wc AS (SELECT x.w AS w1, y.w AS w2, CASE WHEN x.w = y.w THEN 1e0 ELSE corr(x.ar, y.ar) END AS value
       FROM wr x JOIN wr y USING (route_code) GROUP BY x.w, y.w)"""


@query("e11_window_stability", f"WITH {WINDOWS_SQL} SELECT w1 || 'd' AS row_key, w2 || 'd' AS col_key, value FROM wc", needs="u", doubles="value")
def _(spark, d):
    return scoring.window_stability(readings(spark, d, "user_id"))


METHODS_SQL = f"""{score_sql('r')},
means AS (SELECT route_code, avg(avg_speed) AS m, median(avg_speed) AS med FROM r GROUP BY route_code),
ms AS (
  SELECT route_code, 'rolling' AS method, points AS score FROM sc
  UNION ALL SELECT route_code, 'percentile', m FROM means
  UNION ALL SELECT route_code, 'zscore', m FROM means
  UNION ALL SELECT route_code, 'median', med FROM means),
mr AS (SELECT method, route_code, {avg_rank_sql('score', 'method')} AS ar FROM (SELECT method, route_code, round(score, 9) AS score FROM ms))"""


@query("e12_method_agreement", f"""WITH {METHODS_SQL}
SELECT x.method AS row_key, y.method AS col_key, CASE WHEN x.method = y.method THEN 1e0 ELSE corr(x.ar, y.ar) END AS value
FROM mr x JOIN mr y USING (route_code) GROUP BY x.method, y.method""", needs="u", doubles="value")
def _(spark, d):
    return scoring.method_agreement(readings(spark, d, "user_id"))


E13_SQL = f"""WITH w AS (SELECT r.* FROM r, (SELECT max(date) AS ref FROM r) WHERE date >= ref - 10 AND date < ref),
b AS (SELECT iter, date, route_code, avg_speed, {draws.poisson_sql('u')} AS wt FROM {draws.numbers_sql('(SELECT event_id, date, route_code, avg_speed, unnest(range(0, 1000)) AS iter FROM w)', 'u', 'event_id', 0, 'iter')}),
m AS (SELECT iter, date, route_code, sum(wt * avg_speed) / sum(wt) AS v FROM b WHERE wt > 0 GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY iter, date ORDER BY v DESC NULLS LAST, route_code) AS rank, count(*) OVER (PARTITION BY iter, date) AS n FROM m),
p AS (SELECT iter, route_code, round_even(sum(CASE WHEN n = 1 THEN 0.5e0 ELSE n / 2e0 - (rank - 1) * n / CAST(n - 1 AS DOUBLE) END), 1) AS p FROM k GROUP BY ALL),
g AS (SELECT route_code, coalesce(p, 0) AS p FROM (SELECT DISTINCT route_code, unnest(range(0, 1000)) AS iter FROM r) LEFT JOIN p USING (route_code, iter))
SELECT route_code, avg(p) AS points, quantile_cont(p, 0.025) AS ci_lower, quantile_cont(p, 0.975) AS ci_upper FROM g GROUP BY route_code"""


@query("e13_score_intervals", E13_SQL, doubles="points ci_lower ci_upper")
def _(spark, d):
    return scoring.score_intervals(readings(spark, d), ["event_id"])


@query("e14_transitivity", f"""WITH {score_sql('r')}, o AS (SELECT points, row_number() OVER (ORDER BY points DESC, route_code) AS pos FROM sc)
SELECT count(*) AS n_triples, CAST(count(*) FILTER (WHERE a.points > b.points AND b.points > c.points AND NOT a.points > c.points) AS BIGINT) AS n_violations,
       count(*) FILTER (WHERE a.points > b.points AND b.points > c.points AND NOT a.points > c.points) = 0 AS is_transitive
FROM o a JOIN o b ON a.pos < b.pos JOIN o c ON b.pos < c.pos""")
def _(spark, d):
    return scoring.transitivity(scoring.rolling_score(readings(spark, d)))


STABILITY_SQL = """stab AS (
  SELECT 'rolling' AS method, avg(value) AS mean_correlation, stddev_pop(value) AS std_correlation, min(value) AS min_correlation, max(value) AS max_correlation
  FROM wc WHERE w1 < w2
  UNION ALL SELECT unnest(['percentile', 'zscore', 'median']), 1e0, 0e0, 1e0, 1e0)"""


@query("e15_stability_by_method", f"WITH {WINDOWS_SQL}, {STABILITY_SQL} SELECT * FROM stab", needs="u",
       doubles="mean_correlation std_correlation min_correlation max_correlation")
def _(spark, d):
    return scoring.stability_by_method(readings(spark, d, "user_id"))


ROBUST_SQL = f"""
zz AS (SELECT *, abs((avg_speed - avg(avg_speed) OVER ()) / stddev(avg_speed) OVER ()) AS z FROM r),
v AS (SELECT 'all' AS variant, * FROM zz UNION ALL SELECT 'z' || t AS variant, zz.* FROM zz, (SELECT unnest(['2', '2.5', '3']) AS t) WHERE z <= CAST(t AS DOUBLE)),
vagg AS (SELECT variant, date, route_code, avg(avg_speed) AS m FROM v GROUP BY ALL),
vpts AS (SELECT variant, date, route_code, CASE WHEN n = 1 THEN 0.5e0 ELSE n / 2e0 - (rk - 1) * CAST(n AS DOUBLE) / (n - 1) END AS points,
                max(date) OVER (PARTITION BY variant) AS ref
         FROM (SELECT *, row_number() OVER (PARTITION BY variant, date ORDER BY m DESC, route_code) AS rk, count(*) OVER (PARTITION BY variant, date) AS n FROM vagg)),
vs AS (
  SELECT variant, 'rolling' AS method, route_code, round_even(coalesce(sum(points) FILTER (WHERE date < ref AND date >= ref - 10), 0), 1) AS score FROM vpts GROUP BY ALL
  UNION ALL SELECT variant, unnest(['percentile', 'zscore']), route_code, m FROM (SELECT variant, route_code, avg(avg_speed) AS m FROM v GROUP BY ALL)
  UNION ALL SELECT variant, 'median', route_code, median(avg_speed) FROM v GROUP BY ALL),
vj AS (SELECT f.method, f.variant, round(b.score, 9) AS base, round(f.score, 9) AS score FROM vs f JOIN vs b ON b.variant = 'all' AND b.method = f.method AND b.route_code = f.route_code WHERE f.variant <> 'all'),
vr AS (SELECT method, variant, {avg_rank_sql('base', 'method, variant')} AS r1, {avg_rank_sql('score', 'method, variant')} AS r2 FROM vj),
vc AS (SELECT method, variant, corr(r1, r2) AS value FROM vr GROUP BY ALL),
rob AS (SELECT method, avg(value) AS mean_correlation, stddev_pop(value) AS std_correlation, min(value) AS min_correlation FROM vc GROUP BY method)"""


@query("e16_robustness_by_method", f"WITH {ROBUST_SQL} SELECT * FROM rob", needs="u", doubles="mean_correlation std_correlation min_correlation")
def _(spark, d):
    return scoring.robustness_by_method(readings(spark, d, "user_id"))


@query("e17_method_report", f"""WITH {WINDOWS_SQL}, {STABILITY_SQL}, {ROBUST_SQL},
o AS (SELECT s.method, s.mean_correlation AS st, b.mean_correlation AS ro, (0.4e0 * s.mean_correlation + 0.4e0 * b.mean_correlation) / 0.8e0 AS ov
      FROM stab s JOIN rob b USING (method))
SELECT CAST(row_number() OVER (ORDER BY round(ov, 9) DESC, method) AS INTEGER) AS rank, method, round_even(ov, 4) AS overall_score,
       round_even(st, 4) AS stability, round_even(ro, 4) AS robustness, CAST(NULL AS DOUBLE) AS efficiency FROM o""",
       needs="u", doubles="overall_score stability robustness efficiency", digits=4)
def _(spark, d):
    return scoring.method_report(readings(spark, d, "user_id"))


@query("j1_custom_score", """SELECT route_code, 'slowest' AS label, round(min(avg_speed), 9) AS score FROM r WHERE route_code IS NOT NULL GROUP BY route_code
UNION ALL SELECT route_code, 'median', round(median(avg_speed), 9) FROM r WHERE route_code IS NOT NULL GROUP BY route_code""", needs="u", doubles="score")
def _(spark, d):
    """A score of one's own beside the built-in ones."""
    scoring.register_score("slowest", lambda rows: rows.filter("route_code IS NOT NULL").groupBy("route_code").agg(F.min("avg_speed").alias("score")))
    try:
        return scoring.method_scores(readings(spark, d, "user_id")).filter(F.col("label").isin("slowest", "median"))
    finally:
        scoring.unregister_score("slowest")
