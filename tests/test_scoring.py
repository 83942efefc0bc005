import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wayspan.operators import scoring

SCHEMA = "year int, month int, day int, hour int, route_code string, duration double, distance double, avg_speed double"


def reference_scores(pdf, days=10, ref=None):
    """Day-by-day loop, as the definition reads."""
    day = pdf["timestamp"].dt.normalize()
    ref = pd.Timestamp(ref) if ref else day.max()
    total = {r: 0.0 for r in sorted(pdf["route_code"].unique())}
    for back in range(days, 0, -1):
        part = pdf[day == ref - pd.Timedelta(days=back)]
        if part.empty:
            continue
        means = part.groupby("route_code")["avg_speed"].mean().sort_values(ascending=False)
        for route, p in zip(means.index, np.linspace(len(means) / 2, -len(means) / 2, len(means))):
            total[route] += p
    return total


def test_daily_points_sum_to_zero_and_lone_route(spark):
    rows = [(2025, 10, 1, 8, "A", 10.0, 10.0, 60.0), (2025, 10, 1, 8, "B", 20.0, 10.0, 30.0), (2025, 10, 1, 9, "C", 20.0, 10.0, 30.0), (2025, 10, 2, 8, "A", 10.0, 10.0, 60.0)]
    got = {(r.date.day, r.route_code): r.points for r in scoring.daily_points(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, "A"): 1.5, (1, "B"): 0.0, (1, "C"): -1.5, (2, "A"): 0.5}  # ties go by code


def test_null_speed_recomputes_the_whole_day(spark):
    rows = [(2025, 10, 1, 8, "A", 10.0, 10.0, 1.0), (2025, 10, 1, 8, "B", 20.0, 10.0, None), (2025, 10, 2, 8, "A", 10.0, 10.0, 1.0)]
    got = {(r.date.day, r.route_code): r.avg_speed_mean for r in scoring.daily_aggregate(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(1, "A"): 60.0, (1, "B"): 30.0, (2, "A"): 1.0}


@pytest.mark.parametrize("days,ref", [(10, None), (5, "2025-10-12"), (30, None)])
def test_rolling_score_matches_loop(grid, grid_pd, days, ref):
    got = {r.route_code: r.points for r in scoring.rolling_score(grid, ref, days).collect()}
    want = {k: round(v, 1) for k, v in reference_scores(grid_pd, days, ref).items()}
    assert got == pytest.approx(want)


def test_reference_day_is_excluded(spark, grid):
    last = grid.agg(F.max(F.col("timestamp").cast("date"))).first()[0]
    changed = grid.withColumn("avg_speed", F.when(F.col("timestamp").cast("date") == F.lit(last), -F.col("avg_speed")).otherwise(F.col("avg_speed")))
    assert scoring.rolling_score(changed).collect() == scoring.rolling_score(grid).collect()


def test_shift_invariance(grid):
    shifted = grid.withColumn("avg_speed", F.col("avg_speed") + 7)
    assert scoring.rolling_score(shifted).collect() == scoring.rolling_score(grid).collect()


def test_evolution_matches_single_scores(grid, grid_pd):
    got = scoring.ranking_evolution(grid).toPandas()
    assert len(got) == 90
    for day in ("2025-10-01", "2025-10-07", "2025-10-30"):
        part = got[pd.to_datetime(got["date"]) == day].set_index("route_code")
        want = reference_scores(grid_pd, 10, day)
        assert part["points"].to_dict() == pytest.approx({k: round(v, 1) for k, v in want.items()})
    first = got[pd.to_datetime(got["date"]) == "2025-10-01"]
    assert list(first.sort_values("rank")["route_code"]) == ["ROUTE_A", "ROUTE_B", "ROUTE_C"]


def test_other_scores_and_agreement(grid, grid_pd):
    means = grid_pd.groupby("route_code")["avg_speed"].mean()
    pct = {r.route_code: r.percentile_score for r in scoring.percentile_score(grid).collect()}
    assert pct == pytest.approx((means.rank(pct=True) * 100).to_dict())
    z = {r.route_code: r.zscore for r in scoring.zscore_score(grid).collect()}
    assert z == pytest.approx(((means - means.mean()) / means.std()).to_dict())
    matrix = {(r.row_key, r.col_key): r.value for r in scoring.method_agreement(grid).collect()}
    assert len(matrix) == 16 and all(-1 <= v <= 1 for v in matrix.values()) and matrix["rolling", "rolling"] == 1
    stab = {(r.row_key, r.col_key): r.value for r in scoring.window_stability(grid).collect()}
    assert len(stab) == 25 and stab["5d", "5d"] == 1


def test_score_vs_speed(grid):
    row = scoring.score_vs_speed(grid).first()
    assert row.spearman_correlation == pytest.approx(1.0) and row.spearman_pvalue == pytest.approx(0.0, abs=1e-6) and 0 <= row.pearson_pvalue <= 1


def test_reports_and_custom_score(spark, grid):
    scoring.register_score("slowest", lambda df: df.groupBy("route_code").agg(F.min("avg_speed").alias("score")))
    try:
        report = scoring.method_report(grid).toPandas()
        timed = scoring.method_report(grid, spark.createDataFrame([("rolling", 2.0), ("median", 0.0)], "method string, mean_time double")).toPandas().set_index("method")
        with pytest.raises(ValueError):
            scoring.register_score("rolling", lambda df: df)
    finally:
        scoring.unregister_score("slowest")
    assert set(report["method"]) == {"rolling", "percentile", "zscore", "median", "slowest"} and sorted(report["rank"]) == [1, 2, 3, 4, 5]
    assert report["efficiency"].isna().all()
    r = timed.loc["rolling"]
    assert r["overall_score"] == pytest.approx(0.4 * r["stability"] + 0.4 * r["robustness"] + 0.2 * 0.5, abs=1e-4)
    assert timed.loc["median", "efficiency"] == 0.0


def test_intervals_bracket_the_score(grid):
    got = scoring.score_intervals(grid, ["timestamp"], n_bootstrap=100).toPandas().set_index("route_code")
    want = {r.route_code: r.points for r in scoring.rolling_score(grid).collect()}
    assert all(got.loc[k, "ci_lower"] - 1e-9 <= v <= got.loc[k, "ci_upper"] + 1e-9 for k, v in want.items())
    again = scoring.score_intervals(grid.repartition(7), ["timestamp"], n_bootstrap=100).toPandas().set_index("route_code")
    assert got.equals(again.loc[got.index])


def test_transitivity(spark):
    scores = spark.createDataFrame([("A", 3.0), ("B", 1.0), ("C", 1.0), ("D", -2.0)], "route_code string, points double")
    assert list(scoring.transitivity(scores).first()) == [4, 0, True]


def test_percentile_leaves_out_routes_without_speed(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", None)], "route_code string, avg_speed double")
    got = {r.route_code: r.percentile_score for r in scoring.percentile_score(df).collect()}
    assert got == {"a": pytest.approx(100 / 3), "b": pytest.approx(200 / 3), "c": 100.0, "d": None}
