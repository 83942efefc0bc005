import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sample_readings import patterned
from wayspan.operators import anomaly, forecast, patterns, quality
from wayspan.operators.clean import with_calendar


def test_dense_grids(spark, grid):
    assert patterns.hour_weekday_means(grid).count() == 3 * 168
    short = with_calendar(spark.createDataFrame(patterned(2))).filter("hour <> 5")
    gaps = patterns.hour_weekday_means(short, "ROUTE_A")
    assert gaps.count() == 168 and gaps.filter("avg_speed IS NULL").count() == 168 - 2 * 23
    profile = patterns.hour_profiles(short).filter("hour = 5").collect()
    assert len(profile) == 3 and all(r["mean"] is None for r in profile)


def test_calendar_is_a_daily_mean(grid, grid_pd):
    got = patterns.calendar_cells(grid, "ROUTE_A").toPandas()
    part = grid_pd[grid_pd.route_code == "ROUTE_A"]
    want = part.groupby(part["timestamp"].dt.date)["avg_speed"].mean()
    assert np.allclose(got.set_index("date")["avg_speed"].sort_index(), want)
    cell = got[got["day"] == 5].iloc[0]  # 2025-10-05 is a Sunday; the month began on Wednesday
    assert (cell["grid_row"], cell["grid_col"], cell["week_of_year"]) == (0, 6, 40)


@pytest.mark.parametrize("tile", [128, 2])
def test_route_correlations(spark, monkeypatch, tile):
    monkeypatch.setattr(patterns, "TILE_ROUTES", tile)
    pdf = patterned(5, routes=6)
    pdf = pdf[~((pdf.route_code == "ROUTE_B") & (pdf.hour % 5 == 0))]
    pdf["timestamp"] = pd.to_datetime(pdf[["year", "month", "day", "hour"]])
    want = pdf.pivot_table(index="timestamp", columns="route_code", values="avg_speed").corr()
    got = patterns.route_correlations(spark.createDataFrame(pdf.drop(columns="timestamp"))).toPandas()
    assert len(got) == 36
    wide = got.pivot(index="route_a", columns="route_b", values="correlation")
    assert np.allclose(wide, want, atol=1e-10)


@pytest.mark.parametrize("tile", [16, 2])
def test_lag_correlations(spark, monkeypatch, tile):
    monkeypatch.setattr(forecast, "LAG_TILE_ROUTES", tile)
    rng = np.random.default_rng(2)
    base = rng.normal(size=200)
    rows = []
    for t, ts in enumerate(pd.date_range("2025-10-01", periods=150, freq="h")):
        for name, shift in (("A", 0), ("B", 3), ("C", 10)):
            if (t + shift) % 11:
                rows.append((ts.year, ts.month, ts.day, ts.hour, name, base[t + 20 - shift]))
    pdf = pd.DataFrame(rows, columns=["year", "month", "day", "hour", "route_code", "avg_speed"])
    lags = forecast.lag_correlations(spark.createDataFrame(pdf)).cache()
    pdf["ts"] = pd.to_datetime(pdf[["year", "month", "day", "hour"]])
    wide = pdf.pivot_table(index="ts", columns="route_code", values="avg_speed")
    got = {(r.route_a, r.route_b, r.lag): r.correlation for r in lags.collect()}
    assert len(got) == 6 * 49
    for a, b in (("A", "B"), ("C", "A")):
        both = wide[[a, b]].dropna().to_numpy()
        for lag in (-24, -3, 0, 5, 24):
            x, y = (both[: len(both) - lag, 0], both[lag:, 1]) if lag >= 0 else (both[-lag:, 0], both[:lag, 1])
            assert got[a, b, lag] == pytest.approx(np.corrcoef(x, y)[0, 1], abs=1e-9)
    best = {(r.route_a, r.route_b): r.best_lag for r in forecast.best_lags(lags).collect()}
    assert best["A", "B"] in (2, 3) and best["B", "A"] == -best["A", "B"]


def test_rankings_profiles(grid):
    ranks = patterns.hourly_ranking(grid, patterns.KEY_HOURS)
    assert ranks.count() == 24 and ranks.filter("rank = 1").select("route_code").distinct().first()[0] == "ROUTE_C"
    prof = patterns.route_profiles(grid, ["avg_speed", "distance"]).toPandas()
    assert prof["avg_speed"].min() == 0 and prof["avg_speed"].max() == 1 and (prof["distance"] == 0).all()
    with pytest.raises(ValueError, match="cannot be profiled"):
        patterns.route_profiles(grid, ["nope"])
    assert patterns.route_radar(grid, ["ROUTE_A", "ROUTE_B"]).count() == 2
    with pytest.raises(ValueError, match="no readings"):
        patterns.route_radar(grid, ["ROUTE_X"])
    weekdays = patterns.route_radar(grid.filter("NOT is_weekend")).toPandas()
    assert weekdays["weekend_speed"].isna().all() and len(weekdays) == 3


def test_histogram_matches_numpy(spark, grid_pd, grid):
    got = patterns.histogram(grid, "avg_speed").toPandas()
    for route, part in grid_pd.groupby("route_code"):
        count, edges = np.histogram(part["avg_speed"], bins=30)
        mine = got[got.route_code == route].sort_values("bin")
        assert list(mine["count"]) == list(count) and np.allclose(mine["bin_start"], edges[:-1])
    flat = spark.createDataFrame([("A", 5.0)] * 4, "route_code string, avg_speed double")
    rows = patterns.histogram(flat, "avg_speed").orderBy("bin").collect()
    assert [r["count"] for r in rows] == list(np.histogram([5.0] * 4, bins=30)[0]) and rows[0].bin_start == 4.5


def test_cdf(grid, grid_pd):
    steps = patterns.cdf_points(grid)
    assert steps.groupBy("route_code").agg(F.max("cdf").alias("m")).filter("m <> 1").count() == 0
    marks = {(r.route_code, r.share): r.avg_speed for r in patterns.cdf_markers(grid).collect()}
    x = np.sort(grid_pd[grid_pd.route_code == "ROUTE_B"]["avg_speed"].to_numpy())
    assert marks["ROUTE_B", 0.25] == x[int(0.25 * len(x))]


def timeline_direct(pdf, window=168):
    out = {}
    for route, part in pdf.sort_values("timestamp").groupby("route_code"):
        dev = part["avg_speed"] - part.groupby(["hour", "day_of_week"])["avg_speed"].transform("mean")
        out[route] = dev.rolling(min(window, len(part)), center=True, min_periods=1).mean().to_numpy()
    return out


@pytest.mark.parametrize("keep", [720, 101, 100])
def test_deviation_timeline(spark, grid_pd, keep):
    pdf = grid_pd.sort_values("timestamp").groupby("route_code").head(keep)
    df = with_calendar(spark.createDataFrame(pdf.drop(columns=["timestamp", "day_of_week"])))
    got = anomaly.deviation_timeline(df, block_rows=200).toPandas().sort_values("timestamp")
    for route, want in timeline_direct(pdf).items():
        assert np.allclose(got[got.route_code == route]["deviation_ma"], want, atol=1e-9)


def test_deviation_timeline_plan_and_odd_rows(spark):
    """Positions are found without the expectation, whose cells are made once; unknown routes, speeds and hours stay."""
    rows = [(r, f"2025-10-{d:02d} {h:02d}:00:00", None if (d + h) % 5 == 0 else float(d * h % 7)) for r in ("a", None) for d in range(1, 15) for h in (7, 8, 8)]
    df = spark.createDataFrame([*rows, ("a", None, 3.0), ("b", "2025-10-01 07:00:00", None)], "route_code string, t string, avg_speed double")
    df = df.select("route_code", F.col("t").cast("timestamp_ntz").alias("timestamp"), "avg_speed", F.hour("t").alias("hour"), F.date_format("t", "EEEE").alias("day_of_week"), F.lit(False).alias("is_weekend"), F.lit("x").alias("time_category"))
    out = anomaly.deviation_timeline(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Aggregate \[route_code#\d+, hour#\d+, day_of_week#\d+\]", plan)) == 1
    got = out.toPandas()
    assert len(got) == 2 * 14 * 3 + 2 and set(got["n"]) == {43, 42, 1}
    ok = got["expected_speed"].notna() & got["avg_speed"].notna()
    assert np.allclose(got["deviation"][ok], (got["avg_speed"] - got["expected_speed"])[ok]) and not got["is_anomaly"].any()
    for _, part in got.sort_values("pos").groupby("route_code", dropna=False):
        want = part["deviation"].reset_index(drop=True).rolling(len(part), center=True, min_periods=1).mean()
        assert np.allclose(part["deviation_ma"], want, equal_nan=True)


def test_anomalies(spark):
    rng = np.random.default_rng(42)
    rows = []
    for t in pd.date_range("2024-01-01", periods=60 * 24, freq="h"):
        speed = 25 + 5 * np.sin(t.hour * np.pi / 12) + rng.normal(0, 2) + (60 if (t.day, t.hour) == (9, 7) and t.month == 1 else 0)
        rows.append((t.year, t.month, t.day, t.hour, "A", 20.0, 10.0, float(max(speed, 5))))
    df = with_calendar(spark.createDataFrame(pd.DataFrame(rows, columns=["year", "month", "day", "hour", "route_code", "duration", "distance", "avg_speed"])))
    top = anomaly.outlier_summary(df, threshold=2.0, top_n=5).collect()
    assert len(top) <= 5 and str(top[0].timestamp) == "2024-01-09 07:00:00" and top[0].avg_speed == round(top[0].avg_speed, 3)
    empty = anomaly.outlier_summary(df, threshold=99.0)
    assert empty.count() == 0 and "route_label" in empty.columns
    assert anomaly.control_summary(df).first().n_anomalies >= 1
    flat = df.withColumn("avg_speed", F.lit(3.0))
    assert anomaly.anomaly_scatter(flat).filter("deviation_sigma <> 0").count() == 0
    assert anomaly.outlier_summary(flat, threshold=0.0).count() == 0  # zero spread is undefined, not 0


def test_current_vs_typical(grid, grid_pd):
    got = anomaly.current_vs_typical(grid, "ROUTE_A", "2025-10-20").toPandas().sort_values("hour")
    part = grid_pd[grid_pd.route_code == "ROUTE_A"]
    day = part["timestamp"].dt.normalize() == "2025-10-20"
    typical = part[(part.day_of_week == "Monday") & ~day].groupby("hour")["avg_speed"].agg(["mean", "std"])
    assert len(got) == 24 and np.allclose(got["typical_mean"], typical["mean"]) and np.allclose(got["typical_std"], typical["std"])


def decompose_direct(x, period=168):
    half = period // 2
    weights = np.r_[0.5, np.ones(period - 1), 0.5] / period
    trend = np.full(len(x), np.nan)
    trend[half:-half] = np.convolve(x, weights, mode="valid")
    i = np.arange(len(x))
    a, b = slice(half, half + period), slice(len(x) - half - period, len(x) - half)
    trend[:half] = np.polyval(np.polyfit(i[a], trend[a], 1), i[:half])
    trend[-half:] = np.polyval(np.polyfit(i[b], trend[b], 1), i[-half:])
    means = np.array([(x - trend)[p::period].mean() for p in range(period)])
    return trend, np.tile(means - means.mean(), len(x) // period + 1)[: len(x)]


def test_decomposition(grid, grid_pd):
    got = forecast.decomposition(grid, "ROUTE_A").toPandas().sort_values("idx")
    trend, seasonal = decompose_direct(grid_pd[grid_pd.route_code == "ROUTE_A"]["avg_speed"].to_numpy())
    assert np.allclose(got["trend"], trend, atol=1e-8) and np.allclose(got["seasonal"], seasonal, atol=1e-8)
    assert np.allclose(got["observed"], got["trend"] + got["seasonal"] + got["resid"]) and abs(got["seasonal"][:168].sum()) < 1e-6


def test_short_series_gives_status_only(spark):
    df = with_calendar(spark.createDataFrame(patterned(5, routes=1)))
    assert forecast.decomposition(df).count() == 0
    assert forecast.decomposition_status(df).first().status == "too_few_rows"


def test_gap_fill_limits(spark):
    pdf = patterned(2, routes=1)
    pdf = pdf[~pdf["hour"].between(3, 11)]  # nine hours missing: three filled from each side
    kept = forecast.filled_hours(with_calendar(spark.createDataFrame(pdf)))
    assert kept.count() == 48 - 2 * 3


def test_forecast(grid, grid_pd):
    got = forecast.forecast(grid, "ROUTE_A").toPandas().sort_values("timestamp")
    assert len(got) == 24 and str(got["timestamp"].iloc[0]) == "2025-10-31 00:00:00" and not got["is_fallback"].any()
    cell = grid_pd[(grid_pd.route_code == "ROUTE_A") & (grid_pd.hour == 0) & (grid_pd.day_of_week == "Friday")]["avg_speed"]
    first = got.iloc[0]
    assert first["forecast"] == pytest.approx(cell.mean())
    assert first["ci_upper"] - first["forecast"] == pytest.approx(1.96 * cell.std() / np.sqrt(len(cell)))
    few = forecast.forecast(grid.filter("timestamp < '2025-10-02'"), "ROUTE_A").toPandas()
    assert few["is_fallback"].all()


def summary_direct(pdf, level):
    out = {}
    for route, part in pdf.groupby("route_code"):
        r = part.set_index("timestamp").resample(level)[["avg_speed", "duration"]].mean()
        out[route] = (len(r), r["avg_speed"].mean(), r["avg_speed"].median(), r["avg_speed"].quantile(0.25))
    return out


@pytest.mark.parametrize("level", ["D", "W"])
def test_summary_counts_empty_buckets(spark, grid_pd, level):
    pdf = grid_pd[~grid_pd["timestamp"].dt.day.between(7, 21)]
    df = with_calendar(spark.createDataFrame(pdf.drop(columns=["timestamp", "day_of_week"])))
    got = {r.route_code: r for r in patterns.summary_table(df, level=level).collect()}
    for route, (n, mean, median, q25) in summary_direct(pdf, level).items():
        r = got[route]
        assert r.observations == n and (r.avg_speed, r.median_speed, r.p25_speed) == (round(mean, 2), round(median, 2), round(q25, 2))
    assert {r.completeness_pct for r in got.values()} == {33.33}


def test_summary_filters(grid):
    got = patterns.summary_table(grid, routes=["ROUTE_A"], start="2025-10-05", end="2025-10-10", level="H").first()
    assert got.observations == 5 * 24 + 1  # the end date compares with midnight
    with pytest.raises(ValueError, match="Unknown aggregation level"):
        patterns.summary_table(grid, level="X").count()
    assert patterns.date_spine(grid, end="2025-10-03").count() == 3


def test_quality(spark, grid):
    full = quality.coverage(grid).toPandas()
    assert len(full) == 72 and np.allclose(full["completeness_pct"], 100)
    part = grid.filter("NOT (hour = 5) AND NOT (route_code = 'ROUTE_A' AND hour > 12)")
    assert [r.hour for r in quality.dead_hours(part).orderBy("hour").collect()] == [5, *range(13, 24)]
    assert [r.route_code for r in quality.low_coverage_routes(part).collect()] == ["ROUTE_A"]
    assert quality.missing_patterns(part).filter("hour = 5 AND missing_pct = 100").count() == 7
    found = {r.type: r.severity for r in quality.recommendations(part).collect()}
    assert found["missing_data_bias"] == "high" and found["systematic_collection_failure"] == "high"
    calm = quality.recommendations(grid.withColumn("avg_speed", F.col("avg_speed")), skip=("non_normal_distribution", "scoring_method_disagreement"))
    assert [r.type for r in calm.collect()] == ["no_issues"]
    noon = grid.filter("hour = 12")
    assert quality.quality_metrics(noon).first().completeness < 10
    assert quality.distance_consistency(grid).filter("is_inconsistent").count() == 0


def same_readings(spark, n_routes=6):
    """Routes with the same speeds at noon, each in another order (their plain sums differ)."""
    speeds = [1e9 / 7, -1e9 / 7, 0.1, 0.2, 0.3, 100 / 3, 1e-9, 55.55]
    rng = np.random.default_rng(3)
    rows = [(f"R{r}", 12, float(v)) for r in range(n_routes) for v in rng.permutation(speeds)]
    days = spark.createDataFrame(rows, "route_code string, hour int, avg_speed double").coalesce(1)
    return days.selectExpr("*", "DATE'2025-10-05' AS date", "TIMESTAMP_NTZ'2025-10-05 12:00:00' AS timestamp", "'Sunday' AS day_of_week")


def test_hourly_ranking_of_equal_routes_goes_by_code(spark):
    got = patterns.hourly_ranking(same_readings(spark)).orderBy("rank").collect()
    assert [r.route_code for r in got] == [f"R{i}" for i in range(6)] and len({r.avg_speed for r in got}) == 1


def test_rank_volatility_of_equal_routes(spark):
    days = same_readings(spark)
    again = days.withColumn("hour", F.lit(13)).orderBy("avg_speed")
    got = {r.route_code: (r.avg_rank, r.std_rank, r.rank_range) for r in patterns.hourly_rank_volatility(days.unionByName(again)).collect()}
    assert got == {f"R{i}": (i + 1.0, 0.0, 0) for i in range(6)}
