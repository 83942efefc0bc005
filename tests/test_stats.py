from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wayspan.functions import tails
from wayspan.operators import stats

ND = NormalDist()


@pytest.fixture(scope="module")
def series(spark):
    """One autocorrelated route, one white, one constant, one short."""
    rng = np.random.default_rng(3)
    walk = [0.0]
    for _ in range(399):
        walk.append(0.7 * walk[-1] + rng.normal())
    rows = [("ar", i, v) for i, v in enumerate(walk)] + [("white", i, v) for i, v in enumerate(rng.normal(5, 2, 150).round(1))]
    rows += [("flat", i, 4.0) for i in range(40)] + [("short", i, float(i)) for i in range(7)]
    pdf = pd.DataFrame(rows, columns=["route_code", "timestamp", "avg_speed"])
    return spark.createDataFrame(pdf).cache(), pdf


def test_normality(series):
    df, pdf = series
    got = stats.normality(df).toPandas().set_index("route_code")
    for route in ("ar", "white"):
        x = np.sort(pdf[pdf.route_code == route]["avg_speed"].to_numpy())
        n, i = len(x), np.arange(1, len(x) + 1)
        m = np.array([ND.inv_cdf((k - 0.375) / (n + 0.25)) for k in i])
        w, p = tails.shapiro_from_sums(n, (m * m).sum(), m[-1], m[-2], x[0], x[1], x[-2], x[-1], (m * x)[2:-2].sum(), ((x - x.mean()) ** 2).sum())
        z = (x - x.mean()) / x.std(ddof=1)
        lc, ls = np.log([ND.cdf(v) for v in z]), np.log([ND.cdf(-v) for v in z])
        a2 = -n - ((2 * i - 1) / n * (lc + ls[::-1])).sum()
        assert got.loc[route, "shapiro_statistic"] == pytest.approx(w, rel=1e-9) and got.loc[route, "shapiro_pvalue"] == pytest.approx(p, rel=1e-6)
        assert got.loc[route, "anderson_statistic"] == pytest.approx(a2, rel=1e-8)
        assert got.loc[route, "anderson_pvalue"] == pytest.approx(tails.anderson_pvalue(a2, n), rel=1e-6)
    assert pd.isna(got.loc["flat", "is_normal"]) and pd.isna(got.loc["short", "anderson_statistic"]) and not pd.isna(got.loc["short", "shapiro_statistic"])


def adf_direct(x):
    """Plain least squares version."""
    p = int(min(np.ceil(12 * (len(x) / 100) ** 0.25), len(x) // 2 - 2))

    def fit(lags, trim):
        step = np.diff(x)
        t = np.arange(trim, len(step))
        a = np.column_stack([np.ones(len(t)), x[t], *[step[t - k] for k in range(1, lags + 1)]])
        beta, *_ = np.linalg.lstsq(a, step[t], rcond=None)
        ssr = ((step[t] - a @ beta) ** 2).sum()
        n, k = a.shape
        se = np.sqrt(np.linalg.inv(a.T @ a)[1, 1] * ssr / (n - k))
        return n * (np.log(2 * np.pi * ssr / n) + 1) + 2 * k, beta[1] / se, n

    best = int(np.argmin([fit(k, p)[0] for k in range(p + 1)]))
    _, stat, n = fit(best, best)
    return stat, best, n


@pytest.mark.parametrize("block", [50_000, 60])
def test_stationarity(series, block):
    df, pdf = series
    got = stats.stationarity(df, block_rows=block).toPandas().set_index("route_code")
    for route in ("ar", "white"):
        stat, lag, n = adf_direct(pdf[pdf.route_code == route]["avg_speed"].to_numpy())
        assert got.loc[route, "adf_statistic"] == pytest.approx(stat, rel=1e-7)
        assert (got.loc[route, "used_lag"], got.loc[route, "n_obs"]) == (lag, n)
        assert got.loc[route, "is_stationary"] and got.loc[route, "critical_value_5pct"] == pytest.approx(-2.87, abs=0.02)
    assert pd.isna(got.loc["flat", "adf_statistic"]) and pd.isna(got.loc["short", "adf_statistic"])


def test_autocorrelation(series):
    df, pdf = series
    got = stats.autocorrelation(df, 24, block_rows=50).toPandas().pivot(index="route_code", columns="lag", values="acf")
    x = pdf[pdf.route_code == "ar"]["avg_speed"].to_numpy()
    c = x - x.mean()
    want = [(c[: len(c) - k] * c[k:]).sum() / (c * c).sum() for k in range(25)]
    assert np.allclose(got.loc["ar"], want, atol=1e-10)
    assert got.loc["short"].isna().all() and got.loc["flat"].isna().all()


def test_levene(spark):
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(0, 1, 50), "b": rng.normal(2, 1.5, 40), "c": rng.normal(1, 3, 30), "d": np.array([1.0])}
    pdf = pd.DataFrame([(k, float(v)) for k, g in groups.items() for v in g], columns=["route_code", "avg_speed"])
    row = stats.variance_homogeneity(spark.createDataFrame(pdf)).first()
    zs = [np.abs(g - np.median(g)) for k, g in groups.items() if k != "d"]
    n, grand = sum(map(len, zs)), np.concatenate(zs).mean()
    between, within = sum(len(z) * (z.mean() - grand) ** 2 for z in zs), sum(((z - z.mean()) ** 2).sum() for z in zs)
    want = (n - 3) / 2 * between / within
    assert row.levene_statistic == pytest.approx(want) and row.levene_pvalue == pytest.approx(tails.f_upper(want, 2, n - 3)) and row.variances_equal is False


def test_power(spark):
    rows = [("a",)] * 64 + [("b",)] * 20 + [("c",)]
    got = stats.power_analysis(spark.createDataFrame(rows, "route_code string")).toPandas().set_index("route_code")
    assert got.loc["a", "actual_power"] == pytest.approx(0.80146, abs=1e-4) and got.loc["a", "is_sufficient"]
    assert got.loc["b", "actual_power"] == pytest.approx(0.337939, abs=1e-5) and not got.loc["b", "is_sufficient"]
    assert pd.isna(got.loc["c", "actual_power"])


def test_qq(series):
    df, pdf = series
    points = stats.qq_points(df.filter("route_code = 'white'"))
    x = np.sort(pdf[pdf.route_code == "white"]["avg_speed"].to_numpy())
    n = len(x)
    med = (np.arange(1, n + 1) - 0.3175) / (n + 0.365)
    med[-1] = 0.5 ** (1 / n)
    med[0] = 1 - med[-1]
    q = np.array([ND.inv_cdf(v) for v in med])
    got = points.toPandas().sort_values("theoretical")
    assert np.allclose(got["theoretical"], q, atol=1e-9) and np.allclose(got["ordered"], x)
    line = stats.qq_lines(points).first()
    slope, intercept = np.polyfit(q, x, 1)
    assert (line.slope, line.intercept) == (pytest.approx(slope), pytest.approx(intercept))


def test_residual_diagnostics(grid, grid_pd):
    got = stats.residual_diagnostics(grid).select("route_code", "residual", "std_residual").toPandas()
    fitted = grid_pd.groupby(["route_code", "hour", "day_of_week"])["avg_speed"].transform("mean")
    res = grid_pd["avg_speed"] - fitted
    std = res / res.groupby(grid_pd["route_code"]).transform("std")
    assert np.allclose(np.sort(got["std_residual"]), np.sort(std), atol=1e-9)


def test_residual_analysis(grid):
    parts = stats.residual_analysis(grid)
    summary = parts["summary"].toPandas()
    assert len(summary) == 3 and (summary["n"] == 720).all() and summary["shapiro_pvalue"].between(0, 1).all()
    assert parts["histogram"].groupBy("route_code").agg(F.sum("count").alias("n")).filter("n <> 720").count() == 0
