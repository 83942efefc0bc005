"""Lags of hours on routes with gaps, and lags of rows over blocks, against numpy."""

import numpy as np
import pandas as pd
import pytest

from wayspan.functions import tails
from wayspan.operators import forecast, stats


@pytest.fixture(scope="module")
def gappy():
    """Three weeks of four routes with short and long gaps, several readings in some hours."""
    rng = np.random.default_rng(8)
    hours = pd.date_range("2025-10-01", periods=500, freq="h")
    base = np.convolve(rng.normal(size=560), np.ones(6) / 6, "valid")
    rows = []
    for name, shift in (("A", 0), ("B", 4), ("C", 30), ("D", 9)):
        for t, ts in enumerate(hours):
            if rng.random() < 0.1 or 100 + shift < t < 160 or (name == "D" and t > 60):
                continue
            for _ in range(1 + (t % 17 == 0)):
                rows.append((ts.year, ts.month, ts.day, ts.hour, name, 30 + 5 * base[t + 40 - shift] + rng.normal() * 0.3))
    return pd.DataFrame(rows, columns=["year", "month", "day", "hour", "route_code", "avg_speed"])


@pytest.fixture(scope="module")
def wide(gappy):
    pdf = gappy.assign(ts=pd.to_datetime(gappy[["year", "month", "day", "hour"]]))
    return pdf.pivot_table(index="ts", columns="route_code", values="avg_speed").asfreq("h")


@pytest.mark.parametrize("hours,tile", [(4096, 32), (50, 1)])
def test_lag_correlations_of_hours(spark, gappy, wide, monkeypatch, hours, tile):
    monkeypatch.setattr(forecast, "LAG_TILE_HOURS", hours)
    monkeypatch.setattr(forecast, "LAG_TILE_ROUTES", tile)
    got = {(r.route_a, r.route_b, r.lag): r.correlation for r in forecast.lag_correlations(spark.createDataFrame(gappy), regularize=True).collect()}
    assert len(got) == 12 * 49
    for (a, b, lag), value in got.items():
        assert value == pytest.approx(wide[a].corr(wide[b].shift(-lag)), abs=1e-9)
    best = max(range(-24, 25), key=lambda k: got["A", "B", k])
    assert best == 4


def test_lag_correlations_of_rows_over_blocks(spark, gappy):
    df = spark.createDataFrame(gappy)
    key = lambda found: {(r.route_a, r.route_b, r.lag): r.correlation for r in found.collect()}
    whole, cut = key(forecast.lag_correlations(df)), key(forecast.lag_correlations(df, block_rows=30))
    assert whole.keys() == cut.keys() and all(cut[k] == pytest.approx(v, abs=1e-12) for k, v in whole.items())


@pytest.mark.parametrize("regularize", [False, True])
def test_pair_selection(spark, gappy, regularize):
    df = spark.createDataFrame(gappy)
    pairs = spark.createDataFrame([("C", "A"), ("A", "C"), ("B", "B"), ("B", "D"), ("A", "nowhere"), (None, "A")], "route_a string, route_b string")
    got = {(r.route_a, r.route_b, r.lag): r.correlation for r in forecast.lag_correlations(df, pairs=pairs, regularize=regularize).collect()}
    every = {(r.route_a, r.route_b, r.lag): r.correlation for r in forecast.lag_correlations(df, regularize=regularize).collect()}
    assert {k[:2] for k in got} == {("A", "C"), ("C", "A"), ("B", "D"), ("D", "B")}
    assert all(v == pytest.approx(every[k], abs=1e-12) for k, v in got.items())


def test_too_few_hours_and_constant_routes(spark):
    rows = [(2025, 10, 1 + t // 24, t % 24, name, speed) for t in range(40) for name, speed in (("A", 30.0), ("B", 20.0 + t % 7), ("C", 25.0 + t % 5)) if name != "C" or t < 20]
    df = spark.createDataFrame(rows, "year int, month int, day int, hour int, route_code string, avg_speed double")
    for regularize in (False, True):
        got = forecast.lag_correlations(df, regularize=regularize).toPandas()
        assert set(zip(got.route_a, got.route_b)) == {("A", "B"), ("B", "A")} and len(got) == 98
        assert got.correlation.isna().all()
        assert forecast.lag_correlations(df.limit(0), regularize=regularize).count() == 0


@pytest.mark.parametrize("block", [100_000, 40])
def test_autocorrelation_of_hours(spark, gappy, wide, block):
    got = {(r.route_code, r.lag): r.acf for r in stats.autocorrelation(spark.createDataFrame(gappy), block_rows=block, regularize=True).collect()}
    assert len(got) == 4 * 25
    for route in wide:
        c = (wide[route] - wide[route].mean()).to_numpy()
        for lag in range(25):
            both = np.nansum(c[lag:] * c[: len(c) - lag])
            assert got[route, lag] == pytest.approx(both / np.nansum(c * c), abs=1e-9)


def brute_adf(x, longest):
    """Lag by AIC on the rows that know all lags, final fit on those that know the chosen ones."""
    step = np.diff(x)

    def design(lags, rows):
        return np.column_stack([np.ones(len(rows)), x[rows], *[step[rows - k] for k in range(1, lags + 1)]]), step[rows]

    def fit(z, y):
        beta, *_ = np.linalg.lstsq(z, y, rcond=None)
        ssr = ((y - z @ beta) ** 2).sum()
        aic = len(y) * (np.log(2 * np.pi * ssr / len(y)) + 1) + 2 * z.shape[1]
        return aic, beta[1] / np.sqrt(np.linalg.inv(z.T @ z)[1, 1] * ssr / (len(y) - z.shape[1]))

    def rows(lags):
        at = np.arange(lags, len(step))
        z, y = design(lags, at)
        return at[np.isfinite(z).all(1) & np.isfinite(y)]

    common = rows(longest)
    best = min(range(longest + 1), key=lambda k: fit(*design(k, common))[0])
    used = rows(best)
    return fit(*design(best, used))[1], best, len(used)


@pytest.mark.parametrize("block", [50_000, 60])
def test_stationarity_of_hours(spark, gappy, wide, block):
    got = {r.route_code: r for r in stats.stationarity(spark.createDataFrame(gappy), regularize=True, block_rows=block).collect()}
    for route in wide:
        x = wide[route].dropna().to_numpy()
        longest = int(min(np.ceil(12 * (len(x) / 100) ** 0.25), len(x) // 2 - 2))
        series = wide[route].loc[wide[route].first_valid_index() : wide[route].last_valid_index()]
        if route == "D":
            continue  # no stretch of it is long enough for all lags
        stat, lag, n = brute_adf(series.to_numpy() - x.mean(), longest)
        r = got[route]
        assert (r.used_lag, r.n_obs) == (lag, n) and r.adf_statistic == pytest.approx(stat, rel=1e-7)
        assert r.adf_pvalue == pytest.approx(tails.adf_pvalue(stat)) and r.is_stationary == (r.adf_pvalue < 0.05)


def test_stationarity_of_rows_over_blocks(spark, gappy, wide):
    df = spark.createDataFrame(gappy.groupby(["route_code", "year", "month", "day", "hour"], as_index=False).avg_speed.mean())
    got = {r.route_code: r for r in stats.stationarity(df.selectExpr("*", "make_timestamp(year, month, day, hour, 0, 0) AS timestamp"), block_rows=50).collect()}
    for route in wide:
        x = wide[route].dropna().to_numpy()
        longest = int(min(np.ceil(12 * (len(x) / 100) ** 0.25), len(x) // 2 - 2))
        stat, lag, n = brute_adf(x - x.mean(), longest)
        assert (got[route].used_lag, got[route].n_obs) == (lag, n) and got[route].adf_statistic == pytest.approx(stat, rel=1e-7)
