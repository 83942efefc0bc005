"""Tail probabilities for one-row-per-route results (scalar helpers and Arrow UDFs)."""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

NORMAL = NormalDist()


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_inc(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 1.0 / (1.0 - (a + b) * x / (a + 1.0) or 1e-300)
    value = d
    for m in range(1, 5000):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 / (1.0 + term * d or tiny)
            c = 1.0 + term / c or tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * value


def t_two_sided(t: float, df: float) -> float:
    return beta_inc(df / 2.0, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    return beta_inc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def correlation_pvalue(r: float, n: float) -> float:
    """Two-sided p-value of a correlation of ``n`` pairs."""
    if r is None or n is None or math.isnan(r) or n < 2:
        return float("nan")
    if n == 2:
        return 1.0
    if abs(r) >= 1.0:
        return 0.0
    return t_two_sided(r * math.sqrt((n - 2.0) / (1.0 - r * r)), n - 2.0)


def _vector(fn):
    def run(*cols: pd.Series) -> pd.Series:
        return pd.Series([fn(*map(float, row)) if not any(pd.isna(v) for v in row) else None for row in zip(*cols)], dtype="float64")

    return run


@F.pandas_udf(T.DoubleType())
def correlation_p(r: pd.Series, n: pd.Series) -> pd.Series:
    return _vector(correlation_pvalue)(r, n)


@F.pandas_udf(T.DoubleType())
def f_tail(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vector(f_upper)(f, d1, d2)


# --- two-sample t power -----------------------------------------------------------------

@lru_cache(maxsize=4096)
def t_quantile_upper(q: float, df: float) -> float:
    """t with upper tail ``q`` (q < 0.5), by bisection."""
    low, high = 0.0, 1.0
    while t_two_sided(high, df) / 2.0 > q:
        high *= 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        low, high = (mid, high) if t_two_sided(mid, df) / 2.0 > q else (low, mid)
    return (low + high) / 2.0


def _phi(x: np.ndarray) -> np.ndarray:
    return np.array([0.5 * math.erfc(-v / math.sqrt(2.0)) for v in x])


@lru_cache(maxsize=4096)
def t_power(effect: float, nobs: float, alpha: float) -> float:
    """Two-sided power of the two-sample t test with ``nobs`` in each sample.

    The noncentral t tails are integrals of the normal distribution function over the
    chi distribution of the standard error, done with Gauss-Legendre nodes.
    """
    df = 2.0 * nobs - 2.0
    if df <= 0:
        return float("nan")
    shift, crit = effect * math.sqrt(nobs / 2.0), t_quantile_upper(alpha / 2.0, df)
    spread = 1.0 / math.sqrt(2.0 * df)
    low, high = max(1e-12, 1.0 - 12.0 * spread), 1.0 + 12.0 * spread
    if df < 30:
        low, high = 1e-12, 1.0 + 14.0 * spread
    nodes, weights = np.polynomial.legendre.leggauss(240)
    s = 0.5 * (high - low) * nodes + 0.5 * (high + low)
    log_density = math.log(2.0) + 0.5 * df * math.log(df / 2.0) - math.lgamma(df / 2.0) + (df - 1.0) * np.log(s) - df * s * s / 2.0
    tails = _phi(shift - crit * s) + _phi(-crit * s - shift)
    return float(min(1.0, 0.5 * (high - low) * np.sum(weights * np.exp(log_density) * tails)))


def t_required(effect: float, alpha: float, power: float) -> float:
    """Sample size per group (not rounded) that reaches ``power``."""
    low, high = 2.0, 4.0
    if t_power(effect, low, alpha) >= power:
        return low
    while t_power(effect, high, alpha) < power:
        high *= 2.0
        if high > 1e12:
            return float("nan")
    for _ in range(100):
        mid = (low + high) / 2.0
        low, high = (mid, high) if t_power(effect, mid, alpha) < power else (low, mid)
    return (low + high) / 2.0


# --- Shapiro-Wilk (Royston 1995, AS R94) ---------------------------------------------------

# Published polynomial coefficients, lowest power first.
ROYSTON_LAST = [0.0, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056]
ROYSTON_NEXT = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
ROYSTON_SMALL_MEAN = [0.5440, -0.39978, 0.025054, -6.714e-4]
ROYSTON_SMALL_SD = [1.3822, -0.77857, 0.062767, -0.0020322]
ROYSTON_LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
ROYSTON_LARGE_SD = [-0.4803, -0.082676, 0.0030302]
ROYSTON_GAMMA = [-2.273, 0.459]


def _poly(c, x):
    return sum(k * x**i for i, k in enumerate(c))


def shapiro_from_sums(n, sum_m2, m_last, m_next, x_first, x_second, x_next, x_last, inner_mx, ssx) -> tuple[float, float]:
    """(W, p) from per-group sums.

    ``m_i`` are expected normal scores, ``x`` the sorted values; ``inner_mx`` is the sum
    of m_i x_i without the two (n > 5) or one outer pairs, ``ssx`` the centred squares.
    """
    n = int(n)
    if n < 3 or not ssx > 0:
        return float("nan"), float("nan")
    if n == 3:
        a_last = math.sqrt(0.5)
        w = (a_last * (x_last - x_first)) ** 2 / ssx
        p = 6.0 / math.pi * (math.asin(math.sqrt(min(w, 1.0))) - math.asin(math.sqrt(0.75)))
        return w, min(max(p, 0.0), 1.0)
    root, u = math.sqrt(sum_m2), 1.0 / math.sqrt(n)
    a_last = _poly(ROYSTON_LAST, u) + m_last / root
    if n > 5:
        a_next = _poly(ROYSTON_NEXT, u) + m_next / root
        scale = math.sqrt((sum_m2 - 2 * m_last**2 - 2 * m_next**2) / (1 - 2 * a_last**2 - 2 * a_next**2))
        top = a_last * (x_last - x_first) + a_next * (x_next - x_second) + inner_mx / scale
    else:
        scale = math.sqrt((sum_m2 - 2 * m_last**2) / (1 - 2 * a_last**2))
        top = a_last * (x_last - x_first) + inner_mx / scale
    w = min(top * top / ssx, 1.0)
    y, log_n = math.log(max(1.0 - w, 1e-300)), math.log(n)
    if n <= 11:
        gamma = _poly(ROYSTON_GAMMA, n)
        if y >= gamma:
            return w, 1e-99
        y = -math.log(gamma - y)
        mean, sd = _poly(ROYSTON_SMALL_MEAN, n), math.exp(_poly(ROYSTON_SMALL_SD, n))
    else:
        mean, sd = _poly(ROYSTON_LARGE_MEAN, log_n), math.exp(_poly(ROYSTON_LARGE_SD, log_n))
    return w, 0.5 * math.erfc((y - mean) / sd / math.sqrt(2.0))


# --- Anderson-Darling for the normal family ---------------------------------------------------

# Critical points of the corrected statistic and their significance levels.
ANDERSON_POINTS = [0.561, 0.631, 0.752, 0.873, 1.035]
ANDERSON_LEVELS = [0.15, 0.10, 0.05, 0.025, 0.01]


def anderson_pvalue(stat: float, n: float) -> float:
    """p-value interpolated between the tabulated levels, held at the end levels."""
    crit = np.round(np.array(ANDERSON_POINTS) / (1.0 + 0.75 / n + 2.25 / n / n), 3)
    return float(np.interp(stat, crit, ANDERSON_LEVELS))


# --- Dickey-Fuller (constant, one series; MacKinnon 1994, 2010) --------------------------------

# Published response surface coefficients.
DF_MAX, DF_MIN, DF_STAR = 2.74, -18.83, -1.61
DF_SMALL = [2.1659, 1.4412, 0.038269]
DF_LARGE = [1.7339, 0.93202, -0.12745, -0.010368]
DF_CRIT_5 = [-2.86154, -2.8903, -4.234, -40.04]


def adf_pvalue(stat: float) -> float:
    if stat > DF_MAX:
        return 1.0
    if stat < DF_MIN:
        return 0.0
    return NORMAL.cdf(_poly(DF_SMALL if stat <= DF_STAR else DF_LARGE, stat))


def adf_critical_5pct(nobs: float) -> float:
    return _poly(DF_CRIT_5, 1.0 / nobs)
