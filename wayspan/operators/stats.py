"""Statistical tests per route. Sums are Spark aggregates; only a short finish per route is Python."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayspan.functions import normal, tails
from wayspan.operators.anomaly import with_expected
from wayspan.operators.clean import hourly_means
from wayspan.operators.forecast import decomposition
from wayspan.operators.ordering import SALTS, attach, core_rows, expand_counts, group_quantiles, row_frames, running_counts, with_positions
from wayspan.operators.patterns import histogram, only_routes

NORMALITY = T.StructType([T.StructField(n, T.DoubleType()) for n in ("shapiro_statistic", "shapiro_pvalue", "anderson_pvalue")])
SHAPIRO_SUMS = ["n", "sum_m2", "m_last", "m_next", "x_first", "x_second", "x_next", "x_last", "inner_mx", "ssx"]


@F.pandas_udf(NORMALITY)
def _finish_normality(sums: pd.DataFrame, a2: pd.Series) -> pd.DataFrame:
    out = []
    for (_, row), stat in zip(sums.iterrows(), a2):
        w, p = tails.shapiro_from_sums(*[row[c] for c in SHAPIRO_SUMS])
        out.append((w, p, tails.anderson_pvalue(stat, row["n"]) if row["n"] >= 8 and not pd.isna(stat) else None))
    frame = pd.DataFrame(out, columns=["shapiro_statistic", "shapiro_pvalue", "anderson_pvalue"], dtype="float64")
    return frame.where(frame.notna(), None)


def normality(df: DataFrame, value: str = "avg_speed") -> DataFrame:
    """Shapiro-Wilk (n >= 3) and Anderson-Darling (n >= 8) per route.

    Order positions come from value counts, so repeated speeds are counted before anything
    is sorted.
    """
    rows = df.select("route_code", F.col(value).cast("double").alias("x")).dropna()
    stats = rows.groupBy("route_code").agg(F.avg("x").alias("_mu"), F.stddev("x").alias("_sd"))
    steps = attach(running_counts(rows, ["route_code"], "x"), stats, ["route_code"], salts=SALTS)
    each = expand_counts(steps).withColumn("i", F.col("pos") + 1)
    each = normal.add_quantile(each, (F.col("i") - 0.375) / (F.col("n") + 0.25), "m")
    z = F.try_divide(F.col("x") - F.col("_mu"), F.col("_sd"))
    each = normal.add_log_cdf(normal.add_log_cdf(each, z, "_low"), -z, "_high")
    each = each.withColumn("_ad", (2 * F.col("i") - 1) * F.col("_low") + (2 * (F.col("n") - F.col("i")) + 1) * F.col("_high"))
    i, n, x, m = F.col("i"), F.col("n"), F.col("x"), F.col("m")
    outer = F.when(n > 5, F.lit(2)).otherwise(F.lit(1))
    at = lambda cond, c: F.max(F.when(cond, c))
    sums = each.groupBy("route_code").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(m * m).alias("sum_m2"), at(i == n, m).alias("m_last"),
        at(i == n - 1, m).alias("m_next"), at(i == 1, x).alias("x_first"), at(i == 2, x).alias("x_second"),
        at(i == n - 1, x).alias("x_next"), at(i == n, x).alias("x_last"),
        F.sum(F.when((i > outer) & (i <= n - outer), m * x).otherwise(F.lit(0.0))).alias("inner_mx"),
        (F.var_pop(x) * F.count(F.lit(1))).alias("ssx"), F.sum("_ad").alias("_ad"),
    )
    a2 = F.when(F.col("n") >= 8, -F.col("n") - F.col("_ad") / F.col("n"))
    out = sums.withColumn("anderson_statistic", a2).withColumn("_f", _finish_normality(F.struct(*SHAPIRO_SUMS), F.col("anderson_statistic")))
    clean = lambda c: F.when(~F.isnan(c), F.col(c))
    return out.select(
        "route_code", clean("_f.shapiro_statistic").alias("shapiro_statistic"), clean("_f.shapiro_pvalue").alias("shapiro_pvalue"),
        "anderson_statistic", clean("_f.anderson_pvalue").alias("anderson_pvalue"),
    ).withColumn("is_normal", F.col("shapiro_pvalue") > 0.05)


def qq_points(df: DataFrame, value: str = "avg_speed") -> DataFrame:
    """Normal quantile against ordered value per route (three or more rows)."""
    rows = df.select("route_code", F.col(value).cast("double").alias("ordered")).dropna()
    each = expand_counts(running_counts(rows, ["route_code"], "ordered")).filter(F.col("n") >= 3)
    i, n = F.col("pos") + 1, F.col("n")
    edge = F.pow(F.lit(0.5), F.lit(1.0) / n)
    median = F.when(i == n, edge).when(i == 1, 1.0 - edge).otherwise((i - 0.3175) / (n + 0.365))
    return normal.add_quantile(each, median, "theoretical").select("route_code", "theoretical", "ordered")


def qq_lines(points: DataFrame) -> DataFrame:
    """Line fitted through the points of each route."""
    return points.groupBy("route_code").agg(
        F.regr_slope("ordered", "theoretical").alias("slope"), F.regr_intercept("ordered", "theoretical").alias("intercept"),
        F.corr("ordered", "theoretical").alias("r"), F.count(F.lit(1)).alias("n"),
    )


# --- autocorrelation -----------------------------------------------------------------------------

def autocorrelation(
    df: DataFrame, max_lags: int = 24, order: Sequence[str] = ("timestamp",), value: str = "avg_speed",
    block_rows: int = 100_000, *, regularize: bool = False,
) -> DataFrame:
    """Autocorrelation at row lags 0..max in time order, equal times by value; NULL for routes with
    too few rows. With ``regularize``, of the hourly means at lags of hours: hours that are missing
    at either end of a lag are left out of its sum."""
    if regularize:
        return _hourly_autocorrelation(df, max_lags, value, block_rows)
    keys, names = ["route_code"], [f"_o{i}" for i in range(len(order))]
    rows = df.select(*keys, F.col(value).alias("x"), *[F.col(c).alias(n) for c, n in zip(order, names)]).dropna(subset=["x"])
    means = rows.groupBy(*keys).agg(F.avg("x").alias("_mu"), F.count(F.lit(1)).alias("_n"))
    centred = attach(rows, means.filter(F.col("_n") > max_lags), keys, salts=SALTS).withColumn("c", F.col("x") - F.col("_mu"))
    framed, w = row_frames(centred, keys, [*names, "x"], max_lags, 0, block_rows=block_rows)
    lagged = core_rows(framed.withColumns({f"l{k}": F.lag("c", k).over(w) for k in range(1, max_lags + 1)}))
    sums = lagged.groupBy(*keys).agg(F.sum(F.col("c") * F.col("c")).alias("s0"), *[F.sum(F.col("c") * F.col(f"l{k}")).alias(f"s{k}") for k in range(1, max_lags + 1)])
    grid = means.select(*keys).join(sums, keys, "left")
    cells = [F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"s{k}"), F.col("s0")).alias("acf")) for k in range(max_lags + 1)]
    return grid.select(*keys, F.inline(F.array(*cells)))


def hour_frames(series: DataFrame, before: int, block_hours: int) -> tuple[DataFrame, WindowSpec]:
    """Hourly rows (route_code, hour_no) in blocks of ``block_hours``, each with the ``before`` hours in front of
    it, and a window in hour order; ``_core`` tells own rows from copies. Gaps need no rows."""
    size = max(block_hours, before)
    own, off = F.floor(F.col("hour_no") / size), F.pmod(F.col("hour_no"), F.lit(size))
    copies = F.array_compact(F.array(own, F.when(off >= size - before, own + 1)))
    framed = series.withColumn("_own", own).withColumn("_frame", F.explode(copies)).withColumn("_core", F.col("_frame") == F.col("_own")).drop("_own")
    return framed.repartition("route_code", "_frame"), Window.partitionBy("route_code", "_frame").orderBy("hour_no")


def _hourly_autocorrelation(df: DataFrame, max_lags: int, value: str, block_hours: int) -> DataFrame:
    series = hourly_means(df, value).withColumnRenamed(value, "x").dropna(subset=["x"])
    means = series.groupBy("route_code").agg(F.avg("x").alias("_mu"), F.count(F.lit(1)).alias("_n"))
    centred = attach(series, means.filter(F.col("_n") > max_lags), ["route_code"]).select("route_code", "hour_no", (F.col("x") - F.col("_mu")).alias("c"))
    framed, w = hour_frames(centred, max_lags, block_hours)
    back = F.collect_list(F.struct("hour_no", "c")).over(w.rangeBetween(-max_lags, 0))
    each = framed.withColumn("_back", back).filter("_core").select("route_code", "hour_no", "c", F.explode("_back").alias("old"))
    sums = each.groupBy("route_code", (F.col("hour_no") - F.col("old.hour_no")).cast("int").alias("lag")).agg(F.sum(F.col("c") * F.col("old.c")).alias("s"))
    total = sums.filter("lag = 0").select("route_code", F.col("s").alias("s0"))
    enough = attach(means.select("route_code", F.explode(F.sequence(F.lit(0), F.lit(max_lags))).alias("lag"), (F.col("_n") > max_lags).alias("_ok")), total, ["route_code"], "left")
    # a lag without any two hours has a sum of nothing
    return attach(enough, sums, ["route_code", "lag"], "left").select(
        "route_code", "lag", F.when(F.col("_ok"), F.try_divide(F.coalesce("s", F.lit(0.0)), F.col("s0"))).alias("acf")
    )


# --- unit root ---------------------------------------------------------------------------------------

ADF_RESULT = "route_code string, adf_statistic double, adf_pvalue double, critical_value_5pct double, used_lag int, n_obs long"


def _fit(gram: np.ndarray, k: int, nobs: float) -> tuple[float, float]:
    """(AIC, t value of the level) of the regression on the first ``k`` columns; last column is the target."""
    xx, xy, yy = gram[:k, :k], gram[:k, -1], gram[-1, -1]
    scale = np.sqrt(np.diag(xx))
    inv = np.linalg.inv(xx / np.outer(scale, scale)) / np.outer(scale, scale)
    beta = inv @ xy
    ssr = float(yy - xy @ beta)
    loglike = -0.5 * nobs * (np.log(2 * np.pi * ssr / nobs) + 1.0)
    return -2.0 * loglike + 2.0 * k, float(beta[1] / np.sqrt(inv[1, 1] * ssr / (nobs - k)))


def _design(x: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """For the values after the first p + 1: constant, level before, lagged steps 1..p, step; and how many
    of the lagged steps, from the first, are known without a gap (-1: not even level and step)."""
    step, at = np.diff(x), np.arange(p + 1, len(x))
    z = np.column_stack([np.ones(len(at)), x[at - 1], *[step[at - 1 - k] for k in range(1, p + 1)], step[at - 1]])
    known = np.isfinite(z)
    reach = np.logical_and.accumulate(known[:, 2:-1], axis=1).sum(1)
    return z, np.where(known[:, 1] & known[:, -1], reach, -1)


def stationarity(
    df: DataFrame, order: Sequence[str] = ("timestamp",), value: str = "avg_speed", block_rows: int = 50_000, *, regularize: bool = False, lags: int | None = None,
) -> DataFrame:
    """Augmented Dickey-Fuller test per route with a constant; lag by AIC up to ``lags`` (by default a
    number that grows with the rows); NULL below 12 rows.

    Blocks of rows (with the rows before them) give their cross-product matrices, one for the rows
    that know all lagged steps and one for each smaller number of them; the matrices of a route
    are summed by Spark and solved once. AIC compares the lags on the rows that know all; the final
    fit uses every row that knows the chosen ones. With ``regularize`` steps are hours of the hourly
    means: a step into, out of or over a gap is unknown, and gaps need no rows.
    """
    if regularize:
        series = hourly_means(df, value).select("route_code", "hour_no", F.col(value).cast("double").alias("x")).dropna(subset=["route_code", "x"])
        ends = series.groupBy("route_code").agg(F.min("hour_no").alias("_first"), F.max("hour_no").alias("_last"), F.count(F.lit(1)).alias("n"), F.avg("x").alias("_mu"))
        placed = attach(series, ends, ["route_code"]).select("route_code", (F.col("hour_no") - F.col("_first")).alias("pos"), "n", (F.col("_last") - F.col("_first") + 1).alias("_size"), (F.col("x") - F.col("_mu")).alias("x"))
    else:
        rows = df.select("route_code", F.col(value).cast("double").alias("x"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]).dropna(subset=["x"])
        means = rows.groupBy("route_code").agg(F.avg("x").alias("_mu"))
        numbered = with_positions(rows, ["route_code"], [*[f"_o{i}" for i in range(len(order))], "x"]).select("route_code", "pos", "n", F.col("n").alias("_size"), "x")
        placed = attach(numbered, means, ["route_code"], salts=SALTS).withColumn("x", F.col("x") - F.col("_mu")).drop("_mu")
    longest = F.least(F.ceil(F.lit(12.0) * F.pow(F.col("n") / 100.0, F.lit(0.25))), F.floor(F.col("n") / 2) - 2)
    centred = placed.filter("n >= 12").withColumn("lags", (longest if lags is None else F.least(F.lit(lags), longest)).cast("int"))
    # frames whose reach depends on the route: lags + 1 rows before each block
    size = F.lit(block_rows)
    own, off = F.floor(F.col("pos") / size), F.col("pos") % size
    copies = F.array_compact(F.array(own, F.when(off >= size - F.col("lags") - 1, own + 1)))
    framed = centred.withColumn("block", F.explode(copies)).filter(F.col("block") * size < F.col("_size")).repartition("route_code", "block")

    def moments(pdf: pd.DataFrame) -> pd.DataFrame:
        p, start = int(pdf["lags"].iloc[0]), int(pdf["block"].iloc[0]) * block_rows
        at = pdf["pos"].to_numpy() - start + p + 1
        x = np.full(max(int(at.max()), p + 1) + 1, np.nan)
        x[at] = pdf["x"]
        z, reach = _design(x, p)
        cells = np.zeros((p + 1, (p + 3) ** 2 + 1))
        for r in range(p + 1):
            own = z[reach == r].copy()
            own[:, 2 + r : -1] = 0.0
            cells[r, :-1], cells[r, -1] = (own.T @ own).ravel(), len(own)
        return pd.DataFrame({"route_code": [pdf["route_code"].iloc[0]], "lags": [p], "sums": [cells.ravel().tolist()]})

    parts = framed.groupBy("route_code", "block").applyInPandas(moments, "route_code string, lags int, sums array<double>")
    cells = parts.select("route_code", "lags", F.posexplode("sums").alias("cell", "v")).filter("v <> 0").groupBy("route_code", "lags", "cell").agg(F.sum("v").alias("v"))
    # a few thousand sums a route
    ready = cells.groupBy("route_code", "lags").agg(F.collect_list(F.struct("cell", "v")).alias("g")).select(
        "route_code", "lags", F.transform("g", lambda s: s["cell"]).alias("cells"), F.transform("g", lambda s: s["v"]).alias("sums")
    )

    def finish(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                p = int(r.lags)
                sums = np.zeros((p + 1) * ((p + 3) ** 2 + 1))
                sums[np.asarray(r.cells, int)] = r.sums
                try:
                    out.append((r.route_code, *_solve_adf(sums.reshape(p + 1, -1), p)))
                except (np.linalg.LinAlgError, ValueError, FloatingPointError):
                    out.append((r.route_code, None, None, None, None, None))
            yield pd.DataFrame(out, columns=["route_code", "adf_statistic", "adf_pvalue", "critical_value_5pct", "used_lag", "n_obs"])

    solved = ready.mapInPandas(finish, ADF_RESULT)
    routes = df.select("route_code").dropna().distinct()
    return routes.join(solved, "route_code", "left").withColumn("is_stationary", F.col("adf_pvalue") < 0.05)


def _solve_adf(sums: np.ndarray, p: int):
    """Row r of ``sums``: cross products and number of the rows that know r lagged steps."""
    grams, counts = sums[:, :-1].reshape(p + 1, p + 3, p + 3), sums[:, -1]
    with np.errstate(all="raise"):
        tries = [_fit(grams[p], 2 + k, counts[p])[0] for k in range(p + 1)]
        best = int(np.argmin(tries))
        keep = [*range(2 + best), p + 2]
        final, total = grams[best:].sum(0)[np.ix_(keep, keep)], int(counts[best:].sum())
        stat = _fit(final, 2 + best, total)[1]
    if not np.isfinite(stat):
        raise ValueError("no finite statistic")
    return stat, tails.adf_pvalue(stat), tails.adf_critical_5pct(total), best, total


# --- variance and power ---------------------------------------------------------------------------------

def variance_homogeneity(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Levene test across routes, centred at the medians (one row)."""
    rows = df.select("route_code", "avg_speed").dropna()
    centre = group_quantiles(rows, ["route_code"], "avg_speed", {"med": 0.5}, accuracy=accuracy)
    z = attach(rows, centre, ["route_code"], salts=SALTS).select("route_code", F.abs(F.col("avg_speed") - F.col("med")).alias("z"))
    per = z.groupBy("route_code").agg(F.count(F.lit(1)).alias("n"), F.avg("z").alias("m"), F.var_pop("z").alias("v")).filter("n >= 2")
    k, total = F.count(F.lit(1)), F.sum("n")
    grand = F.sum(F.col("n") * F.col("m")) / total
    between = F.sum(F.col("n") * F.col("m") * F.col("m")) - total * grand * grand
    sums = per.agg(k.alias("k"), total.alias("total"), between.alias("between"), F.sum(F.col("n") * F.col("v")).alias("within"))
    stat = F.when(F.col("k") >= 2, F.try_divide((F.col("total") - F.col("k")) * F.col("between"), (F.col("k") - 1) * F.col("within")))
    out = sums.select(stat.alias("levene_statistic"), F.col("k").alias("n_routes"), F.col("total").alias("n_rows"))
    p = tails.f_tail("levene_statistic", (F.col("n_routes") - 1).cast("double"), (F.col("n_rows") - F.col("n_routes")).cast("double"))
    return out.withColumn("levene_pvalue", F.when(F.col("levene_statistic").isNotNull(), p)).withColumn("variances_equal", F.col("levene_pvalue") > 0.05)


def route_variances(df: DataFrame) -> DataFrame:
    return df.groupBy("route_code").agg(F.variance("avg_speed").alias("variance"))


def power_analysis(df: DataFrame, effect_size: float = 0.5, alpha: float = 0.05, power: float = 0.8) -> DataFrame:
    """Rows per route against the sample size a two-sample t test needs."""
    needed = tails.t_required(effect_size, alpha, power)

    @F.pandas_udf(T.DoubleType())
    def achieved(n: pd.Series) -> pd.Series:
        return n.map(lambda v: tails.t_power(effect_size, float(v), alpha) if v >= 2 else None)

    sizes = df.groupBy("route_code").agg(F.count(F.lit(1)).alias("sample_size"))
    distinct = sizes.select("sample_size").distinct().withColumn("actual_power", achieved("sample_size"))
    out = sizes.join(distinct, "sample_size", "left").withColumn("required_sample_size", F.lit(needed))
    enough = F.when(F.col("sample_size") >= 2, F.col("sample_size") >= F.col("required_sample_size"))
    return out.select("route_code", "sample_size", "required_sample_size", "actual_power", enough.alias("is_sufficient"))


# --- residuals -----------------------------------------------------------------------------------------------

def residual_diagnostics(df: DataFrame, route: str | None = None) -> DataFrame:
    """Fitted (hour, weekday) mean, residual, standardised residual and its root per reading."""
    out = with_expected(only_routes(df, route), spread=True)
    return out.withColumnsRenamed({"expected_speed": "fitted", "deviation": "residual"}).withColumn(
        "std_residual", F.try_divide(F.col("residual"), F.col("residual_std"))
    ).withColumn("sqrt_std_residual", F.sqrt(F.abs("std_residual"))).drop("context_std", "context_n", "residual_std", "route_rows")


def residual_analysis(df: DataFrame, route: str | None = None) -> dict[str, DataFrame]:
    """Residuals of the decomposition: summary with Shapiro-Wilk, histogram, Q-Q points and
    autocorrelation, each over all of them."""
    parts = decomposition(df, route).select("route_code", "timestamp", "idx", "resid")
    test = normality(parts, "resid")
    summary = parts.groupBy("route_code").agg(F.avg("resid").alias("mean"), F.stddev("resid").alias("std"), F.count("resid").alias("n")).join(
        test.select("route_code", "shapiro_pvalue", "is_normal"), "route_code", "left"
    )
    return {
        "summary": summary, "histogram": histogram(parts, "resid"), "qq": qq_points(parts, "resid"),
        "acf": autocorrelation(parts, order=["idx"], value="resid"),
    }
