"""Seasonal decomposition, short forecasts and lagged correlation of routes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayspan.functions import columns as C
from wayspan.operators.anomaly import context_stats
from wayspan.operators.clean import ensure_calendar, hourly_means
from wayspan.operators.ordering import attach, core_rows, row_frames
from wayspan.operators.patterns import SALTS, only_routes, route_tiles

PERIOD = 168
FILL_HOURS = 3
MAX_LAG = 24
LAG_TILE_ROUTES = 32
LAG_TILE_HOURS = 4096

# Windows per route below run over hourly means: at most one row per route and hour of
# the time span, however many readings the route has.


def filled_hours(df: DataFrame, limit: int = FILL_HOURS) -> DataFrame:
    """Hourly means per route with gaps filled forward, then backward, up to ``limit`` hours;
    what stays empty is dropped. ``idx`` numbers the kept hours."""
    means = hourly_means(df).withColumnRenamed("avg_speed", "x")
    spine = means.groupBy("route_code").agg(F.min("hour_no").alias("lo"), F.max("hour_no").alias("hi")).select(
        "route_code", F.explode(F.sequence("lo", "hi")).alias("hour_no")
    )
    at = Window.partitionBy("route_code").orderBy("hour_no")
    rows = spine.join(means, ["route_code", "hour_no"], "left")
    rows = rows.withColumn("x", F.last("x", ignorenulls=True).over(at.rowsBetween(-limit, 0)))
    rows = rows.withColumn("x", F.first("x", ignorenulls=True).over(at.rowsBetween(0, limit)))
    return rows.dropna(subset=["x"]).withColumn("idx", (F.row_number().over(at) - 1).cast("bigint"))


def decomposition(df: DataFrame, route: str | None = None, period: int = PERIOD) -> DataFrame:
    """Additive decomposition per route: observed = trend + seasonal + resid.

    Trend is the centred moving mean with half weights at both ends, continued over the
    edges by the line through the nearest ``period`` trend values; the seasonal part is the
    mean detrended value per position in the period, shifted to mean 0. Routes with fewer
    than two periods of hours give no rows (see :func:`decomposition_status`).
    """
    series = filled_hours(only_routes(df, route))
    by = Window.partitionBy("route_code")
    at = by.orderBy("idx")
    half = period // 2
    series = series.withColumn("n", F.count(F.lit(1)).over(by)).filter(F.col("n") >= 2 * period)
    inner = F.sum("x").over(at.rowsBetween(-(half - 1), half - 1)) if period % 2 == 0 else F.sum("x").over(at.rowsBetween(-half, half))
    if period % 2 == 0:
        mean = (inner + 0.5 * (F.lag("x", half).over(at) + F.lead("x", half).over(at))) / period
    else:
        mean = inner / period
    full = (F.col("idx") >= half) & (F.col("idx") < F.col("n") - half)
    series = series.withColumn("raw_trend", F.when(full, mean))
    head = (F.col("idx") >= half) & (F.col("idx") < half + period)
    tail = (F.col("idx") >= F.col("n") - half - period) & (F.col("idx") < F.col("n") - half)
    lines = series.groupBy("route_code").agg(
        F.regr_slope(F.when(head, F.col("raw_trend")), F.when(head, F.col("idx"))).alias("s0"),
        F.regr_intercept(F.when(head, F.col("raw_trend")), F.when(head, F.col("idx"))).alias("i0"),
        F.regr_slope(F.when(tail, F.col("raw_trend")), F.when(tail, F.col("idx"))).alias("s1"),
        F.regr_intercept(F.when(tail, F.col("raw_trend")), F.when(tail, F.col("idx"))).alias("i1"),
    )
    joined = series.join(lines, "route_code")
    trend = (
        F.when(F.col("idx") < half, F.col("i0") + F.col("s0") * F.col("idx"))
        .when(F.col("idx") >= F.col("n") - half, F.col("i1") + F.col("s1") * F.col("idx")).otherwise(F.col("raw_trend"))
    )
    joined = joined.withColumn("trend", trend).withColumn("phase", (F.col("idx") % period).cast("int"))
    phases = joined.groupBy("route_code", "phase").agg(F.avg(F.col("x") - F.col("trend")).alias("m"))
    phases = phases.withColumn("seasonal", F.col("m") - F.avg("m").over(by)).drop("m")
    return joined.join(phases, ["route_code", "phase"]).select(
        "route_code", C.hour_from_number("hour_no").alias("timestamp"), "idx", "phase", F.col("x").alias("observed"), "trend", "seasonal",
        (F.col("x") - F.col("trend") - F.col("seasonal")).alias("resid"),
    )


def decomposition_status(df: DataFrame, period: int = PERIOD) -> DataFrame:
    """Per route: rows, kept hours and whether a decomposition is possible."""
    df = ensure_calendar(df)
    raw = df.groupBy("route_code").agg(F.count(F.lit(1)).alias("n_rows"))
    kept = filled_hours(df).groupBy("route_code").agg(F.count(F.lit(1)).alias("n_hours"))
    hours = F.coalesce("n_hours", F.lit(0).cast("bigint"))
    status = F.when(F.col("n_rows") < period, "too_few_rows").when(hours < 2 * period, "too_few_hours").otherwise("ok")
    return raw.join(kept, "route_code", "left").select("route_code", "n_rows", hours.alias("n_hours"), status.alias("status"))


def forecast(df: DataFrame, route: str | None = None, hours: int = 24) -> DataFrame:
    """Next ``hours`` per route: context mean with its 95 % interval, or the route mean where
    the hour and weekday were never seen."""
    df = only_routes(ensure_calendar(df), route)
    cells = context_stats(df)
    overall = df.groupBy("route_code").agg(
        F.max("timestamp").alias("last"), F.avg("avg_speed").alias("m_all"), F.stddev("avg_speed").alias("s_all")
    )
    ahead = overall.withColumn("hour_no", C.hour_number("last")).withColumn(
        "hour_no", F.explode(F.sequence(F.col("hour_no") + 1, F.col("hour_no") + hours))
    ).withColumn("timestamp", C.hour_from_number("hour_no"))
    ahead = ahead.withColumn("hour", F.hour("timestamp")).withColumn("day_of_week", C.day_name(F.col("timestamp").cast("date")))
    out = ahead.join(cells, ["route_code", "hour", "day_of_week"], "left")
    seen = F.col("context_n").isNotNull()
    centre = F.when(seen, F.col("expected_speed")).otherwise(F.col("m_all"))
    error = F.when(seen, F.when(F.col("context_n") > 0, F.col("context_std") / F.sqrt("context_n")).otherwise(F.col("context_std"))).otherwise(F.col("s_all"))
    return out.select(
        "route_code", "timestamp", centre.alias("forecast"), (centre - 1.96 * error).alias("ci_lower"), (centre + 1.96 * error).alias("ci_upper"),
        (~seen).alias("is_fallback"),
    )


def recent_readings(df: DataFrame, route: str | None = None, hours: int = 48) -> DataFrame:
    """Readings of the last ``hours`` of each route."""
    df = only_routes(ensure_calendar(df), route)
    last = df.groupBy("route_code").agg(F.max("timestamp").alias("_last"))
    joined = attach(df, last, ["route_code"], salts=SALTS)
    return joined.filter(F.col("timestamp") >= F.col("_last") - F.expr(f"interval {int(hours)} hours")).drop("_last")


def _pairs_of(pairs: DataFrame) -> DataFrame:
    """Wanted pairs in name order, each once."""
    a, b = F.least("route_a", "route_b"), F.greatest("route_a", "route_b")
    return pairs.filter("route_a <> route_b").select(a.alias("route_a"), b.alias("route_b")).distinct()


def _lags_by_row(series: DataFrame, wanted: DataFrame | None, max_lag: int, block_rows: int) -> DataFrame:
    """(route_a, route_b, lag, sxx, syy, sxy): lags count the hours that both routes have. The shared
    rows of a pair are numbered and cut into blocks, each with the ``max_lag`` rows before it."""
    side = lambda r, x: series.select(F.col("route_code").alias(r), F.col("hour_no").alias(f"hour_{x}"), F.col("x").alias(x))
    a, b = side("route_a", "xa"), side("route_b", "xb")
    same = F.col("hour_xa") == F.col("hour_xb")
    if wanted is None:
        rows = a.join(b, same & (F.col("route_a") < F.col("route_b")))
    else:
        rows = wanted.join(a, "route_a").join(b.withColumnRenamed("route_b", "other"), same & (F.col("route_b") == F.col("other")))
    rows = rows.select("route_a", "route_b", F.col("hour_xa").alias("hour_no"), "xa", "xb")
    framed, w = row_frames(rows, ["route_a", "route_b"], ["hour_no"], max_lag, 0, block_rows=block_rows)
    back = F.reverse(F.collect_list(F.struct("xa", "xb")).over(w.rowsBetween(-max_lag, 0)))
    core = core_rows(framed.withColumn("_back", back)).filter(F.col("n") >= max_lag)
    each = core.select("route_a", "route_b", "xa", "xb", F.posexplode("_back").alias("k", "old"))
    ahead = F.struct(F.col("k").alias("lag"), F.col("old.xa").alias("u"), F.col("xb").alias("v"))
    behind = F.struct((-F.col("k")).alias("lag"), F.col("xa").alias("u"), F.col("old.xb").alias("v"))
    both = each.select("route_a", "route_b", F.inline(F.when(F.col("k") > 0, F.array(ahead, behind)).otherwise(F.array(ahead))))
    sums = both.groupBy("route_a", "route_b", "lag").agg(F.regr_sxx("v", "u").alias("sxx"), F.regr_syy("v", "u").alias("syy"), F.regr_sxy("v", "u").alias("sxy"))
    # a lag that leaves no rows has its line too
    grid = core.select("route_a", "route_b").distinct().withColumn("lag", F.explode(F.sequence(F.lit(-max_lag), F.lit(max_lag))))
    return grid.join(sums, ["route_a", "route_b", "lag"], "left")


def _lags_by_hour(series: DataFrame, wanted: DataFrame | None, max_lag: int, least: int) -> DataFrame:
    """(route_a, route_b, lag, sxx, syy, sxy): lags are hours; hours that a route lacks are left out of
    its products. A task holds the hours of one stretch, and the ``max_lag`` before it, of one
    pair of route blocks, and returns sums for each pair and lag by matrix products."""
    if wanted is not None:
        named = wanted.select(F.col("route_a").alias("route_code")).union(wanted.select("route_b")).distinct()
        series = series.join(named, "route_code", "left_semi")
    span, hours = F.floor(F.col("hour_no") / LAG_TILE_HOURS), LAG_TILE_HOURS
    late = F.col("hour_no") % hours >= hours - max_lag
    tiles = route_tiles(series, LAG_TILE_ROUTES).withColumn("span", F.explode(F.when(late, F.array(span, span + 1)).otherwise(F.array(span))))

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        names, column = np.unique(pdf["route_code"].to_numpy(str), return_inverse=True)
        x = np.full((hours + max_lag, len(names)), np.nan)
        x[pdf["hour_no"].to_numpy() - int(pdf["span"].iloc[0]) * hours + max_lag, column] = pdf["x"]
        seen = (~np.isnan(x)).astype(float)
        x = np.where(seen > 0, x, 0.0)
        in_a = np.zeros(len(names), bool)
        in_a[column] = pdf["in_a"].to_numpy()
        mixed = pdf["tile_a"].iloc[0] != pdf["tile_b"].iloc[0]
        i, j = np.nonzero((in_a[:, None] != in_a) if mixed else ~np.eye(len(names), dtype=bool))
        out, now, m = [], x[max_lag:], seen[max_lag:]
        for k in range(max_lag + 1):
            old, o = x[max_lag - k : max_lag - k + hours], seen[max_lag - k : max_lag - k + hours]
            # entry [i, j]: route i at t - k with route j at t
            parts = {"n": o.T @ m, "su": old.T @ m, "sv": o.T @ now, "suu": (old * old).T @ m, "svv": o.T @ (now * now), "suv": old.T @ now}
            first = names[i] < names[j]
            keep = (parts["n"][i, j] > 0) & (first | (k > 0))
            a, b, first = i[keep], j[keep], first[keep]
            cells = {c: v[a, b] for c, v in parts.items()}
            # in name order: a lag of k if the earlier name is the older value, else of -k
            swap = lambda c, d: np.where(first, cells[c], cells[d])  # noqa: B023, E731
            out.append(pd.DataFrame({
                "route_a": np.where(first, names[a], names[b]), "route_b": np.where(first, names[b], names[a]), "lag": np.where(first, k, -k),
                "n": cells["n"], "su": swap("su", "sv"), "sv": swap("sv", "su"), "suu": swap("suu", "svv"), "svv": swap("svv", "suu"), "suv": cells["suv"],
            }))
        return pd.concat(out)

    fields = ("n", "su", "sv", "suu", "svv", "suv")
    schema = "route_a string, route_b string, lag int, " + ", ".join(f"{c} double" for c in fields)
    total = tiles.groupBy("tile_a", "tile_b", "span").applyInPandas(sums, schema).groupBy("route_a", "route_b", "lag").agg(*[F.sum(c).alias(c) for c in fields])
    if wanted is not None:
        total = total.join(wanted, ["route_a", "route_b"], "left_semi")
    enough = total.filter((F.col("lag") == 0) & (F.col("n") >= least)).select("route_a", "route_b", F.explode(F.sequence(F.lit(-max_lag), F.lit(max_lag))).alias("lag"))
    centred = lambda s2, p, q: F.col(s2) - F.col(p) * F.col(q) / F.col("n")
    # what rounding leaves of a constant stretch is no variance
    sure = lambda s2, p: F.when(centred(s2, p, p) > 1e-12 * F.col(s2), centred(s2, p, p)).otherwise(0.0)
    return enough.join(total, ["route_a", "route_b", "lag"], "left").select("route_a", "route_b", "lag", sure("suu", "su").alias("sxx"), sure("svv", "sv").alias("syy"), centred("suv", "su", "sv").alias("sxy"))


def lag_correlations(
    df: DataFrame, max_lag: int = MAX_LAG, routes: Sequence[str] | None = None, *, pairs: DataFrame | None = None, regularize: bool = False, block_rows: int = 100_000,
) -> DataFrame:
    """Correlation of every two routes at lags of -``max_lag`` to ``max_lag`` over their shared hours, in both orders.

    Lag k > 0 compares the first route with the second k rows later; with ``regularize`` k hours
    later, where gaps stay gaps. ``routes`` and ``pairs`` (route_a, route_b) select. Pairs with
    fewer than ``max_lag`` shared hours are left out; a lag without variation is NULL.
    """
    series = hourly_means(only_routes(df, routes)).dropna(subset=["avg_speed", "route_code"]).select(
        "route_code", "hour_no", (F.col("avg_speed") - F.avg("avg_speed").over(Window.partitionBy("route_code"))).alias("x")
    )
    wanted = None if pairs is None else _pairs_of(pairs)
    sums = _lags_by_hour(series, wanted, max_lag, max_lag) if regularize else _lags_by_row(series, wanted, max_lag, block_rows)
    size = F.sqrt(F.col("sxx") * F.col("syy"))
    found = sums.select("route_a", "route_b", "lag", F.when(size > 1e-12, F.col("sxy") / size).alias("correlation"))
    mirrored = F.array(F.struct("route_a", "route_b", "lag", "correlation"),
                       F.struct(F.col("route_b").alias("route_a"), F.col("route_a").alias("route_b"), (-F.col("lag")).alias("lag"), "correlation"))
    return found.select(F.inline(mirrored))


def best_lags(lags: DataFrame) -> DataFrame:
    """Lag with the largest absolute correlation per ordered pair; the lowest lag wins a tie."""
    size = F.round(F.abs("correlation"), 9)
    return lags.filter(F.col("correlation").isNotNull()).groupBy("route_a", "route_b").agg(
        F.max_by(F.struct("lag", "correlation"), F.struct(size, -F.col("lag"))).alias("b")
    ).select("route_a", "route_b", F.col("b.lag").alias("best_lag"), F.col("b.correlation").alias("best_correlation"))
