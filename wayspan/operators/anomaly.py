"""Control chart and contextual anomalies (against the same hour and weekday)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayspan.functions import columns as C
from wayspan.operators.clean import ensure_calendar
from wayspan.operators.enrich import with_labels
from wayspan.operators.ordering import attach, core_rows, row_frames
from wayspan.operators.patterns import SALTS, only_routes

CONTEXT = ["route_code", "hour", "day_of_week"]
WEEK_ROWS = 168


def context_stats(df: DataFrame) -> DataFrame:
    """Mean, deviation and rows per route, hour and weekday (at most 168 rows per route); readings
    of unknown hour or day belong to no context."""
    return df.filter(F.col("hour").isNotNull() & F.col("day_of_week").isNotNull()).groupBy(*CONTEXT).agg(
        F.avg("avg_speed").alias("expected_speed"), F.stddev("avg_speed").alias("context_std"),
        F.count("avg_speed").alias("context_n"), F.var_pop("avg_speed").alias("context_var"),
    )


def route_residual_spread(cells: DataFrame) -> DataFrame:
    """Add the deviation of all residuals of a route to its context cells, from the cells alone (the residuals' mean is 0)."""
    route = Window.partitionBy("route_code")  # at most 168 cells
    ss = F.sum(F.col("context_var") * F.col("context_n")).over(route)
    n = F.sum("context_n").over(route)
    return cells.withColumns({"residual_std": F.sqrt(F.try_divide(ss, n - 1)), "route_rows": n})


def with_expected(df: DataFrame, spread: bool = False, onto: DataFrame | None = None) -> DataFrame:
    """Add the context mean and the deviation from it; optionally the route's residual spread.

    The facts meet one small table of context cells. A reading without a context is kept, its
    expectation is NULL. ``onto`` are rows made from ``df`` that get the figures in its place.
    """
    df = ensure_calendar(df)
    cells = context_stats(df)
    small = route_residual_spread(cells) if spread else cells
    out = attach(df if onto is None else onto, small.drop("context_var"), CONTEXT, "left")
    return out.withColumn("deviation", F.col("avg_speed") - F.col("expected_speed"))


def control_chart(df: DataFrame, route: str | None = None) -> DataFrame:
    """Readings with the mean, the 2 and 3 sigma limits of their route and the anomaly flag."""
    df = only_routes(ensure_calendar(df), route)
    stats = df.groupBy("route_code").agg(F.avg("avg_speed").alias("mean_speed"), F.stddev("avg_speed").alias("std_speed"))
    limits = {
        "ucl": F.col("mean_speed") + 3 * F.col("std_speed"), "lcl": F.col("mean_speed") - 3 * F.col("std_speed"),
        "uwl": F.col("mean_speed") + 2 * F.col("std_speed"), "lwl": F.col("mean_speed") - 2 * F.col("std_speed"),
    }
    out = attach(df, stats.withColumns(limits), ["route_code"], salts=SALTS)
    flag = (F.col("avg_speed") > F.col("ucl")) | (F.col("avg_speed") < F.col("lcl"))
    return out.withColumn("is_anomaly", F.coalesce(flag, F.lit(False)))


def control_summary(df: DataFrame, route: str | None = None) -> DataFrame:
    """Anomalies outside 3 sigma per route: number and percent."""
    return control_chart(df, route).groupBy("route_code").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("is_anomaly").alias("n_anomalies"),
        (F.count_if("is_anomaly") * F.lit(100.0) / F.count(F.lit(1))).alias("anomaly_pct"),
    )


def deviation_timeline(
    df: DataFrame, route: str | None = None, order: Sequence[str] = ("timestamp",), window: int = WEEK_ROWS,
    block_rows: int = 100_000,
) -> DataFrame:
    """Deviation from the context mean with its centred moving mean over ``window`` rows.

    A route with fewer rows uses a window as long as the route. Rows of equal ``order`` follow
    the hash of their columns. Frames run over numbered row blocks with copied edges, so a
    busy route is not one task.
    """
    df = only_routes(ensure_calendar(df), route)
    ahead = (window - 1) // 2
    behind = window - 1 - ahead
    tied = df.withColumn("_tie", F.xxhash64(*df.columns))
    expected = lambda placed: with_expected(df, spread=True, onto=placed)
    rows, order_window = row_frames(tied, ["route_code"], [*order, "_tie"], behind, ahead, block_rows=block_rows, figures=expected)
    # a route below ``window`` rows lies in one frame; its few deviations travel as an array
    few = F.col("n") < window
    whole = order_window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({
        "_long": F.avg("deviation").over(order_window.rowsBetween(-behind, ahead)),
        "_all": F.collect_list(F.when(few, F.struct("pos", "deviation"))).over(whole),
    })
    half = F.floor((F.col("n") - 1) / 2)
    inside = F.filter("_all", lambda x: (x["pos"] >= F.col("pos") - (F.col("n") - 1 - half)) & (x["pos"] <= F.col("pos") + half) & x["deviation"].isNotNull())
    short = F.try_divide(F.aggregate(inside, F.lit(0.0), lambda acc, x: acc + x["deviation"]), F.size(inside))
    out = core_rows(rows.withColumn("deviation_ma", F.when(few, short).otherwise(F.col("_long"))))
    limit = 3 * F.col("residual_std")
    return out.withColumn("is_anomaly", F.coalesce(F.abs("deviation") > limit, F.lit(False))).drop(
        "_long", "_all", "_tie", "context_std", "context_n", "route_rows"
    )


def anomaly_scatter(df: DataFrame, route: str | None = None) -> DataFrame:
    """Deviation in context sigmas; a zero deviation divides by 1, an undefined one gives NULL."""
    out = with_expected(only_routes(df, route))
    sigma = F.when(F.col("context_std") == 0, F.lit(1.0)).otherwise(F.col("context_std"))
    return out.withColumn("deviation_sigma", F.col("deviation") / sigma).drop("context_n", "context_std")


def anomaly_share(df: DataFrame, route: str | None = None, limit: float = 3.0) -> DataFrame:
    """Rows, anomalies beyond ``limit`` sigmas and their percentage (one row)."""
    flagged = F.count_if(F.coalesce(F.abs("deviation_sigma") > limit, F.lit(False)))
    return anomaly_scatter(df, route).agg(
        F.count(F.lit(1)).alias("n_rows"), flagged.alias("n_anomalies"), F.try_divide(flagged * F.lit(100.0), F.count(F.lit(1))).alias("anomaly_pct")
    )


def outlier_summary(
    df: DataFrame, routes: DataFrame | None = None, top_n: int = 20, route: str | None = None, threshold: float = 3.0,
    tie_break: Sequence[str] = ("timestamp", "route_code"),
) -> DataFrame:
    """The ``top_n`` largest contextual outliers with their labels, rounded for display."""
    out = with_expected(only_routes(df, route))
    sigma = F.col("deviation") / F.nullif("context_std", F.lit(0.0))
    found = out.withColumn("deviation_sigma", sigma).filter(F.abs("deviation_sigma") >= threshold)
    size = F.round(F.abs("deviation_sigma"), 9)
    top = found.orderBy(size.desc(), *[F.col(c) for c in tie_break]).limit(top_n)
    labelled = with_labels(top, routes) if routes is not None else top.withColumn("route_label", F.col("route_code"))
    measures = ["avg_speed", "expected_speed", "deviation", "deviation_sigma"]
    return labelled.orderBy(size.desc(), *[F.col(c) for c in tie_break]).select(
        "timestamp", "route_code", "route_label", "hour", "day_of_week", *[C.half_even(c, 3).alias(c) for c in measures]
    )


def current_vs_typical(df: DataFrame, route: str | None = None, date: str | None = None) -> DataFrame:
    """Readings of one date (by default each route's last) against the same weekday on other dates."""
    df = only_routes(ensure_calendar(df), route).withColumn("_day", F.col("timestamp").cast("date"))
    last = df.groupBy("route_code").agg(F.max("_day").alias("ref_date"))
    if date is not None:
        last = last.withColumn("ref_date", F.lit(date).cast("date"))
    rows = attach(df, last, ["route_code"], salts=SALTS)
    same = (F.weekday("_day") == F.weekday("ref_date")) & (F.col("_day") != F.col("ref_date"))
    typical = rows.filter(same).groupBy("route_code", "hour").agg(
        F.avg("avg_speed").alias("typical_mean"), F.stddev("avg_speed").alias("typical_std")
    )
    current = rows.filter(F.col("_day") == F.col("ref_date")).drop("_day")
    out = current.join(typical, ["route_code", "hour"], "left").withColumn("deviation", F.col("avg_speed") - F.col("typical_mean"))
    return out.withColumn("is_anomaly", F.coalesce(F.abs("deviation") > 2 * F.col("typical_std"), F.lit(False)))


def typical_spread(df: DataFrame, route: str | None = None, date: str | None = None) -> DataFrame:
    """Mean typical deviation per route (the two-sigma guide line is twice this)."""
    hours = current_vs_typical(df, route, date).select("route_code", "hour", "typical_std").distinct()
    return hours.groupBy("route_code").agg(F.avg("typical_std").alias("mean_std"))
