"""Rolling relative route score and the evaluation of scoring methods.

Facts are reduced once to (date, route) figures with map-side aggregation; everything
after that works on days x routes.  ``by`` names extra label columns (outlier
threshold, bootstrap round), so several variants run in one plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayspan.functions.columns import half_even, hour_number
from wayspan.functions.tails import correlation_p
from wayspan.operators.clean import ensure_calendar
from wayspan.operators.ordering import group_quantiles, value_counts, weighted_quantiles, with_positions
from wayspan.operators.outliers import poisson_sums

WINDOW_SIZES = (5, 10, 15, 20, 30)
THRESHOLDS = (2.0, 2.5, 3.0)
METHODS = ("rolling", "percentile", "zscore", "median")
CRITERIA_WEIGHTS = {"stability": 0.4, "robustness": 0.4, "efficiency": 0.2}
TIE_DIGITS = 9  # sums that differ only by float noise count as equal

_CUSTOM: dict[str, Callable[[DataFrame], DataFrame]] = {}


def register_score(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """Add a scoring method: readings -> (route_code, score). It joins the method reports."""
    if name in METHODS:
        raise ValueError(f"{name} is a built-in method")
    _CUSTOM[name] = fn


def unregister_score(name: str) -> None:
    _CUSTOM.pop(name, None)


def _day(df: DataFrame) -> Column:
    """The date column where there is one, so that a table partitioned by date is pruned."""
    return F.col("date") if ("date", "date") in df.dtypes else F.col("timestamp").cast("date")


def _dated(df: DataFrame) -> DataFrame:
    df = ensure_calendar(df)
    return df.withColumn("date", _day(df))


# --- daily points ---------------------------------------------------------------------

def daily_aggregate(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Min/mean/max of duration, distance and speed per date and route.

    If any speed of a day is NULL, that whole day uses 60 x distance / duration.
    """
    again = F.try_divide(F.lit(60.0) * F.col("distance"), F.col("duration"))
    stats = [("min", F.min), ("mean", F.avg), ("max", F.max)]
    aggs = [fn(c).alias(f"{c}_{n}") for c in ("duration", "distance", "avg_speed") for n, fn in stats]
    aggs += [fn(again).alias(f"_again_{n}") for n, fn in stats]
    per = _dated(df).groupBy(*by, "date", "route_code").agg(*aggs, F.max(F.col("avg_speed").isNull()).alias("_gap"))
    gap = F.max("_gap").over(Window.partitionBy(*by, "date"))
    per = per.withColumn("_gap", gap)
    for n, _ in stats:
        per = per.withColumn(f"avg_speed_{n}", F.when(F.col("_gap"), F.col(f"_again_{n}")).otherwise(F.col(f"avg_speed_{n}")))
    return per.drop("_gap", *[f"_again_{n}" for n, _ in stats])


def centred_points(rank: Column, n: Column) -> Column:
    """Evenly spaced from n/2 (rank 1) to -n/2 (rank n); a lone route gets 0.5."""
    return F.when(n == 1, F.lit(0.5)).otherwise(n / F.lit(2.0) - (rank - 1) * n / (n - 1))


def _points(daily: DataFrame, by: Sequence[str]) -> DataFrame:
    day = Window.partitionBy(*by, "date")
    rank = F.row_number().over(day.orderBy(F.desc_nulls_last("avg_speed_mean"), "route_code"))
    n = F.count(F.lit(1)).over(day)
    return daily.select(*by, "date", "route_code", "avg_speed_mean", rank.alias("rank"), n.alias("n_routes")).withColumn(
        "points", centred_points(F.col("rank"), F.col("n_routes"))
    )


def daily_points(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Points per date and route from the speed ranking of the routes present that day."""
    means = F.avg("avg_speed").alias("avg_speed_mean")
    again = F.avg(F.try_divide(F.lit(60.0) * F.col("distance"), F.col("duration"))).alias("_again")
    per = _dated(df).groupBy(*by, "date", "route_code").agg(means, again, F.max(F.col("avg_speed").isNull()).alias("_gap"))
    gap = F.max("_gap").over(Window.partitionBy(*by, "date"))
    per = per.withColumn("avg_speed_mean", F.when(gap, F.col("_again")).otherwise(F.col("avg_speed_mean"))).drop("_again", "_gap")
    return _points(per, by)


# --- rolling score ----------------------------------------------------------------------

def _last_day(df: DataFrame) -> Column:
    return df.agg(F.max(_day(df))).scalar()


def rolling_score(df: DataFrame, ref_date: str | None = None, days: int = 10) -> DataFrame:
    """Sum of daily points over the ``days`` days before the reference date (itself not included).

    The date range is applied before the aggregation, so only those days are read.
    """
    df = ensure_calendar(df)
    day = _day(df)
    # one pass gives both the routes and the last day
    routes = df.groupBy("route_code").agg(F.max(day).alias("last_day")).filter(F.col("last_day").isNotNull())
    ref = F.lit(ref_date).cast("date") if ref_date else routes.agg(F.max("last_day")).scalar()
    window = df.filter((day >= F.date_sub(ref, days)) & (day < ref))
    total = daily_points(window).groupBy("route_code").agg(F.sum("points").alias("points"))
    return routes.filter(F.col("route_code").isNotNull()).join(total, "route_code", "left").select(
        "route_code", F.coalesce("points", F.lit(0.0)).alias("raw_points")
    ).select("route_code", half_even("raw_points", 1).alias("points"), F.round("raw_points", TIE_DIGITS).alias("raw_points")).orderBy(
        F.desc("raw_points"), "route_code"
    )


def window_scores(df: DataFrame, windows: Sequence[int] = WINDOW_SIZES) -> DataFrame:
    """Score per route for several window lengths from one pass: (route_code, label, score)."""
    df = ensure_calendar(df)
    ref = _last_day(df)
    day = _day(df)
    points = daily_points(df.filter((day >= F.date_sub(ref, max(windows))) & (day < ref)))
    age = F.datediff(ref, F.col("date"))
    sums = points.groupBy("route_code").agg(*[F.sum(F.when(age <= w, F.col("points"))).alias(f"w{w}") for w in windows])
    routes = df.select("route_code").dropna().distinct().join(sums, "route_code", "left")
    pairs = [F.struct(F.lit(f"{w}d").alias("label"), half_even(F.coalesce(F.col(f"w{w}"), F.lit(0.0)), 1).alias("score")) for w in windows]
    return routes.select("route_code", F.inline(F.array(*pairs)))


def ranking_evolution(df: DataFrame, days: int = 10) -> DataFrame:
    """Score and rank of every route for every day, from one sliding sum instead of a day loop.

    Days run in 24-hour steps from the first reading, so a last day that ends earlier in
    the day than the first one began is not listed.
    """
    df = ensure_calendar(df)
    points = daily_points(df).select("date", "route_code", "points")
    span = df.agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi")).select(
        F.sequence(
            F.col("lo").cast("date"),
            F.date_add(F.col("lo").cast("date"), F.floor((hour_number("hi") - hour_number("lo")) / 24).cast("int")),
            F.expr("interval 1 day"),
        )
    ).scalar()
    grid = df.select("route_code").dropna().distinct().withColumn("date", F.explode(span))
    dense = grid.join(points, ["date", "route_code"], "left")
    history = Window.partitionBy("route_code").orderBy("date").rowsBetween(-days, -1)
    scored = dense.select("date", "route_code", F.round(F.coalesce(F.sum("points").over(history), F.lit(0.0)), TIE_DIGITS).alias("raw"))
    order = Window.partitionBy("date").orderBy(F.desc("raw"), "route_code")
    return scored.select("date", "route_code", F.row_number().over(order).alias("rank"), half_even("raw", 1).alias("points"))


def rank_volatility(ranking: DataFrame) -> DataFrame:
    return ranking.groupBy("route_code").agg(
        F.avg("rank").alias("avg_rank"), F.stddev("rank").alias("std_rank"), F.min("rank").alias("min_rank"),
        F.max("rank").alias("max_rank"), (F.max("rank") - F.min("rank")).alias("rank_range"),
    )


# --- other scores --------------------------------------------------------------------------

def route_means(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, "route_code").agg(F.avg("avg_speed").alias("mean_speed"))


def average_ranks(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Add ``avg_rank`` (ties share their mean rank) and ``n_ranked`` inside ``by``; a NULL value
    has no rank and does not count. The tables ranked here hold one row per route."""
    by = list(by)
    group = Window.partitionBy(*by)
    tie = F.count(F.lit(1)).over(Window.partitionBy(*by, value))
    rank = F.rank().over(group.orderBy(F.asc_nulls_last(value))) + (tie - 1) / F.lit(2.0)
    return df.withColumn("avg_rank", F.when(F.col(value).isNotNull(), rank)).withColumn("n_ranked", F.count(value).over(group))


def percentile_score(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average rank of the route mean as a share of the routes, in percent."""
    ranked = average_ranks(route_means(df, by), by, "mean_speed")
    return ranked.select(*by, "route_code", (F.col("avg_rank") / F.col("n_ranked") * 100).alias("percentile_score"))


def zscore_score(df: DataFrame) -> DataFrame:
    """Route means standardised over the routes."""
    means = route_means(df)
    s = means.agg(F.avg("mean_speed").alias("mu"), F.stddev("mean_speed").alias("sd")).select(F.struct("mu", "sd").alias("s")).scalar()
    return means.select("route_code", F.try_divide(F.col("mean_speed") - s.getField("mu"), s.getField("sd")).alias("zscore"))


def median_score(df: DataFrame, by: Sequence[str] = (), accuracy: int | None = None) -> DataFrame:
    return group_quantiles(df, [*by, "route_code"], "avg_speed", {"median_speed": 0.5}, accuracy=accuracy)


# --- rank correlation ------------------------------------------------------------------------

def _clean_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def rank_matrix(scores: DataFrame, labels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Spearman matrix of (route_code, label, score) in long form, aligned on the route.

    The few labels become columns, so every pair is one ``corr`` in a single aggregate.
    """
    ranked = average_ranks(scores, [*by, "label"], "score")
    wide = ranked.groupBy(*by, "route_code").agg(*[F.max(F.when(F.col("label") == l, F.col("avg_rank"))).alias(f"r{i}") for i, l in enumerate(labels)])
    pairs = [(i, j) for i in range(len(labels)) for j in range(i, len(labels))]
    corr = wide.groupBy(*by).agg(*[_clean_nan(F.corr(f"r{i}", f"r{j}")).alias(f"c{i}_{j}") for i, j in pairs])
    cells = [
        F.struct(
            F.lit(labels[i]).alias("row_key"), F.lit(labels[j]).alias("col_key"),
            (F.lit(1.0) if i == j else F.col(f"c{min(i, j)}_{max(i, j)}")).alias("value"),
            F.col(f"c{min(i, j)}_{max(i, j)}").alias("raw_value"),
        )
        for i in range(len(labels)) for j in range(len(labels))
    ]
    return corr.select(*by, F.inline(F.array(*cells)))


def score_vs_speed(df: DataFrame, days: int = 10) -> DataFrame:
    """Pearson and Spearman correlation of the score with the raw mean speed, with p-values."""
    joined = rolling_score(df, days=days).select("route_code", "points").join(route_means(df), "route_code")
    ranked = average_ranks(joined, [], "points").withColumnRenamed("avg_rank", "r1").drop("n_ranked")
    ranked = average_ranks(ranked, [], "mean_speed").withColumnRenamed("avg_rank", "r2")
    out = ranked.agg(_clean_nan(F.corr("points", "mean_speed")).alias("pearson_correlation"),
                     _clean_nan(F.corr("r1", "r2")).alias("spearman_correlation"), F.count(F.lit(1)).alias("n_routes"))
    return out.select(
        "pearson_correlation", correlation_p("pearson_correlation", F.col("n_routes").cast("double")).alias("pearson_pvalue"),
        "spearman_correlation", correlation_p("spearman_correlation", F.col("n_routes").cast("double")).alias("spearman_pvalue"), "n_routes",
    )


def _deviation(df: DataFrame) -> Column:
    """|z| of the speed against all rows; NULL where it has none."""
    s = df.agg(F.avg("avg_speed").alias("mu"), F.stddev("avg_speed").alias("sd")).select(F.struct("mu", "sd").alias("s")).scalar()
    return F.abs(F.try_divide(F.col("avg_speed") - s.getField("mu"), s.getField("sd")))


def _band(z: Column, limits: Sequence[float]) -> Column:
    """Number of the (ascending) limits that |z| is beyond; a row without z is beyond none."""
    out = F.lit(0)
    for t in limits:
        out = out + F.coalesce((z > t).cast("int"), F.lit(0))
    return out


def _labels(limits: Sequence[float]) -> list[str]:
    """Names of the variants: rows within each limit, and all rows. Variant i keeps the bands 0 to i."""
    return [f"z{t:g}" for t in limits] + ["all"]


def _banded_days(df: DataFrame, limits: Sequence[float]) -> DataFrame:
    """One row a date and route with the figures of every variant: ``m`` mean speed of the day (by
    distance and duration where a speed of the day is missing), ``s`` sum and ``c`` count of the
    speeds, ``n`` rows. A fact is read once and belongs to one band; variants are sums of bands."""
    again = F.try_divide(F.lit(60.0) * F.col("distance"), F.col("duration"))
    per = _dated(df).withColumn("_band", _band(_deviation(df), limits)).groupBy("date", "route_code", "_band").agg(
        F.count(F.lit(1)).alias("n"), F.sum("avg_speed").alias("s"), F.count("avg_speed").alias("c"), F.sum(again).alias("a"), F.count(again).alias("k"),
        F.max(F.col("avg_speed").isNull()).alias("_gap"),
    )
    upto = lambda column, i: F.sum(F.when(F.col("_band") <= i, F.col(column))).alias(f"{column}{i}")
    wide = per.groupBy("date", "route_code").agg(*[upto(c, i) for c in ("n", "s", "c", "a", "k") for i in range(len(limits) + 1)], F.max("_gap").alias("_gap"))
    # rows without a speed are in every variant
    gap = F.max("_gap").over(Window.partitionBy("date"))
    mean = lambda i: F.when(gap, F.try_divide(f"a{i}", f"k{i}")).otherwise(F.try_divide(f"s{i}", f"c{i}"))
    some = lambda c: F.coalesce(F.col(c), F.lit(0))
    kept = [c for i in range(len(limits) + 1) for c in (mean(i).alias(f"m{i}"), some(f"s{i}").alias(f"s{i}"), some(f"c{i}").alias(f"c{i}"), some(f"n{i}").alias(f"n{i}"))]
    return wide.select("date", "route_code", *kept)


def _rolling_variants(days_table: DataFrame, variants: int, days: int) -> DataFrame:
    """(route_code, points0, points1, ...): the rolling score of each variant, with its own last day;
    NULL for a route that a variant has no row of."""
    last = days_table.agg(*[F.max(F.when(F.col(f"n{i}") > 0, F.col("date"))).alias(f"r{i}") for i in range(variants)]).select(F.struct("*").alias("r")).scalar()
    day = Window.partitionBy("date")
    sums = []
    out = days_table
    for i in range(variants):
        present = F.col(f"n{i}") > 0
        rank = F.row_number().over(day.orderBy(F.desc(present), F.desc_nulls_last(f"m{i}"), "route_code"))
        out = out.withColumn(f"p{i}", F.when(present, centred_points(rank, F.count_if(present).over(day))))
        age = F.datediff(last.getField(f"r{i}"), F.col("date"))
        score = half_even(F.coalesce(F.sum(F.when((age >= 1) & (age <= days), F.col(f"p{i}"))), F.lit(0.0)), 1)
        sums.append(F.when(F.sum(f"n{i}") > 0, score).alias(f"points{i}"))
    return out.groupBy("route_code").agg(*sums)


def outlier_scores(df: DataFrame, threshold: float = 3.0, days: int = 10) -> DataFrame:
    """Route scores with all rows and with the rows beyond the z threshold removed."""
    rolled = _rolling_variants(_banded_days(ensure_calendar(df), [threshold]), 2, days)
    return rolled.select("route_code", F.col("points1").alias("baseline_points"), F.col("points0").alias("filtered_points"))


def outlier_sensitivity(df: DataFrame, threshold: float = 3.0, days: int = 10) -> DataFrame:
    """Spearman correlation between both scorings and the number of removed rows."""
    table = _banded_days(ensure_calendar(df), [threshold])
    both = _rolling_variants(table, 2, days).select("route_code", F.col("points1").alias("baseline_points"), F.col("points0").alias("filtered_points")).dropna()
    ranked = average_ranks(both, [], "baseline_points").withColumnRenamed("avg_rank", "r1").drop("n_ranked")
    ranked = average_ranks(ranked, [], "filtered_points").withColumnRenamed("avg_rank", "r2")
    removed = table.agg(F.coalesce(F.sum(F.col("n1") - F.col("n0")), F.lit(0))).scalar()
    out = ranked.agg(_clean_nan(F.corr("r1", "r2")).alias("rank_correlation"), F.count(F.lit(1)).alias("n_routes"))
    return out.select("rank_correlation", correlation_p("rank_correlation", F.col("n_routes").cast("double")).alias("rank_correlation_pvalue"),
                      removed.alias("n_outliers_removed"))


def window_stability(df: DataFrame, windows: Sequence[int] = WINDOW_SIZES) -> DataFrame:
    """Spearman matrix of the rolling scores over window lengths."""
    return rank_matrix(window_scores(df, windows), [f"{w}d" for w in windows]).drop("raw_value")


def _as_score(df: DataFrame, label: str, value: str) -> DataFrame:
    return df.select("route_code", F.lit(label).alias("label"), F.col(value).alias("score"))


def static_scores(df: DataFrame) -> DataFrame:
    """The methods that do not depend on a day window, custom ones included, in long form.
"""
    means = route_means(df.filter(F.col("route_code").isNotNull()))
    medians = group_quantiles(df, ["route_code"], "avg_speed", {"median_speed": 0.5})
    s = means.agg(F.avg("mean_speed").alias("mu"), F.stddev("mean_speed").alias("sd")).select(F.struct("mu", "sd").alias("s")).scalar()
    wide = average_ranks(means, [], "mean_speed").join(medians, "route_code", "left")
    scores = {
        "percentile": F.col("avg_rank") / F.col("n_ranked") * 100,
        "zscore": F.try_divide(F.col("mean_speed") - s.getField("mu"), s.getField("sd")),
        "median": F.col("median_speed"),
    }
    out = wide.select("route_code", F.inline(F.array(*[F.struct(F.lit(k).alias("label"), v.alias("score")) for k, v in scores.items()])))
    for name, fn in _CUSTOM.items():
        out = out.unionByName(_as_score(fn(df), name, "score"))
    return out.withColumn("score", F.round("score", TIE_DIGITS))


def method_scores(df: DataFrame, days: int = 10) -> DataFrame:
    """All methods in long form (route_code, label, score)."""
    return static_scores(df).unionByName(_as_score(rolling_score(df, days=days), "rolling", "points"))


def method_agreement(df: DataFrame, days: int = 10) -> DataFrame:
    """Spearman matrix of the scoring methods."""
    labels = [*METHODS, *_CUSTOM]
    scores = static_scores(df).unionByName(_as_score(rolling_score(df, days=days), "rolling", "points"))
    return rank_matrix(scores, labels).drop("raw_value")


def transitivity(scores: DataFrame) -> DataFrame:
    """Triples i < j < k in score order, and those with A > B, B > C but not A > C.

    Routes are in descending order, so ``>`` over a triple can only fail if it fails
    between neighbours; comparing neighbours therefore decides all triples.
    """
    numbered = with_positions(scores.select("route_code", F.col("points"), (-F.col("points")).alias("_down")), [], ["_down", "route_code"])
    # two-row frames over the numbered routes: join each position to the next two
    right = numbered.select((F.col("pos") - 1).alias("pos"), F.col("points").alias("p2"))
    third = numbered.select((F.col("pos") - 2).alias("pos"), F.col("points").alias("p3"))
    near = numbered.join(right, "pos", "left").join(third, "pos", "left")
    broken = (F.col("points") > F.col("p2")) & (F.col("p2") > F.col("p3")) & ~(F.col("points") > F.col("p3"))
    n = F.count(F.lit(1)).cast("decimal(12,0)")
    return near.agg(
        F.floor(n * (n - 1) * (n - 2) / 6).cast("bigint").alias("n_triples"),
        F.count_if(F.coalesce(broken, F.lit(False))).alias("n_violations"),
    ).withColumn("is_transitive", F.col("n_violations") == 0)


# --- bootstrap ------------------------------------------------------------------------------------

def score_intervals(
    df: DataFrame, row_key: Sequence[str], n_bootstrap: int = 1000, days: int = 10, level: float = 0.95,
    seed: int = 0, ref_date: str | None = None,
) -> DataFrame:
    """Bootstrap mean and percentile interval of the rolling score per route.

    Only rows of the score window are resampled. Every (row, round) gets a Poisson(1) weight made
    from ``row_key``; the weighted sums of all rounds are one vector a date and route, added up
    where the rows are. The reference date is that of the data.
    """
    df = ensure_calendar(df)
    ref = F.lit(ref_date).cast("date") if ref_date else _last_day(df)
    day = _day(df)
    again = F.try_divide(F.lit(60.0) * F.col("distance"), F.col("duration"))
    keys = [c for c in row_key if c not in ("date", "route_code", "avg_speed")]
    rows = df.filter((day >= F.date_sub(ref, days)) & (day < ref)).select(day.alias("date"), "route_code", "avg_speed", again.alias("_again"), *keys)
    sums = poisson_sums(rows, ["date", "route_code"], ["avg_speed", "_again"], row_key, n_bootstrap, seed)
    per = sums.select(
        "iter", "date", "route_code", F.try_divide("avg_speed_sum", "avg_speed_n").alias("avg_speed_mean"),
        F.try_divide("_again_sum", "_again_n").alias("_again"), (F.col("avg_speed_n") < F.col("n")).alias("_gap"),
    )
    # as in daily_points: a day with a missing speed takes its means from distance and duration
    gap = F.max("_gap").over(Window.partitionBy("iter", "date"))
    per = per.withColumn("avg_speed_mean", F.when(gap, F.col("_again")).otherwise(F.col("avg_speed_mean")))
    scores = _points(per, ["iter"]).groupBy("route_code", "iter").agg(half_even(F.sum("points"), 1).alias("points"))
    routes = df.select("route_code").dropna().distinct()
    grid = routes.withColumn("iter", F.explode(F.sequence(F.lit(0), F.lit(n_bootstrap - 1))))
    full = grid.join(scores, ["route_code", "iter"], "left").withColumn("points", F.coalesce("points", F.lit(0.0)))
    tail = (1.0 - level) / 2.0
    # n_bootstrap values per route: a bounded group
    return full.groupBy("route_code").agg(
        F.avg("points").alias("points"), F.percentile("points", F.lit(tail)).alias("ci_lower"),
        F.percentile("points", F.lit(1.0 - tail)).alias("ci_upper"),
    ).orderBy(F.desc("points"), "route_code")


# --- method reports ---------------------------------------------------------------------------------

def stability_by_method(df: DataFrame, windows: Sequence[int] = WINDOW_SIZES) -> DataFrame:
    """Mean, spread (population), min and max of the pairwise window correlations per method.

    Only the rolling score depends on the window; the other methods compare with themselves.
    """
    labels = [f"{w}d" for w in windows]
    position = F.array(*[F.lit(l) for l in labels])
    pairs = rank_matrix(window_scores(df, windows), labels).filter(
        F.array_position(position, F.col("row_key")) < F.array_position(position, F.col("col_key"))
    )
    rolling = pairs.select(F.lit("rolling").alias("method"), "value")
    others = [m for m in (*METHODS, *_CUSTOM) if m != "rolling"]
    fixed = rank_matrix(static_scores(df), others).filter("row_key = col_key")
    fixed = fixed.select(F.col("row_key").alias("method"), F.col("raw_value").alias("value"))
    return _correlation_summary(rolling.unionByName(fixed), "max")


def _correlation_summary(values: DataFrame, *extra: str) -> DataFrame:
    aggs = [F.avg("value").alias("mean_correlation"), F.stddev_pop("value").alias("std_correlation"), F.min("value").alias("min_correlation")]
    if extra:
        aggs.append(F.max("value").alias("max_correlation"))
    return values.groupBy("method").agg(*aggs).orderBy(F.desc_nulls_last("mean_correlation"), "method")


def _variant_scores(df: DataFrame, thresholds: Sequence[float], days: int) -> DataFrame:
    """(variant, method, route_code, score) without the rows beyond each threshold, and with all."""
    df = ensure_calendar(df)
    limits = sorted(set(thresholds))
    labels, every = _labels(limits), range(len(limits) + 1)
    table = _banded_days(df, limits)

    def listed(wide: DataFrame, method: str, columns: Sequence[str]) -> DataFrame:
        cells = [F.struct(F.lit(labels[i]).alias("variant"), F.lit(method).alias("method"), F.round(columns[i], TIE_DIGITS).alias("score")) for i in every]
        return wide.select("route_code", F.inline(F.array(*cells))).filter("score IS NOT NULL").select("variant", "method", "route_code", "score")

    out = listed(_rolling_variants(table, len(labels), days), "rolling", [f"points{i}" for i in every])
    means = table.groupBy("route_code").agg(*[F.try_divide(F.sum(f"s{i}"), F.sum(f"c{i}")).alias(f"mean{i}") for i in every])
    # percentile and standard score keep the order of the means, so the means give their ranks
    for method in ("percentile", "zscore"):
        out = out.unionByName(listed(means, method, [f"mean{i}" for i in every]))
    counts = value_counts(df, ["route_code"], "avg_speed").withColumn("_band", _band(_deviation(df), limits))
    medians = weighted_quantiles(counts.select("route_code", "avg_speed", *[F.when(F.col("_band") <= i, F.col("cnt")).otherwise(0).alias(f"w{i}") for i in every]), ["route_code"], "avg_speed", [f"w{i}" for i in every])
    out = out.unionByName(listed(medians, "median", [f"w{i}" for i in every]))
    z = _deviation(df)
    for name, fn in _CUSTOM.items():
        for i, label in enumerate(labels):
            part = df if label == "all" else df.filter(~F.coalesce(z > limits[i], F.lit(False)))
            own = fn(part).select(F.lit(label).alias("variant"), F.lit(name).alias("method"), "route_code", F.round("score", TIE_DIGITS).alias("score"))
            out = out.unionByName(own)
    return out


def robustness_by_method(df: DataFrame, thresholds: Sequence[float] = THRESHOLDS, days: int = 10) -> DataFrame:
    """Mean, spread (population) and minimum over thresholds of the correlation with the unfiltered score."""
    scores = _variant_scores(df, thresholds, days)
    base = scores.filter("variant = 'all'").select("method", "route_code", F.col("score").alias("base"))
    both = scores.filter("variant <> 'all'").join(base, ["method", "route_code"])
    by = ["method", "variant"]
    ranked = average_ranks(both, by, "base").withColumnRenamed("avg_rank", "r1").drop("n_ranked")
    ranked = average_ranks(ranked, by, "score").withColumnRenamed("avg_rank", "r2")
    values = ranked.groupBy(*by).agg(_clean_nan(F.corr("r1", "r2")).alias("value"))
    return _correlation_summary(values)


def method_report(df: DataFrame, timings: DataFrame | None = None, days: int = 10) -> DataFrame:
    """Methods ranked by weighted stability, robustness and efficiency.

    ``timings`` (method, mean_time) is optional; a missing criterion leaves the mean and
    the other weights are rescaled.
    """
    joined = stability_by_method(df).select("method", F.col("mean_correlation").alias("stability")).join(
        robustness_by_method(df, days=days).select("method", F.col("mean_correlation").alias("robustness")), "method", "full_outer"
    )
    if timings is not None:
        speed = timings.select("method", F.when(F.col("mean_time") > 0, 1.0 / F.col("mean_time")).otherwise(F.lit(0.0)).alias("efficiency"))
        joined = joined.join(speed, "method", "left")
    else:
        joined = joined.withColumn("efficiency", F.lit(None).cast("double"))
    top = sum((F.coalesce(F.col(c) * w, F.lit(0.0)) for c, w in CRITERIA_WEIGHTS.items()), F.lit(0.0))
    used = sum((F.when(F.col(c).isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in CRITERIA_WEIGHTS.items()), F.lit(0.0))
    scored = joined.withColumn("overall_score", F.try_divide(top, used))
    # one row per method
    rank = F.row_number().over(Window.orderBy(F.desc_nulls_last(F.round("overall_score", TIE_DIGITS)), "method"))
    return scored.withColumn("rank", rank).select(
        "rank", "method", *[half_even(c, 4).alias(c) for c in ("overall_score", "stability", "robustness", "efficiency")]
    )
