"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The test tables are first mapped to Parquet fact tables of readings; the queries then scan
those. Every query runs twice; ``queries`` holds the second (warm) time, ``cold`` the first.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from types import SimpleNamespace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wayspan.operators import anomaly, clean, forecast, patterns, quality, scoring, stats  # noqa: E402
from wayspan.plans.tables import raw_readings, readings, shipments  # noqa: E402
from wayspan.session import build_session  # noqa: E402

ORDER = ["ts", "event_id"]

HEADLINE = {
    "rolling_score": lambda t: scoring.rolling_score(t.readings),
    "rolling_score_cleaned": lambda t: scoring.rolling_score(clean.preprocess(t.raw, ORDER)),
    "rolling_score_shipments": lambda t: scoring.rolling_score(t.shipments, ref_date="2000-01-01", days=30),
    "ranking_evolution": lambda t: scoring.ranking_evolution(t.readings),
    "bootstrap_intervals_1000": lambda t: scoring.score_intervals(t.readings, ["event_id"], n_bootstrap=1000),
    "method_agreement": lambda t: scoring.method_agreement(t.readings),
    "route_correlations": lambda t: patterns.route_correlations(t.readings),
    "decomposition": lambda t: forecast.decomposition(t.readings),
    "hour_weekday_means": lambda t: patterns.hour_weekday_means(t.readings),
    "forecast": lambda t: forecast.forecast(t.readings),
    "outlier_summary": lambda t: anomaly.outlier_summary(t.readings, tie_break=ORDER),
    "deviation_timeline": lambda t: anomaly.deviation_timeline(t.readings, order=ORDER),
    "autocorrelation": lambda t: stats.autocorrelation(t.readings, order=ORDER),
    "normality": lambda t: stats.normality(t.readings),
    "stationarity": lambda t: stats.stationarity(t.readings, order=ORDER),
    "coverage": lambda t: quality.coverage(t.readings),
    "summary_daily_shipments": lambda t: patterns.summary_table(t.shipments, level="D"),
    "median_scores_shipments": lambda t: scoring.median_score(t.shipments),
}


def fact_tables(spark, sf_dir: str) -> SimpleNamespace:
    """Readings mapped from the test tables, stored once as Parquet fact tables (not timed)."""
    base = tempfile.mkdtemp(prefix="wayspan-bench-")
    out = {}
    for name, view in (("readings", readings), ("raw", raw_readings), ("shipments", shipments)):
        view(spark, sf_dir).repartition(8).write.parquet(f"{base}/{name}")
        out[name] = spark.read.parquet(f"{base}/{name}")
    return SimpleNamespace(**out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    cold, warm = {}, {}
    tables = fact_tables(spark, sf_dir)
    for times in (cold, warm):
        for name, build in HEADLINE.items():
            if only and name not in only:
                continue
            start = time.perf_counter()
            build(tables).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
