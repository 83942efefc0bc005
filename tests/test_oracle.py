"""Registered queries against DuckDB on sf0.001.

By default one query of each family; WAYSPAN_ALL=1 runs all of them.
"""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import DATA, compare, connect

SF = "sf0.001"
SHORT = ["a1_feed_scan", "b4_b5_route_ends", "c1_drop_repeats", "c8_fill_gaps", "d1_iqr_outliers", "e3_rolling_score", "e4_ranking_evolution",
         "e12_method_agreement", "f5_quality_metrics", "g4_autocorrelation", "h3_decomposition", "h14_deviation_timeline", "h25_summary_weekly", "k1_stream_dedup"]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("WAYSPAN_ALL") else SHORT


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_duckdb(spark, duck, name):
    got = entry.queries()[name](spark, f"{DATA}/{SF}").toPandas()
    assert compare(got, duck.execute(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 5
