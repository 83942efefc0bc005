"""Registry of named queries over the test tables with their DuckDB counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayspan.functions import normal

Build = Callable[[SparkSession, str], DataFrame]

# Events as readings, in SQL; the counterpart of plans.tables.readings.
READINGS_SQL = """
r AS (
  SELECT event_id, ts, {route} AS route_code, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M') AS time,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
         CAST(hour(ts) AS INTEGER) AS hour, date_trunc('hour', ts) AS timestamp, dayname(ts) AS day_of_week,
         isodow(ts) >= 6 AS is_weekend,
         CASE WHEN hour(ts) <= 6 THEN 'late_night' WHEN hour(ts) <= 8 THEN 'morning' WHEN hour(ts) <= 11 THEN 'morning_rush'
              WHEN hour(ts) <= 14 THEN 'early_afternoon' WHEN hour(ts) <= 18 THEN 'late_afternoon'
              WHEN hour(ts) <= 21 THEN 'evening_rush' ELSE 'night' END AS time_category,
         CAST(10 + k AS DOUBLE) AS duration, value AS distance, value / (CAST(10 + k AS DOUBLE) / 60e0) AS avg_speed
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
)"""
SHIPMENTS_SQL = """
s AS (
  SELECT l_orderkey, l_linenumber, s_nationkey || '|' || c_nationkey AS route_code, CAST(l_shipdate AS DATE) AS date,
         CAST(l_shipdate AS TIMESTAMP) AS timestamp, l_quantity AS duration, l_extendedprice / 1000e0 AS distance,
         (l_extendedprice / 1000e0) / (l_quantity / 60e0) AS avg_speed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
)"""
ROUTES_SQL = """
routes AS (
  SELECT DISTINCT event_type AS route_code, 'Route ' || upper(event_type) AS label_full,
         CASE WHEN event_type <> 'view' THEN upper(event_type[1]) || event_type[2:] END AS label_short
  FROM events WHERE event_type <> 'signup'
)"""
PRELUDES = {
    "r": READINGS_SQL.format(route="event_type"),
    "u": READINGS_SQL.format(route="CAST(user_id AS VARCHAR)"),
    "s": SHIPMENTS_SQL,
    "routes": ROUTES_SQL,
}


def poly_sql(x: str, coefs) -> str:
    """Polynomial in Horner form, lowest power first."""
    out = repr(float(coefs[-1]))
    for c in reversed(coefs[:-1]):
        out = f"({out} * {x} + {float(c)!r})"
    return re.sub(r"(\d\.\d+)(?![\de.])", r"\1e0", out)


def normal_quantile_sql(p: str) -> str:
    """Inverse normal distribution function of a column in (0, 1)."""
    ratio = lambda x, a, b: f"({poly_sql(x, a)} / {poly_sql(x, b)})"
    r = f"sqrt(-ln(least({p}, 1 - {p})))"
    outer = f"(CASE WHEN {r} <= 5 THEN {ratio(f'({r} - 1.6e0)', normal.AS241_MIDDLE_NUM, normal.AS241_MIDDLE_DEN)} ELSE {ratio(f'({r} - 5)', normal.AS241_TAIL_NUM, normal.AS241_TAIL_DEN)} END)"
    centre = f"(({p} - 0.5e0) * {ratio(f'(0.180625e0 - ({p} - 0.5e0) * ({p} - 0.5e0))', normal.AS241_CENTRE_NUM, normal.AS241_CENTRE_DEN)})"
    return f"CASE WHEN abs({p} - 0.5e0) <= 0.425e0 THEN {centre} WHEN {p} < 0.5e0 THEN -{outer} ELSE {outer} END"


def even_sql(sql: str) -> str:
    """Write ``round_even(x, n)`` as rounding of the scaled double, which is what the library does.

    DuckDB casts doubles to integers with halves to even.
    """
    at = sql.find("round_even(")
    if at < 0:
        return sql
    start = at + len("round_even(")
    depth, end, comma = 1, start, 0
    while depth:
        depth += {"(": 1, ")": -1}.get(sql[end], 0)
        if sql[end] == "," and depth == 1:
            comma = end
        end += 1
    inner, digits = sql[start:comma], int(sql[comma + 1 : end - 1])
    return sql[:at] + f"(CAST(({inner}) * 1e{digits} AS BIGINT) / 1e{digits})" + even_sql(sql[end:])


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None
    doubles: tuple[str, ...]
    digits: int


# Rounding edge of the comparison: off one half, where many exact results of the tables lie,
# so that float noise in a sum does not decide the last digit.
EDGE = 0.5003

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, doubles: str = "", needs: str = "r", digits: int = 6):
    """Register a query. ``doubles`` are compared after rounding to ``digits`` on both sides;
    ``needs`` names the shared views that the SQL refers to."""

    def add(build: Build) -> Build:
        names = tuple(doubles.split())
        text = None
        if sql is not None:
            views = "".join(f"{PRELUDES[n].strip()}, " for n in needs.split())
            final = ", ".join(f"floor({c} * 1e{digits} + {EDGE}) / 1e{digits} AS {c}" for c in names)
            pick = f"* REPLACE ({final})" if names else "*"
            text = f"WITH {views}q AS (\n{even_sql(sql.strip())}\n)\nSELECT {pick} FROM q"
        QUERIES[name] = Query(name, build, text, names, digits)
        return build

    return add


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    q = QUERIES[name]
    df = q.build(spark, sf_dir)
    scale = F.lit(10.0**q.digits)
    # the same double arithmetic as in the SQL text, so both engines round alike
    changed = {c: F.floor(F.col(c) * scale + F.lit(EDGE)).cast("double") / scale for c in q.doubles}
    for c, kind in df.dtypes:
        if kind in ("timestamp", "timestamp_ntz", "date"):
            changed[c] = F.col(c).cast("string")
    return df.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in df.columns])
