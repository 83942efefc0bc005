"""Queries of the sources, parsing, cleaning and outlier families (A, B, C, D)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from wayspan.functions import columns as C
from wayspan.functions import draws
from wayspan.functions.pluscode import route_points
from wayspan.operators import clean, enrich, outliers, patterns, stations
from wayspan.plans.registry import query
from wayspan.plans.scoring import RAW_SQL
from wayspan.plans.tables import feed_text, locations, raw_readings, readings, route_table, shipments, table, weather_table
from wayspan.session import checkpoint_dir
from wayspan.sources import feed, sinks

FEED_SQL = """
f AS (
  SELECT event_id, strftime(ts, '%Y-%m-%d') AS date,
         CASE WHEN event_id % 53 = 0 THEN '' WHEN event_id % 59 = 0 THEN '25:61' ELSE strftime(ts, '%H:%M') END AS time,
         event_type AS route_code,
         CASE WHEN event_id % 41 = 0 THEN 'n/a' WHEN event_id % 43 = 0 THEN (m // 60) || ' hrs'
              WHEN m < 60 THEN (m % 60) || ' min' WHEN m % 60 = 0 THEN (m // 60) || ' hr'
              ELSE (m // 60) || ' hr ' || (m % 60) || ' min' END AS duration,
         CASE WHEN event_id % 47 = 0 THEN '-' ELSE CAST(CAST(value AS DECIMAL(10, 2)) AS VARCHAR) || ' km' END AS distance
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) + 10 AS m FROM events))"""
MINUTES_SQL = """CASE WHEN duration LIKE '% hr%' AND duration NOT LIKE '%hrs%' OR duration LIKE '% min' THEN
    coalesce(CAST(nullif(regexp_extract(duration, '([0-9]+) hr( |$)', 1), '') AS DOUBLE), 0) * 60
    + coalesce(CAST(nullif(regexp_extract(duration, '([0-9]+) min', 1), '') AS DOUBLE), 0)
  ELSE TRY_CAST(split_part(duration, ' ', 1) AS DOUBLE) END"""
WEATHER_SQL = """
w AS (
  SELECT route_code, CAST(k AS VARCHAR) AS temp, CAST(k + 2 AS VARCHAR) AS realfeel, CAST(CAST(floor(value % 100) AS BIGINT) AS VARCHAR) AS humidity,
         CASE WHEN k % 2 = 0 THEN 'No Precipitation' ELSE 'Rain soon' END AS rsi_flag, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS aqi
  FROM (SELECT event_type AS route_code, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value,
               row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1 AND route_code <> 'click')"""
PLACES_SQL = "p AS (SELECT CAST(n_nationkey AS VARCHAR) AS plus_code, n_name AS location FROM nation WHERE n_nationkey <> 7)"
STATIONS_SQL = """
st AS (SELECT s_suppkey AS line_no, s_name AS label_short, CAST(s_suppkey AS VARCHAR) AS route_code,
              CASE WHEN s_suppkey % 9 = 0 THEN 'bad' WHEN s_suppkey % 7 = 0 THEN ' ' ELSE 'n' || s_nationkey || '/' || (100 + s_nationkey) END AS accuweather_station
       FROM supplier)"""


def scratch(spark, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/io-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}/{name}"


# --- A: sources and sinks -------------------------------------------------------------------

@query("a1_feed_scan", f"""WITH {FEED_SQL}
SELECT date, time, route_code, TRY_CAST(duration AS DOUBLE) AS duration, TRY_CAST(replace(distance, ' km', '') AS DOUBLE) AS distance
FROM f WHERE trim(time) <> ''""", needs="", doubles="duration distance")
def _(spark, d):
    text = feed_text(spark, d).withColumn("distance", F.replace("distance", F.lit(" km"), F.lit("")))
    path = scratch(spark, "feed")
    sinks.feed_rows(text).write.csv(path, header=True)
    return feed.read_feed(spark, path).select("date", "time", "route_code", "duration", "distance")


@query("a2_route_scan", """SELECT DISTINCT s_nationkey || '|' || c_nationkey AS route_code, 'L' || s_nationkey AS label_full
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""", needs="")
def _(spark, d):
    codes = shipments(spark, d).select("route_code").distinct()
    good = codes.select(F.concat(F.lit('"'), "route_code", F.lit('"')).alias("route_code"),
                        F.concat(F.lit("L"), C.route_end("route_code", 1)).alias("label_full"))
    blank = good.select(C.route_end("route_code", 1).alias("route_code"), "label_full")  # without a pipe: left out
    rows = good.unionByName(blank).withColumns({c: F.lit(None).cast("string") for c in ("label_short", "map_link", "accuweather_station")})
    path = scratch(spark, "routes")
    rows.write.csv(path, header=True)
    return feed.read_routes(spark, path, pipe_only=True).select("route_code", "label_full")


@query("a3_location_scan", "SELECT CAST(n_nationkey AS VARCHAR) AS plus_code, n_name AS location, 12.5e0 AS ref_lat, -77.25e0 AS ref_lon FROM nation",
       needs="", doubles="ref_lat ref_lon")
def _(spark, d):
    rows = table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("plus_code"), F.col("n_name").alias("location"))
    path = scratch(spark, "loc_12.5_-77.25.csv")
    rows.write.option("header", True).csv(path)
    # the reference point is taken from the file name of a plain file; a folder of part files carries it in the folder name
    scan = feed.read_locations(spark, path)
    pattern = r"_(-?[0-9.]+)_(-?[0-9.]+)\.csv/"
    name = F.input_file_name()
    return scan.select("plus_code", "location", F.regexp_extract(name, pattern, 1).cast("double").alias("ref_lat"),
                       F.regexp_extract(name, pattern, 2).cast("double").alias("ref_lon"))


@query("a4_weather_scan", f"WITH {WEATHER_SQL} SELECT * FROM w", needs="")
def _(spark, d):
    rows = weather_table(spark, d)
    full = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in feed.SNAPSHOT_COLUMNS])
    path = scratch(spark, "weather")
    full.write.csv(path, header=True)
    absent = feed.read_weather(spark, path + "-absent")
    return feed.read_weather(spark, path).unionByName(absent)


@query("a5_append_sink", """SELECT CAST(date AS VARCHAR) AS date, time, route_code, duration, distance FROM r
UNION ALL SELECT CAST(date AS VARCHAR), time, route_code, duration, distance FROM r""", doubles="distance")
def _(spark, d):
    rows = readings(spark, d)
    path = scratch(spark, "table")
    sinks.append_feed(rows, path)
    sinks.append_feed(rows, path)
    return feed.read_feed(spark, path, "parquet").select("date", "time", "route_code", "duration", "distance")


AS_OF_SQL = "lim AS (SELECT max(ts) - INTERVAL 5 DAY AS cut FROM r)"


@query("a6_rewrite_counters", f"""WITH {AS_OF_SQL},
k AS (SELECT count(DISTINCT (date, hour, route_code)) AS kept FROM r, lim WHERE ts < cut),
c AS (SELECT count(*) AS n, count(*) FILTER (WHERE ts < cut) AS old FROM r, lim)
SELECT n AS rows_before, old AS old_rows, old - kept AS removed, n - old AS recent_rows, kept + n - old AS rows_after FROM k, c""")
def _(spark, d):
    rows = readings(spark, d)
    as_of = rows.agg(F.max("ts") - F.expr("interval 4 days")).scalar()
    return clean.dedup_counters(rows, as_of)


@query("a6_rewrite_applied", """
WITH f AS (SELECT date, time, hour, route_code, duration, distance, CAST(date AS TIMESTAMP) + CAST(time || ':00' AS INTERVAL) AS moment FROM r),
lim AS (SELECT max(moment) - INTERVAL 5 DAY AS cut FROM f),
k AS (SELECT *, moment >= cut AS recent, row_number() OVER (PARTITION BY date, hour, route_code, moment >= cut ORDER BY time, duration, distance) AS rn FROM f, lim)
SELECT CAST(date AS VARCHAR) AS date, time, route_code, duration, distance, CAST(2 AS INTEGER) AS version FROM k WHERE recent OR rn = 1""", doubles="distance")
def _(spark, d):
    """The feed is put down, read back, cleaned and swapped for the clean one."""
    path = scratch(spark, "table")
    sinks.rewrite_feed(readings(spark, d), path, apply=True)
    rows, version = sinks.live_feed(spark, path)
    as_of = rows.agg(F.max(C.feed_timestamp(F.col("date").cast("string"), "time")) - F.expr("interval 4 days")).scalar()
    sinks.rewrite_feed(clean.drop_old_repeats(rows, as_of, ["time", "duration", "distance"]), path, apply=True, since=version)
    rows, version = sinks.live_feed(spark, path)
    return rows.select(F.col("date").cast("string").alias("date"), "time", "route_code", "duration", "distance", F.lit(version).alias("version"))


SNAPSHOT_EMPTY_SQL = ", ".join(f"'' AS {c}" for c in feed.SNAPSHOT_COLUMNS[3:] if c not in ("temp", "rsi_flag"))


@query("a7_weather_snapshot", f"""WITH {STATIONS_SQL},
u AS (SELECT * FROM (SELECT *, trim(accuweather_station) AS station, row_number() OVER (PARTITION BY trim(accuweather_station) ORDER BY line_no) AS rn FROM st) WHERE station <> '' AND rn = 1),
x AS (SELECT station, line_no % 4 AS g, route_code, label_short, line_no FROM u)
SELECT CASE WHEN g = 3 THEN '' ELSE route_code END AS route_code, CASE WHEN g = 3 THEN '' ELSE label_short END AS route_name_short,
       CASE WHEN g = 3 THEN '' ELSE station END AS accuweather_station,
       CASE WHEN g = 1 THEN CAST(line_no AS VARCHAR) ELSE '' END AS temp, CASE WHEN g IN (1, 2) THEN 'dry' ELSE '' END AS rsi_flag, {SNAPSHOT_EMPTY_SQL}
FROM x""", needs="")
def _(spark, d):
    """The snapshot as it stands in the written file."""
    stn = stations.unique_stations(_stations(spark, d))
    g = F.col("line_no") % 4
    text = F.lit(None).cast("string")
    got = stn.filter(g != 0).select(
        "station", (g == 3).alias("failed"), F.when(g == 1, F.col("line_no").cast("string")).alias("temp"),
        F.when(g != 3, F.lit("dry")).alias("rsi_flag"),
        *[text.alias(c) for c in feed.SNAPSHOT_COLUMNS[3:] if c not in ("temp", "rsi_flag")],
    )
    path = scratch(spark, "snapshot")
    sinks.write_weather_snapshot(sinks.weather_snapshot(stn, got), path)
    back = spark.read.schema(", ".join(f"{c} string" for c in feed.SNAPSHOT_COLUMNS)).csv(path, header=True)
    return sinks.blank_nulls(back, feed.SNAPSHOT_COLUMNS)


@query("a8_weather_export", f"""WITH {WEATHER_SQL}
SELECT route_code, aqi, '' AS aqi_category, rsi_flag AS condition, temp AS temp_c, realfeel AS realfeel_c, '' AS realfeel_word,
       humidity AS humidity_pct, '' AS wind_gust_kmh, '' AS uv_index FROM w""", needs="")
def _(spark, d):
    rows = weather_table(spark, d).withColumnsRenamed({"aqi": "aqi_value", "rsi_flag": "status", "realfeel": "realfeel_temp"})
    return sinks.weather_export(rows)


@query("a9_report_metadata", "SELECT strftime(min(ts), '%Y-%m-%d') AS min_date, strftime(max(ts), '%Y-%m-%d') AS max_date, count(DISTINCT route_code) AS routes, count(*) AS observations FROM r")
def _(spark, d):
    return patterns.report_metadata(readings(spark, d))


@query("a10_result_export", "SELECT route_code, avg(avg_speed) AS avg_speed FROM r GROUP BY route_code", doubles="avg_speed")
def _(spark, d):
    path = scratch(spark, "result")
    sinks.write_result(readings(spark, d).groupBy("route_code").agg(F.avg("avg_speed").alias("avg_speed")), path)
    return spark.read.schema("route_code string, avg_speed double").csv(path, header=True)


# --- B: parsing, scalars, enrichment ---------------------------------------------------------

@query("b1_b2_feed_phrases", f"""WITH {FEED_SQL} SELECT event_id, {MINUTES_SQL} AS minutes, TRY_CAST(replace(distance, ' km', '') AS DOUBLE) AS km FROM f""",
       needs="", doubles="minutes km")
def _(spark, d):
    return feed_text(spark, d).select("event_id", C.duration_minutes("duration").alias("minutes"), C.distance_km("distance").alias("km"))


@query("b3_parse_scraped", f"""WITH {FEED_SQL}, m AS (SELECT event_id, {MINUTES_SQL} AS mins, TRY_CAST(replace(distance, ' km', '') AS DOUBLE) AS distance FROM f)
SELECT event_id, CAST(mins AS INTEGER) AS duration, distance FROM m WHERE mins IS NOT NULL AND distance IS NOT NULL""", needs="", doubles="distance")
def _(spark, d):
    return enrich.parse_scraped(feed_text(spark, d)).select("event_id", "duration", "distance")


@query("b4_b5_route_ends", f"""WITH {PLACES_SQL}
SELECT route_code, split_part(route_code, '|', 1) AS origin_code, split_part(route_code, '|', 2) AS destination_code, a.location AS origin, b.location AS destination, n
FROM (SELECT route_code, count(*) AS n FROM s GROUP BY route_code)
LEFT JOIN p a ON a.plus_code = split_part(route_code, '|', 1) LEFT JOIN p b ON b.plus_code = split_part(route_code, '|', 2)""", needs="s")
def _(spark, d):
    trips = shipments(spark, d).groupBy("route_code").agg(F.count(F.lit(1)).alias("n"))
    out = enrich.with_route_ends(trips, locations(spark, d))
    return out.select("route_code", C.route_end("route_code", 1).alias("origin_code"), C.route_end("route_code", 2).alias("destination_code"), "origin", "destination", "n")


POLL_SQL = f"""WITH {PLACES_SQL}, c AS (SELECT DISTINCT route_code FROM s),
k AS (SELECT route_code, a.location AS origin, b.location AS destination FROM c
      JOIN p a ON a.plus_code = split_part(route_code, '|', 1) JOIN p b ON b.plus_code = split_part(route_code, '|', 2))"""


@query("b6_poll_list", f"{POLL_SQL} SELECT * FROM k", needs="s")
def _(spark, d):
    return enrich.poll_list(shipments(spark, d).select("route_code").distinct(), locations(spark, d))


@query("b6_dropped_routes", f"{POLL_SQL} SELECT route_code FROM c WHERE route_code NOT IN (SELECT route_code FROM k)", needs="s")
def _(spark, d):
    return enrich.dropped_routes(shipments(spark, d).select("route_code").distinct(), locations(spark, d))


CODES_SQL = """c AS (SELECT p_partkey, upper(substr(md5(CAST(p_partkey AS VARCHAR)), 1, 4)) || CASE WHEN p_partkey % 5 = 0 THEN '-' ELSE '+' END
                     || upper(substr(md5(p_name), 1, 2)) AS code FROM part)"""


def _codes(spark, d):
    mark = F.when(F.col("p_partkey") % 5 == 0, F.lit("-")).otherwise(F.lit("+"))
    code = F.concat(F.upper(F.substring(F.md5(F.col("p_partkey").cast("string").cast("binary")), 1, 4)), mark, F.upper(F.substring(F.md5(F.col("p_name").cast("binary")), 1, 2)))
    return table(spark, d, "part").select("p_partkey", code.alias("code"))


@query("b7_plus_code_test", f"WITH {CODES_SQL} SELECT p_partkey, regexp_matches(code, '^[2-9A-HJ-NP-Z]{{4,7}}\\+[2-9A-HJ-NP-Z]{{2,}}$') AS is_plus_code FROM c", needs="")
def _(spark, d):
    return _codes(spark, d).select("p_partkey", C.is_plus_code("code").alias("is_plus_code"))


def _place_sql(end: str, digits: list[int]) -> str:
    """Centre of the cell nearest to the reference point, for digits after the prefix 7J4V."""
    full = [5, 12, 2, 17, *[f"(p_partkey * {n} % 20)" for n in digits]]
    lat = " + ".join(f"{full[i]} * {20.0 ** (1 - i // 2):.12g}e0" for i in range(0, 10, 2))
    lon = " + ".join(f"{full[i]} * {20.0 ** (1 - i // 2):.12g}e0" for i in range(1, 10, 2))
    if len(full) == 11:  # one grid digit: five rows, four columns
        lat, lon = f"{lat} + ({full[10]} // 4) * 0.000025e0", f"{lon} + ({full[10]} % 4) * 0.00003125e0"
        high, wide = "0.0000125e0", "0.000015625e0"
    else:
        high = wide = "0.0000625e0"
    near = lambda c, ref: f"CASE WHEN {ref}e0 + 0.5e0 < {c} THEN {c} - 1 WHEN {ref}e0 - 0.5e0 > {c} THEN {c} + 1 ELSE {c} END"
    return f"{near(f'({lat} - 90 + {high})', '12.9514242')} AS {end}_lat, {near(f'({lon} - 180 + {wide})', '77.6590212')} AS {end}_lon"


@query("b8_route_points", f"SELECT p_partkey, {_place_sql('origin', [1, 3, 7, 9, 11, 13])}, {_place_sql('destination', [9, 7, 3, 1, 13, 17, 19])} FROM part",
       needs="", doubles="origin_lat origin_lon destination_lat destination_lon", digits=8)
def _(spark, d):
    alphabet = F.lit("23456789CFGHJMPQRVWX")
    digit = lambda n: F.substring(alphabet, (F.col("p_partkey") * n % 20 + 1).cast("int"), F.lit(1))
    short = F.concat(digit(1), digit(3), digit(7), digit(9), F.lit("+"), digit(11), digit(13))
    other = F.concat(digit(9), digit(7), digit(3), digit(1), F.lit("+"), digit(13), digit(17), digit(19))
    routes = table(spark, d, "part").select("p_partkey", F.concat(short, F.lit("|"), other).alias("route_code"))
    return route_points(routes, 12.9514242, 77.6590212).select("p_partkey", "origin_lat", "origin_lon", "destination_lat", "destination_lon")


@query("b9_report_view", f"""WITH {PLACES_SQL}
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS date, 0 AS hour, dayname(date) AS day_of_week,
       a.location AS origin, b.location AS destination, duration, distance, round_even(distance / (duration / 60e0), 2) AS avg_speed
FROM s LEFT JOIN p a ON a.plus_code = split_part(route_code, '|', 1) LEFT JOIN p b ON b.plus_code = split_part(route_code, '|', 2)""",
       needs="s", doubles="distance avg_speed", digits=2)
def _(spark, d):
    return enrich.report_view(shipments(spark, d), locations(spark, d))


@query("b10_slowest_trips", f"""WITH {PLACES_SQL}, m AS (SELECT max(duration) AS top FROM s)
SELECT route_code, b.location AS destination, duration, distance, round_even(distance / (duration / 60e0), 2) AS avg_speed
FROM s JOIN m ON duration = top LEFT JOIN p b ON b.plus_code = split_part(route_code, '|', 2)""", needs="s", doubles="distance avg_speed", digits=2)
def _(spark, d):
    return enrich.slowest_trips(shipments(spark, d), locations(spark, d)).select("route_code", "destination", "duration", "distance", "avg_speed")


@query("b11_b12_weather_join", f"""WITH {WEATHER_SQL}
SELECT event_id, r.route_code, coalesce(temp, '') AS temp, coalesce(realfeel, '') AS realfeel, coalesce(humidity, '') AS humidity,
       coalesce(CASE WHEN lower(rsi_flag) LIKE 'no precipitation%' THEN '' ELSE rsi_flag END, '') AS rsi_flag, coalesce(aqi, '') AS aqi
FROM r LEFT JOIN w ON w.route_code = r.route_code""")
def _(spark, d):
    return enrich.with_weather(readings(spark, d), weather_table(spark, d)).select("event_id", "route_code", *feed.WEATHER_FIELDS)


def _stations(spark, d):
    key = F.col("s_suppkey")
    name = F.when(key % 9 == 0, "bad").when(key % 7 == 0, " ").otherwise(
        F.concat(F.lit("n"), F.col("s_nationkey").cast("string"), F.lit("/"), (F.col("s_nationkey") + 100).cast("string")))
    return table(spark, d, "supplier").select(key.alias("line_no"), F.col("s_name").alias("label_short"), key.cast("string").alias("route_code"), name.alias("accuweather_station"))


@query("b13_unique_stations", f"""WITH {STATIONS_SQL}
SELECT station, label_short AS label, route_code, line_no FROM (
  SELECT *, trim(accuweather_station) AS station, row_number() OVER (PARTITION BY trim(accuweather_station) ORDER BY line_no) AS rn FROM st)
WHERE station <> '' AND rn = 1""", needs="")
def _(spark, d):
    return stations.unique_stations(_stations(spark, d))


PAGE_SQL = ", ".join(
    f"CASE WHEN station LIKE '%/%' THEN 'https://weather.example/en/in/' || station || '/{page}/' || split_part(station, '/', 2) || '?unit=c' END AS {name}_url"
    for name, page in (("minute", "minute-weather-forecast"), ("current", "current-weather"), ("aqi", "air-quality-index"))
)


@query("b14_page_urls", f"WITH {STATIONS_SQL}, u AS (SELECT line_no, accuweather_station AS station FROM st) SELECT line_no, {PAGE_SQL} FROM u", needs="")
def _(spark, d):
    rows = _stations(spark, d).withColumnRenamed("accuweather_station", "station")
    return stations.station_pages(rows, "https://weather.example", "in").select("line_no", "minute_url", "current_url", "aqi_url")


@query("b15_page_fields", r"""SELECT page_id,
  nullif(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1), '(?s)<[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g'), '') AS title,
  nullif(regexp_replace(regexp_replace(regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1), '(?s)<[^>]*>', '', 'g'), '^\s+|\s+$', '', 'g'), '') AS heading,
  nullif(regexp_extract(regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1), '([0-9]+)', 1), '') AS first_number,
  regexp_extract(html, '(?i)<html[^>]*\blang="([^"]*)"', 1) AS lang FROM pages""", needs="")
def _(spark, d):
    html = F.col("html")
    heading = F.regexp_extract(html, r"(?is)<h1\b[^>]*>(.*?)</h1\s*>", 1)
    return table(spark, d, "pages").select(
        "page_id", stations.tag_text(html, "title").alias("title"), stations.tag_text(html, "h1").alias("heading"),
        stations.first_integer(heading).alias("first_number"), F.regexp_extract(html, r'(?i)<html[^>]*\blang="([^"]*)"', 1).alias("lang"),
    )


def _snapshot_pages(spark, d):
    """The three pages of a station for every row of ``pages``: its title, address and numbers stand where
    the fields are read, next to decoys outside of these scopes, and its own markup follows."""
    p, k = F.col("page_id"), F.col("page_id") % 45
    title = F.regexp_extract("html", r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
    text = lambda *parts: F.concat(*[x if not isinstance(x, str) else F.lit(x) for x in parts])
    number = lambda c: c.cast("string")
    humidity = text('<div class="detail-item spaced"><div>Humidity</div><div> ', number(k + 30), " % </div></div>")
    wind = F.lit('<div class="detail-item"><div>Wind</div><div>9 km/h</div></div><div class="detail-item"><div>Humidity</div></div>')
    extra = text('<section><div class="no-realfeel-phrase  current-weather-extra"><div>RealFeel<b> ', number(k + 2), "</b>&deg;<div>7<div>Like ", F.col("url"), "</div></div></div></div></section>")
    current = text(
        '<p class="phrase">decoy</p><div class="current-weather-info"><p>Now<div><!-- 5 --><i>1</i><div class="temp">&#x2212;', number(k), "<span>&#176;C</span></div><div>99</div></div></div>",
        '<div class="phrase">decoy</div><div class="card current-weather" id=main><div><br><span class=\'day phrase\'>', title, "</span></div></div>",
        F.when(p % 7 == 0, F.lit('<div class="current-weather-extra"><div>88</div></div>')).otherwise(extra),
        '<div class="current-weather-details">', F.when(p % 2 == 0, F.concat(humidity, wind)).when(p % 5 == 0, wind).otherwise(F.concat(wind, humidity)), "</div>", F.col("html"),
    )
    minute = text('<p class="icon-phrase">decoy</p><div class="conditions-icon"><svg/><div class="icon-phrase">decoy</div><p class="icon-phrase">', title, " <b>&amp; wind</b></p></div>", F.col("html"),
                  '<div class="summary"> Dry for ', number(k), " min </div><div class='summary'>later</div>")
    aqi = text('<div class="aq-number">1</div><div id="current"><div><div class="aq-number"> ', F.when(p % 3 == 0, F.lit("none")).otherwise(number(k * 3)), " </div>",
               '<p class="category-text">', F.when(p % 4 == 0, F.lit(" &nbsp; ")).otherwise(title), "</p></div></div>", F.col("html"))
    return table(spark, d, "pages").select(
        number(p).alias("station"), F.when(p % 13 != 0, minute).alias("minute_html"), F.when(p % 11 != 0, current).alias("current_html"), aqi.alias("aqi_html")
    )


@query("b15_weather_fields", r"""
WITH p AS (SELECT *, page_id % 45 AS k, regexp_replace(regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1), '^\s+|\s+$', '', 'g') AS raw FROM pages),
t AS (SELECT *, replace(replace(replace(replace(raw, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'), '&amp;', '&') AS title FROM p)
SELECT CAST(page_id AS VARCHAR) AS station,
  CASE WHEN page_id % 11 <> 0 THEN CAST(k AS VARCHAR) END AS temp, CASE WHEN page_id % 11 <> 0 THEN nullif(title, '') END AS temp_flag,
  CASE WHEN page_id % 11 <> 0 AND page_id % 7 <> 0 THEN CAST(k + 2 AS VARCHAR) END AS realfeel, CASE WHEN page_id % 11 <> 0 AND page_id % 7 <> 0 THEN 'Like ' || url END AS realfeel_flag,
  CASE WHEN page_id % 11 <> 0 AND (page_id % 2 = 0 OR page_id % 5 <> 0) THEN CAST(k + 30 AS VARCHAR) END AS humidity,
  CASE WHEN page_id % 13 <> 0 THEN title || '& wind' END AS rsi_flag, CASE WHEN page_id % 13 <> 0 THEN 'Dry for ' || k || ' min' END AS rsi_forecast,
  CASE WHEN page_id % 3 <> 0 THEN CAST(k * 3 AS VARCHAR) END AS aqi, CASE WHEN page_id % 4 <> 0 THEN nullif(title, '') END AS aqi_flag FROM t""", needs="")
def _(spark, d):
    return stations.weather_fields(_snapshot_pages(spark, d))


@query("b16_b18_b19_row_labels", """
SELECT event_id, value / (CAST(10 + CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) / 60e0) AS speed,
       CASE WHEN hour(ts) % 12 = 0 THEN '12' ELSE CAST(hour(ts) % 12 AS VARCHAR) END || CASE WHEN hour(ts) < 12 THEN ' AM' ELSE ' PM' END AS hour_label,
       strftime(ts, '%Y-%m-%d %H:%M') AS time_label FROM events""", needs="", doubles="speed")
def _(spark, d):
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, d, "events").select("event_id", C.speed_kmh("value", k + 10).alias("speed"), C.hour_label(F.hour("ts")).alias("hour_label"), C.timestamp_label("ts").alias("time_label"))


@query("b17_route_labels", """SELECT route_code, coalesce(label_short, route_code) AS short_label, coalesce(label_full, route_code) AS full_label
FROM (SELECT DISTINCT route_code FROM r) LEFT JOIN routes USING (route_code)""", needs="r routes")
def _(spark, d):
    codes, dim = readings(spark, d).select("route_code").distinct(), route_table(spark, d)
    short = enrich.with_labels(codes, dim).withColumnRenamed("route_label", "short_label")
    return enrich.with_labels(short, dim, "full").withColumnRenamed("route_label", "full_label")


@query("b20_significance", """SELECT l_orderkey, l_linenumber, CASE WHEN l_discount * l_tax < 0.001e0 THEN '***' WHEN l_discount * l_tax < 0.01e0 THEN '**' WHEN l_discount * l_tax < 0.05e0 THEN '*' ELSE 'ns' END AS mark FROM lineitem""", needs="")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", C.significance(F.col("l_discount") * F.col("l_tax")).alias("mark"))


@query("b21_route_colors", f"""WITH pal AS (SELECT {C.PALETTE!r} AS c)
SELECT route_code, c[CAST((row_number() OVER (ORDER BY route_code) - 1) % 20 + 1 AS INTEGER)] AS color_hex FROM (SELECT DISTINCT route_code FROM s), pal""", needs="s")
def _(spark, d):
    return enrich.route_colors(shipments(spark, d).select("route_code").distinct())


@query("b22_maps_urls", """SELECT s_suppkey, 'https://www.google.com/maps/dir/?api=1&origin=' || replace(s_name, '#', '%23') || '&destination=' || replace(n_name || ', A/B', ', ', '%2C%20') || '&travelmode=driving' AS url
FROM supplier JOIN nation ON s_nationkey = n_nationkey""", needs="")
def _(spark, d):
    rows = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select("s_suppkey", C.maps_url("s_name", F.concat("n_name", F.lit(", A/B"))).alias("url"))


DETAIL_SQL = """'<b>' || coalesce(label_short, r.route_code) || '</b><br>Time: ' || strftime(timestamp, '%Y-%m-%d %H:%M') || '<br>Speed: ' || format('{:.1f}', round_even(avg_speed, 1))
  || ' km/h<br>Duration: ' || format('{:.1f}', round_even(duration, 1)) || ' min<br>Distance: ' || format('{:.1f}', round_even(distance, 1)) || ' km'"""


@query("b23_reading_details", f"SELECT event_id, {DETAIL_SQL} AS detail FROM r LEFT JOIN routes USING (route_code)", needs="r routes")
def _(spark, d):
    return enrich.reading_details(readings(spark, d), route_table(spark, d)).select("event_id", "detail")


@query("b23_reading_details_ranked", f"SELECT event_id, {DETAIL_SQL} || '<br>Percentile: ' || format('{{:.1f}}', round_even(event_id % 1000 / 10e0, 1)) || '%' AS detail FROM r LEFT JOIN routes USING (route_code)", needs="r routes")
def _(spark, d):
    rows = readings(spark, d).withColumn("percentile_rank", F.col("event_id") % 1000 / 10.0)
    return enrich.reading_details(rows, route_table(spark, d)).select("event_id", "detail")


@query("b24_feed_timestamps", f"""WITH {FEED_SQL} SELECT event_id, CAST(try_strptime(date || ' ' || time, '%Y-%m-%d %H:%M') AS VARCHAR) AS ts FROM f""", needs="")
def _(spark, d):
    return feed_text(spark, d).select("event_id", C.feed_timestamp("date", "time").alias("ts"))


@query("b24_unreadable_rows", f"""WITH {FEED_SQL} SELECT event_id, time FROM f WHERE try_strptime(date || ' ' || time, '%Y-%m-%d %H:%M') IS NULL""", needs="")
def _(spark, d):
    return clean.unreadable_rows(feed_text(spark, d)).select("event_id", "time")


# --- C: cleaning -----------------------------------------------------------------------------------

@query("c1_drop_repeats", f"WITH {RAW_SQL} SELECT event_id, route_code, duration, distance FROM c1", doubles="distance")
def _(spark, d):
    return clean.drop_repeats(raw_readings(spark, d), ["ts", "event_id"]).select("event_id", "route_code", "duration", "distance")


@query("c2_c4_preprocess", f"WITH {RAW_SQL} SELECT event_id, route_code, distance / (duration / 60e0) AS avg_speed FROM c1", doubles="avg_speed")
def _(spark, d):
    return clean.preprocess(raw_readings(spark, d).drop("avg_speed"), ["ts", "event_id"]).select("event_id", "route_code", "avg_speed")


@query("c3_null_profile", f"""WITH {RAW_SQL}
SELECT 'route_code' AS column_name, count(*) FILTER (WHERE route_code IS NULL) AS n_null FROM raw UNION ALL
SELECT 'duration', count(*) FILTER (WHERE duration IS NULL) FROM raw UNION ALL SELECT 'distance', count(*) FILTER (WHERE distance IS NULL) FROM raw UNION ALL
SELECT 'avg_speed', count(*) FILTER (WHERE avg_speed IS NULL) FROM raw""")
def _(spark, d):
    return clean.null_profile(raw_readings(spark, d).select("route_code", "duration", "distance", "avg_speed"))


@query("c4_critical_rows", f"WITH {RAW_SQL} SELECT event_id FROM c1 WHERE avg_speed IS NOT NULL")
def _(spark, d):
    return clean.preprocess(raw_readings(spark, d), ["ts", "event_id"]).select("event_id")


@query("c5_sorted_readings", "SELECT event_id, year, month, day, hour FROM r")
def _(spark, d):
    return clean.sorted_readings(readings(spark, d)).select("event_id", "year", "month", "day", "hour")


@query("c6_c7_calendar", "SELECT event_id, CAST(timestamp AS VARCHAR) AS timestamp, year, month, day, hour, day_of_week, is_weekend, time_category FROM r")
def _(spark, d):
    out = clean.with_calendar(readings(spark, d).select("event_id", "date", "time"))
    return out.select("event_id", "timestamp", "year", "month", "day", "hour", "day_of_week", "is_weekend", "time_category")


@query("c8_fill_gaps", """
WITH h AS (SELECT route_code, timestamp, avg(avg_speed) AS v FROM r GROUP BY ALL),
g AS (SELECT a.route_code, b.timestamp FROM (SELECT DISTINCT route_code FROM h) a, (SELECT DISTINCT timestamp FROM h) b),
j AS (SELECT g.*, h.v FROM g LEFT JOIN h USING (route_code, timestamp)),
k AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY route_code ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p,
             first_value(v IGNORE NULLS) OVER (PARTITION BY route_code ORDER BY timestamp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS f FROM j)
SELECT route_code, CAST(timestamp AS VARCHAR) AS timestamp, coalesce(v, (p + f) / 2, p, f) AS avg_speed, v IS NULL AS was_missing FROM k""", doubles="avg_speed")
def _(spark, d):
    return clean.fill_gaps(readings(spark, d))


@query("c9_rule_violations", """SELECT count(*) AS n_rows, count(*) FILTER (WHERE value < 0) AS negative_speed, CAST(0 AS BIGINT) AS nonpositive_duration,
count(*) FILTER (WHERE value <= 0) AS nonpositive_distance, CAST(0 AS BIGINT) AS hour_out_of_range, CAST(0 AS BIGINT) AS month_out_of_range, CAST(0 AS BIGINT) AS day_out_of_range FROM events""", needs="")
def _(spark, d):
    rows = table(spark, d, "events").select(
        F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"), F.hour("ts").alias("hour"),
        F.lit(10.0).alias("duration"), F.col("value").alias("distance"), F.col("value").alias("avg_speed"),
    )
    return clean.rule_violations(rows)


@query("c10_unknown_routes", "SELECT DISTINCT route_code FROM r WHERE route_code NOT IN (SELECT route_code FROM routes)", needs="r routes")
def _(spark, d):
    return clean.unknown_routes(readings(spark, d), route_table(spark, d))


@query("c11_drop_old_repeats", f"""WITH {AS_OF_SQL},
k AS (SELECT event_id, row_number() OVER (PARTITION BY date, split_part(time, ':', 1), route_code ORDER BY ts, event_id) AS rn FROM r, lim WHERE ts < cut)
SELECT event_id FROM k WHERE rn = 1 UNION ALL SELECT event_id FROM r, lim WHERE ts >= cut""")
def _(spark, d):
    rows = readings(spark, d)
    as_of = rows.agg(F.max("ts") - F.expr("interval 4 days")).scalar()
    return clean.drop_old_repeats(rows, as_of, ["ts", "event_id"]).select("event_id")


@query("c12_drop_cycle_repeats", """
WITH c AS (SELECT event_id, route_code, ts, date_trunc('hour', ts - INTERVAL 10 MINUTE) AS cyc, minute(ts - INTERVAL 10 MINUTE) AS o FROM r),
k AS (SELECT *, row_number() OVER (PARTITION BY cyc, route_code ORDER BY least(abs(o), abs(o - 30)), ts, event_id) AS rn FROM c)
SELECT event_id, CAST(cyc + INTERVAL 10 MINUTE AS VARCHAR) AS cycle_start FROM k WHERE rn = 1""")
def _(spark, d):
    return clean.drop_cycle_repeats(readings(spark, d), ["ts", "event_id"]).select("event_id", "cycle_start")


@query("c13_dataset_profile", """SELECT count(*) AS observations, count(DISTINCT route_code) AS routes, min(year) AS min_year, min(month) AS min_month, max(year) AS max_year, max(month) AS max_month,
min(year) || '-' || lpad(CAST(min(month) AS VARCHAR), 2, '0') || ' to ' || max(year) || '-' || lpad(CAST(max(month) AS VARCHAR), 2, '0') AS period FROM r""")
def _(spark, d):
    return clean.dataset_profile(readings(spark, d))


@query("c14_route_list", "SELECT DISTINCT route_code FROM s", needs="s")
def _(spark, d):
    return clean.route_list(shipments(spark, d))


# --- D: outliers and resampling ----------------------------------------------------------------------

@query("d1_iqr_outliers", """WITH q AS (SELECT quantile_cont(avg_speed, 0.25) AS a, quantile_cont(avg_speed, 0.75) AS b FROM r)
SELECT event_id, avg_speed < a - 3 * (b - a) OR avg_speed > b + 3 * (b - a) AS is_outlier FROM r, q""")
def _(spark, d):
    return outliers.flag_outliers(readings(spark, d), method="iqr").select("event_id", "is_outlier")


@query("d2_zscore_outliers", "SELECT event_id, abs((avg_speed - avg(avg_speed) OVER ()) / stddev(avg_speed) OVER ()) > 3 AS is_outlier FROM r")
def _(spark, d):
    return outliers.flag_outliers(readings(spark, d), method="zscore").select("event_id", "is_outlier")


@query("d3_isolation_properties", """
WITH v AS (SELECT DISTINCT avg_speed AS v FROM r)
SELECT (SELECT count(*) FROM r) AS n, true AS about_a_tenth, true AS largest_flagged, true AS middle_kept, true AS scores_between, (SELECT min(v) FROM v) AS lowest, (SELECT max(v) FROM v) AS highest""", doubles="lowest highest")
def _(spark, d):
    """What holds whatever trees are drawn: the share, the ends and the middle of the values."""
    rows = readings(spark, d)
    ends = rows.agg(F.max("avg_speed").alias("b"), F.percentile_approx("avg_speed", 0.5).alias("m")).select(F.struct("*").alias("e")).scalar()
    out = outliers.flag_outliers(rows, method="isolation_forest", order=["ts", "event_id"]).withColumn("ends", ends)
    flagged, x, ends = F.col("is_outlier"), F.col("avg_speed"), F.col("ends")
    return out.agg(
        F.count(F.lit(1)).alias("n"), F.avg(flagged.cast("double")).between(0.05, 0.1001).alias("about_a_tenth"),
        F.bool_and(F.when(x == ends.getField("b"), flagged)).alias("largest_flagged"),
        F.bool_and(F.when(x == ends.getField("m"), ~flagged)).alias("middle_kept"), F.bool_and(F.col("isolation_score").between(0.0, 1.0)).alias("scores_between"),
        F.min("avg_speed").alias("lowest"), F.max("avg_speed").alias("highest"),
    )


@query("d3_isolation_forest")
def _(spark, d):
    out = outliers.flag_outliers(readings(spark, d), method="isolation_forest", order=["ts", "event_id"])
    return out.select("event_id", "avg_speed", "isolation_score", "is_outlier")


D5_ROWS = "(SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos, count(*) OVER () AS n, unnest(range(0, 20)) AS iter FROM r)"


@query("d5_bootstrap", f"""WITH x AS (SELECT iter, (high * n + ((low * n) >> 31)) >> 31 AS pos FROM {draws.numbers_sql(draws.numbers_sql(D5_ROWS, 'high', 'pos', 7, 'iter'), 'low', 'pos', 8, 'iter')})
SELECT CAST(x.iter AS INTEGER) AS iter, event_id, count(*) AS weight FROM x JOIN (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM r) USING (pos) GROUP BY ALL""")
def _(spark, d):
    drawn = outliers.bootstrap(readings(spark, d).select("event_id", "ts", "route_code", "avg_speed"), ["ts", "event_id"], n_iterations=20, seed=7)
    return drawn.select("iter", "event_id", "weight")


POISSON_SQL = f"b AS (SELECT *, {draws.poisson_sql('u')} AS weight FROM {draws.numbers_sql('(SELECT *, unnest(range(0, 20)) AS iter FROM r)', 'u', 'event_id', 7, 'iter')})"


@query("d5_poisson_bootstrap", f"WITH {POISSON_SQL} SELECT CAST(iter AS INTEGER) AS iter, route_code, CAST(sum(weight) AS BIGINT) AS n, sum(weight * avg_speed) / sum(weight) AS mean_speed FROM b WHERE weight > 0 GROUP BY iter, route_code", doubles="mean_speed")
def _(spark, d):
    rows = readings(spark, d).select("event_id", "route_code", "avg_speed")
    drawn = outliers.poisson_bootstrap(rows, ["event_id"], n_iterations=20, seed=7)
    return drawn.groupBy("iter", "route_code").agg(F.sum("weight").alias("n"), (F.sum(F.col("weight") * F.col("avg_speed")) / F.sum("weight")).alias("mean_speed"))


@query("d5_poisson_sums", f"""WITH raw AS (SELECT * REPLACE (CASE WHEN event_id % 37 <> 0 THEN avg_speed END AS avg_speed) FROM r), {POISSON_SQL.replace('FROM r)', 'FROM raw)')}
SELECT CAST(iter AS INTEGER) AS iter, route_code, hour, CAST(sum(weight) AS DOUBLE) AS n, coalesce(sum(weight * avg_speed), 0) AS avg_speed_sum, CAST(coalesce(sum(weight) FILTER (avg_speed IS NOT NULL), 0) AS DOUBLE) AS avg_speed_n
FROM b WHERE weight > 0 GROUP BY iter, route_code, hour""", doubles="avg_speed_sum", digits=4)
def _(spark, d):
    rows = readings(spark, d).withColumn("avg_speed", F.when(F.col("event_id") % 37 != 0, F.col("avg_speed")))
    return outliers.poisson_sums(rows, ["route_code", "hour"], ["avg_speed"], ["event_id"], 20, 7)


@query("d6_sample_fraction", f"SELECT event_id, route_code, avg_speed FROM {draws.numbers_sql('r', 'u', 'event_id', 42)} WHERE u < {int(0.1 * draws.TOP)}", doubles="avg_speed")
def _(spark, d):
    return outliers.sample_fraction(readings(spark, d), 0.1, 42, ["event_id"]).select("event_id", "route_code", "avg_speed")
