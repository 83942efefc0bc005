"""Joins with the dimensions: locations, labels, colours, weather, poll list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayspan.functions import columns as C
from wayspan.operators.clean import ensure_calendar
from wayspan.operators.ordering import with_positions
from wayspan.sources.feed import WEATHER_FIELDS

# Dimension tables are joined without a forced broadcast: Spark broadcasts them when
# their measured size allows and shuffles otherwise.


def parse_scraped(df: DataFrame) -> DataFrame:
    """Numbers from the scraped phrases; a reading without distance or duration is dropped."""
    out = df.withColumn("distance", C.distance_km("distance")).withColumn("duration", C.duration_minutes("duration"))
    return out.dropna(subset=["distance", "duration"]).withColumn("duration", F.col("duration").cast("int"))


def with_route_ends(df: DataFrame, locations: DataFrame) -> DataFrame:
    """Names of both ends; an unknown end is NULL."""
    names = locations.select("plus_code", "location")
    start = names.select(F.col("plus_code").alias("_o"), F.col("location").alias("origin"))
    end = names.select(F.col("plus_code").alias("_d"), F.col("location").alias("destination"))
    split = df.withColumn("_o", C.route_end("route_code", 1)).withColumn("_d", C.route_end("route_code", 2))
    return split.join(start, "_o", "left").join(end, "_d", "left").drop("_o", "_d")


def poll_list(routes: DataFrame, locations: DataFrame) -> DataFrame:
    """Routes whose both ends are known."""
    return with_route_ends(routes, locations).filter(F.col("origin").isNotNull() & F.col("destination").isNotNull())


def dropped_routes(routes: DataFrame, locations: DataFrame) -> DataFrame:
    """Routes left out of the poll list."""
    return routes.join(poll_list(routes, locations).select("route_code"), "route_code", "left_anti")


def with_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather fields of the route, empty text where unknown; dry phrases become empty."""
    joined = df.join(weather.select("route_code", *WEATHER_FIELDS), "route_code", "left")
    out = joined.withColumn("rsi_flag", C.rain_flag("rsi_flag"))
    return out.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in WEATHER_FIELDS})


def report_view(df: DataFrame, locations: DataFrame) -> DataFrame:
    """Flat view of the readings, slowest first."""
    day = F.col("date").cast("date")
    named = with_route_ends(df, locations)
    return named.select(
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("date"), C.clock_hour("time").alias("hour"),
        C.day_name(day).alias("day_of_week"), "origin", "destination", "duration", "distance",
        C.half_even(C.speed_kmh("distance", "duration"), 2).alias("avg_speed"),
    ).orderBy("avg_speed")


def slowest_trips(df: DataFrame, locations: DataFrame) -> DataFrame:
    """All readings with the largest duration, with the summary line."""
    longest = df.agg(F.max("duration")).scalar()
    named = with_route_ends(df.filter(F.col("duration") == longest), locations)
    out = named.select(
        C.clock_hour("time").alias("hour"), "route_code", "destination", "duration", "distance",
        C.half_even(C.speed_kmh("distance", "duration"), 2).alias("avg_speed"),
    )
    line = F.format_string("%shrs [snapshot] %s mins @ %s Km/hr (→ %s)", F.col("hour").cast("string"), F.col("duration").cast("string"),
                           F.col("avg_speed").cast("string"), F.col("destination"))
    return out.withColumn("summary", line)


def with_labels(df: DataFrame, routes: DataFrame, kind: str = "short") -> DataFrame:
    """Add ``route_label``: short or full label, or the code where there is none."""
    column = {"short": "label_short", "full": "label_full"}.get(kind)
    if column is None or column not in routes.columns:
        return df.withColumn("route_label", F.col("route_code"))
    named = routes.select("route_code", F.col(column).alias("_label")).dropDuplicates(["route_code"])
    return df.join(named, "route_code", "left").withColumn("route_label", F.coalesce("_label", "route_code")).drop("_label")


def route_colors(routes: DataFrame, readings: DataFrame | None = None, palette: Sequence[str] = C.PALETTE) -> DataFrame:
    """Colour per route: the given one, else the palette in order of the code.

    Routes that only occur in ``readings`` get palette colours of their own.
    """
    known = routes.select("route_code", *(["color_hex"] if "color_hex" in routes.columns else [])).dropDuplicates(["route_code"]).dropna(subset=["route_code"])
    if "color_hex" in routes.columns:
        out = known.select("route_code", F.coalesce("color_hex", F.lit(C.NO_COLOR)).alias("color_hex"))
    else:
        out = with_positions(known, [], ["route_code"]).select("route_code", C.palette_color("pos", palette).alias("color_hex"))
    if readings is not None:
        extra = readings.select("route_code").dropna().distinct().join(known.select("route_code"), "route_code", "left_anti")
        out = out.unionByName(with_positions(extra, [], ["route_code"]).select("route_code", C.palette_color("pos", palette).alias("color_hex")))
    return out


def route_options(df: DataFrame, routes: DataFrame) -> DataFrame:
    """(label, code) of the routes with readings, by label."""
    return with_labels(df.select("route_code").dropna().distinct(), routes).select("route_label", "route_code").orderBy("route_label", "route_code")


def reading_details(df: DataFrame, routes: DataFrame) -> DataFrame:
    """Readings with their detail text."""
    return with_labels(ensure_calendar(df), routes).withColumn(
        "detail", C.reading_detail(percentile="percentile_rank" if "percentile_rank" in df.columns else None)
    )


def weather_relation(df: DataFrame) -> DataFrame:
    """Correlation of temperature, humidity and air quality with the speed (one row)."""
    return df.agg(
        F.count("avg_speed").alias("observations"),
        *[F.corr(F.col(c).try_cast("double"), "avg_speed").alias(f"{c}_corr") for c in ("temp", "humidity", "aqi")],
    )


def speed_by_rain(df: DataFrame) -> DataFrame:
    """Mean speed per rain phrase (empty: dry or unknown)."""
    return df.groupBy("rsi_flag").agg(F.count(F.lit(1)).alias("observations"), F.avg("avg_speed").alias("avg_speed"))
