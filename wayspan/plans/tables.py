"""Views of the test tables as readings, route table, feed text and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayspan.functions import columns as C


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str, route: str = "event_type") -> DataFrame:
    """``events`` as readings: k of the JSON is the delay, value the distance."""
    k = F.get_json_object("props", "$.k").cast("int")
    day = F.col("ts").cast("date")
    return (
        table(spark, sf_dir, "events")
        .select(
            "event_id", "ts", F.col(route).cast("string").alias("route_code"), day.alias("date"),
            F.date_format("ts", "HH:mm").alias("time"), F.year(day).alias("year"), F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"), F.hour("ts").alias("hour"),
            C.hour_from_number(C.hour_number("ts")).alias("timestamp"), C.day_name(day).alias("day_of_week"),
            C.is_weekend(day).alias("is_weekend"), C.time_band(F.hour("ts")).alias("time_category"),
            (k + 10).cast("double").alias("duration"), F.col("value").alias("distance"),
        )
        .withColumn("avg_speed", C.speed_kmh("distance", "duration"))
    )


def raw_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings before cleaning: planted repeats inside the hour and planted NULL speeds."""
    base = readings(spark, sf_dir).select("event_id", "ts", "route_code", "date", "time", "duration", "distance", "avg_speed")
    again = base.filter("event_id % 10 = 0").withColumn("event_id", F.col("event_id") + 100000000)
    both = base.unionByName(again)
    return both.withColumn("avg_speed", F.when(F.col("event_id") % 37 != 0, F.col("avg_speed")))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as readings between the nations of supplier and customer (day grain)."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    joined = (
        items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    day = F.col("l_shipdate").cast("date")
    return joined.select(
        "l_orderkey", "l_linenumber",
        F.concat_ws("|", F.col("s_nationkey").cast("string"), F.col("c_nationkey").cast("string")).alias("route_code"),
        day.alias("date"), F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        F.lit(0).alias("hour"), F.lit("00:00").alias("time"), day.cast("timestamp_ntz").alias("timestamp"),
        F.col("l_quantity").alias("duration"), (F.col("l_extendedprice") / 1000.0).alias("distance"),
    ).withColumn("avg_speed", C.speed_kmh("distance", "duration"))


def route_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route dimension over the event types; one code has no short label, one is missing."""
    codes = table(spark, sf_dir, "events").select(F.col("event_type").alias("route_code")).distinct().filter("route_code <> 'signup'")
    return codes.select(
        "route_code", F.concat(F.lit("Route "), F.upper("route_code")).alias("label_full"),
        F.when(F.col("route_code") != "view", F.initcap("route_code")).alias("label_short"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the location dimension; key 7 is left out so that some ends do not resolve."""
    return table(spark, sf_dir, "nation").filter("n_nationkey <> 7").select(
        F.col("n_nationkey").cast("string").alias("plus_code"), F.col("n_name").alias("location")
    )


def feed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed text: duration and distance as phrases, some of them malformed."""
    k = F.get_json_object("props", "$.k").cast("int")
    total = k + 10
    hours, minutes = F.floor(total / 60).cast("int"), total % 60
    phrase = (
        F.when(F.col("event_id") % 41 == 0, F.lit("n/a"))
        .when(F.col("event_id") % 43 == 0, F.concat(hours.cast("string"), F.lit(" hrs")))
        .when(hours == 0, F.concat(minutes.cast("string"), F.lit(" min")))
        .when(minutes == 0, F.concat(hours.cast("string"), F.lit(" hr")))
        .otherwise(F.concat(hours.cast("string"), F.lit(" hr "), minutes.cast("string"), F.lit(" min")))
    )
    km = F.when(F.col("event_id") % 47 == 0, F.lit("-")).otherwise(F.concat(F.col("value").cast("decimal(10,2)").cast("string"), F.lit(" km")))
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(F.col("event_id") % 53 == 0, F.lit("")).when(F.col("event_id") % 59 == 0, F.lit("25:61"))
        .otherwise(F.date_format("ts", "HH:mm")).alias("time"),
        F.col("event_type").alias("route_code"), phrase.alias("duration"), km.alias("distance"),
    )


def weather_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather per route from its latest event; one route has none."""
    k = F.get_json_object("props", "$.k").cast("int")
    last = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("route_code")).agg(
        F.max_by(F.struct(k.alias("k"), F.col("value").alias("v")), F.struct("ts", "event_id")).alias("x")
    )
    return last.filter("route_code <> 'click'").select(
        "route_code", F.col("x.k").cast("string").alias("temp"), (F.col("x.k") + 2).cast("string").alias("realfeel"),
        F.floor(F.col("x.v") % 100).cast("string").alias("humidity"),
        F.when(F.col("x.k") % 2 == 0, F.lit("No Precipitation")).otherwise(F.lit("Rain soon")).alias("rsi_flag"),
        F.floor(F.col("x.v")).cast("string").alias("aqi"),
    )
