"""Streaming forms of the feed dedup and the hourly means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayspan.operators.ordering import first_rows


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """Append-only folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Watermarks need a timestamp with time zone; plain timestamps are read as session time."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def dedup_hourly(stream: DataFrame, column: str = "ts", delay: str = "24 hours") -> DataFrame:
    """First arrival per route and clock hour; state is dropped after the watermark."""
    timed = event_time(stream, column).withWatermark(column, delay)
    keyed = timed.withColumn("hour_bucket", F.date_trunc("hour", column))
    return keyed.dropDuplicatesWithinWatermark(["route_code", "hour_bucket"])


def first_of_hour(stream: DataFrame, order: Sequence[str], column: str = "ts", delay: str = "24 hours") -> DataFrame:
    """The earliest row by ``order`` of every route and clock hour, whatever the order of arrival; it
    comes out when the watermark has passed the hour. The state is one row an open hour."""
    columns = [c for c in stream.columns if c != column] + [column]
    timed = event_time(stream, column).withWatermark(column, delay)
    entry = F.struct(*columns)
    first = timed.groupBy(F.window(column, "1 hour").alias("w"), "route_code").agg(F.min_by(entry, F.struct(*order)).alias("first"))
    return first.select(F.col("w.start").alias("hour_bucket"), "first.*")


def cleaned_feed(spark: SparkSession, source: DataFrame, closed: str, checkpoint: str, order: Sequence[str], column: str = "ts") -> DataFrame:
    """The feed under the rule of the batch rewrite at the newest time of ``source``: hours that
    :func:`first_of_hour` has closed (the table at ``closed``) hold their first row, and of the hours that
    its state still holds, rows older than a day are reduced to the first and newer ones stay.

    ``source`` is the table that the stream has read; only rows of open hours are taken from it.
    """
    state = spark.read.format("statestore").load(checkpoint).select(F.col("key").cast("struct<w: struct<start: timestamp, end: timestamp>, route_code: string>").alias("k"))
    still = state.select(F.col("k.w.start").alias("_open"), F.col("k.route_code").alias("_route"))
    rows = event_time(source, column).withColumn("_hour", F.date_trunc("hour", column))
    held = rows.join(still, (F.col("_hour") == F.col("_open")) & F.col("route_code").eqNullSafe(F.col("_route")), "left_semi")
    last = rows.agg(F.max(column)).scalar()
    old = F.col(column) < last - F.expr("interval 24 hours")
    first = first_rows(held.filter(old), ["_hour", "route_code"], order)
    recent = held.filter(~old)
    done = spark.read.parquet(closed)
    return done.select(*source.columns).unionByName(first.unionByName(recent).select(*source.columns))


def hourly_speed(stream: DataFrame, column: str = "ts", delay: str = "24 hours") -> DataFrame:
    """Mean speed per route and tumbling hour, emitted once the hour is closed."""
    timed = event_time(stream, column).withWatermark(column, delay)
    return timed.groupBy(F.window(column, "1 hour").alias("w"), "route_code").agg(
        F.avg("avg_speed").alias("avg_speed"), F.count(F.lit(1)).alias("readings")
    ).select("route_code", F.col("w.start").alias("hour_start"), "avg_speed", "readings")


def open_hours(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The hours that ``hourly_speed`` still holds in the state of its last run: those the watermark
    has not closed. With what it has emitted they are all hours read so far."""
    state = spark.read.format("statestore").load(checkpoint).select(
        F.col("key").cast("struct<w: struct<start: timestamp, end: timestamp>, route_code: string>").alias("k"),
        F.col("value").cast("struct<total: double, valued: bigint, readings: bigint>").alias("v"),
    )
    speed = F.when(F.col("v.valued") > 0, F.col("v.total") / F.col("v.valued"))
    return state.select("k.route_code", F.col("k.w.start").alias("hour_start"), speed.alias("avg_speed"), "v.readings")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Process what is there and stop; the checkpoint carries the state to the next run."""
    query = (
        stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )
    query.awaitTermination()
    return query
