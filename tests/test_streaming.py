import time

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from wayspan.operators.ordering import first_rows
from wayspan.plans.tables import readings
from wayspan.streaming import feed

SF = "/root/testdata/sf0.001"


def test_stream_dedup_equals_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = readings(spark, SF).select("event_id", "ts", "route_code", "avg_speed")
    rows.repartition(1).sortWithinPartitions("ts").write.parquet(src)
    stream = feed.file_stream(spark, src, spark.read.parquet(src).schema)
    feed.run_available(feed.dedup_hourly(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = first_rows(rows.withColumn("h", F.date_trunc("hour", "ts")), ["route_code", "h"], ["ts", "event_id"])
    assert got.count() == batch.count() == got.select("route_code", "hour_bucket").distinct().count()
    # a second run over the same folder finds nothing new
    feed.run_available(feed.dedup_hourly(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == batch.count()


def test_stream_hourly_speed(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = readings(spark, SF).select("event_id", "ts", "route_code", "avg_speed")
    rows.write.parquet(src)
    stream = feed.file_stream(spark, src, spark.read.parquet(src).schema)
    feed.run_available(feed.hourly_speed(stream), str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out")).toPandas()
    pdf = rows.toPandas()
    want = pdf.groupby(["route_code", pdf["ts"].dt.floor("h")])["avg_speed"].mean()
    for r in got.head(50).itertuples():
        assert abs(want[r.route_code, pd.Timestamp(r.hour_start)] - r.avg_speed) < 1e-9
    assert 0 < len(got) <= len(want)


def test_open_hours_complete_the_emitted(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    rows = readings(spark, SF).select("event_id", "ts", "route_code", "avg_speed")
    rows.write.parquet(src)
    feed.run_available(feed.hourly_speed(feed.file_stream(spark, src, spark.read.parquet(src).schema)), out, state)
    got = spark.read.parquet(out).unionByName(feed.open_hours(spark, state)).toPandas()
    pdf = rows.toPandas()
    want = pdf.groupby(["route_code", pdf["ts"].dt.floor("h")])["avg_speed"].agg(["mean", "size"])
    assert len(got) == len(want)
    for r in got.itertuples():
        mean, n = want.loc[(r.route_code, pd.Timestamp(r.hour_start))]
        assert abs(mean - r.avg_speed) < 1e-9 and n == r.readings


def test_cleaned_feed_in_any_order_of_arrival(spark, tmp_path):
    """Files arrive shuffled; the earliest row of an hour stays, and the newest day is left as it is."""
    from wayspan.operators.clean import drop_old_repeats

    rows = readings(spark, SF).select("event_id", "ts", "route_code", "date", "time", "avg_speed")
    again = rows.unionByName(rows.filter("event_id % 3 = 0").withColumn("event_id", F.col("event_id") + 1000000).withColumn("ts", F.expr("ts - interval 1 second")))
    last = again.agg(F.max("ts")).first()[0]
    want = {r.event_id for r in drop_old_repeats(again.withColumn("time", F.date_format("ts", "HH:mm")).withColumn("date", F.col("ts").cast("date")), str(last), ["ts", "event_id"]).select("event_id").collect()}
    for name, order, delay in (("shuffled", F.xxhash64("event_id"), "3650 days"), ("backwards", F.desc("ts"), "3650 days"), ("in_time", F.col("ts"), "24 hours")):
        src, out = str(tmp_path / name), str(tmp_path / f"{name}-out")
        listed = again.withColumn("k", F.row_number().over(Window.orderBy(order)) % 10**9)
        n = listed.count()
        for i in range(4):  # four files, in this order
            listed.filter((F.col("k") > i * n / 4) & (F.col("k") <= (i + 1) * n / 4)).drop("k").coalesce(1).write.mode("append").parquet(src)
            time.sleep(1.1)
        stream = feed.file_stream(spark, src, spark.read.parquet(src).schema, files_per_trigger=1)
        feed.run_available(feed.first_of_hour(stream, ["ts", "event_id"], delay=delay), out, f"{out}-state")
        got = feed.cleaned_feed(spark, spark.read.parquet(src), out, f"{out}-state", ["ts", "event_id"])
        assert sorted(r.event_id for r in got.select("event_id").collect()) == sorted(want), name
        if name == "in_time":
            assert spark.read.parquet(out).count() > 0
