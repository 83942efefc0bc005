"""Writers: append, rewrite, weather snapshot, report data, results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayspan.sources.feed import FEED_COLUMNS, SNAPSHOT_COLUMNS, read_feed
from wayspan.sources.versions import Version, VersionedTable

# Output name and input field of the alternate weather export.
WEATHER_EXPORT = {
    "route_code": "route_code",
    "aqi": "aqi_value",
    "aqi_category": "aqi_category",
    "condition": "status",
    "temp_c": "temp",
    "realfeel_c": "realfeel_temp",
    "realfeel_word": "realfeel_word",
    "humidity_pct": "humidity",
    "wind_gust_kmh": "wind",
    "uv_index": "uv_index",
}


def feed_rows(df: DataFrame) -> DataFrame:
    """Feed columns in their fixed order; absent weather fields are NULL."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in FEED_COLUMNS])


def append_feed(df: DataFrame, path: str) -> None:
    """Append typed readings, one folder per date so that later scans can prune.

    The rebalance hint lets adaptive execution merge small dates and split a busy one.
    """
    feed_rows(df).hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(path)


def rewrite_feed(cleaned: DataFrame, path: str, apply: bool = False, since: int | None = None) -> Version | None:
    """Replace the feed table at ``path`` by the cleaned rows, sorted by (date, time, route).

    The rows go to a new version, so ``cleaned`` may read the live one; it is swapped in when it
    is complete. ``since`` is the version that ``cleaned`` was made from; a newer one in place is a
    :class:`VersionConflict`. Without ``apply`` nothing is written.
    """
    if not apply:
        return None
    rows = feed_rows(cleaned).orderBy("date", "time", "route_code")
    return VersionedTable(cleaned.sparkSession, path).replace(lambda folder: rows.write.mode("errorifexists").csv(folder, header=True), since)


def live_feed(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """The live version of a rewritten feed and its number."""
    at = VersionedTable(spark, path).live()
    if at.path is None:
        raise FileNotFoundError(f"{path} has no version yet")
    return read_feed(spark, at.path), at.number


def blank_nulls(df: DataFrame, columns) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])


def weather_snapshot(stations: DataFrame, extracted: DataFrame) -> DataFrame:
    """One row per station in station order; fields of failed pages are empty.

    ``stations``: station, label, route_code, line_no. ``extracted``: station and the
    weather fields (any of them NULL); ``failed`` marks a station that gave nothing at
    all, whose whole row is then empty.
    """
    lost = F.coalesce(F.col("failed"), F.lit(False)) if "failed" in extracted.columns else F.lit(False)
    named = stations.join(extracted, "station", "left").select(
        "line_no",
        F.when(~lost, F.col("route_code")).alias("route_code"),
        F.when(~lost, F.coalesce("label", "station")).alias("route_name_short"),
        F.when(~lost, F.col("station")).alias("accuweather_station"),
        *[F.when(~lost, F.col(c)).alias(c) for c in SNAPSHOT_COLUMNS[3:]],
    )
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in SNAPSHOT_COLUMNS]
    return named.select("line_no", *filled)


def write_weather_snapshot(snapshot: DataFrame, path: str) -> None:
    snapshot.orderBy("line_no").select(*SNAPSHOT_COLUMNS).write.mode("errorifexists").csv(path, header=True, emptyValue="")


def weather_export(rows: DataFrame) -> DataFrame:
    """Alternate weather export: ten renamed columns, NULL as empty text."""
    def field(name: str):
        return F.col(name).cast("string") if name in rows.columns else F.lit(None).cast("string")

    return rows.select(*[F.coalesce(field(src), F.lit("")).alias(out) for out, src in WEATHER_EXPORT.items()])


def write_result(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Export a result table to a new folder."""
    writer = df.write.mode("errorifexists")
    if fmt == "csv":
        writer.csv(path, header=True)
    else:
        writer.format(fmt).save(path)
