"""Tables that are replaced as a whole."""

import os

import pytest

from wayspan.operators import clean
from wayspan.sources import sinks
from wayspan.sources.versions import VersionConflict, VersionedTable

FEED = "date date, time string, route_code string, duration int, distance double"


def rows(spark, *times):
    return spark.createDataFrame([("2026-02-04", t, "A", i, 1.0) for i, t in enumerate(times)], "d string, time string, route_code string, duration int, distance double").selectExpr("CAST(d AS DATE) AS date", "time", "route_code", "duration", "distance")


def test_replace_what_is_read(spark, tmp_path):
    path = str(tmp_path / "feed")
    table = VersionedTable(spark, path)
    assert table.live().number == 0
    with pytest.raises(FileNotFoundError):
        sinks.live_feed(spark, path)
    assert sinks.rewrite_feed(rows(spark, "00:40", "00:10", "01:10"), path, apply=False) is None and table.live().number == 0
    first = sinks.rewrite_feed(rows(spark, "00:40", "00:10", "01:10"), path, apply=True)
    live, number = sinks.live_feed(spark, path)
    assert number == first.number == 1 and [r.time for r in live.collect()] == ["00:10", "00:40", "01:10"]
    second = sinks.rewrite_feed(clean.drop_old_repeats(live, "2026-02-09 00:00:00", ["time"]), path, apply=True, since=number)
    live, number = sinks.live_feed(spark, path)
    assert number == second.number == 2 and [r.time for r in live.collect()] == ["00:10", "01:10"]
    assert len(os.listdir(tmp_path / "feed" / "data")) == 2  # the version before can still be read


def test_second_writer_fails_cleanly(spark, tmp_path):
    path = str(tmp_path / "feed")
    sinks.rewrite_feed(rows(spark, "00:10"), path, apply=True)
    base = VersionedTable(spark, path).live().number
    sinks.rewrite_feed(rows(spark, "00:20", "00:30"), path, apply=True, since=base)
    with pytest.raises(VersionConflict):
        sinks.rewrite_feed(rows(spark, "00:50"), path, apply=True, since=base)
    live, number = sinks.live_feed(spark, path)
    assert number == 2 and [r.time for r in live.collect()] == ["00:20", "00:30"]
    assert len(os.listdir(tmp_path / "feed" / "data")) == 2
    assert [f for f in os.listdir(tmp_path / "feed" / "manifest") if "-" in f] == []


def test_writer_that_is_overtaken_while_it_writes(spark, tmp_path):
    """The other version comes in after the check and before the rename."""
    path = str(tmp_path / "feed")
    table = VersionedTable(spark, path)

    def slow(folder):
        sinks.rewrite_feed(rows(spark, "00:20"), path, apply=True)
        rows(spark, "00:50").write.csv(folder)

    with pytest.raises(VersionConflict):
        table.replace(slow)
    late = VersionedTable(spark, path)
    kept = late.live
    late.live = lambda: type(kept())(0, None)  # as if it had looked before the other was done
    with pytest.raises(VersionConflict):
        late.replace(lambda folder: rows(spark, "00:55").write.csv(folder))
    assert [r.time for r in sinks.live_feed(spark, path)[0].collect()] == ["00:20"]


def test_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "feed")
    sinks.rewrite_feed(rows(spark, "00:10"), path, apply=True)
    with pytest.raises(ZeroDivisionError):
        VersionedTable(spark, path).replace(lambda folder: 1 / 0)
    assert sinks.live_feed(spark, path)[1] == 1
