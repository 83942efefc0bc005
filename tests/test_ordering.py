"""Blocks of any size must give the same numbers as pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wayspan.operators import ordering as o


@pytest.fixture(scope="module")
def hot(spark):
    """One route holds two thirds of all rows; a third of its values are equal."""
    rng = np.random.default_rng(1)
    n = 6000
    route = np.where(rng.random(n) < 0.67, "hot", rng.choice(["a", "b", "c"], n))
    x = np.where(rng.random(n) < 0.33, 5.0, np.round(rng.normal(10, 4, n), 2))
    pdf = pd.DataFrame({"route_code": route, "id": np.arange(n), "ts": rng.integers(0, 500, n), "x": x})
    return spark.createDataFrame(pdf).cache(), pdf


@pytest.mark.parametrize("size", [1_000_000, 97, 5])
def test_positions(hot, size):
    df, pdf = hot
    got = o.with_positions(df, ["route_code"], ["ts", "id"], rows_per_block=size).toPandas().sort_values(["route_code", "ts", "id"])
    assert (got.groupby("route_code").cumcount() == got["pos"]).all()
    assert (got.groupby("route_code")["id"].transform("count") == got["n"]).all()
    everything = o.with_positions(df, [], ["ts", "id"], rows_per_block=size).toPandas().sort_values(["ts", "id"])
    assert (everything["pos"].to_numpy() == np.arange(len(pdf))).all() and (everything["n"] == len(pdf)).all()


@pytest.mark.parametrize("size", [1_000_000, 97, 5])
def test_quantiles(hot, size):
    df, pdf = hot
    qs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = o.group_quantiles(df, ["route_code"], "x", qs, rows_per_block=size).toPandas().set_index("route_code").sort_index()
    want = pdf.groupby("route_code")["x"].quantile(list(qs.values())).unstack()
    assert np.allclose(got[list(qs)].to_numpy(), want.to_numpy(), atol=1e-12)
    whole = o.group_quantiles(df, [], "x", qs, rows_per_block=size).toPandas()
    assert np.allclose(whole[list(qs)].to_numpy()[0], pdf["x"].quantile(list(qs.values())), atol=1e-12)


@pytest.mark.parametrize("size", [1_000_000, 7])
def test_nulls_and_ties(spark, size):
    """A NULL group is a group, NULL values count nowhere, rows of equal order keep all positions."""
    rows = [(k, v, t) for k in ("a", "b", None) for t, v in enumerate([None, 1.0, 1.0, 2.0, None, 7.0] * 5)]
    df = spark.createDataFrame(rows, "k string, v double, t int")
    placed = o.with_positions(df.withColumn("same", F.lit(1)), ["k"], ["same", "t"], rows_per_block=size).toPandas()
    assert len(placed) == 90 and all(sorted(g["pos"]) == list(range(30)) for _, g in placed.groupby("k", dropna=False))
    halves = o.group_quantiles(df, ["k"], "v", {"m": 0.5}, rows_per_block=size).toPandas()
    assert len(halves) == 3 and (halves["m"] == 1.5).all()
    frames, w = o.row_frames(df, ["k"], ["t"], 2, 1, block_rows=4, rows_per_block=size)
    assert o.core_rows(frames.withColumn("c", F.count("t").over(w.rowsBetween(-2, 1)))).groupBy("k").agg(F.sum("c").alias("c")).select("c").distinct().first()[0] == 30 * 4 - 4


def test_expand_counts(hot):
    df, pdf = hot
    steps = o.running_counts(df, ["route_code"], "x", rows_per_block=53)
    got = o.expand_counts(steps, chunk=7).toPandas().sort_values(["route_code", "pos"])
    assert (got["x"].to_numpy() == pdf.sort_values(["route_code", "x"])["x"].to_numpy()).all()
    assert (got.groupby("route_code").cumcount() == got["pos"]).all()


@pytest.mark.parametrize("size", [1_000_000, 97, 5])
def test_row_frames(hot, size):
    df, pdf = hot
    rows, w = o.row_frames(df, ["route_code"], ["ts", "id"], 5, 3, block_rows=40, rows_per_block=size)
    got = o.core_rows(rows.withColumn("m", F.avg("x").over(w.rowsBetween(-5, 3)))).toPandas().sort_values(["route_code", "ts", "id"])
    assert len(got) == len(pdf)
    for _, part in got.groupby("route_code"):
        x = part["x"].to_numpy()
        want = [x[max(0, i - 5) : i + 4].mean() for i in range(len(x))]
        assert np.allclose(part["m"], want)


def test_first_rows_and_salted_join(hot):
    df, pdf = hot
    got = o.first_rows(df, ["route_code", "x"], ["ts", "id"]).toPandas()
    want = pdf.sort_values(["ts", "id"]).drop_duplicates(["route_code", "x"])
    assert sorted(got["id"]) == sorted(want["id"])
    stats = df.groupBy("route_code").agg(F.count(F.lit(1)).alias("n"))
    joined = o.attach(df, stats, ["route_code"], salts=8)
    assert joined.count() == len(pdf) and "_salt" not in joined.columns


def test_short_groups_are_one_frame(spark):
    """Rows are copied to neighbouring blocks that exist only; NULL routes, repeated rows and none at all included."""
    rows = [(k, t // 2) for k in ("a", "b", None) for t in range(30)]
    df = spark.createDataFrame(rows, "k string, t int")
    frames, _ = o.row_frames(df, ["k"], ["t"], 20, 10, block_rows=100)
    assert frames.count() == 90 and frames.select("_frame").distinct().collect() == [(0,)]
    cut, _ = o.row_frames(df, ["k"], ["t"], 2, 1, block_rows=10)
    assert cut.count() == 90 + 3 * 2 * (2 + 1) and cut.agg(F.min("_frame"), F.max("_frame")).first() == (0, 2)
    empty, _ = o.row_frames(df.filter("t < 0"), ["k"], ["t"], 2, 1)
    assert empty.count() == 0
