"""Outlier variants as sums over bands, against a filter for each threshold."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wayspan.operators import ordering, scoring


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    out = []
    for i in range(900):
        route = f"R{rng.integers(0, 6)}"
        speed = float(rng.normal(30 + 3 * int(route[1]), 6) + (60 if rng.random() < 0.02 else 0))
        out.append((2025, 10, 1 + i % 14, int(rng.integers(0, 24)), route, None if i % 90 == 0 else speed, 10.0, 15.0 + float(rng.random())))
    out += [(2025, 10, 13, 5, "FAR", 200.0, 10.0, 3.0), (2025, 10, 20, 5, "R1", 190.0, 10.0, 3.0)]  # a route and a last day that go
    return pd.DataFrame(out, columns=["year", "month", "day", "hour", "route_code", "avg_speed", "distance", "duration"])


def readings(spark, pdf):
    return spark.createDataFrame(pdf).withColumn("avg_speed", F.when(~F.isnan("avg_speed"), F.col("avg_speed")))


def kept(pdf, limit):
    z = ((pdf.avg_speed - pdf.avg_speed.mean()) / pdf.avg_speed.std()).abs()
    return pdf if limit is None else pdf[~(z > limit)]


def rolling(pdf, days=10):
    last, points = pdf.day.max(), {r: 0.0 for r in pdf.route_code.unique()}
    for day, g in pdf.groupby("day"):
        x = 60 * g.distance / g.duration if g.avg_speed.isna().any() else g.avg_speed
        if 1 <= last - day <= days:
            mean = x.groupby(g.route_code).mean().sort_values(ascending=False, kind="stable")
            n = len(mean)
            for k, r in enumerate(mean.index):
                points[r] += 0.5 if n == 1 else n / 2 - k * n / (n - 1)
    return {r: np.rint(p * 10) / 10 for r, p in points.items()}


def test_scores_of_variants(spark, rows):
    df = readings(spark, rows).repartition(3)
    got = {}
    for r in scoring._variant_scores(df, [3.0, 2.0, 2.5], 10).collect():
        got.setdefault((r.variant, r.method), {})[r.route_code] = r.score
    for name, limit in (("z2", 2.0), ("z2.5", 2.5), ("z3", 3.0), ("all", None)):
        part = kept(rows, limit)
        assert got[name, "rolling"] == pytest.approx(rolling(part))
        means, medians = part.groupby("route_code").avg_speed.mean().dropna(), part.groupby("route_code").avg_speed.median().dropna()
        assert got[name, "percentile"] == got[name, "zscore"] == pytest.approx(means.to_dict())
        assert got[name, "median"] == pytest.approx(medians.to_dict())
    assert "FAR" in got["all", "rolling"] and "FAR" not in got["z3", "rolling"]


def test_outlier_sensitivity(spark, rows):
    df = readings(spark, rows)
    base, part = rolling(rows), kept(rows, 3.0)
    filtered = rolling(part)
    got = {r.route_code: (r.baseline_points, r.filtered_points) for r in scoring.outlier_scores(df).collect()}
    assert got == {r: (pytest.approx(p), pytest.approx(filtered[r]) if r in filtered else None) for r, p in base.items()}
    r = scoring.outlier_sensitivity(df).first()
    both = pd.DataFrame({"a": base, "b": filtered}).dropna().rank()
    assert r.n_outliers_removed == len(rows) - len(part) > 5
    assert r.rank_correlation == pytest.approx(both.a.corr(both.b))


@pytest.mark.parametrize("block", [1_000_000, 3])
def test_weighted_quantiles(spark, block):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 60), "x": rng.integers(0, 40, 60).astype(float), "u": rng.integers(0, 4, 60), "v": rng.integers(0, 2, 60)})
    pdf = pdf.groupby(["g", "x"], as_index=False).sum().assign(none=0)
    got = ordering.weighted_quantiles(spark.createDataFrame(pdf), ["g"], "x", ["u", "v", "none"], 0.3, rows_per_block=block).toPandas().set_index("g")
    for g, part in pdf.groupby("g"):
        for w in ("u", "v"):
            assert got.loc[g, w] == pytest.approx(np.quantile(np.repeat(part.x, part[w]), 0.3))
    assert got["none"].isna().all()
