import math
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayspan.functions import columns as C
from wayspan.functions import normal, tails
from wayspan.functions.pluscode import locate, route_points


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_duration_phrases(spark):
    phrases = {"1 hr 5 min": 65, "2 hr": 120, "7 min": 7, "25 min": 25, "2 hrs": 2, "12": 12, "1.5": 1.5, "": None, "  ": None, "n/a": None, "x min": None, "hr 5 min": None}
    df = spark.createDataFrame([(k,) for k in phrases] + [(None,)], "s string")
    got = {r.s: r.m for r in df.select("s", C.duration_minutes("s").alias("m")).collect()}
    assert got == {**phrases, None: None}


def test_scalars(spark):
    row = one(spark, C.distance_km(F.lit("11.0 km")), C.distance_km(F.lit("11,0 km")), C.rain_flag(F.lit("No precipitation for 2 h")), C.rain_flag(F.lit("Rain")),
              C.clock_hour(F.lit("25:00")), C.clock_hour(F.lit("07:30")), C.speed_kmh(F.lit(10.0), F.lit(0.0)))
    assert list(row) == [11.0, None, "", "Rain", None, 7, None]
    assert [one(spark, C.hour_label(F.lit(h)))[0] for h in (0, 9, 12, 13)] == ["12 AM", "9 AM", "12 PM", "1 PM"]
    assert [one(spark, C.significance(F.lit(p)))[0] for p in (0.0005, 0.005, 0.03, 0.05)] == ["***", "**", "*", "ns"]
    assert one(spark, C.half_even(F.lit(0.25), 1), C.half_even(F.lit(0.35), 1))[0] == 0.2
    assert one(spark, C.maps_url(F.lit("A b/c"), F.lit("ü,d")))[0].endswith("origin=A%20b/c&destination=%C3%BC%2Cd&travelmode=driving")


def test_bands_cover_all_hours(spark):
    got = [r.b for r in spark.range(24).select(C.time_band(F.col("id")).alias("b")).collect()]
    assert got == ["late_night"] * 7 + ["morning"] * 2 + ["morning_rush"] * 3 + ["early_afternoon"] * 3 + ["late_afternoon"] * 4 + ["evening_rush"] * 3 + ["night"] * 2


def test_week_bucket_ends_on_sunday(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-03 05:00:00' AS a, timestamp_ntz'2024-03-04 00:00:00' AS b")
    row = df.select(C.bucket_start("a", "W").cast("string"), C.bucket_start("b", "W").cast("string")).first()
    assert list(row) == ["2024-03-03 00:00:00", "2024-03-10 00:00:00"]
    with pytest.raises(ValueError):
        C.bucket_start("a", "M")


def test_normal_distribution(spark):
    nd = NormalDist()
    df = spark.range(1, 2000).select((F.col("id") / 2000.0).alias("p"), ((F.col("id") - 1000) / 40.0).alias("x"))
    rows = normal.add_log_cdf(normal.add_cdf(normal.add_quantile(df, F.col("p"), "q"), F.col("x"), "c"), F.col("x"), "l").collect()
    assert max(abs(r.q - nd.inv_cdf(r.p)) for r in rows) < 1e-13
    assert max(abs(r.c - 0.5 * math.erfc(-r.x / math.sqrt(2))) for r in rows) < 1e-15
    assert max(abs(r.l - math.log(0.5 * math.erfc(-r.x / math.sqrt(2)))) for r in rows) < 1e-10
    far = normal.add_quantile(normal.add_log_cdf(spark.range(1), F.lit(-40.0), "l"), F.lit(0.0), "q").first()
    assert far.l == pytest.approx(-804.6084420137539, rel=1e-9) and far.q is None


def test_tails():
    assert tails.t_two_sided(2.228138852, 10) == pytest.approx(0.05, abs=1e-9)
    assert tails.f_upper(4.102821, 2, 10) == pytest.approx(0.05, abs=1e-6)
    assert tails.beta_inc(2, 3, 0.5) == pytest.approx(0.6875)
    assert tails.t_required(0.5, 0.05, 0.8) == pytest.approx(63.76561, abs=1e-4)  # published value
    assert tails.t_power(0.5, 64, 0.05) == pytest.approx(0.8014596, abs=1e-6)
    assert tails.correlation_pvalue(1.0, 5) == 0.0 and tails.correlation_pvalue(0.3, 2) == 1.0
    assert tails.adf_pvalue(-2.86) == pytest.approx(0.0502, abs=1e-3)


def test_shapiro_published_example():
    x = np.array(sorted([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236]), float)
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (len(x) + 0.25)) for i in range(1, len(x) + 1)])
    w, p = tails.shapiro_from_sums(len(x), (m * m).sum(), m[-1], m[-2], x[0], x[1], x[-2], x[-1], (m * x)[2:-2].sum(), ((x - x.mean()) ** 2).sum())
    assert w == pytest.approx(0.7888147, abs=1e-6) and p == pytest.approx(0.0067038, abs=1e-6)


def test_plus_codes(spark):
    df = spark.createDataFrame([("8FVC9G8F+6X",), ("9G8F+6X",), ("9G8F+6XQ",), ("CJ+2VX",), ("bad",), (None,)], "code string")
    rows = locate(df, "code", 47.4, 8.6, "p").collect()
    full = rows[0]
    assert (full.p_code, full.p_lat, full.p_lon) == ("8FVC9G8F+6X", pytest.approx(47.3655625), pytest.approx(8.5249375))
    assert rows[1].p_code == "8FVC9G8F+6X" and rows[2].p_code == "8FVC9G8F+6XQ"
    assert rows[4].p_code is None and rows[5].p_lat is None
    # the nearest cell may lie in the neighbouring degree
    near = locate(spark.createDataFrame([("9G8F+6X",)], "code string"), "code", 46.95, 8.1, "p").first()
    assert abs(near.p_lat - 46.95) <= 0.5 and abs(near.p_lon - 8.1) <= 0.5
    ends = route_points(spark.createDataFrame([("XJG4+7J|5PX4+HQ",)], "route_code string"), 12.9514242, 77.6590212).first()
    assert abs(ends.origin_lat - 12.95) < 0.5 and abs(ends.destination_lon - 77.66) < 0.5 and "," in ends.origin_point


def test_exact_mean(spark):
    rng = np.random.default_rng(5)
    groups = {
        0: list(rng.normal(50, 20, 500)), 1: [1e15 + 0.5, -1e15, 0.25], 2: [0.1] * 7, 3: [-0.1, -0.2, 1e-12], 4: [None, 2.5], 5: [None],
        6: [float("nan"), 1.0], 7: [float("inf"), 1.0], 8: [1e300, 1e300], 9: [2.0**52 + 1, 2.0**-40], 10: [-(2.0**52), 3.75],
    }
    rows = [(g, None if v is None else float(v)) for g, vs in groups.items() for v in vs]
    got = {r.g: r.m for r in spark.createDataFrame(rows, "g int, v double").groupBy("g").agg(C.exact_mean("v").alias("m")).collect()}
    for g, vs in groups.items():
        known = [v for v in vs if v is not None]
        want = math.fsum(known) / len(known) if known else None
        assert got[g] == want or (want != want and got[g] != got[g]), g
