"""Random numbers that Spark, numpy and SQL share, and resampling by them."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wayspan.functions import draws
from wayspan.operators import outliers, scoring


def test_engines_agree(spark):
    rows = [0, 1, 2, 10**6, (1 << 31) - 1, 1 << 31, 1 << 40, (1 << 63) - 1]
    df = spark.createDataFrame([(r,) for r in rows], "row long").withColumn("iter", F.explode(F.array(*map(F.lit, range(5)))))
    got = {(r.row, r.iter): (r.u, r.w) for r in df.select("row", "iter", draws.number(F.col("row"), 7, F.col("iter")).alias("u")).withColumn("w", draws.poisson_weight(F.col("u"))).collect()}
    u = draws.numbers(np.array(rows), np.arange(5), 7)
    given = pd.DataFrame([(r, i) for r in rows for i in range(5)], columns=["row", "iter"])  # noqa: F841 (read by DuckDB)
    sql = duckdb.sql(f"SELECT row, iter, u, {draws.poisson_sql('u')} AS w FROM {draws.numbers_sql('given', 'u', 'row', 7, 'iter')}").fetchall()
    want = {(r, i): (int(u[a, i]), int(draws.poisson_counts(u[a, i]))) for a, r in enumerate(rows) for i in range(5)}
    assert got == want == {(a, b): (c, d) for a, b, c, d in sql}
    assert 0 <= u.min() and u.max() < draws.TOP


@pytest.mark.parametrize("rows", [np.arange(8000), np.arange(8000) << 31, np.arange(8000) * 1000])
def test_weights_are_poisson_and_independent(rows):
    w = draws.poisson_counts(draws.numbers(rows, np.arange(200), 3))
    assert w.mean() == pytest.approx(1, abs=0.005) and w.var() == pytest.approx(1, abs=0.01)
    assert np.bincount(w.ravel())[:4] / w.size == pytest.approx([0.3679, 0.3679, 0.1839, 0.0613], abs=0.002)
    between = np.corrcoef(w.T) - np.eye(200)
    assert np.abs(between).max() * 8000**0.5 < 5.5
    trend = (w.T @ np.arange(8000.0)) / w.sum(0)
    assert trend.std() == pytest.approx(8000 / 12**0.5 / 8000**0.5, rel=0.2)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    return [(i, rng.choice(["a", "b", None]), int(rng.integers(0, 3)), None if rng.random() < 0.2 else float(rng.normal()), float(i % 7)) for i in range(400)]


def sums(df):
    return {(r.k, r.g, r.iter): (r.n, r.x_sum, r.x_n, r.y_sum, r.y_n) for r in df.collect()}


def test_sums_of_rounds(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, "id long, k string, g int, x double, y double").repartition(3)
    got = sums(outliers.poisson_sums(df, ["k", "g"], ["x", "y"], ["id"], 30, 5))
    w = draws.poisson_counts(draws.numbers(np.arange(400), np.arange(30), 5))
    want = {}
    for (i, k, g, x, y), own in zip(rows, w):
        for r in range(30):
            if own[r]:
                at = want.setdefault((k, g, r), [0.0] * 5)
                for c, v in enumerate((own[r], own[r] * (x or 0), own[r] * (x is not None), own[r] * y, own[r])):
                    at[c] += v
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v) for k, v in want.items())
    monkeypatch.setattr(outliers, "ROUND_SUMS", 10)
    listed = outliers.poisson_bootstrap(df, ["id"], 30, 5).groupBy("k", "g", "iter").agg(F.sum("weight").alias("n"))
    assert {(r.k, r.g, r.iter): r.n for r in listed.collect()} == {k: v[0] for k, v in got.items()}
    whole = outliers.poisson_sums(df, [], ["y"], ["id"], 30, 5).orderBy("iter").collect()
    assert [r.n for r in whole] == w.sum(0).tolist()
    assert outliers.poisson_sums(df.limit(0), ["k", "g"], ["x"], ["id"], 30, 5).count() == 0


def test_keys_other_than_integers(spark, rows):
    df = spark.createDataFrame(rows, "id long, k string, g int, x double, y double").withColumn("day", F.expr("date_add(DATE'2025-01-01', g)"))
    a = outliers.poisson_sums(df, ["day"], ["x"], ["k", "y", "g"], 10)
    b = outliers.poisson_sums(df.repartition(5), ["day"], ["x"], ["k", "y", "g"], 10)
    key = lambda d: {(r.day, r.iter): (r.n, pytest.approx(r.x_sum)) for r in d.collect()}
    assert key(a) == key(b) and a.count() == 30


def test_sample_is_the_same_however_laid_out(spark, rows):
    df = spark.createDataFrame(rows * 3, "id long, k string, g int, x double, y double")
    one = sorted(r.id for r in outliers.sample_fraction(df, 0.2, 1, ["id"]).collect())
    assert one == sorted(r.id for r in outliers.sample_fraction(df.repartition(4), 0.2, 1, ["id"]).collect())
    assert 0.1 < len(one) / 1200 < 0.3 and len(one) % 3 == 0
    assert outliers.sample_fraction(df, 0.5, 1).count() % 3 == 0


def test_intervals_equal_rows_times_rounds(spark):
    """The vectors give what a row for every weight gives."""
    rng = np.random.default_rng(3)
    rows = [(i, 2025, 10, 1 + i % 12, i % 24, f"R{rng.integers(0, 4)}", None if i % 50 == 0 else float(rng.normal(30, 5)), 10.0, 20.0 + float(rng.random())) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, year int, month int, day int, hour int, route_code string, avg_speed double, distance double, duration double")
    got = {r.route_code: tuple(r)[1:] for r in scoring.score_intervals(df, ["id"], n_bootstrap=40).collect()}
    w = draws.poisson_counts(draws.numbers(np.arange(600), np.arange(40), 0))
    pdf = pd.DataFrame(rows, columns=["id", "y", "m", "day", "h", "route", "speed", "distance", "duration"])
    points = {r: [] for r in got}
    for k in range(40):
        p = pdf.assign(w=w[:, k])
        p = p[(p.w > 0) & (p.day >= 2) & (p.day < 12)]
        total = dict.fromkeys(got, 0.0)
        for _, g in p.groupby("day"):
            x = g.speed if not g.speed.isna().any() else 60 * g.distance / g.duration
            mean = ((x * g.w).groupby(g.route).sum() / g.w.groupby(g.route).sum()).sort_index().sort_values(ascending=False, kind="stable")
            n = len(mean)
            for rank, r in enumerate(mean.index, 1):
                total[r] += 0.5 if n == 1 else n / 2 - (rank - 1) * n / (n - 1)
        for r in total:
            points[r].append(np.rint(total[r] * 10) / 10)
    for r, v in points.items():
        assert got[r] == pytest.approx((np.mean(v), np.quantile(v, 0.025), np.quantile(v, 0.975)))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_forest_model_is_not_copied_into_rows(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id * id AS DOUBLE) AS avg_speed")
    scored = outliers.isolation_scores(df, "avg_speed", ["id"])
    assert "_model" not in plan_of(scored) and scored.columns == ["id", "avg_speed", "isolation_score"]


def test_bootstrap_makes_no_row_for_a_draw(spark):
    n, rounds = 70_000, 9  # more than one block of positions and of rounds
    df = spark.range(n).selectExpr("id", "id % 7 AS v", "CASE WHEN id > 5 THEN 'x' END AS t")
    drawn = outliers.bootstrap(df, ["id"], n_iterations=rounds, seed=3)
    assert "MapInArrow" in plan_of(drawn) and drawn.columns == ["id", "v", "t", "iter", "weight"]
    high, low = (draws.numbers(np.arange(n), np.arange(rounds), s) for s in (3, 4))
    target = (high * n + ((low * n) >> draws.BITS)) >> draws.BITS
    got = drawn.toPandas()
    times = np.zeros((rounds, n), int)
    times[got["iter"], got["id"]] = got["weight"]
    assert len(got) == (times > 0).sum() and (got["v"] == got["id"] % 7).all() and (got["t"].isna() == (got["id"] <= 5)).all()
    assert all((times[r] == np.bincount(target[:, r], minlength=n)).all() for r in range(rounds))
    assert outliers.bootstrap(df.limit(0), ["id"], 3).count() == 0


def test_poisson_numbers_are_mixed_once(spark):
    """No number is worked out element by element or in a filter of its own; odd keys draw what they drew."""
    rows = [(None, "a", 1.0), (7, None, None), (7, None, None), (1 << 40, "b", 2.0), (-3, "a", 3.0)]
    df = spark.createDataFrame(rows, "id long, k string, x double")
    drawn = outliers.poisson_bootstrap(df, ["id"], 40, 5)
    plan = plan_of(drawn)
    assert "lambdafunction" not in plan and "Filter" not in plan
    assert dict(drawn.dtypes) == {"id": "bigint", "k": "string", "x": "double", "iter": "int", "weight": "int"}
    keys = np.array([0, 7, 7, 1 << 40, -3 & ((1 << 63) - 1)])
    w = draws.poisson_counts(draws.numbers(keys, np.arange(40), 5))
    want = sorted((str(r), i, int(w[a, i])) for a, r in enumerate(rows) for i in range(40) if w[a, i])
    assert sorted((str(tuple(r)[:3]), r.iter, r.weight) for r in drawn.collect()) == want
    for key in (["k"], ["k", "id"]):
        u = df.withColumn("iter", F.explode(F.sequence(F.lit(0), F.lit(39)))).withColumn("u", draws.number(draws.row_number(df, key), 5, F.col("iter")))
        other = u.withColumn("weight", draws.once(F.col("u"), draws.poisson_weight)).filter("weight > 0").drop("u")
        assert sorted(map(str, outliers.poisson_bootstrap(df, key, 40, 5).collect())) == sorted(map(str, other.collect()))
    assert outliers.poisson_bootstrap(df.filter("x > 9"), ["id"], 40, 5).count() == 0
