"""Hard negatives against all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm_helpers import DOCS  # noqa: F401
from wayspan.llm import hard_negatives as hn

VECS = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=5, share=(80, 100)):
    kept = []
    for i, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(c))) for c in x], label))
    inner = lambda a, b: sum(p * q for p, q in zip(a, b))
    key = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = Counter()
    for k, (i, x, label) in enumerate(kept):
        if i is None or i % 100:
            continue
        other = [(inner(x, y), j, m) for n, (j, y, m) in enumerate(kept) if n != k]
        for ps, j, _ in sorted((s for s in other if s[2] == label), key=key)[:positives]:
            window = sorted((s for s in other if s[2] != label and share[0] * ps <= share[1] * s[0] <= share[1] * ps), key=key)[:negatives]
            out.update((i, j, rank, n, ps, s) for rank, (s, n, _) in enumerate(window, 1))
    return out


def clusters(n, dims=12, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dims))
    return [(int(i * 5), (centres[i % 8] * rng.choice([0.5, 1, 2]) + rng.normal(size=dims) * 0.2).tolist(), int(rng.integers(0, 4))) for i in range(n)]


def found(df):
    return Counter(tuple(r) for r in df.collect())


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, VECS).repartition(3).selectExpr("*", "1 AS row", "'x' AS id", "2 AS leaf", "3 AS anchor", "4 AS score")
    from pyspark.sql import functions as F

    return found(hn.mine(df, F.col("vec_id") % 100 == 0, **more))


def test_clusters(spark, monkeypatch):
    rows = clusters(900)
    want = brute(rows)
    assert run(spark, rows) == want and len(want) > 100
    # a deep tree over a small sample, and many chunks and blocks
    for name, value in (("SAMPLE", 120), ("LEAF", 8), ("FAN", 4), ("CHUNK", 20), ("BLOCK", 10), ("CELLS", 64)):
        monkeypatch.setattr(hn, name, value)
    assert run(spark, rows) == want


def test_odd_rows(spark):
    rows = clusters(150) + [(1000, None, 1), (1100, [1.0] * 12, None), (1200, [float("nan")] + [1.0] * 11, 1), (1300, [None] + [1.0] * 11, 1), (1400, [float("inf")] * 12, 2)]
    rows += [(1500, [0.0] * 12, 1), (1600, [], 2), (1700, [1.0, 2.0], 3), (None, [0.5] * 12, 1), (None, [0.5] * 12, 2)]
    rows += [(2000, [0.25] * 12, 1)] * 3 + [(2001 + i, [0.25] * 12, i % 3) for i in range(30)]  # equal rows, ties
    rows += [(3000, [-0.5] * 12, 3), (3100, [1e4] * 12, 1), (3101, [1e4] * 11 + [9e3], 2)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, positives=2, negatives=3, share=(50, 100)) == brute(rows, 2, 3, (50, 100))


def test_few_rows(spark):
    assert run(spark, []) == Counter()
    assert run(spark, [(0, [1.0], 1)]) == Counter()
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [0.9, 1.0], 2), (3, [0.1, 0.1], 2), (100, [None, 1.0], 1)]
    assert run(spark, rows) == brute(rows) == Counter({(0, 1, 1, 2, 131072, 124416): 1})


def test_scores_are_exact():
    rng = np.random.default_rng(1)
    for size in (100, 1e7, 3e8):
        a, b = (np.floor(rng.normal(size=(n, 9)) * size) for n in (4, 5))
        want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        assert hn.scores(a, b).tolist() == want


@pytest.mark.parametrize("equal", [False, True])
def test_eliminated_leaves_hold_no_match(equal):
    """Recall of the index is 1: no row of a window lies in a leaf that its anchor does not reach; and
    some leaves are eliminated."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16)) * 300
    x = np.floor(centres[rng.integers(0, 20, 3000)] + rng.normal(size=(3000, 16)) * 20)
    if equal:
        x[::3] = x[0]
    tree = hn.Tree(np.arange(1000), np.arange(1000), np.zeros(1000, int), x[:1000], float((x * x).sum(1).max()), 3000)
    leaf = np.zeros(3000, int)
    for n, _, away, near in tree.walk(x, leaf):
        for k in np.unique(near):
            tree.nodes[n].low[:, k], tree.nodes[n].high[:, k] = away[near == k].min(0), away[near == k].max(0)
    asked = x[rng.choice(3000, 50)]
    value = hn.scores(asked, x)
    high = np.sort(value, axis=1)[:, -10].astype(float)
    low = np.ceil(0.95 * high)
    reached = tree.reached(asked, low, high)
    inside = (value >= low[:, None]) & (value <= high[:, None])
    assert inside.any() and not (inside & ~reached[:, leaf]).any()
    assert tree.leaves > 20 and reached.mean() < 0.6


def test_many_random_windows(spark):
    rng = random.Random(2)
    rows = [(i * 4, [rng.choice([-0.5, 0.25, 1.0]) for _ in range(4)], rng.randint(0, 2)) for i in range(400)]
    assert run(spark, rows) == brute(rows)


def test_no_vectors_are_broadcast(spark, monkeypatch):
    """Files of repeated vectors are small beside their rows, so joins must not pick them by file size."""
    plans, rows = [], clusters(600)
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    stored = hn.store

    def store(df, name):
        df.collect()
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(hn, "store", store)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    try:
        assert run(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert [name for name, _ in plans].count("matches") == 2
    depth = lambda line: len(line) - len(line.lstrip(" :|+-"))
    for name, plan in plans:
        lines = plan.splitlines()
        for k, line in enumerate(lines):
            if "BroadcastExchange" in line:
                below = next((n for n in range(k + 1, len(lines)) if depth(lines[n]) <= depth(line)), len(lines))
                assert not any("vector#" in x for x in lines[k:below]), f"{name}: {line.strip()}"


@pytest.mark.parametrize("share", [None, (80, 100)])
def test_few_vectors_are_sent_to_leaves_at_once(monkeypatch, share):
    """A batch of anchors goes out in pieces, and scores are held for few of their windows at once."""
    rng, held = np.random.default_rng(8), []
    x = np.floor(rng.normal(size=(400, 6)) * 200)
    tree = hn.Tree(np.arange(400), np.arange(400), np.arange(400) % 3, x, float((x * x).sum(1).max()), 400_000)
    for node in tree.nodes:
        node.low[:], node.high[:] = 0, np.inf
    bounds = hn._bounds
    monkeypatch.setattr(hn, "_bounds", lambda known, *a: held.append(known.size) or bounds(known, *a))
    batch = pa.record_batch([pa.array(range(400, 450)), pa.array([k % 3 for k in range(50)]), pa.array(x[:50].tolist()), pa.array([[{"score": k + n} for n in range(5)] for k in range(50)])], names=["row", "label", "vector", "positives"])
    shared = type("Shared", (), {"value": tree})

    def sent():
        out = list(hn._reach(shared, 6, 5, share)([batch]))
        return sorted(zip(*[sum((b[c].to_pylist() for b in out), []) for c in ("leaf", "row")])), max(b.num_rows for b in out)

    whole, _ = sent()
    held.clear()
    monkeypatch.setattr(hn, "CELLS", 5 * 400)
    pieces, most = sent()
    assert pieces == whole and tree.leaves > 20
    assert most <= 5 * 400 // 6 and max(held) <= 5 * 400
