"""Fingerprints, near and exact copies against brute force."""

import hashlib
import random
import struct
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from llm_helpers import DOCS, LOWER, words
from wayspan.llm import fingerprints, simhash_links, stream_dedup
from wayspan.llm.components import components
from wayspan.llm.queries import op6_document_fingerprints


def simhash(text, k):
    w = words(text, lower=True)
    shingles = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def group_numbers(rows, k=3):
    """For every row the number of the first row of its group, by all pairs."""
    prints = [simhash(r[1], k) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(rows))]


def expected_groups(rows, k=3):
    group, least = group_numbers(rows, k), {}
    for g, r in zip(group, rows):
        if r[0] is not None:
            least[g] = min(r[0], least.get(g, r[0]))
    return Counter((r[0], f"{simhash(r[1], k):016x}", least.get(g)) for g, r in zip(group, rows))


def test_near_groups(docs, rows):
    expected = expected_groups(rows)
    for large in (1000, 1):  # by pairs, and all by stars
        assert Counter(map(tuple, simhash_links.near_groups(docs, large=large).collect())) == expected


def test_star_links_equal_pair_links(spark):
    near = [(a ^ (1 << i) ^ (1 << j),) for a in (0, 12345) for i in range(0, 64, 9) for j in range(0, 63, 7)]
    near = [(x - (1 << 64) if x >= 1 << 63 else x,) for (x,) in {(v & (1 << 64) - 1,) for (v,) in near}]
    fps = spark.createDataFrame(near, "fp long")
    both = [dict(map(tuple, components(simhash_links.links(fps, n)).collect())) for n in (1000, 2)]
    assert both[0] == both[1] and len(both[0]) == len(near)


def test_components_of_a_path(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 7), (None, 3)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a int, b int")).collect()))
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_survivors(spark, docs, rows):
    """Of every group of the brute-force grouping the smallest id stays, once; different texts under
    one id are judged apart."""
    extra = [(700, rows[3][1], "en", "s0", 1), (700, "another text under the same id as the copy before it", "en", "s0", 1), (701, None, "x", None, 1), (300, "", "en", "s1", 0)]
    table = docs.select(DOCS.names).union(spark.createDataFrame(extra, DOCS)).withColumn("key", F.lit("k"))
    kept = simhash_links.survivors(table)
    assert kept.columns == table.columns
    every = [*rows, *extra]
    members = {}
    for r, g in zip(every, group_numbers(every)):
        members.setdefault(g, []).append(r)
    want = Counter()
    for group in members.values():
        ids = [r[0] for r in group if r[0] is not None]
        want[min(ids) if ids else None] += 1
    assert Counter(r.doc_id for r in kept.collect()) == want
    texts = [r.text for r in kept.collect() if r.doc_id == 700]
    assert texts == ["another text under the same id as the copy before it"]


def test_exact_classes(spark, docs, rows, tmp_path):
    path = docs.inputFiles()[0].rsplit("/", 1)[0]
    texts = Counter((r[1] or "").encode().translate(LOWER) for r in rows)
    largest = {}
    for r in rows:
        key = (r[1] or "").encode().translate(LOWER)
        largest[key] = max(largest.get(key, -1), -1 if r[0] is None else r[0])
    expected = Counter()
    for r in rows:
        key = (r[1] or "").encode().translate(LOWER)
        expected[(r[0], None if largest[key] < 0 else largest[key], texts[key], hashlib.sha256(key).hexdigest())] += 1
    for files in (None, 1):  # one batch, and one for each file
        found = stream_dedup.classes(spark, path, str(tmp_path / f"state{files}"), files_per_batch=files).collect()
        assert Counter((r["id"], r["keep_id"], r["group_size"], r["digest"].hex()) for r in found) == expected
        assert sum(r["kept"] for r in found) == len(texts)


def test_texts_with_one_digest_stay_apart(spark, docs, rows):
    path = docs.inputFiles()[0].rsplit("/", 1)[0]
    short = lambda body: stream_dedup.sha256(body).substr(1, 1)
    found = stream_dedup.classes(spark, path, digest=short).collect()
    assert sum(r["kept"] for r in found) == len({(r[1] or "").encode().translate(LOWER) for r in rows})
    assert len(found) == len(rows)


def test_state_is_kept_between_runs(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "state")
    spark.createDataFrame([(1, "A"), (2, "b")], "doc_id long, text string").write.parquet(path)
    assert stream_dedup.absorb(spark, path, state).count() == 2
    spark.createDataFrame([(3, "a")], "doc_id long, text string").write.mode("append").parquet(path)
    assert {(r["n"], r["id"]) for r in stream_dedup.absorb(spark, path, state).collect()} == {(2, 3), (1, 2)}


def test_exact_survivors(spark, docs, rows):
    kept = stream_dedup.survivors(spark, docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({(r[1] or "").encode().translate(LOWER) for r in rows})


def test_document_fingerprints(docs, rows):
    found = fingerprints.fingerprints(docs).collect()
    assert len(found) == len(rows)
    by_text = {}
    for r, text in sorted(((r, next(x[1] for x in rows if x[0] == r.doc_id)) for r in found if r.doc_id is not None), key=lambda x: x[0].doc_id):
        assert by_text.setdefault(text or "", r.fingerprint) == r.fingerprint
    assert by_text[""] == "0" * 32


def test_search_within_radius(spark):
    rng = random.Random(1)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    base = [rng.getrandbits(128) for _ in range(20)]
    prints = {b ^ sum(1 << i for i in rng.sample(range(128), rng.randint(0, 6))) for b in base for _ in range(10)}
    table = spark.createDataFrame([(signed(p >> 64), signed(p & (1 << 64) - 1)) for p in prints], "high long, low long")
    asked = sorted(prints)[::7]
    queries = spark.createDataFrame([(signed(p >> 64), signed(p & (1 << 64) - 1)) for p in asked], "high long, low long")
    for radius in (3, 5):
        assert fingerprints.within(queries, table, radius).count() == sum((a ^ b).bit_count() <= radius for a in asked for b in prints)


def test_next_document(spark):
    ids = [-9, -1, 0, 3, 4, 5, 40, 41, 700, 1 << 60, -(1 << 61), None]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    order = sorted((i for i in ids if i is not None), reverse=True) + [None]
    for block in (100, 4, 1):
        found = {r["id"]: r["next_text"] for r in fingerprints.with_next(df, rows_per_block=block).collect()}
        assert found == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}


def document_print(text):
    """The 128 bits by votes of word pairs."""
    w, votes, total = words(text), [0] * 128, 0
    for i in range(len(w)):
        pair = w[i : i + 2]
        weight = sum(len(x.decode()) for x in pair)
        h0 = h1 = 42
        for x in pair:
            h0 = xxhash.xxh64_intdigest(x, seed=h0)
        for x in pair[::-1]:
            h1 = xxhash.xxh64_intdigest(x, seed=h1)
        h1 = xxhash.xxh64_intdigest(struct.pack("<i", 7), seed=h1)
        total += weight
        for b in range(128):
            votes[b] += weight * ((h0 << 64 | h1) >> b & 1)
    return sum(1 << b for b in range(128) if 2 * votes[b] > total)


def test_document_fingerprints_whole_result(spark, docs, rows, tmp_path):
    extra = [(3, "another text under an id that is there", "en", "s0", 1), (3, rows[3][1], "en", "s0", 1), (None, "one more without id", None, None, 1), (50, "x", None, None, 1), (100, None, None, None, 1)]
    short = [r for r in rows if r[0] != 500]
    every = [*short, *extra]
    spark.createDataFrame(every, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = op6_document_fingerprints(spark, str(tmp_path)).collect()
    hashed = lambda t: xxhash.xxh64_intdigest((t or "").encode(), seed=42)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    order = sorted(every, key=lambda r: (-(1 << 62) if r[0] is None else r[0], signed(hashed(r[1]))))
    prints = [document_print(r[1]) for r in order]
    want = Counter()
    for k, r in enumerate(order):
        text, after = r[1] or "", order[k - 1][1] or ""
        moved = len(text) // 3
        edited = text[: len(text) - moved] + after[:moved]
        print_, near = document_print(edited), lambda a, b: 1 - (a ^ b).bit_count() / 128
        within = sum((prints[k] ^ p).bit_count() <= 3 for p in prints) if r[0] is not None and r[0] % 50 == 0 else None
        want[(r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{prints[k]:032x}", f"{print_:032x}", near(prints[k], print_), near(prints[k], prints[k - 1]), within)] += 1
    assert Counter(map(tuple, got)) == want


def test_empty_tables(spark, empty):
    assert simhash_links.near_groups(empty).count() == 0
    assert simhash_links.survivors(empty).count() == 0
    assert stream_dedup.survivors(spark, empty).count() == 0
    assert fingerprints.fingerprints(empty).count() == 0
