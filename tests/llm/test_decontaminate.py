"""Benchmark passages in texts against brute force."""

import random
import re
from collections import Counter

from llm_helpers import DOCS, LOWER
from wayspan.llm import decontaminate, wordhash

ITEMS = "item_id long, text string"


def item_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().translate(LOWER))


def brute(rows, items, width=10):
    windows = {}
    for key, text in items:
        w = item_words(text)
        n = min(len(w), width)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(key)
    out = Counter()
    for r in rows:
        w, hit, ids = item_words(r[1]), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    ids |= found
        out[(r[0], len(w), frozenset(hit), tuple(sorted(str(x) for x in ids if x is not None)))] += 1
    return out


def found(df):
    return Counter((r.doc_id, r.n_words, frozenset(i for s in r.spans for i in range(s.start, s.end)), tuple(r["items"])) for r in df.collect())


def planted(rows, seed=3):
    """Items cut from the rows, items that share a template, short ones, repeats, blanks and nulls."""
    rng = random.Random(seed)
    texts = [r[1] for r in rows if r[1] and len(r[1].split()) > 40]
    items = []
    for i in range(20):
        w = rng.choice(texts).split()
        at = rng.randrange(len(w) - 30)
        items.append((i, "QUESTION: " * (i % 2) + ", ".join(w[at : at + rng.randint(8, 30)]).upper().replace("É", "é").replace("Ñ", "ñ") + "?"))
    template = "the following is a question about things that many know well so choose one of"
    items += [(30 + i, f"{template} x{i} y{i}") for i in range(5)]
    items += [(50, "one"), (51, "a a"), (52, "a-a.a"), (53, None), (54, ""), (55, "?!"), (None, items[3][1]), (56, items[4][1]), (4, items[4][1]), (4, items[4][1])]
    more = [(900 + i, f"zz {template} {'x1 y1' if i % 2 else 'zz'} a_a", "en", "s0", 1) for i in range(8)] + [(950, f"{template} {template}", None, None, 1)]
    return items, more


def test_passages(spark, docs, rows):
    items, more = planted(rows)
    table = docs.select(DOCS.names).union(spark.createDataFrame(more, DOCS)).selectExpr("*", "1 AS row", "'x' AS print", "2 AS n_words", "'y' AS items", "3 AS windows")
    bench = spark.createDataFrame(items, ITEMS).selectExpr("*", "'z' AS id", "4 AS size")
    for width in (10, 4):
        got = found(decontaminate.passages(table, bench, width))
        want = brute([*rows, *more], items, width)
        assert got == want
        assert sum(n for (_, _, hit, _), n in want.items() if hit) > 20


def test_passages_over_small_blocks(spark, rows, monkeypatch):
    """Windows that lie across two blocks of words are found too."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(wordhash, "WORDS_AT_ONCE", 16)
    texts = [r[1] or "" for r in rows[:40]]
    for start, end, raw, limits in wordhash.text_chunks(pa.array(texts), 2000):
        raw = wordhash.lowered(raw)
        begins, ends, before = wordhash.word_limits(raw, limits, decontaminate.OUTSIDE)
        hashes = wordhash.word_hashes(raw, begins, ends, (decontaminate.BASE,))[0]
        assert [raw[a:b].tobytes() for a, b in zip(begins, ends)] == [w for t in texts[start:end] for w in item_words(t)]
        for size in (10, 3, 1):
            covered = np.zeros(len(hashes), int)
            for first, count, _ in decontaminate._prints(hashes, before, size):
                for f, c in zip(first, count):
                    covered[f : f + c] += 1
                body = wordhash.joined(raw, begins, ends, first, count + size - 1).to_pylist()
                assert body == [b" ".join(raw[a:b].tobytes() for a, b in zip(begins[f : f + c + size - 1], ends[f : f + c + size - 1])).decode() for f, c in zip(first, count)]
            want = np.zeros(len(hashes), int)
            for a, b in zip(before, before[1:]):
                want[a : max(a, b - size + 1)] = 1
            assert (covered == want).all()


def test_equal_windows_keep_one_fingerprint(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    words = rng.integers(0, 6, 4000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    seen = {}
    for first, count, mark in decontaminate._prints(words, np.array([0, 1500, 4000]), 4):
        for f, c, m in zip(first, count, mark):
            for i in range(f, f + c):
                assert seen.setdefault(tuple(words[i : i + 4].tolist()), m) == m
    assert len(seen) > 1000


def test_empty_tables(spark, docs, empty, rows):
    bench = spark.createDataFrame([], ITEMS)
    got = found(decontaminate.passages(docs, bench))
    assert sum(got.values()) == len(rows) and not any(hit or ids for _, _, hit, ids in got)
    assert decontaminate.passages(empty, spark.createDataFrame([(1, "some words")], ITEMS)).count() == 0
    assert decontaminate.passages(empty, bench).count() == 0
