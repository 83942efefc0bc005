"""Phrase collocations against brute force."""

import random
import re
from collections import Counter

import pytest

from llm_helpers import DOCS, LOWER
from wayspan.llm import collocations, wordhash


def pieces(text):
    for piece in re.split(rb"[.,;:!?\n-\r]", (text or "").encode().translate(LOWER)):
        yield re.findall(rb"[^ \t]+", piece)


def brute(rows, least, longest=4, top=2000):
    f, totals = Counter(), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        for w in pieces(r[1]):
            totals[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cands = {p: n for p, n in f.items() if len(p) > 2 and n >= least}
    most = Counter()
    for (lang, *w), n in cands.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                sub = (lang, *w[i : i + k])
                most[sub] = max(most[sub], n)
    out = {}
    for p, a in cands.items():
        if 100 * most[p] >= 80 * a and most[p]:
            continue
        score, _, l, r = min((2_000_000 * a // (f[p[: k + 1]] + f[(p[0], *p[k + 1 :])]), k, f[p[: k + 1]], f[(p[0], *p[k + 1 :])]) for k in range(1, len(p) - 1))
        out.setdefault(p[0], []).append((-score, -a, b" ".join(p[1:]), l, r))
    want = set()
    for lang, found in out.items():
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            want.add((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return want


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    vocab = ["The", "é", "a", "b\x01", "b", "\x1cx", "漢", "on", "in", "of", *[f"w{i}" for i in range(40)]]
    idiom = ["once upon a time", "in spite of the", "the the the the the", "of course"]
    rows = []
    for i in range(150):
        out = []
        for _ in range(rng.randint(0, 60)):
            out.append(rng.choice(idiom) if rng.random() < 0.2 else rng.choice(vocab[: rng.choice([6, 50])]))
            out.append(rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " ? "]))
        rows.append((i, "".join(out), rng.choice(["en", "en", "fr", None, ""]), "s", 1))
    return rows + [(200, None, "en", None, None), (201, "", None, None, None), (202, "., \n", "de", None, None), (None, None, None, None, None)] + rows[:3]


def found(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("budget,bits,top", [(500_000, 26, 2000), (20, 26, 2000), (60, 8, 15)])
def test_collocations(spark, texts, budget, bits, top):
    df = spark.createDataFrame(texts, DOCS).repartition(3).selectExpr("*", "1 AS n", "'x' AS phrase", "2 AS f", "3 AS words")
    got = collocations.collocations(df, least=5, top=top, budget=budget, filter_bits=bits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(texts, 5, top=top)
    assert found(got) == want and len(want) > 30


def test_corpus_with_long_text(docs, rows, monkeypatch):
    assert found(collocations.collocations(docs, least=4)) == brute(rows, 4)


def test_longer_phrases(spark, texts):
    df = spark.createDataFrame(texts, DOCS)
    assert found(collocations.collocations(df, least=5, longest=6, budget=50)) == brute(texts, 5, longest=6)


def test_small_chunks(texts):
    """Words, pieces and rows of chunks hold together."""
    import pyarrow as pa

    batch = pa.record_batch([pa.array([r[2] or "und" for r in texts]), pa.array([r[1] or "" for r in texts])], names=["lang", "text"])
    want = Counter((r[2] or "und", w) for r in texts for p in pieces(r[1]) for w in p)
    size = wordhash.CHUNK
    for chunk in (300, size):
        wordhash.CHUNK = chunk
        got = Counter()
        for out in collocations._words(iter([batch.slice(2, 100), batch.slice(102), batch.slice(0, 2)])):
            for lang, phrase, n in zip(out["lang"].to_pylist(), out["phrase"].to_pylist(), out["n"].to_pylist()):
                got[lang, phrase.encode()] += n
        assert got == want
    wordhash.CHUNK = size


def test_empty(empty):
    assert collocations.collocations(empty).count() == 0


def test_scores_pass_64_bits(spark):
    big = 6 * 10**17
    rows = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, 3 * big), ("en", "a b", 2, big)], "lang string, phrase string, words int, f long")
    r = collocations._scored(rows).first()
    assert r.score == 2_000_000 * big // (4 * big)
