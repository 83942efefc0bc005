"""Language ID, mixing and the pipeline."""

import math

import numpy as np
import pytest

import corpus_pipeline
from oracle_check import DATA
from wayspan.llm import language_id, mixing
from wayspan.llm.queries import QUERIES
from wayspan.llm.textops import table

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def real(spark):
    return table(spark, SF, "documents")


def evidence(df):
    return df.selectExpr("*", "lang AS declared", "CAST(NULL AS STRING) AS suffix", "source AS host")


def test_held_out_accuracy(real):
    model = language_id.train(real.filter("doc_id % 2 = 0"), "doc_id", "text", "lang")
    silent = real.filter("doc_id % 2 = 1").selectExpr("*", "CAST(NULL AS STRING) AS declared", "CAST(NULL AS STRING) AS suffix", "CAST(NULL AS STRING) AS host")
    got = language_id.identify(silent, model).select("lang", "language", "accepted").toPandas()
    assert (got.lang == got.language).mean() > 0.97 and got.accepted.mean() > 0.97


def test_evidence_decides_short_texts(spark, real):
    model = language_id.train(real, "doc_id", "text", "lang")
    host = [(1000 + i, t.text, "fr", "x.fr.example") for i, t in enumerate(real.filter("lang = 'fr'").limit(40).collect())]
    unsure = [(1, "xq", None, "x.fr.example"), (2, "xq", "fr", None), (3, "12 34", None, None), (4, None, "fr", "x.fr.example"), (5, "%%% ### a", None, None), (None, "a", "de", "new.example")]
    rows = spark.createDataFrame(host + unsure, "doc_id long, text string, declared string, host string").selectExpr("*", "CAST(NULL AS STRING) AS suffix", "'q' AS language")
    got = {r.doc_id: (r.language, r.accepted) for r in language_id.identify(rows, model).collect()}
    assert got[1] == got[2] == ("fr", True)
    assert got[3] == got[4] == got[5] == ("und", False)
    assert len(got) == len(host) + len(unsure)


def brute_posterior(rows, languages):
    """Fusion of the text likelihoods with declared language, suffix and smoothed host priors, by loops."""
    n = len(languages)
    soft = lambda logs: [math.exp(x - max(logs)) / sum(math.exp(y - max(logs)) for y in logs) for x in logs]
    shares = [(r, soft(r._evidence)) for r in rows if r._letters >= language_id.MIN_SHARE]
    sums = lambda key: {v: [sum(s[k] for r, s in shares if key(r) == v) for k in range(n)] for v in {key(r) for r, _ in shares} - {None}}

    def likelihood(key):
        counted = sums(key)
        total = [sum(v[k] for v in counted.values()) for k in range(n)]
        return {v: [math.log((c[k] + 0.5) / (total[k] + 0.5 * (len(counted) + 1))) for k in range(n)] for v, c in counted.items()}

    declared, suffix, hosts = likelihood(lambda r: r.declared), likelihood(lambda r: r.suffix), sums(lambda r: r.host)
    domain = lambda h: ".".join(h.split(".")[-2:])
    whole = [sum(s[k] for _, s in shares) for k in range(n)]
    top = [(x + 1) / ((sum(whole) or 1) + n) for x in whole]
    S, prior = language_id.STRENGTH, {}
    for h, c in hosts.items():
        d = [sum(v[k] for g, v in hosts.items() if domain(g) == domain(h)) for k in range(n)]
        prior[h] = [math.log((c[k] + S * (d[k] + S * top[k]) / (sum(d) + S)) / (sum(c) + S)) for k in range(n)]
    out = {}
    for r in rows:
        parts = [r._evidence, declared.get(r.declared, [0.0] * n), suffix.get(r.suffix, [0.0] * n), prior.get(r.host, [math.log(p) for p in top])]
        p = soft([sum(x[k] for x in parts) for k in range(n)])
        sure = r._letters >= language_id.MIN_SHARE and max(p) >= language_id.MIN_POSTERIOR
        out[r.key] = (languages[p.index(max(p))] if sure else "und", max(p), sure)
    return out


def test_fused_posterior(spark, real):
    model = language_id.train(real, "doc_id", "text", "lang")
    texts = [r.text for r in real.limit(60).collect()]
    rows = [(i, texts[i % 60][: 5 + i % 40], ["en", "fr", None, "xx"][i % 4], ["com", "de/fr", None][i % 3], [f"h{i % 5}.a.example", f"h{i % 7}.b.org", "plain", None][i % 4]) for i in range(200)]
    rows += [(300, None, "en", "com", "h1.a.example"), (301, "12 34 !", "fr", None, None), (302, "", None, None, None), (303, "zq", "fr", "de/fr", "new.a.example")]
    df = spark.createDataFrame(rows, "key long, text string, declared string, suffix string, host string")
    got = {r.key: (r.language, r.posterior, r.accepted) for r in language_id.identify(df, model).collect()}
    want = brute_posterior(language_id.text_evidence(df, model).collect(), model.languages)
    assert got.keys() == want.keys()
    for key, (language, posterior, accepted) in want.items():
        assert got[key][1] == pytest.approx(posterior, rel=1e-6) and (got[key][0], got[key][2]) == (language, accepted), key


def test_page_evidence(spark):
    pages = [(1, "https://News.Site.example.fr/de/x?y=1", '<HTML class="a" lang=FR-ca><script>var a="<p>no</p>"</script><p>un&amp;deux<!-- no --></p>'), (2, "ftp:bad", "<p>x"), (3, None, None), (4, "http://a.org/about/de/", "plain")]
    got = {r.page_id: (r.text.split(), r.declared, r.host, r.suffix) for r in language_id.page_evidence(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: (["un", "deux"], "fr", "news.site.example.fr", "fr/de"), 2: (["x"], None, None, ""), 3: ([], None, None, ""), 4: (["plain"], None, "a.org", "org")}


def test_columns_with_clashing_names(real):
    model = language_id.train(real, "doc_id", "text", "lang")
    plain = evidence(real.limit(40))
    clash = plain.selectExpr("*", "1 AS evidence", "2 AS letters", "'x' AS share", "'y' AS language", "3 AS posterior", "'z' AS accepted")
    key = lambda df: {r.doc_id: (r.language, round(r.posterior, 9), r.accepted) for r in df.collect()}
    got = language_id.identify(clash, model)
    assert {"evidence", "letters", "share"} <= set(got.columns) and key(got) == key(language_id.identify(plain, model))


def test_empty_and_unlabelled(spark, docs, empty):
    blank = language_id.train(empty, "doc_id", "text", "lang")
    assert blank.languages == []
    assert language_id.identify(evidence(docs), blank).filter("accepted").count() == 0
    assert language_id.identify(evidence(empty), language_id.train(docs, "doc_id", "text", "lang")).count() == 0


def brute_rake(cells, goals, sweeps=200):
    w = cells.copy()
    for _ in range(sweeps):
        for axis, goal in enumerate(goals):
            held = w.sum(axis=tuple(a for a in range(w.ndim) if a != axis))
            shape = [1] * w.ndim
            shape[axis] = -1
            w = w * np.where(held > 0, goal / np.where(held > 0, held, 1), 0).reshape(shape)
    return w


def test_rake_meets_targets(spark):
    rng = np.random.default_rng(2)
    cells = rng.integers(1, 500, (3, 4, 2)).astype(float)
    goals = [np.array(g) / np.sum(g) for g in ([1, 1, 2], [4, 3, 2, 1], [1, 3])]
    rows = [(None if i == 2 else f"s{i}", f"l{j}", f"t{k}", int(cells[i, j, k])) for i in range(3) for j in range(4) for k in range(2)]
    df = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    names = [("source", ["s0", "s1", None]), ("lang", ["l0", "l1", "l2", "l3"]), ("topic", ["t0", "t1"])]
    targets = {d: spark.createDataFrame(list(zip(v, g.tolist())), f"{d} string, share double") for (d, v), g in zip(names, goals)}
    got = {(r.source, r.lang, r.topic): r.weight for r in mixing.rake(df, targets, close=1e-10).collect()}
    want = brute_rake(cells, goals)
    for i, s in enumerate(names[0][1]):
        for j in range(4):
            for k in range(2):
                assert got[(s, f"l{j}", f"t{k}")] == pytest.approx(want[i, j, k], abs=1e-7)


def test_mix(docs, empty, rows):
    shaped = lambda d: d.withColumns({"topic": mixing.register(d.text), "tokens": mixing.token_count(d.text)})
    got = mixing.mix(shaped(docs)).toPandas()
    assert len(got) == len(rows) and got.probability.between(0, 1).all() and got.probability.max() == 1
    assert not got.sampled[got.tokens == 0].any()
    assert (mixing.mix(shaped(docs)).toPandas().sampled.sum()) == got.sampled.sum()
    assert mixing.mix(shaped(empty)).count() == 0


def test_pipeline(spark, real):
    docs, counts = real, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == real.columns, name
        out = out.cache()
        counts.append(out.count())
        assert out.join(docs, "doc_id", "left_anti").count() == 0
        docs = out
    texts = real.toPandas().text.str.lower()
    assert counts[0] == real.count() and counts[1] == texts.nunique()
    assert counts[1] >= counts[2] > counts[3] > 0
    got = corpus_pipeline.run(spark, SF)
    assert got.count() == counts[3] and got.filter("round_trip").count() == counts[3]


def test_registered_names():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
