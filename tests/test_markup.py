"""Elements and scopes of pages against a tree built with the standard library."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from wayspan.operators import markup, stations
from wayspan.operators.markup import Step


class Tree(HTMLParser):
    """Nodes as [tag, classes, id, parent, parts]; for pages whose tags are balanced."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.nodes, self.open = [], []
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        self.nodes.append([tag, (a.get("class") or "").split(), a.get("id") or "", self.open[-1] if self.open else None, []])
        if tag not in markup.VOID:
            self.open.append(len(self.nodes) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in markup.VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        if self.open and self.nodes[self.open[-1]][0] == tag:
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.nodes[self.open[-1]][0] not in ("script", "style"):
            for n in self.open:
                self.nodes[n][4].append(data.strip())

    def find(self, *steps):
        found = None
        for step in steps:
            out = []
            for n, (tag, classes, key, parent, _) in enumerate(self.nodes):
                if tag in ("script", "style") or not ((not step.tag or step.tag == tag) and set(step.classes) <= set(classes) and (not step.id or step.id == key)):
                    continue
                above = []
                while parent is not None:
                    above.append(parent)
                    parent = self.nodes[parent][3]
                if found is None or set(above[:1] if step.child else above) & set(found):
                    out.append(n)
            found = out
        return ["".join(self.nodes[n][4]) for n in found]


STEPS = [
    (Step("div"),), (Step(classes=("a",)),), (Step(classes=("a", "b")), Step("p")), (Step(id="x"), Step(child=True)),
    (Step(classes=("a",)), Step("div", child=True), Step("div", child=True)), (Step("ul"), Step("li"), Step("ul"), Step("li")), (Step("br"),), (Step("section"), Step(classes=("b",))),
]


def page(rng, depth=0):
    out = []
    for _ in range(rng.randint(0, 4)):
        tag = rng.choice(["div", "DIV", "p", "ul", "li", "section", "b"])
        attrs = rng.choice(["", ' class="a"', " class='b  a'", ' class=b', ' id="x" class="a"', ' data-class="a" title="a > b"', '\n class="A"'])
        kind = rng.random()
        if kind < 0.15:
            out.append(rng.choice(["<br>", "<br/>", '<img class="a" src=x>', "<!-- <div class='a'>no</div> -->", "<script>if (a < b) '<div class=a>'</script>", "<style>p > b {}</style>", "<div class=a/>"[:0]]))
        elif kind < 0.75 and depth < 5:
            out.append(f"<{tag}{attrs}>{page(rng, depth + 1)}</{tag.lower()} >")
        else:
            out.append(rng.choice([" text ", "one &amp; two", "&#65;&#x42;", " \n ", "5 &lt; 6", "é &nbsp;", "a&b &unknown; &"]))
    return "".join(out)


def test_elements_and_scopes(spark):
    rng = random.Random(4)
    pages = [f"<!DOCTYPE html><html><body>{page(rng)}{page(rng)}</body></html>" for _ in range(120)]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "k int, html string").repartition(3)
    parsed = markup.elements(df, "html", ["k"])
    texts = [F.transform(markup.matching(F.col("nodes"), *s), lambda n: markup.node_text(F.col("texts"), n)).alias(f"s{i}") for i, s in enumerate(STEPS)]
    got = {r.k: r for r in parsed.select("k", *texts).collect()}
    found = 0
    for k, h in enumerate(pages):
        tree = Tree(h)
        for i, s in enumerate(STEPS):
            want = tree.find(*s)
            assert got[k][f"s{i}"] == want, (h, s)
            found += len(want)
    assert found > 300


def test_stray_tags(spark):
    """Tags without a partner hold nothing and move no scope."""
    html = '</div></p><div class="a"><p>one<p>two</p></b><i>three</div><div class="b">four</div></section><div class="a">five'
    parsed = markup.elements(spark.createDataFrame([(html,)], "html string"), "html", [])
    text = lambda *s: F.transform(markup.matching(F.col("nodes"), *s), lambda n: markup.node_text(F.col("texts"), n))
    r = parsed.select(text(Step(classes=("a",))), text(Step(classes=("a",)), Step("p")), text(Step(classes=("b",))), text(Step(classes=("a",)), Step(classes=("b",)))).first()
    assert list(map(list, r)) == [["onetwothree", ""], ["", "two"], ["four"], []]


def test_no_page(spark):
    parsed = markup.elements(spark.createDataFrame([(1, None), (2, ""), (2, "just text")], "k int, html string"), "html", ["k"]).orderBy("k").collect()
    assert [(r.k, r.nodes, [t.text for t in r.texts]) for r in parsed][0] == (1, [], [])
    assert sorted([t.text for t in r.texts] for r in parsed[1:]) == [[], ["just text"]]


def test_unescape(spark):
    texts = ["&#65;&#x1F600;b &amp;amp; &nope; &#xD800; &#99999999; &", "&deg;C &quot;x&quot;", "plain", None, "&#0;"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(markup.unescape(F.col("t"))).collect()]
    assert got == ["A\U0001F600b &amp; &nope; &#xD800; &#99999999; &", '°C "x"', "plain", None, "&#0;"]


def test_repeated_and_missing_pages(spark):
    html = '<div id="current"><p class="category-text"> &nbsp; </p><div class="aq-number">n/a</div></div>'
    rows = [("a/1", None, None, html), ("a/1", None, None, html), (None, "", "", ""), ("b/2", None, None, None)]
    got = stations.weather_fields(spark.createDataFrame(rows, "station string, minute_html string, current_html string, aqi_html string"))
    assert got.columns == ["station", "temp", "temp_flag", "realfeel", "realfeel_flag", "humidity", "rsi_flag", "rsi_forecast", "aqi", "aqi_flag"]
    assert sorted(map(str, (r.station for r in got.collect()))) == ["None", "a/1", "a/1", "b/2"]
    assert all(v is None for r in got.collect() for v in r[1:])


def test_pages_travel_whole(spark):
    """One row a page is exchanged, not one a token; places count the tokens that are left out, and pages of nothing
    else, of no text and repeated pages are what they were."""
    pages = [(1, "<!-- a --><p>x<script>var a = '<p>';</script> <b>y</b></p>"), (1, "<!-- a --><p>x</p>"), (1, "<!-- a --><p>x</p>"), (None, "<br>"), (2, "<!-- only --> \n"), (3, ""), (4, None), (5, " ")]
    parsed = markup.elements(spark.createDataFrame(pages, "k int, html string"), "html", ["k"])
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.index("posexplode") < plan.index("RepartitionByExpression") and plan.count("RepartitionByExpression") == 1
    got = sorted(((r.k or 0, [(n.node, n.end, n.depth, n.tag) for n in r.nodes], [tuple(t) for t in r.texts]) for r in parsed.collect()), key=str)
    once = (1, [(1, 3, 1, "p")], [(2, "x")])
    assert got == [(0, [(0, 0, 1, "br")], []), once, once, (1, [(1, 8, 1, "p"), (5, 7, 2, "b")], [(2, "x"), (6, "y")]), (3, [], []), (4, [], [])]
