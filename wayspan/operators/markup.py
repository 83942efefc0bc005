"""Elements of HTML pages as columns: tokens, open depth, scopes, text.

A page is cut into tags and text, one row each. Tags of one name open and close at a level, a
running sum over the page; at one level openings and closings of that name alternate, so the next
one after an opening is its end. The depth of an element is a running sum of the openings that
have an end and of these ends. An element without an end holds nothing, and an end without an
opening is passed over, so stray tags do not move the scopes around them.

All windows run over one page, in one exchange of the pages; what comes back is one row a page with
its elements and texts as arrays, on which :func:`matching` selects. Comments, scripts and styles
are left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Elements that never have an end tag, and the named characters that are decoded.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "deg": "°", "middot": "·", "copy": "©", "ndash": "–", "mdash": "—", "hellip": "…"}

TOKEN = (
    r"""(?is)<!--.*?-->|<![^>]*+>|<(?:script|style)\b[^>]*+>.*?</(?:script|style)\s*+>"""
    r"""|</?[a-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^<]++|<"""
)
BLANK = r"(?U)^\s+|\s+$"


def _attribute(token: Column, name: str) -> Column:
    value = F.regexp_extract(token, rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)
    return F.regexp_replace(value, r"""^["']|["']$""", "")


def unescape(text: Column) -> Column:
    """Decode numeric characters and the :data:`NAMED` ones; others stay as they are."""
    named = F.create_map(*[F.lit(x) for pair in NAMED.items() for x in pair])

    def one(part: Column) -> Column:
        body = F.regexp_extract(part, r"^&#?[xX]?([0-9A-Za-z]+);$", 1)
        code = F.when(F.rlike(part, F.lit("^&#[xX]")), F.conv(body, 16, 10)).otherwise(body).try_cast("int")
        letter = F.when(code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.when(F.startswith(part, F.lit("&#")), F.coalesce(letter, part)).when(F.length(body) > 0, F.coalesce(F.try_element_at(named, body), part)).otherwise(part)

    parts = F.regexp_extract_all(text, F.lit(r"&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};|&[A-Za-z]+;|[^&]+|&"), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(parts, one), "")).otherwise(text)


def elements(pages: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """One row for every row of ``pages`` with the columns ``keep`` and

    * ``nodes``: (node, end, depth, tag, classes, id) of every element in page order; ``node`` and
      ``end`` are the places of its tags among the tokens,
    * ``texts``: (at, text) of every text that is not blank, trimmed and decoded.

    A null or empty page has empty arrays.
    """
    keep = list(keep)
    rows = pages.select(F.monotonically_increasing_id().alias("_page"), *keep, F.col(html).alias("_html"))
    # a page travels as one row with the tokens that are used, the others NULL in their place
    used = lambda t: ~F.rlike(t, F.lit(r"(?i)^<(!|script\b|style\b)")) & F.rlike(t, F.lit(r"\S"))
    tokens = F.transform(F.regexp_extract_all("_html", F.lit(TOKEN), F.lit(0)), lambda t: F.when(used(t), t))
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("_page", *keep, tokens.alias("_tokens")).repartition(tasks, "_page")
    cut = dealt.select("_page", *keep, F.posexplode_outer("_tokens").alias("_at", "_token")).filter(F.col("_at").isNull() | F.col("_token").isNotNull())
    tag = F.lower(F.regexp_extract("_token", r"^</?([A-Za-z][A-Za-z0-9:-]*)", 1))
    bare = F.rlike("_token", F.lit(r"^<[A-Za-z]"))
    kind = (
        F.when(F.startswith("_token", F.lit("</")), "close").when(bare & (tag.isin(*VOID) | F.endswith("_token", F.lit("/>"))), "empty")
        .when(bare, "open").otherwise("text")
    )
    thin = cut.select(
        "_page", *keep, "_at", kind.alias("_kind"), tag.alias("_tag"),
        F.when(bare, F.split(F.regexp_replace(_attribute(F.col("_token"), "class"), BLANK, ""), r"\s+")).alias("_classes"),
        F.when(bare, _attribute(F.col("_token"), "id")).alias("_id"),
        F.when(kind == "text", F.regexp_replace(unescape(F.col("_token")), BLANK, "")).alias("_text"),
    )
    step = F.when(F.col("_kind") == "open", 1).when(F.col("_kind") == "close", -1).otherwise(0)
    upto = lambda *by: Window.partitionBy("_page", *by).orderBy("_at")
    opened = thin.withColumn("_level", F.sum(step).over(upto("_tag").rowsBetween(Window.unboundedPreceding, 0)) + F.when(F.col("_kind") == "close", 1).otherwise(0))
    same = upto("_tag", "_level", F.col("_kind").isin("open", "close"))
    paired = opened.withColumns({
        "_end": F.when((F.col("_kind") == "open") & (F.lead("_kind").over(same) == "close"), F.lead("_at").over(same)),
        "_ends": (F.col("_kind") == "close") & (F.lag("_kind").over(same) == "open"),
    })
    deeper = F.when(F.col("_end").isNotNull(), 1).when(F.col("_ends"), -1).otherwise(0)
    placed = paired.withColumn("_depth", F.sum(deeper).over(upto().rowsBetween(Window.unboundedPreceding, 0)))
    # an element without an end is one deeper than what is open around it
    depth = F.col("_depth") + F.when(F.col("_end").isNull(), 1).otherwise(0)
    node = F.struct(F.col("_at").alias("node"), F.coalesce("_end", "_at").alias("end"), depth.alias("depth"), F.col("_tag").alias("tag"), F.col("_classes").alias("classes"), F.col("_id").alias("id"))
    text = F.struct(F.col("_at").alias("at"), F.col("_text").alias("text"))
    return placed.groupBy("_page", *keep).agg(
        F.sort_array(F.collect_list(F.when(F.col("_kind").isin("open", "empty"), node))).alias("nodes"),
        F.sort_array(F.collect_list(F.when((F.col("_kind") == "text") & (F.col("_text") != ""), text))).alias("texts"),
    ).drop("_page")


@dataclass(frozen=True)
class Step:
    """An element by name, id and classes; below the step before, or with ``child`` right below it."""

    tag: str = ""
    classes: tuple[str, ...] = ()
    id: str = ""
    child: bool = False

    def fits(self, node: Column) -> Column:
        tests = [F.array_contains(node["classes"], c) for c in self.classes]
        tests += [node["tag"] == self.tag] if self.tag else []
        tests += [node["id"] == self.id] if self.id else []
        out = F.lit(True)
        for t in tests:
            out = out & t
        return out


def within(nodes: Column, scope: Column, step: Step) -> Column:
    """Elements that fit ``step`` inside the element ``scope``, in page order."""
    below = lambda n: (n["node"] > scope["node"]) & (n["node"] < scope["end"])
    right = lambda n: n["depth"] == scope["depth"] + 1 if step.child else F.lit(True)
    return F.filter(nodes, lambda n: below(n) & right(n) & step.fits(n))


def matching(nodes: Column, *steps: Step) -> Column:
    """The elements that the steps lead to, in page order."""
    found = F.filter(nodes, steps[0].fits)
    for step in steps[1:]:
        inner = F.transform(found, lambda scope: within(nodes, scope, step))  # noqa: B023 (built at once)
        found = F.array_sort(F.array_distinct(F.flatten(inner)))
    return found


def node_text(texts: Column, node: Column) -> Column:
    """All text inside an element, each part trimmed; empty where there is none, NULL without an element."""
    inside = F.filter(texts, lambda t: (t["at"] > node["node"]) & (t["at"] < node["end"]))
    return F.when(node.isNotNull(), F.array_join(F.transform(inside, lambda t: t["text"]), ""))


def first_text(nodes: Column, texts: Column, *steps: Step) -> Column:
    """Text of the first element that the steps lead to. The element is looked up once."""
    found = F.slice(matching(nodes, *steps), 1, 1)
    return F.get(F.transform(found, lambda node: node_text(texts, node)), 0)
