"""Weather stations: unique list, page addresses, fields of fetched pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayspan.functions.columns import as_column
from wayspan.operators.markup import Step, elements, first_text, matching, node_text, within
from wayspan.operators.ordering import first_rows

PAGES = {"minute": "minute-weather-forecast", "current": "current-weather", "aqi": "air-quality-index"}


def unique_stations(routes: DataFrame) -> DataFrame:
    """First route (by ``line_no``) of every non-empty station."""
    named = routes.withColumn("station", F.trim("accuweather_station")).filter(F.col("station") != "")
    kept = first_rows(named.select("station", "label_short", "route_code", "line_no"), ["station"], ["line_no"])
    return kept.select("station", F.col("label_short").alias("label"), F.coalesce("route_code", F.lit("")).alias("route_code"), "line_no")


def page_url(station: Column | str, page: str, base: str, country: str) -> Column:
    """Page address from ``name/id``; NULL when the station is malformed."""
    parts = F.split(F.regexp_replace(as_column(station), "^/+|/+$", ""), "/")
    name, code = F.get(parts, 0), F.get(parts, 1)
    url = F.concat(F.lit(f"{base}/en/{country}/"), name, F.lit("/"), code, F.lit(f"/{PAGES[page]}/"), code, F.lit("?unit=c"))
    return F.when(F.size(parts) == 2, url)


def station_pages(stations: DataFrame, base: str, country: str) -> DataFrame:
    return stations.withColumns({f"{p}_url": page_url("station", p, base, country) for p in PAGES})


def malformed_stations(stations: DataFrame) -> DataFrame:
    return stations.filter(page_url("station", "aqi", "", "").isNull())


# --- page fields -----------------------------------------------------------------------------

def tag_text(html: Column | str, tag: str) -> Column:
    """Text of the first node of a tag."""
    return plain_text(F.regexp_extract(as_column(html), rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1))


def plain_text(fragment: Column) -> Column:
    """Fragment without tags, outer blanks trimmed; empty becomes NULL."""
    text = F.regexp_replace(F.regexp_replace(fragment, r"(?s)<[^>]*>", ""), r"^\s+|\s+$", "")
    return F.when(text != "", text)


def first_integer(text: Column) -> Column:
    """The first digits; NULL where there are none."""
    found = F.regexp_extract(text, r"([0-9]+)", 1)
    return F.when(found != "", found)


# Where the fields stand on the pages.
FIELDS = {
    "temp": ("current", (Step(classes=("current-weather-info",)), Step("div", child=True), Step("div", child=True))),
    "temp_flag": ("current", (Step(classes=("current-weather",)), Step(classes=("phrase",)))),
    "realfeel": ("current", (Step(classes=("current-weather-extra", "no-realfeel-phrase")), Step("div", child=True))),
    "realfeel_flag": ("current", (Step(classes=("current-weather-extra", "no-realfeel-phrase")), *[Step("div", child=True)] * 3)),
    "humidity": ("current", (Step(classes=("current-weather-details",)), Step(classes=("detail-item",)))),
    "rsi_flag": ("minute", (Step(classes=("conditions-icon",)), Step("p", classes=("icon-phrase",)))),
    "rsi_forecast": ("minute", (Step(classes=("summary",)),)),
    "aqi": ("aqi", (Step(id="current"), Step(classes=("aq-number",)))),
    "aqi_flag": ("aqi", (Step(id="current"), Step(classes=("category-text",)))),
}
NUMBERS = ("temp", "realfeel", "humidity", "aqi")


def _labelled(nodes: Column, texts: Column, steps: tuple[Step, ...], label: str) -> Column:
    """Text of the second ``div`` of the first element whose first ``div`` reads ``label``."""
    pairs = F.transform(matching(nodes, *steps), lambda item: F.transform(F.slice(within(nodes, item, Step("div", child=True)), 1, 2), lambda div: node_text(texts, div)))
    named = F.filter(pairs, lambda both: (F.size(both) == 2) & (F.get(both, 0) == label))
    return F.get(F.get(named, 0), 1)


def weather_fields(pages: DataFrame) -> DataFrame:
    """Snapshot fields from fetched pages: station, minute_html, current_html, aqi_html.

    One row for every row of ``pages``; a field whose element is missing or empty, or whose page is
    NULL, is NULL, and so is a number where the element has no digits.
    """
    rows = pages.withColumn("_row", F.monotonically_increasing_id())
    kinds = ("current", "minute", "aqi")
    each = rows.select("_row", "station", F.inline(F.array(*[F.struct(F.lit(k).alias("_page_kind"), F.col(f"{k}_html").alias("_html")) for k in kinds])))
    parsed = elements(each, "_html", ["_row", "station", "_page_kind"])
    nodes, texts, found = F.col("nodes"), F.col("texts"), {}
    for name, (kind, steps) in FIELDS.items():
        text = _labelled(nodes, texts, steps, "Humidity") if name == "humidity" else first_text(nodes, texts, *steps)
        found[name] = F.when(F.col("_page_kind") == kind, text)
    # one page each has a field, so the largest is that one
    fields = parsed.select("_row", "station", *[c.alias(n) for n, c in found.items()]).groupBy("_row", "station").agg(*[F.max(n).alias(n) for n in found])
    return fields.select("station", *[(first_integer(F.col(n)) if n in NUMBERS else F.nullif(F.col(n), F.lit(""))).alias(n) for n in found])
