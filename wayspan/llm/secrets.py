"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every file is a blob named by the SHA-256 of its text. The ledger lists which
(blob, rule, rule version) pairs were scanned, so a run reads texts only for pairs that are not
in it; a new rule version scans old blobs again for that rule alone. Findings belong to blobs
and are joined back to every path that holds the blob.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayspan.llm.textops import settle


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds, leftmost and non-overlapping; ``group`` must have ``least`` characters.
    ``needs`` is a cheap condition that every text with a match fulfils."""

    kind: str
    pattern: str
    needs: str
    group: int = 0
    least: int = 1
    version: int = 1


# The three rules of the contract, then those of widely published token formats.
# A bound moved into a pattern of one character class selects the same matches as a later test.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"(?i)(?:pass(?:word|wd)|secret|token|api_?key)[\"']?\x20*[:=]", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]{16}"),
    Rule("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN "),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", r"xox[abprs]-"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", r"eyJ[A-Za-z0-9_-]{10}"),
)
RULES = BASE + MORE
LEDGER = "blob string, kind string, version int"


def blobs(paths: DataFrame, path_col: str, text_col: str) -> DataFrame:
    """(path, blob, text) of every row; null text is the empty blob."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return paths.select(F.col(path_col).alias("path"), F.sha2(text, 256).alias("blob"), text.alias("text"))


def pending(versions: DataFrame, ledger: DataFrame | None, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, source, due): blobs with rules that the ledger does not list for them, the path
    that their text is read from, and these rules. Copies are combined before the shuffle."""
    seen = versions.groupBy("blob").agg(F.min("path").alias("source"))
    if ledger is None:
        return seen.withColumn("due", F.array(*[F.lit(r.kind) for r in rules]))
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    open_pairs = seen.select("blob", "source", F.inline(wanted)).join(ledger, ["blob", "kind", "version"], "left_anti")
    return open_pairs.groupBy("blob").agg(F.min("source").alias("source"), F.collect_set("kind").alias("due"))


def _cuts(text: Column, rule: Rule) -> Column:
    """Lengths of the gaps before the matches, of the matches and of the tested group."""
    length = lambda parts: F.transform(parts, lambda x: F.char_length(x))
    found = F.struct(
        F.lit(rule.kind).alias("kind"), F.lit(rule.least).alias("least"),
        length(F.split(text, rule.pattern, -1)).alias("gaps"),
        length(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))).alias("lengths"),
        length(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))).alias("tested"),
    )
    return F.when(F.array_contains("due", rule.kind) & F.rlike(text, F.lit(rule.needs)), found)


def scan(texts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, kind, start, end) in code points, end exclusive, for (blob, text, due) rows; a row that
    is there twice gives its findings twice."""
    rows = texts.withColumn("row", F.monotonically_increasing_id())  # a blob may be listed twice
    hits = rows.select("row", "blob", F.explode(F.array(*[_cuts(F.col("text"), r) for r in rules])).alias("x")).filter("x is not null")
    each = hits.select("row", "blob", "x.kind", "x.least", F.posexplode(F.arrays_zip("x.gaps", "x.lengths", "x.tested")).alias("i", "m"))
    upto = Window.partitionBy("row", "blob", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum(F.col("m.gaps") + F.coalesce("m.lengths", F.lit(0))).over(upto)
    spans = each.select("blob", "kind", "least", "m.tested", before.alias("end"), "m.lengths")
    return spans.filter("tested >= least").select("blob", "kind", (F.col("end") - F.col("lengths")).alias("start"), "end")


def update(paths: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, path_col: str = "path", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Scan what is due. Returns the new findings (blob, kind, start, end) and the new ledger rows
    (blob, kind, version), to be appended to the stored tables by the caller, findings first."""
    versions = blobs(paths, path_col, text_col)
    due = settle(pending(versions, ledger, rules))
    same = (F.col("path").eqNullSafe(F.col("source"))) & (F.col("blob") == F.col("b"))
    texts = versions.join(due.withColumnRenamed("blob", "b"), same).select("blob", "text", "due")
    number = F.element_at(F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)]), F.col("kind"))
    done = due.select("blob", F.explode("due").alias("kind")).withColumn("version", number.cast("int"))
    return scan(texts, rules).distinct(), done


def summary(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row for each blob with findings: spans (kind, start, end) by start, then rule order."""
    order = F.element_at(F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)]), F.col("kind"))
    entry = F.struct("start", order.alias("order"), "end", "kind")
    return findings.groupBy("blob").agg(F.array_sort(F.collect_list(entry)).alias("spans"))


def at_paths(paths: DataFrame, found: DataFrame, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(path, blob, spans) for every row of ``paths``; spans is empty where nothing was found."""
    held = blobs(paths, path_col, text_col).select("path", "blob")
    nothing = F.array().cast(found.schema["spans"].dataType)
    return held.join(found, "blob", "left").select(F.col("path").alias(path_col), "blob", F.coalesce("spans", nothing).alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def oracle() -> str:
    """DuckDB text of the contract's query."""
    each = []
    for i, r in enumerate(RULES):
        pat = r.pattern.replace("'", "''")
        each.append(f"""SELECT doc_id, {i} AS ord, '{r.kind}' AS kind, {r.least} AS least,
  [length(x) FOR x IN string_split_regex(body, '{pat}')] AS gaps, [length(x) FOR x IN regexp_extract_all(body, '{pat}')] AS lens,
  [length(x) FOR x IN regexp_extract_all(body, '{pat}', {r.group})] AS tested FROM d""")
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
c AS ({" UNION ALL ".join(each)}),
m AS (SELECT doc_id, ord, kind, least, gaps, lens, tested, unnest(range(1, len(lens) + 1)) AS i FROM c),
s AS (SELECT doc_id, ord, kind, CAST(list_sum(gaps[1:i]) + coalesce(list_sum(lens[1:i-1]), 0) AS BIGINT) AS start, lens[i] AS n FROM m WHERE tested[i] >= least),
t AS (SELECT doc_id, ord, kind, start, kind || ':' || start || ':' || (start + n) AS span FROM s),
g AS (SELECT doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
  string_agg(span, ',' ORDER BY start, ord) FILTER (ord < 3) AS base, string_agg(span, ',' ORDER BY start, ord) AS spans FROM t GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)"""
