"""Benchmark passages in training texts by winnowed fingerprints.

A window of ``width`` words keeps the smallest hash of its runs of about half as many words (leftmost
on ties), so two equal windows keep the same fingerprint and every shared span of ``width`` words is
found. Windows in a row that keep the same run are one row: its fingerprint and their words. The
fingerprints of texts and items are joined; what meets is extended to its whole windows, which must
be equal word for word. Items shorter than a window are one window of their own length, for which
the texts are winnowed once more.

Before the join, fingerprints of texts that no item can have are left out by a bitmap of
``2 ** FILTER`` bits (1 MB at any size of the benchmark); it only saves work. Joins meet tables with
one row a fingerprint or window, so a passage that very many texts or items share costs one row a
text and item, not their product, and Spark may split it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayspan.llm import wordhash
from wayspan.llm.bitmaps import bitmap, held
from wayspan.llm.textops import store

WIDTH = 10
FILTER = 23
BASE = 0x9E3779B97F4A7C15
STEP = 0xA0761D6478BD642F
OUTSIDE = np.ones(256, bool)  # words are made of 0-9, a-z and everything beyond ASCII
OUTSIDE[0x30:0x3A] = OUTSIDE[0x61:0x7B] = OUTSIDE[0x80:] = False
RUNS = "array<struct<print: long, size: int, first: long, windows: long, body: string>>"


def _prints(words: np.ndarray, before: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(first window, windows, fingerprint) of the runs of windows of ``size`` words that keep one
    fingerprint; ``before`` holds the number of words before each row, no window crosses two."""
    short = (size + 1) // 2
    spread = size - short + 1
    for lo in range(0, len(words) - size + 1, wordhash.WORDS_AT_ONCE):
        part = words[lo : lo + wordhash.WORDS_AT_ONCE + size - 1]
        n = len(part) - size + 1
        hashes = wordhash._mix(wordhash.rolling(part, short, STEP) + np.uint64(size))
        least = wordhash.sliding_min(hashes, spread)[:n]
        spot = np.zeros(n, np.int64)
        for k in range(spread - 1, -1, -1):
            spot[hashes[k : k + n] == least] = k
        at = np.arange(n)
        spot += at
        row = np.searchsorted(before, at + lo, "right") - 1
        inside = at + lo + size <= before[row + 1]
        fresh = np.ones(n, bool)
        fresh[1:] = (spot[1:] != spot[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(fresh & inside)
        stops = np.append(np.flatnonzero(fresh | ~inside), n)
        yield first + lo, stops[np.searchsorted(stops, first, "right")] - first, least[first]


def _read(sizes, kept):
    """Rows (id, text) to (id, n_words, runs): the runs of windows of each of ``sizes`` whose
    fingerprint is in the bitmap ``kept``. No bitmap, as for items: all runs, but of each text
    only those of the largest size that it has."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, raw, limits in wordhash.text_chunks(batch.column(1)):
                raw = wordhash.lowered(raw)
                begins, ends, before = wordhash.word_limits(raw, limits, OUTSIDE)
                words = wordhash.word_hashes(raw, begins, ends, (BASE,))[0]
                parts = []
                for size in sizes:
                    for first, count, mark in _prints(words, before, size):
                        if kept is not None:
                            there = held(kept.value, mark)
                        else:
                            n = np.diff(before)[np.searchsorted(before, first, "right") - 1]
                            there = np.minimum(n, max(sizes)) == size
                        first, count, mark = first[there], count[there], mark[there]
                        parts.append((first, count, mark, np.full(len(first), size)))
                first, count, mark, size = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 4
                row = np.searchsorted(before, first, "right") - 1
                order = np.argsort(row, kind="stable")
                first, count, mark, size, row = (x[order] for x in (first, count, mark, size, row))
                body = wordhash.joined(raw, begins, ends, first, count + size - 1)
                fields = [pa.array(mark.view(np.int64)), pa.array(size, pa.int32()), pa.array(first - before[row]), pa.array(count), body]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(row, np.arange(end - start + 1)), pa.int32()), pa.StructArray.from_arrays(fields, names=["print", "size", "first", "windows", "body"])
                )
                yield pa.record_batch([batch.column(0).slice(start, end - start), pa.array(np.diff(before)), lists], names=["id", "n_words", "runs"])

    return read


def _rows(table: DataFrame, id_col: str, text_col: str, kind: str) -> DataFrame:
    return table.select(F.col(id_col).cast(kind).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _windows(runs: DataFrame, keep: list[str]) -> DataFrame:
    """Every window of the runs: ``keep``, size, at (its first word), words."""
    each = runs.select(*keep, "size", "first", F.split("body", " ").alias("w"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("windows") - 1)).alias("i"))
    return each.select(*keep, "size", (F.col("first") + F.col("i")).alias("at"), F.array_join(F.slice("w", F.col("i").cast("int") + 1, F.col("size")), " ").alias("words"))


def item_windows(items: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The windows of the items (window, print, size, words), each once, and (window, item_id).

    An item of fewer words than ``width`` is one window, one without words has none.
    """
    rows = store(_rows(items, id_col, text_col, "string").mapInArrow(_read(range(1, width + 1), None), f"id string, n_words long, runs {RUNS}"), "items")
    runs = rows.select("id", F.inline("runs"))
    each = store(_windows(runs, ["id", "print"]).select("id", "print", "size", "words").distinct(), "item-windows")
    kinds = store(each.groupBy("words").agg(F.first("print").alias("print"), F.first("size").alias("size")).withColumn("window", F.monotonically_increasing_id()), "windows")
    members = each.filter(F.col("id").isNotNull()).join(kinds.select("words", "window"), "words").select("window", F.col("id").alias("item_id"))
    return kinds, store(members, "members")


def passages(docs: DataFrame, items: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for every row of ``docs``: id, n_words, spans (start, end: words in windows that an
    item has too, end exclusive, merged) and items, their ids as sorted strings.

    Null text has no words; repeated rows stay rows of their own; repeated items count once; items
    without an id mark words but are not listed. Empty tables of either kind give no spans. Other
    columns are not touched.
    """
    spark = docs.sparkSession
    kinds, members = item_windows(items, width, item_col, item_text_col)
    sizes = [r["size"] for r in kinds.select("size").distinct().orderBy(F.desc("size")).collect()]  # at most ``width`` rows
    kept = spark.sparkContext.broadcast(bitmap(kinds, "print", FILTER))
    kind = docs.schema[id_col].dataType.simpleString()
    read = _rows(docs, id_col, text_col, kind).mapInArrow(_read(sizes, kept), f"id {kind}, n_words long, runs {RUNS}")
    rows = store(read.withColumn("row", F.monotonically_increasing_id()), "prints")
    met = rows.select("row", F.inline("runs")).join(kinds.select("print").distinct(), "print", "left_semi")
    hits = store(_windows(met, ["row"]).join(kinds.select("words", "window"), "words").select("row", "at", "size", "window"), "hits")
    spans = merged(hits.select("row", F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end")))
    # texts with the same set of windows have the same items, listed once
    sets = store(hits.groupBy("row").agg(F.sort_array(F.collect_set("window")).alias("windows")), "window-sets")
    listed = sets.select("windows").distinct().withColumn("window", F.explode("windows")).join(members, "window").groupBy("windows").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    found = spans.join(sets, "row").join(listed, "windows", "left").select("row", "spans", "items")
    none = lambda column, kind: F.coalesce(column, F.array().cast(kind))
    return rows.select("row", "id", "n_words").join(found, "row", "left").select(
        F.col("id").alias(id_col), "n_words", none("spans", "array<struct<start:bigint,end:bigint>>").alias("spans"), none("items", "array<string>").alias("items")
    )


def merged(spans: DataFrame) -> DataFrame:
    """(row, spans) from the (row, start, end) of one text each: overlapping and touching ones joined.
    A window sees the spans of one text, no more than its words."""
    order = Window.partitionBy("row").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = spans.distinct().withColumn("fresh", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1)))
    runs = cut.withColumn("run", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def oracle(width: int = WIDTH) -> str:
    """DuckDB text of the contract's query."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {words} AS w, least(len(w), {width}) AS size FROM benchmark),
i AS (SELECT DISTINCT item_id, size, array_to_string(w[k:k + size - 1], ' ') AS body FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM b WHERE len(w) > 0)),
p AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, (SELECT DISTINCT size FROM i) WHERE len(w) >= size),
h AS (SELECT DISTINCT doc_id, k, p.size, item_id FROM (SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS body FROM p) AS p JOIN i USING (size, body)),
n AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + size)) FROM h) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN l USING (doc_id)"""
