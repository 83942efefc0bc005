"""Phrase collocations from depth-truncated suffix subtrees, partitioned by word prefixes.

Every word starts a suffix that ends with its piece or after ``longest`` words. Scans of the text
deepen the suffixes step by step: words are counted, then neighbouring pairs of frequent words, and
only suffixes whose words and pairs are all frequent go on (a phrase is no more frequent than its
parts, so none is lost). Equal suffixes are one leaf with a total.

Leaves are partitioned vertically: a prefix of one word is a group's unit if it has at most
``budget`` leaves, else it is extended by a word, and so on; units are dealt to groups that hold
about ``budget`` leaves each. Every group sorts its leaves, which is its subtree, and reads the count
of each node from the leaf totals below it. Nodes above a unit that had to be extended lie in
several groups; their parts are added up at the end.

Counts are by the words themselves. Hashes only tell equal words inside one chunk of text and fill
the bitmaps of fixed size that hold the frequent words and pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayspan.llm import wordhash
from wayspan.llm.bitmaps import bitmap, held
from wayspan.llm.textops import store

LEAST = 30
LONGEST = 4
TOP = 2000
BUDGET = 500_000
FILTER = 26  # 8 MB
BASE = 0x9E3779B97F4A7C15
STEP = np.uint64(0xA0761D6478BD642F)
BREAK = np.zeros(256, bool)
BREAK[[0x0A, 0x0B, 0x0C, 0x0D, *b".,;:!?"]] = True
BETWEEN = BREAK.copy()
BETWEEN[[0x20, 0x09]] = True


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(langs, raw, starts, ends, hashes, linked) for chunks of (lang, text) rows: the language and
    hash of every word (words of two languages differ), and whether the next one follows it in its piece."""
    langs = batch.column(0).dictionary_encode()
    salts = np.array([int.from_bytes(blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs.dictionary.to_pylist()], np.uint64)
    for start, end, raw, limits in wordhash.text_chunks(batch.column(1)):
        raw = wordhash.lowered(raw)
        begins, ends, before = wordhash.word_limits(raw, limits, BETWEEN)
        if not len(begins):
            continue
        row = np.repeat(np.arange(end - start), np.diff(before))
        codes = langs.indices.to_numpy()[start:end][row]
        hashes = wordhash._mix(wordhash.word_hashes(raw, begins, ends, (BASE,))[0] ^ salts[codes])
        piece = np.cumsum(BREAK[raw])[begins]
        linked = np.zeros(len(begins), bool)
        linked[:-1] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
        yield langs.dictionary.take(pa.array(codes)), raw, begins, ends, hashes, linked


def _longer(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    return wordhash._mix(key * STEP + word)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, key, n): the distinct words of each chunk."""
    for batch in batches:
        for langs, raw, begins, ends, hashes, _ in _chunks(batch):
            keys, at, n = np.unique(hashes, return_index=True, return_counts=True)
            yield pa.record_batch([langs.take(pa.array(at)), wordhash.joined(raw, begins, ends, at, np.ones_like(at)), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "phrase", "key", "n"])


def _pairs(frequent):
    """(key, n): neighbouring frequent words, distinct in each chunk."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, hashes, linked in _chunks(batch):
                good = held(frequent.value, hashes)
                at = np.flatnonzero(linked[:-1] & good[:-1] & good[1:])
                keys, n = np.unique(_longer(hashes[at], hashes[at + 1]), return_counts=True)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n)], names=["key", "n"])

    return read


def _leaves(pairs, longest: int):
    """(lang, phrase, words, n): suffixes of two words or more, cut before the first pair that is
    not frequent, distinct in each chunk."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for langs, raw, begins, ends, hashes, linked in _chunks(batch):
                link = linked.copy()
                at = np.flatnonzero(linked)
                link[at] = held(pairs.value, _longer(hashes[at], hashes[at + 1]))
                depth, key, alive = np.ones(len(hashes), np.int64), hashes.copy(), np.flatnonzero(link)
                for k in range(1, longest):
                    depth[alive] += 1
                    key[alive] = _longer(key[alive], hashes[alive + k])
                    alive = alive[link[alive + k]]
                deep = np.flatnonzero(depth > 1)
                _, first, n = np.unique(key[deep], return_index=True, return_counts=True)
                at = deep[first]
                yield pa.record_batch([langs.take(pa.array(at)), wordhash.joined(raw, begins, ends, at, depth[at]), pa.array(depth[at], pa.int32()), pa.array(n)], names=["lang", "phrase", "words", "n"])

    return read


def _subtree(least: int, longest: int):
    """The nodes of one group's leaves (lang, phrase, cut, n): those of ``least`` occurrences or more,
    and the parts of nodes above the group's units, whatever their count."""

    def build(leaves: pa.Table) -> pa.Table:
        leaves = leaves.combine_chunks()
        split = pc.split_pattern(leaves["phrase"].combine_chunks(), " ")
        depth = pc.list_value_length(split).to_numpy()
        words = split.flatten().dictionary_encode()
        codes = np.full((len(depth), longest + 1), -1, np.int64)
        first = np.cumsum(depth) - depth
        codes[:, 0] = leaves["lang"].combine_chunks().dictionary_encode().indices.to_numpy()
        codes[np.repeat(np.arange(len(depth)), depth), np.arange(int(depth.sum())) - np.repeat(first, depth) + 1] = words.indices.to_numpy()
        order = np.lexsort(codes.T[::-1])
        codes, depth = codes[order], depth[order]
        n, cut = leaves["n"].to_numpy()[order], leaves["cut"].to_numpy()[order]
        out = []
        for k in range(2, longest + 1):
            deep = np.flatnonzero(depth >= k)
            if not len(deep):
                break
            # leaves that end above sort first, so those below one node are neighbours
            tops = np.flatnonzero(np.append(True, (codes[deep[1:], : k + 1] != codes[deep[:-1], : k + 1]).any(axis=1)))
            total = np.add.reduceat(n[deep], tops)
            node = deep[tops]
            keep = (total >= least) | (cut[node] > k)
            node, total = node[keep], total[keep]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(node) + 1) * k, pa.int32()), words.dictionary.take(pa.array(codes[node, 1 : k + 1].ravel())))
            out.append(pa.table({"lang": leaves["lang"].take(pa.array(order[node])), "phrase": pc.binary_join(lists, " "), "words": pa.array(np.full(len(node), k), pa.int32()), "n": pa.array(total)}))
        return pa.concat_tables(out) if out else pa.table({"lang": pa.array([], pa.string()), "phrase": pa.array([], pa.string()), "words": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})

    return build


def _grouped(leaves: DataFrame, longest: int, budget: int) -> DataFrame:
    """``leaves`` with cut, the words of the prefix that is their unit (more than they may have
    themselves), and group. Of prefixes over the budget there is at most one for ``budget``
    leaves, so the broadcast tables are that small."""
    prefix = lambda k: F.substring_index("phrase", " ", k)
    cut, heavy_rows = F.lit(1), leaves.withColumn("over0", F.lit(True))
    out = leaves
    for k in range(1, longest):
        above = heavy_rows.filter(f"over{k - 1} AND words >= {k}")
        heavy = store(above.groupBy("lang", prefix(k).alias("prefix")).agg(F.count("*").alias("leaves")).filter(F.col("leaves") > budget).select(F.col("lang").alias("l"), "prefix", F.lit(True).alias(f"over{k}")), "prefixes")
        out = out.join(F.broadcast(heavy), (F.col("lang") == F.col("l")) & (prefix(k) == F.col("prefix")), "left").drop("l", "prefix")
        heavy_rows = out
        cut = cut + F.coalesce(F.col(f"over{k}").cast("int"), F.lit(0))
    groups = leaves.count() // budget + 1
    unit = F.expr("substring_index(phrase, ' ', cut)")
    return out.withColumn("cut", cut).select("lang", "phrase", "words", "n", "cut").withColumn("group", F.pmod(F.xxhash64("lang", unit), F.lit(groups)))


def frequencies(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, lang_col: str = "lang", text_col: str = "text", budget: int = BUDGET, filter_bits: int = FILTER) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to ``longest`` words that occur ``least`` times or more
    in their language, and (lang, n), all word occurrences. Null text is empty, null lang is ``und``."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    counted = rows.mapInArrow(_words, "lang string, phrase string, key long, n long").groupBy("lang", "phrase").agg(F.first("key").alias("key"), F.sum("n").alias("f"))
    words = store(counted, "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = words.filter(F.col("f") >= least)
    frequent = spark.sparkContext.broadcast(bitmap(often, "key", filter_bits))
    pairs = store(rows.mapInArrow(_pairs(frequent), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("key"), "pairs")
    linked = spark.sparkContext.broadcast(bitmap(pairs, "key", filter_bits))
    found = rows.mapInArrow(_leaves(linked, longest), "lang string, phrase string, words int, n long")
    leaves = store(found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")), "leaves")
    parts = _grouped(leaves, longest, budget).groupBy("group").applyInArrow(_subtree(least, longest), "lang string, phrase string, words int, n long")
    nodes = parts.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)
    return store(often.select("lang", "phrase", F.lit(1).alias("words"), "f").unionByName(nodes), "phrases"), totals


def _scored(found: DataFrame) -> DataFrame:
    """Phrases of two words or more with l, r and score of their lowest-scoring cut."""
    cuts = found.filter("words > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).selectExpr(
        "lang", "phrase", "words", "f AS a", "k", "substring_index(phrase, ' ', k) AS head", "substring_index(phrase, ' ', k - words) AS rest"
    )
    part = lambda name: found.select(F.col("lang").alias(f"{name}_lang"), F.col("phrase").alias(f"{name}_phrase"), F.col("f").alias(name))
    both = cuts
    for side, name in (("head", "l"), ("rest", "r")):
        both = both.join(part(name), (F.col("lang") == F.col(f"{name}_lang")) & (F.col(side) == F.col(f"{name}_phrase"))).drop(f"{name}_lang", f"{name}_phrase")
    exact = both.withColumn("score", F.expr("(cast(a AS decimal(28, 0)) * 2000000BD) div (cast(l AS decimal(28, 0)) + cast(r AS decimal(28, 0)))"))
    lowest = exact.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    return lowest.select("lang", "phrase", "words", "a", "x.l", "x.r", "x.score")


def _held_by_longer(found: DataFrame) -> DataFrame:
    """(lang, phrase, most): of the phrases inside longer ones the largest count of a longer one."""
    longer = found.filter("words > 2").select("lang", "f", "words", F.split("phrase", " ").alias("w"))
    sized = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = sized.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    return inner.groupBy("lang", F.array_join(F.expr("slice(w, at, size)"), " ").alias("phrase")).agg(F.max("f").alias("most"))


def top_rows(rows: DataFrame, by: str, order: list, top: int) -> DataFrame:
    """The first ``top`` rows of each ``by`` with their rank. Each group is cut into about
    sqrt(rows / top) parts that give their own first rows, so no task ranks all rows of one."""
    parts = int((rows.count() / top) ** 0.5) + 1
    best = lambda df, keys: df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    dealt = rows.withColumn("part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)))
    return best(best(dealt, [by, "part"]).drop("part", "rank"), [by])


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, lang_col: str = "lang", text_col: str = "text", budget: int = BUDGET, filter_bits: int = FILTER) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Phrases of 2 to ``longest`` words with ``a`` >= ``least`` occurrences are scored
    floor(2000000 a / (l + r)) at their lowest-scoring cut (ties: the earliest); those that lie in
    a longer one of at least 80 % of their count are dropped. By score, then count, then phrase
    in byte order. Null text is empty, null lang is ``und``; repeated rows count each; a table
    without words gives no rows. Other columns are not touched.
    """
    found, totals = frequencies(docs, least, longest, lang_col, text_col, budget, filter_bits)
    inside = _held_by_longer(found).select(F.col("lang").alias("x_lang"), F.col("phrase").alias("x_phrase"), "most")
    scored = _scored(found).join(inside, (F.col("lang") == F.col("x_lang")) & (F.col("phrase") == F.col("x_phrase")), "left")
    kept = scored.filter("most IS NULL OR cast(most AS decimal(28, 0)) * 100 < cast(a AS decimal(28, 0)) * 80")
    rows = store(kept.select("lang", "phrase", "a", "l", "r", "score"), "collocations")
    ranked = top_rows(rows, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = LEAST, top: int = TOP) -> str:
    """DuckDB text of the contract's query."""
    body = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({body}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM s, (SELECT unnest(range(1, 5)) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1 AND f >= {least}),
t AS (SELECT c.*, unnest(range(1, k)) AS cut FROM c),
x AS (SELECT t.lang, t.phrase, t.a, t.cut, l.f AS l, r.f AS r, CAST(2000000::HUGEINT * t.a // (l.f + r.f) AS BIGINT) AS score FROM t
  JOIN g AS l ON l.lang = t.lang AND l.phrase = array_to_string(t.w[:t.cut], ' ') JOIN g AS r ON r.lang = t.lang AND r.phrase = array_to_string(t.w[t.cut + 1:], ' ')),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, array_to_string(w[j:j + size - 1], ' ') AS phrase, max(a) AS most FROM (SELECT *, unnest(range(1, k - size + 2)) AS j FROM (SELECT *, unnest(range(2, k)) AS size FROM c)) GROUP BY ALL),
z AS (SELECT y.* FROM y LEFT JOIN i USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM z JOIN n USING (lang)
QUALIFY rank <= {top}"""
