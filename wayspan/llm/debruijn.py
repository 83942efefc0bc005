"""Long repeated passages by compaction of a De Bruijn graph of word windows.

Every window of ``width`` words is an edge between the runs of ``width - 1`` words at its ends. Windows
in a row that share the place of their smallest hash of ``MARK`` words (their mark) form a nonbranching
path that is kept as one row; its first and last window overlap, so their hashes tell all its words, so the graph takes about one row for every 15 words. Paths with a mark
that occurs once cannot hold a repeated window and leave. Of the rest, equal paths are compacted
by a count: all windows of a path that occurs twice are repeated. Only paths that occur once but
share their mark with others are read again from their source coordinates and compared window by
window. A window is told by its mark and a 64-bit hash of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayspan.llm import wordhash
from wayspan.llm.textops import store

WIDTH = 35
MARK = 6
BASE = 0x9E3779B97F4A7C15
STEP = 0xA0761D6478BD642F
REF = "id long, th long"


def _marks(words: np.ndarray, width: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest hash of MARK words in each of ``n`` windows, and the first place in the window that has it."""
    span = min(MARK, width)
    short = wordhash.rolling(words, span, STEP)
    marks = wordhash.sliding_min(short, width - span + 1)[:n]
    spot = np.zeros(n, np.int64)
    for k in range(width - span, -1, -1):
        spot[short[k : k + n] == marks] = k
    return marks, spot


def _paths(words: np.ndarray, limits: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(first window, windows, mark, hash) of the paths in a flat run of words; ``limits`` holds the
    number of words before each row, so that no window crosses two rows."""
    for lo in range(0, max(0, len(words) - width + 1), wordhash.WORDS_AT_ONCE):
        part = words[lo : lo + wordhash.WORDS_AT_ONCE + width - 1]
        hashes = wordhash.rolling(part, width, STEP)
        n = len(hashes)
        at = np.arange(lo, lo + n)
        row = np.searchsorted(limits, at, "right") - 1
        inside = at + width <= limits[row + 1]
        marks, spot = _marks(part, width, n)
        spot += at  # equal windows of one text have their marks at different places
        fresh = np.ones(n, bool)
        fresh[1:] = (spot[1:] != spot[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(fresh & inside)
        if not len(first):
            continue
        stops = np.append(np.flatnonzero(fresh | ~inside), n)
        last = stops[np.searchsorted(stops, first, "right")] - 1
        count = last - first + 1
        whole = wordhash._mix(hashes[first] * np.uint64(STEP) + hashes[last] + count.astype(np.uint64))
        yield first + lo, count, marks[first], whole


def _read_paths(width: int):
    """Rows (id, th, text) to the paths of the texts: mark, s, id, th, at, n."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ths = batch.column(0), batch.column(1)
            for start, _, raw, limits in wordhash.text_chunks(batch.column(2)):
                begins, ends, before = wordhash.word_limits(raw, limits)
                if len(begins) < width:
                    continue
                words = wordhash.word_hashes(raw, begins, ends, (BASE,))[0]
                for first, count, mark, whole in _paths(words, before, width):
                    row = np.searchsorted(before, first, "right") - 1
                    take = pa.array(row + start)
                    yield pa.record_batch(
                        [pa.array(mark.view(np.int64)), pa.array(whole.view(np.int64)), ids.take(take), ths.take(take), pa.array(first - before[row]), pa.array(count)],
                        names=["mark", "s", "id", "th", "at", "n"],
                    )

    return read


def _read_windows(width: int):
    """Rows (id, th, text, paths) to the windows of the listed paths: mark, h, id, th, at, lone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ths, listed = batch.column(0), batch.column(1), batch.column(3)
            for start, _, raw, limits in wordhash.text_chunks(batch.column(2)):
                begins, ends, before = wordhash.word_limits(raw, limits)
                words = wordhash.word_hashes(raw, begins, ends, (BASE,))[0]
                for r in range(len(limits) - 1):
                    own = words[before[r] : before[r + 1]]
                    hashes = wordhash.rolling(own, width, STEP)
                    marks, _ = _marks(own, width, len(hashes))
                    paths = listed[start + r].values
                    at, n, lone = (paths.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                    spot = np.repeat(at, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                    take = pa.array(np.full(len(spot), start + r))
                    yield pa.record_batch(
                        [pa.array(marks[spot].view(np.int64)), pa.array(hashes[spot].view(np.int64)), ids.take(take), ths.take(take), pa.array(spot), pa.array(np.repeat(lone, n))],
                        names=["mark", "h", "id", "th", "at", "lone"],
                    )

    return read


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows under (id, hash of the text): rows that share both are copies with the same result."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["th"] == b["th"])


def repeated_windows(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, at, n): runs of ``n`` windows from word ``at`` whose words start elsewhere too."""
    keyed = _keyed(docs, id_col, text_col)
    paths = keyed.mapInArrow(_read_paths(width), f"mark long, s long, {REF}, at long, n long")
    # stored, so that the join can split a mark that very many paths share
    shared = store(paths.groupBy("mark").agg(F.count("*").alias("seen")).filter("seen > 1").select("mark"), "marks")
    kept = store(paths.join(shared, "mark"), "paths")
    kinds = kept.groupBy("mark", "s").agg(F.count("*").alias("c"), F.min(F.struct("id", "th", "at", "n")).alias("source"))
    kinds = store(kinds, "kinds")
    whole = kept.join(kinds.filter("c > 1").select("mark", "s"), ["mark", "s"]).select("id", "th", "at", "n")
    # of a mark with several kinds of paths each kind is read again at one source; a kind with
    # copies is settled by ``whole`` and only there to be met by others
    mixed = store(kinds.groupBy("mark").agg(F.count("*").alias("kinds"), F.min("c").alias("least")).filter("kinds > 1 and least = 1").select("mark"), "mixed")
    again = kinds.join(mixed, "mark").select("source.id", "source.th", F.struct("source.at", "source.n", (F.col("c") == 1).alias("lone")).alias("path"))
    lists = again.groupBy("id", "th").agg(F.collect_list("path").alias("paths"))  # no more than the words of one text
    texts = keyed.join(lists, _same_row(keyed, lists)).select(lists["id"], lists["th"], keyed["text"], "paths")
    windows = store(texts.mapInArrow(_read_windows(width), f"mark long, h long, {REF}, at long, lone boolean"), "windows")
    weight = F.when(F.col("lone"), 1).otherwise(2)
    twice = store(windows.groupBy("mark", "h").agg(F.sum(weight).alias("c")).filter("c > 1").select("mark", "h"), "twice")
    lone = windows.filter("lone").join(twice, ["mark", "h"]).select("id", "th", "at", F.lit(1).cast("long").alias("n"))
    return whole.union(lone)


def _strip(width: int):
    """Rows (id, text, runs) to (id, n_words, n_removed, kept): runs are (at, n) of windows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, runs in zip(batch.column(1), batch.column(2), strict=True):
                words = text.as_py().encode().split()
                total.append(len(words))
                if runs.is_valid and len(runs.values):
                    at, n = (runs.values.field(k).to_numpy(zero_copy_only=False) for k in range(2))
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, at, 1)
                    np.add.at(change, at + n + width - 1, -1)
                    clean = np.cumsum(change[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(clean)]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.record_batch([batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", "kept"])

    return read


def without_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every row of ``docs``: id, n_words, n_removed and ``kept``, the words that no
    repeated window covers, joined by one space.

    Windows are judged on the input: of two copies both lose the passage. Null text has no
    words; a text below ``width`` words loses none. Repeated rows count as copies of each
    other. An empty table gives an empty result; other columns are left alone.
    """
    found = repeated_windows(docs, width, id_col, text_col)
    runs = store(found.groupBy("id", "th").agg(F.collect_list(F.struct("at", "n")).alias("runs")), "runs")
    keyed = _keyed(docs, id_col, text_col)
    rows = keyed.join(runs, _same_row(keyed, runs), "left").select(keyed["id"], keyed["text"], "runs")
    return rows.mapInArrow(_strip(width), "id long, n_words long, n_removed long, kept string")
