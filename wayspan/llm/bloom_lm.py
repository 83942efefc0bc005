"""Word bigram scores from a log-frequency Bloom filter.

Counts are quantised on a logarithmic scale; an n-gram of level q is held as the items (n-gram, 1)
to (n-gram, q), so its count is read by probing levels until one is absent, and can only come out
too high. Each level is a part of its own, cut into shards by the hash of the n-gram. Every ZONE
levels a part is an anchor with more bits: probing starts at the highest anchor that holds the
n-gram. Which parts are at hand therefore never changes an answer: the zones whose parts fit
``filter_mb`` together are broadcast, from the top; an n-gram that none of their anchors holds is
open. Open tokens are written out with their row, their pairs are read from the stored shards, each
in the task that holds the shard, and the results are added back. So the broadcast is bounded
at any input and all n-grams count.

Weights of the bigram, one for each level of the context, are fitted on one training fold by the
counts of the others; scores then use the counts of all training folds. Both filters come from one
exchange of the pairs.

Unigram and context counts are exact and never broadcast whole: the most frequent words, at most
``head_words`` of them, are broadcast; the rare rest is joined, so no frequent word goes through
that join. Tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayspan.llm import wordhash
from wayspan.llm.textops import scratch_path, store

BASE = 0x9E3779B97F4A7C15
STEP = np.uint64(0xA0761D6478BD642F)
START, END = np.uint64(0x51A9E0D5C2B3F701), np.uint64(0xE4D909C290D0FB1C)
GOLD = 0x9E3779B97F4A7C15
RATIO = 1.5  # between two levels
ZONE = 4  # levels 1, 5, 9, ... are anchors
ITEM_BITS = 8
ANCHOR_BITS = 12  # more, above the first zone, where a false hit would be a large count
KEYS_PER_SHARD = 500_000
FIT, ALL = 0, 1  # filter of the folds that weights are fitted by, and of all training folds
GRID = np.round(np.arange(0, 20) * 0.05, 2)
FOLDS, TEST, FIT_WEIGHTS = 5, 1, 2  # of crc32(id): scored only; fit the weights before their bigrams are counted too


def fold(id_col: str) -> Column:
    """crc32 of the id as text, mod 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS


def _tokens(raw: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes with one end token a row, first token of each row)."""
    low = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    starts, ends, before = wordhash.word_limits(low, limits)
    rows = len(limits) - 1
    out = np.empty(len(starts) + rows, np.uint64)
    stops = before[1:] + np.arange(rows)
    inner = np.ones(len(out), bool)
    inner[stops] = False
    out[inner] = wordhash.word_hashes(low, starts, ends, (BASE,))[0]
    out[stops] = END
    return out, before[:-1] + np.arange(rows)


def _contexts(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[first] = START
    return out


def pair_key(context: np.ndarray, token: np.ndarray) -> np.ndarray:
    return wordhash._mix(context * STEP + token)


def _count(pairs: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = batch.column(1).to_numpy(zero_copy_only=False)
            for start, end, raw, limits in wordhash.text_chunks(batch.column(0)):
                tokens, first = _tokens(raw, limits)
                row_of = np.repeat(np.arange(start, end), np.diff(np.append(first, len(tokens))))
                if pairs:
                    keys = pair_key(_contexts(tokens, first), tokens)
                else:
                    keys, row_of = np.append(tokens, np.full(len(first), START)), np.append(row_of, np.arange(start, end))
                keys, back, n = np.unique(keys, return_inverse=True, return_counts=True)
                fit = np.bincount(back, fits[row_of], len(keys)).astype(np.int64)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n), pa.array(fit)], names=["key", "n", "fit"])

    return read


def counts(docs: DataFrame, text_col: str, pairs: bool, fit: Column | None = None) -> DataFrame:
    """(key, n, fit), added up for each chunk of text: occurrences, and those in rows with ``fit``;
    START is counted once a row."""
    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), (F.lit(True) if fit is None else fit).alias("fit"))
    return rows.mapInArrow(_count(pairs), "key long, n long, fit long")


def levels(n: np.ndarray) -> np.ndarray:
    """1 for one occurrence, and one more for each factor of RATIO; 0 for none."""
    return np.where(n > 0, 1 + np.floor(np.log(np.maximum(n, 1)) / np.log(RATIO) + 1e-9).astype(np.int64), 0)


def _anchor(level: int) -> bool:
    return level % ZONE == 1


def _shape(level: int, item_bits: int) -> tuple[int, int]:
    """Probes and bits an item of a part."""
    bits = item_bits + ANCHOR_BITS if level > 1 and _anchor(level) else item_bits
    return max(1, round(0.65 * bits)), bits


def _probes(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """First place and stride of the probes of a level."""
    a = wordhash._mix(keys + np.uint64(level * GOLD % (1 << 64)))
    return a, (a >> np.uint64(32)) | np.uint64(1)


def _shards(item_bits: int):
    """Rows (shard, key, n, fit), whole shards, to the parts (which, level, shard, bits)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[batch.column(k).to_numpy() for k in range(4)] for batch in batches]
        if not parts:
            return
        shard, keys, n, fit = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(shard, kind="stable")
        shard, keys, tops = shard[order], keys[order].view(np.uint64), {ALL: levels(n[order]), FIT: levels(fit[order])}
        edges = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
        for lo, hi in zip(edges, np.append(edges[1:], len(shard)), strict=True):
            for which, top in tops.items():
                for level in range(1, int(top[lo:hi].max()) + 1):
                    own, (probes, bits) = keys[lo:hi][top[lo:hi] >= level], _shape(level, item_bits)
                    size = len(own) * bits // 8 + 8
                    flags = np.zeros(size * 8, bool)
                    a, b = _probes(own, level)
                    for k in range(probes):
                        flags[wordhash._mix(a + np.uint64(k) * b) % np.uint64(size * 8)] = True
                    yield pa.record_batch([pa.array([which]), pa.array([level]), pa.array([int(shard[lo])]), pa.array([np.packbits(flags, bitorder="little").tobytes()])], names=["which", "level", "shard", "bits"])

    return read


@dataclass
class Filter:
    """Parts from level ``lowest`` up: ``start`` and ``bits`` are [level, shard], byte and bits of
    each part in ``data``, no bits where it is empty."""

    data: np.ndarray
    start: np.ndarray
    bits: np.ndarray
    lowest: int = 1
    item_bits: int = ITEM_BITS

    def _holds(self, keys: np.ndarray, shard: np.ndarray, level: int) -> np.ndarray:
        """Numbers of the keys that the part of ``level`` holds."""
        at = np.flatnonzero(self.bits[level, shard])
        sizes, starts = self.bits[level, shard[at]], self.start[level, shard[at]]
        a, b = _probes(keys[at], level)
        for k in range(_shape(level, self.item_bits)[0]):
            place = wordhash._mix(a + np.uint64(k) * b) % sizes
            held = (self.data[starts + (place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at, sizes, starts, a, b = at[held], sizes[held], starts[held], a[held], b[held]
        return at

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Quantised count of every key; 0 where it is absent, -1 where only lower parts know."""
        shard = (keys % np.uint64(self.bits.shape[1])).astype(np.int64)
        out = np.full(len(keys), 0 if self.lowest == 1 else -1)
        rest = np.arange(len(keys))
        anchors = [n for n in range(self.lowest, len(self.bits)) if _anchor(n)]
        for anchor in reversed(anchors):
            alive = rest[self._holds(keys[rest], shard[rest], anchor)]
            out[alive] = anchor
            rest = rest[out[rest] <= 0]
            for level in range(anchor + 1, min(anchor + ZONE, len(self.bits))):
                alive = alive[self._holds(keys[alive], shard[alive], level)]
                out[alive] = level
        return out


def _shard(key: str, shards: int) -> Column:
    """Unsigned key modulo ``shards``, a power of two."""
    return F.col(key).bitwiseAND(F.lit(shards - 1))


def _assembled(parts: pa.Table, shards: int, lowest: int, item_bits: int) -> Filter:
    """Rows (level, shard, bits) as a filter."""
    level, shard = parts["level"].to_numpy(), parts["shard"].to_numpy()
    size = pc.binary_length(parts["bits"]).to_numpy().astype(np.int64)
    shape = (int(level.max(initial=0)) + 1, shards)
    start, bits = np.zeros(shape, np.int64), np.zeros(shape, np.uint64)
    start[level, shard], bits[level, shard] = np.cumsum(size) - size, size * 8
    data = np.zeros(max(1, int(size.sum())), np.uint8)
    for at, n, part in zip(start[level, shard], size, parts["bits"], strict=True):
        data[at : at + n] = np.frombuffer(part.as_buffer(), np.uint8)
    return Filter(data, start, bits, lowest, item_bits)


def _probe(shards: int, item_bits: int):
    """(key, level) of the asked keys of one shard, by the stored parts of that shard."""

    def probe(asked: pa.Table, held: pa.Table) -> pa.Table:
        keys = asked["key"].to_numpy().view(np.uint64)
        found = _assembled(held, shards, 1, item_bits).level(keys) if len(keys) else np.zeros(0, np.int64)
        return pa.table({"key": pa.array(keys.view(np.int64)), "level": pa.array(found)})

    return probe


@dataclass
class Stored:
    """Parts of both filters in the shared folder."""

    path: str
    shards: int
    item_bits: int

    def parts(self, spark, which: int) -> DataFrame:
        return spark.read.parquet(self.path).filter(F.col("which") == which).select("level", "shard", "bits")

    def levels(self, keys: DataFrame, which: int) -> DataFrame:
        """(key, level) of the distinct keys. Hashed keys spread evenly over the shards."""
        asked = keys.distinct().select(_shard("key", self.shards).alias("to"), "key")
        held = self.parts(keys.sparkSession, which)
        return asked.groupBy("to").cogroup(held.groupBy("shard")).applyInArrow(_probe(self.shards, self.item_bits), "key long, level long")

    def fitting(self, spark, which: int, filter_mb: int) -> Filter:
        """The zones that fit, from the top."""
        stored = self.parts(spark, which)
        sizes = {r["level"]: r["size"] for r in stored.groupBy("level").agg(F.sum(F.octet_length("bits")).alias("size")).collect()}  # one row a level
        top = max(sizes, default=0)
        lowest, used = top - (top - 1) % ZONE + ZONE if top else 1, 0  # none
        for anchor in range(lowest - ZONE, 0, -ZONE):
            used += sum(sizes.get(n, 0) for n in range(anchor, anchor + ZONE))
            if used > filter_mb << 20:
                break
            lowest = anchor
        return _assembled(stored.filter(F.col("level") >= lowest).toArrow(), self.shards, lowest, self.item_bits)  # at most filter_mb


def build_filters(pairs: DataFrame, tokens: int, item_bits: int = ITEM_BITS) -> Stored:
    """Both filters of the (key, n, fit) counts, which are added up by shard in one exchange."""
    shards = 1 << max(4, (tokens // KEYS_PER_SHARD).bit_length())
    summed = pairs.select(_shard("key", shards).alias("shard"), "key", "n", "fit").repartition("shard").groupBy("shard", "key").agg(F.sum("n").alias("n"), F.sum("fit").alias("fit"))
    path = scratch_path(pairs.sparkSession, "filter")
    summed.mapInArrow(_shards(item_bits), "which long, level long, shard long, bits binary").write.parquet(path)
    return Stored(path, shards, item_bits)


@dataclass
class Model:
    filter: Filter
    head: np.ndarray  # sorted token hashes
    head_n: np.ndarray
    total: int
    distinct: int
    starts: int  # rows that were counted
    weights: np.ndarray  # of the bigram, by level of the context

    def base(self, n: np.ndarray) -> np.ndarray:
        return (n + 0.5) / (self.total + 0.5 * (self.distinct + 1))

    def parts(self, tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of every token: exact count, level of its pair and of its context, each -1 where it is
        not broadcast, and the keys of pair and context. Levels of contexts are those of exact counts."""
        kinds, which = np.unique(np.append(tokens, START), return_inverse=True)
        spot = np.minimum(np.searchsorted(self.head, kinds), max(0, len(self.head) - 1))
        known = self.head[spot] == kinds if len(self.head) else np.zeros(len(kinds), bool)
        exact = np.where(known, self.head_n[spot], -1) if len(self.head) else np.full(len(kinds), -1)
        level = np.where(known, levels(exact), -1)
        level[which[-1]] = levels(np.array(self.starts))
        context = _contexts(tokens, first)
        before = np.empty(len(tokens), np.int64)
        before[1:], before[first] = which[:-2], which[-1]
        keys = pair_key(context, tokens)
        pairs, back = np.unique(keys, return_inverse=True)
        return exact[which[:-1]], self.filter.level(pairs)[back], level[before], keys, context

    def estimates(self, exact: np.ndarray, both: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Unigram and bigram estimate, and the level that picks the weight."""
        two = np.where(both > 0, RATIO ** (both - 1.0 - around), 0)  # at most the true share, bar false hits
        return self.base(np.maximum(exact, 0)), np.minimum(two, 1.0), np.clip(around, 0, len(self.weights) - 1)


OPEN = "array<struct<key: long, n: long, pair: long, level: long, context: long, around: long>>"


def _open(first: np.ndarray, at: np.ndarray, tokens: np.ndarray, exact: np.ndarray, both: np.ndarray, around: np.ndarray, keys: np.ndarray, context: np.ndarray) -> pa.Array:
    """For each row the tokens at ``at`` with what is known of them; what is known has no key to ask for."""
    row = np.searchsorted(first, at, "right") - 1
    column = lambda x: pa.array(x[at].view(np.int64))
    asks = lambda x, known: pa.array(x[at].view(np.int64), mask=known[at] >= 0)
    fields = pa.StructArray.from_arrays(
        [asks(tokens, exact), column(exact), asks(keys, both), column(both), asks(context, around), column(around)],
        names=["key", "n", "pair", "level", "context", "around"],
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(first) + 1)), pa.int32()), fields)


def _grid(model):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        sums = np.zeros((len(m.weights), len(GRID)))
        for batch in batches:
            for _, _, raw, limits in wordhash.text_chunks(batch.column(0)):
                exact, both, around, _, _ = m.parts(*_tokens(raw, limits))
                closed = (exact >= 0) & (both >= 0) & (around >= 0)
                one, two, around = m.estimates(exact[closed], both[closed], around[closed])
                for k, w in enumerate(GRID):
                    sums[:, k] += np.bincount(around, np.log10(w * two + (1 - w) * one), len(m.weights))
        used = np.flatnonzero(sums[:, 0])
        yield pa.record_batch([pa.array(used)] + [pa.array(sums[used, k]) for k in range(len(GRID))], names=["level", *[f"g{k}" for k in range(len(GRID))]])

    return read


def _opens(model):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for _, _, raw, limits in wordhash.text_chunks(batch.column(0)):
                tokens, first = _tokens(raw, limits)
                exact, both, around, keys, context = m.parts(tokens, first)
                at = np.flatnonzero((exact < 0) | (both < 0) | (around < 0))
                yield pa.record_batch([_open(first, at, tokens, exact, both, around, keys, context)], names=["open"])

    return read


def _scores(model):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for start, end, raw, limits in wordhash.text_chunks(batch.column(1)):
                tokens, first = _tokens(raw, limits)
                exact, both, around, keys, context = m.parts(tokens, first)
                known = exact >= 0
                closed = known & (both >= 0) & (around >= 0)
                one, two, level = m.estimates(exact, both, around)
                weight = m.weights[level]
                score = np.add.reduceat(np.where(closed, np.log10(weight * two + (1 - weight) * one), 0.0), first)
                base = np.add.reduceat(np.where(known, np.log10(one), 0.0), first)
                n_known = np.add.reduceat(known.astype(np.int64), first)
                size = np.append(first[1:], len(tokens)) - first
                lists = _open(first, np.flatnonzero(~closed), tokens, exact, both, around, keys, context)
                yield pa.record_batch([batch.column(0).slice(start, end - start), pa.array(size), pa.array(n_known), pa.array(base), pa.array(score), lists], names=["id", "n_tokens", "n_known", "base_score", "score", "open"])

    return read


def _looked_up(rows: DataFrame, at: str, table: DataFrame, value: str) -> DataFrame:
    """``rows`` with the value of the key ``at``, 0 where the table (key, found) lacks it; rows
    without a key keep theirs and take no part in the join."""
    joined = rows.filter(F.col(at).isNotNull()).join(table.withColumnRenamed("key", at), at, "left").withColumn(value, F.coalesce("found", F.lit(0)))
    return joined.select(*rows.columns).unionByName(rows.filter(F.col(at).isNull()))


def _closed(rows: DataFrame, model: Model, stored: Stored, which: int, rare: DataFrame) -> DataFrame:
    """``rows`` (open tokens, ``m`` times each) with every count filled in, and one, two, weighted (the level)."""
    if model.filter.lowest > 1:
        asked = rows.filter("pair IS NOT NULL").select(F.col("pair").alias("key"))
        rows = store(_looked_up(rows, "pair", stored.levels(asked, which).withColumnRenamed("level", "found"), "level"), "pairs")
    level = F.when(F.col("n") > 0, F.floor(F.log("n") / F.lit(float(np.log(RATIO))) + 1e-9) + 1).otherwise(0).cast("long")
    rows = store(_looked_up(rows, "context", rare.select("key", level.alias("found")), "around"), "contexts")
    rows = _looked_up(rows.withColumn("joined", F.col("key").isNotNull()), "key", rare.select("key", F.col("n").alias("found")), "n")
    one = (F.col("n") + 0.5) / F.lit(float(model.total) + 0.5 * (model.distinct + 1))
    two = F.when(F.col("level") > 0, F.least(F.pow(F.lit(RATIO), F.col("level") - 1.0 - F.col("around")), F.lit(1.0))).otherwise(0.0)
    return rows.select("*", one.alias("one"), two.alias("two"), F.least("around", F.lit(len(model.weights) - 1)).alias("weighted"))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", filter_mb: int = 80, head_words: int = 500_000, item_bits: int = ITEM_BITS) -> DataFrame:
    """One row for every row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score
    and score, log10 of the probability of the whole text.

    ``filter_mb`` and ``head_words`` bound what is broadcast and change no result; more
    ``item_bits`` mean fewer false hits of the filter. Null text is
    empty: one end token. Null ids are of the fold of the empty text. Repeated rows are scored
    each. With no training rows all counts are zero. Other columns are not touched.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), fold(id_col).alias("fold"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    trained, fits = rows.filter(F.col("fold") != TEST), F.col("fold") != FIT_WEIGHTS
    words = store(counts(trained, "text", False, fits).groupBy("key").agg(F.sum("n").alias("n"), F.sum("fit").alias("fit")), "words")
    start = int(START) - (1 << 64) if int(START) >= 1 << 63 else int(START)
    some = lambda column: F.coalesce(F.sum(column), F.lit(0))
    real = words.filter(F.col("key") != start)
    total, distinct, total_fit, distinct_fit = real.agg(some("n"), F.count("*"), some("fit"), F.count(F.when(F.col("fit") > 0, 1))).first()
    starts, starts_fit = words.filter(F.col("key") == start).agg(some("n"), some("fit")).first()
    stored = build_filters(counts(trained, "text", True, fits), int(total), item_bits)
    least = _head_limit(real, head_words)
    head = real.filter(F.col("n") >= (least or 0)).toPandas().sort_values("key") if least else real.limit(0).toPandas()  # at most head_words rows
    keys = head["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    number = lambda column: head[column].to_numpy(np.int64)[order]
    rare = real.filter(F.col("n") < least) if least else real
    model = Model(stored.fitting(spark, FIT, filter_mb), keys[order], number("fit"), int(total_fit), int(distinct_fit), int(starts_fit), np.zeros(80))
    weights = _fit_weights(rows.filter(F.col("fold") == FIT_WEIGHTS), model, stored, rare.select("key", F.col("fit").alias("n")))
    model = Model(stored.fitting(spark, ALL, filter_mb), keys[order], number("n"), int(total), int(distinct), int(starts), weights)
    shared = spark.sparkContext.broadcast(model)
    scored = rows.select("id", "text").mapInArrow(_scores(shared), f"id {docs.schema[id_col].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double, open " + OPEN)
    kept = store(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    shared.unpersist()
    tail = kept.select("row", F.inline("open"))
    tail = tail.groupBy(*tail.columns).agg(F.count("*").alias("m"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in model.weights]), F.col("weighted").cast("int"))
    added = _closed(tail, model, stored, ALL, rare.select("key", "n")).groupBy("row").agg(
        F.sum(F.when(F.col("joined"), F.col("m") * F.log10("one")).otherwise(0.0)).alias("more"),
        F.sum(F.when(F.col("joined") & (F.col("n") > 0), F.col("m")).otherwise(0)).alias("more_known"),
        F.sum(F.col("m") * F.log10(weight * F.col("two") + (1 - weight) * F.col("one"))).alias("more_score"),
    )
    return kept.join(added, "row", "left").select(
        F.col("id").alias(id_col), (fold("id") == TEST).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def _head_limit(words: DataFrame, head_words: int) -> int | None:
    """Smallest count that no more than ``head_words`` words reach. The words are first counted by
    power of two, then by count inside the one class that the limit lies in."""
    size = F.floor(F.log2("n")).cast("int")
    above, limit = 0, None
    for r in words.groupBy(size.alias("size")).agg(F.count("*").alias("m")).orderBy(F.desc("size")).collect():  # at most 64 rows
        if above + r["m"] > head_words:
            inside = words.filter(size == r["size"]).groupBy("n").agg(F.count("*").alias("m")).orderBy(F.desc("n")).limit(head_words)
            for x in inside.toLocalIterator():
                above += x["m"]
                if above > head_words:
                    return limit
                limit = x["n"]
            return limit
        above, limit = above + r["m"], 1 << r["size"]
    return limit


def _fit_weights(docs: DataFrame, model: Model, stored: Stored, rare: DataFrame) -> np.ndarray:
    """For each level of the context the weight that gives these documents the highest score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"g{k}" for k in range(len(GRID))]
    sums = docs.select("text").mapInArrow(_grid(shared), "level long, " + ", ".join(f"{n} double" for n in names))
    rows = store(docs.select("text").mapInArrow(_opens(shared), "open " + OPEN).select(F.inline("open")), "open")
    rows = rows.groupBy(*rows.columns).agg(F.count("*").alias("m"))
    grid = [F.sum(F.col("m") * F.log10(F.lit(float(w)) * F.col("two") + F.lit(float(1 - w)) * F.col("one"))).alias(n) for n, w in zip(names, GRID, strict=True)]
    sums = sums.unionByName(_closed(rows, model, stored, FIT, rare).groupBy(F.col("weighted").alias("level")).agg(*grid))
    out = np.zeros(len(model.weights))
    for r in sums.groupBy("level").agg(*[F.sum(n).alias(n) for n in names]).collect():  # one row a level
        out[r["level"]] = GRID[int(np.argmax([r[n] for n in names]))]
    shared.unpersist()
    return out
