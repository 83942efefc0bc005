"""Document fingerprints of 128 bits by weighted term votes, and search within a radius.

Terms are pairs of adjacent words (the last word alone too); a term weighs as many votes as it
has characters, so that long pairs count more than stop words. Bit k of the fingerprint is set
where the terms that set it weigh over half. The search keeps one table for each of ``radius + 1``
blocks of the fingerprint: prints within the radius agree in one block, so an equality join of
every block table and a check of the distance finds them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayspan.llm.textops import hex16, lane_votes, majority_bits, words
from wayspan.operators import ordering

BITS = 128
RADIUS = 3
ROWS_PER_BLOCK = 20_000  # of the neighbour search, or more:
BLOCKS = 100_000  # at most about so many, whose split points are broadcast


def votes(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprints (high, low) of the word arrays ``w``, for every row of ``parts``; ``keys``
    tell the rows apart. No words: all bits zero."""
    spots = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - 1, F.lit(0)))).alias("i")
    one, two = F.get(F.col("w"), F.col("i")), F.get(F.col("w"), F.col("i") + 1)
    weight = F.coalesce(F.char_length(one) + F.coalesce(F.char_length(two), F.lit(0)), F.lit(0)).cast("long")
    terms = parts.select(*keys, "w", spots).select(
        *keys, weight.alias("weight"), F.xxhash64(one, two).alias("h0"), F.xxhash64(two, one, F.lit(7)).alias("h1")
    )
    lanes = [F.sum(lane_votes(F.col(h), k) * F.col("weight")).alias(f"{h}_{k}") for h in ("h0", "h1") for k in range(32)]
    sums = terms.groupBy(*keys).agg(F.sum("weight").alias("total"), *lanes)
    bits = {h: majority_bits([F.col(f"{h}_{k}") for k in range(32)], F.col("total")) for h in ("h0", "h1")}
    return sums.select(*keys, bits["h0"].alias("high"), bits["h1"].alias("low"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint of 32 hex digits) for every row; null is the empty text."""
    parts = docs.select(F.monotonically_increasing_id().alias("r"), F.col(id_col), words(F.coalesce(F.col(text_col), F.lit(""))).alias("w"))
    return votes(parts, ["r", id_col]).select(id_col, as_hex("high", "low").alias("fingerprint"))


def as_hex(high: str, low: str) -> Column:
    return F.concat(hex16(F.col(high)), hex16(F.col(low)))


def differing(a: str, b: str) -> Column:
    """Differing bits of two prints held as columns (<a>_high, <a>_low), (<b>_high, <b>_low)."""
    return F.bit_count(F.col(f"{a}_high").bitwiseXOR(F.col(f"{b}_high"))) + F.bit_count(F.col(f"{a}_low").bitwiseXOR(F.col(f"{b}_low")))


def _block(side: str, k: int, blocks: int) -> Column:
    """Block k of the print: its bits put first, the rest masked off."""
    if blocks == 4:
        half = F.col(f"{side}_high" if k < 2 else f"{side}_low")
        return F.shiftrightunsigned(half, 32) if k % 2 == 0 else half.bitwiseAND(F.lit(0xFFFFFFFF))
    text = as_hex(f"{side}_high", f"{side}_low")
    width = BITS // 4
    start, end = k * width // blocks, (k + 1) * width // blocks
    return F.substring(text, start + 1, end - start)


def within(queries: DataFrame, prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Matches between two tables of distinct prints, columns (high, low) each: (q_high, q_low,
    p_high, p_low, bits) for all pairs that differ in ``radius`` bits or fewer, once each."""
    blocks = radius + 1
    if blocks > BITS // 4:
        raise ValueError("radius is too large for blocks of four bits")
    q = queries.select(F.col("high").alias("q_high"), F.col("low").alias("q_low"))
    p = prints.select(F.col("high").alias("p_high"), F.col("low").alias("p_low"))
    tables = lambda df, side: df.select("*", F.posexplode(F.array(*[_block(side, k, blocks) for k in range(blocks)])))
    left = tables(q, "q").withColumnsRenamed({"pos": "k", "col": "v"})
    right = tables(p, "p")
    first = F.coalesce(*[F.when(_block("q", k, blocks) == _block("p", k, blocks), F.lit(k)) for k in range(blocks)])
    bits = differing("q", "p")
    return left.join(right, (F.col("k") == F.col("pos")) & (F.col("v") == F.col("col")) & (bits <= radius)).filter(F.col("k") == first).select(
        "q_high", "q_low", "p_high", "p_low", bits.alias("bits")
    )


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_block: int | None = None) -> DataFrame:
    """Every row with the text of the next row in descending id order (the last is followed by
    the first): (id, key, hash, text, next_key, next_hash, next_text), where (key, hash) tells a text.

    Null ids come last; equal ids go by the hash of the text. Rows are cut at split points from a
    sample of (id, hash), however sparse the ids and however many are null, and each block takes
    its first neighbour from the last row of the block before. Only rows equal in id and text
    cannot be cut apart.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 62)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), F.xxhash64(text).alias("hash"), text.alias("text"))
    size = rows_per_block or max(ROWS_PER_BLOCK, docs.count() // BLOCKS)
    placed = ordering._blocked(rows, [], ["key", "hash"], size)
    entry = F.struct("key", "hash", "text")
    order = Window.partitionBy("_block").orderBy("key", "hash")
    inner = placed.repartition("_block").select("id", "key", "hash", "text", "_block", F.lag(entry).over(order).alias("next"))
    # one row a block
    tops = placed.groupBy("_block").agg(F.max_by(entry, F.struct("key", "hash")).alias("top"))
    above = Window.orderBy("_block")
    largest = F.max_by("top", "_block").over(above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = tops.select(F.col("_block").alias("b"), F.coalesce(F.lag("top").over(above), largest).alias("head"))
    found = inner.join(heads, F.col("_block") == F.col("b")).withColumn("next", F.coalesce("next", "head"))
    return found.select("id", "key", "hash", "text", *[F.col(f"next.{c}").alias(f"next_{c}") for c in ("key", "hash", "text")])
