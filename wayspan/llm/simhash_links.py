"""SimHash near-duplicates through deletion variants of fingerprint segments.

Fingerprints that differ in at most two of 64 bits agree in one half up to one bit. Each half is
therefore indexed under its 32 variants with one bit left out; an equality join on the variants
finds every pair, and the exact distance is checked in the join. A variant shared by more than
``large`` fingerprints is not joined: its fingerprints get all variants of the whole 64 bits with
two bits left out, and fingerprints that share one of these are linked to the smallest of them,
which needs no pairs and is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayspan.llm.components import components
from wayspan.llm.textops import hex16, lane_votes, lower_ascii, majority_bits, settle, words

HALF = 32
RADIUS = 2
LARGE = 1000


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fingerprint long) for every row: majority bits of the XXH64 of its word shingles.

    Null or blank text has fingerprint 0; fewer words than ``shingle`` count as one shingle.
    Repeated rows and null ids stay rows of their own. Other columns are not touched.
    """
    body = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        words(lower_ascii(F.coalesce(F.col(text_col), F.lit("")))).alias("w"),
    ).withColumn("n", F.size("w"))
    starts = F.when(F.col("n") >= shingle, F.sequence(F.lit(0), F.col("n") - shingle)).otherwise(F.array(F.lit(-1)))
    parts = body.select("row", "id", "w", "n", F.explode(starts).alias("i"))
    joined = F.concat_ws(" ", *[F.get(F.col("w"), F.col("i") + k) for k in range(shingle)])
    text = F.when(F.col("i") >= 0, joined).otherwise(F.concat_ws(" ", "w"))
    hashed = parts.select("row", "id", F.when(F.col("n") > 0, F.xxhash64(text)).otherwise(F.lit(0)).alias("h"))
    sums = hashed.groupBy("row", "id").agg(
        F.count("*").alias("n"), *[F.sum(lane_votes(F.col("h"), k)).alias(f"s{k}") for k in range(HALF)]
    )
    return sums.select("id", majority_bits([F.col(f"s{k}") for k in range(HALF)], F.col("n")).alias("fingerprint"))


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _half(value: Column, high: bool) -> Column:
    return F.shiftrightunsigned(value, HALF) if high else value.bitwiseAND(F.lit(0xFFFFFFFF))


def _variants(fps: DataFrame) -> DataFrame:
    """(fp, key) for the 64 variants of the two halves; the low 6 bits of key tell the half and
    the bit left out, the other 32 hold the half."""
    keys = []
    for high in (False, True):
        for bit in range(HALF):
            kept = _half(F.col("fp"), high).bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << bit)))
            keys.append(F.shiftleft(kept, 6).bitwiseOR(F.lit(bit + HALF * high)))
    return fps.select("fp", F.explode(F.array(*keys)).alias("key"))


def _first_key(a: str, b: str) -> Column:
    """Tag of the first variant in which two fingerprints agree, so that a pair is emitted once."""
    x = F.col(a).bitwiseXOR(F.col(b))
    tag = lambda half: F.when(half == 0, F.lit(0)).otherwise(F.bit_count(half - 1))
    low, high = _half(x, False), _half(x, True)
    return F.when(F.bit_count(low) <= 1, tag(low)).otherwise(tag(high) + HALF)


def links(fps: DataFrame, large: int = LARGE) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that give the same components
    as all pairs at two or fewer differing bits; every link is such a pair."""
    index = _variants(fps)
    sizes = index.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = settle(index.join(sizes, "key"))
    usual = shared.filter(F.col("n") <= large).select("key", "fp")
    pairs = (
        usual.select("key", F.col("fp").alias("a"))
        .join(usual.select(F.col("key").alias("k"), F.col("fp").alias("b")), (F.col("key") == F.col("k")) & (F.col("a") < F.col("b")) & (_distance("a", "b") <= RADIUS))
        .filter(F.col("key").bitwiseAND(F.lit(63)) == _first_key("a", "b"))
        .select("a", "b")
    )
    crowd = shared.filter(F.col("n") > large).select("fp").distinct()
    bits = F.explode(F.sequence(F.lit(0), F.lit(62)))
    keyed = (
        crowd.select("fp", bits.alias("i"))
        .select("fp", "i", F.explode(F.sequence(F.col("i") + 1, F.lit(63))).alias("j"))
        .select("fp", (F.col("i") * 64 + F.col("j")).alias("at"), F.col("fp").bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, i) | shiftleft(1L, j)"))).alias("rest"))
    )
    heads = keyed.groupBy("at", "rest").agg(F.min("fp").alias("head"), F.count("*").alias("n")).filter("n > 1")
    stars = keyed.join(heads, ["at", "rest"]).filter("fp <> head").select(F.col("head").alias("a"), F.col("fp").alias("b")).distinct()
    return pairs.union(stars)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, large: int = LARGE) -> DataFrame:
    """One row for every row of ``docs``: id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reachable over fingerprints at two or fewer differing
    bits, the row's own included (null where no reachable row has an id). An empty table gives
    an empty result.
    """
    rows = settle(fingerprints(docs, id_col, text_col, shingle))
    reps = settle(rows.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("id").alias("least")))
    found = components(links(reps.select("fp"), large))
    rooted = reps.join(found, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select(F.col("fp").alias("fingerprint"), "component_id")
    return rows.join(labels, "fingerprint").select(F.col("id").alias(id_col), hex16(F.col("fingerprint")).alias("fingerprint"), "component_id")


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, large: int = LARGE) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id, all columns.

    Rows are told apart by id and text, so different texts under one id are judged each by
    itself; rows without an id come last, ties go by the hash of the text, and of rows equal in
    both one stays. Blank texts are one group, like any other texts of one fingerprint.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("hash"))
    labels = near_groups(docs.select(key.alias("key"), F.col(text_col).alias("body")), "key", "body", shingle, large)
    heads = settle(labels.filter(F.col("key") == F.col("component_id")).groupBy("key").agg(F.count("*").alias("copies")))
    same = docs[id_col].eqNullSafe(heads["key.id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == heads["key.hash"])
    held = lambda which: docs.join(heads.filter(which), same, "left_semi")
    again = held("copies > 1").withColumn("_body", F.coalesce(F.col(text_col), F.lit(""))).dropDuplicates([id_col, "_body"]).drop("_body")
    return held("copies = 1").union(again)
