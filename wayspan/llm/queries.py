"""Registered queries of this package and their DuckDB text, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayspan.llm import bloom_lm, collocations, debruijn, decontaminate, edit_counts, fingerprints, hard_negatives, language_id, mixing, secrets, sentencepieces, simhash_links, stream_dedup
from wayspan.llm.textops import settle, table, words

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pre-token pattern that belongs to these ranks
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text, and whether decoding them gives the text again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepieces.encode_column(docs, PIECE_MODEL)
    return coded.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "round_trip")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every text before and after three edits: its middle 20 characters are replaced by
    its first 40, ten are cut a third in, and its source is put in front."""
    docs = table(spark, sf_dir, "documents")
    n = F.char_length(F.coalesce("text", F.lit("")))
    change = lambda at, size, new: F.struct(at.cast("int").alias("start"), F.lit(size).alias("length"), new.alias("insert"))
    edits = F.array(
        change(F.floor(n / 2), 20, F.left(F.coalesce("text", F.lit("")), F.lit(40))),
        change(F.floor(n / 3), 10, F.lit("")),
        change(F.lit(0), 0, F.concat(F.coalesce("source", F.lit("")), F.lit("\n"))),
    )
    return edit_counts.recount(docs.select("doc_id", "text", edits.alias("edits")), RANKS, PATTERN)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents (declared: lang, host: source) and pages in one table; ``doc_id`` is null for pages."""
    docs = table(spark, sf_dir, "documents")
    nothing = F.lit(None)
    own = docs.select("doc_id", nothing.cast("long").alias("page_id"), "text", F.col("lang").alias("declared"), nothing.cast("string").alias("suffix"), F.col("source").alias("host"))
    pages = language_id.page_evidence(table(spark, sf_dir, "pages")).select(nothing.cast("long").alias("doc_id"), "page_id", "text", "declared", "suffix", "host")
    model = language_id.train(docs, "doc_id", "text", "lang")
    return language_id.identify(own.unionByName(pages), model).drop("text")


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found, _ = secrets.update(docs, path_col="doc_id")
    rows = secrets.at_paths(docs, secrets.summary(found), path_col="doc_id")
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin([r.kind for r in secrets.BASE]))
    return rows.select(
        "doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in secrets.BASE],
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"), secrets.span_text(F.col("spans")).alias("spans"),
    )


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prints of every text and of its edited form; ``n_within`` (ids divisible by 50): rows,
    itself included, whose prints differ in three bits or fewer."""
    near = fingerprints.with_next(table(spark, sf_dir, "documents")).withColumn("r", F.monotonically_increasing_id())
    n = F.char_length("text")
    moved = F.floor(n / 3).cast("int")
    edited = F.concat(F.left("text", n - moved), F.left("next_text", moved))
    both = near.select(
        "r", "id", "key", "hash", "next_key", "next_hash", n.cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"),
        F.posexplode(F.array("text", edited)).alias("which", "body"),
    )
    keys = ["r", "id", "key", "hash", "next_key", "next_hash", "n_chars", "edited_sha256", "which"]
    prints = fingerprints.votes(both.select(*keys, words(F.col("body")).alias("w")), keys)
    own = F.col("which") == 0
    rows = settle(prints.groupBy(*keys[:-1]).agg(
        F.max(F.when(own, F.col("high"))).alias("a_high"), F.max(F.when(own, F.col("low"))).alias("a_low"),
        F.max(F.when(~own, F.col("high"))).alias("e_high"), F.max(F.when(~own, F.col("low"))).alias("e_low"),
    ))
    # rows of one id and text have one print
    follows = rows.groupBy(F.col("key").alias("next_key"), F.col("hash").alias("next_hash")).agg(F.max(F.struct("a_high", "a_low")).alias("x"))
    follows = follows.select("next_key", "next_hash", F.col("x.a_high").alias("n_high"), F.col("x.a_low").alias("n_low"))
    distinct = rows.groupBy(F.col("a_high").alias("high"), F.col("a_low").alias("low")).agg(F.count("*").alias("n"))
    asked = rows.filter("id % 50 = 0").select(F.col("a_high").alias("high"), F.col("a_low").alias("low")).distinct()
    sizes = distinct.select(F.col("high").alias("p_high"), F.col("low").alias("p_low"), "n")
    found = fingerprints.within(asked, distinct).join(sizes, ["p_high", "p_low"]).groupBy(F.col("q_high").alias("a_high"), F.col("q_low").alias("a_low")).agg(F.sum("n").alias("n_within"))
    likeness = lambda a, b: 1.0 - fingerprints.differing(a, b) / fingerprints.BITS
    return rows.join(follows, ["next_key", "next_hash"], "left").join(found, ["a_high", "a_low"], "left").select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        fingerprints.as_hex("a_high", "a_low").alias("fingerprint"), fingerprints.as_hex("e_high", "e_low").alias("edited_fingerprint"),
        likeness("a", "e").alias("near_edited"), likeness("a", "n").alias("near_next"),
        F.when(F.col("id") % 50 == 0, F.col("n_within")).alias("n_within"),
    )


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_links.near_groups(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stream_dedup.classes(spark, f"{sf_dir}/documents.parquet")
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", mixing.register(F.col("text")).alias("topic"), mixing.token_count(F.col("text")).alias("tokens"))
    return mixing.mix(docs)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = debruijn.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = decontaminate.n_hit(F.col("spans"))
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_token_counts": op3_token_counts,
    "op4_language_id": op4_language_id,
    "op5_secret_scans": op5_secret_scans,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_source_mixing": op9_source_mixing,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_decontamination": op13_decontamination,
}
SQL: dict[str, str] = {
    "op5_secret_scans": secrets.oracle(),
    "op11_collocations": collocations.oracle(),
    "op12_hard_negatives": hard_negatives.oracle(),
    "op13_decontamination": decontaminate.oracle(),
    "op8_exact_dedup": """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM d JOIN g USING (body)""",
}
