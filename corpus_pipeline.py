"""Corpus pipeline: language ID, exact dedup, near-dedup, mixing, SentencePiece ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as a table in
the shared folder and hands the table to the next stage. All stages but the last keep the columns
of ``documents``. What a stage does with nulls, ties and empty tables is told in its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayspan.llm import language_id, mixing, sentencepieces, simhash_links, stream_dedup
from wayspan.llm.queries import PIECE_MODEL
from wayspan.llm.textops import store

PIECES_AT_ONCE = 1 << 20  # bytes of text


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; declared: lang, host: source. Text that is not in a
    language (no letters, or too few) goes."""
    model = language_id.train(docs, "doc_id", "text", "lang")
    rows = docs.withColumns({"declared": F.col("lang"), "suffix": F.lit(None).cast("string"), "host": F.col("source")})
    return language_id.identify(rows, model).filter("accepted").select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for the case of A-Z, the one with the largest id."""
    return stream_dedup.survivors(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that fingerprints (three-word shingles, two of 64 bits) link, the document
    with the smallest id."""
    return simhash_links.survivors(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token shares by source, language and form meet tempered targets."""
    rows = docs.withColumns({"topic": mixing.register(F.col("text")), "tokens": mixing.token_count(F.col("text"))})
    return mixing.mix(rows).filter("sampled").select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece ids, and whether these decode to the text. Workers that keep their
    memory stay beside the other stages here, so less text is encoded at once than usual."""
    return sentencepieces.encode_column(docs, PIECE_MODEL, at_once=PIECES_AT_ONCE)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]
# Text models, drawing by hashes and piece ids cannot be told in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
