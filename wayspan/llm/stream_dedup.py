"""Exact dedup as a stateful stream: keyed state on disk, never expired, full bytes on hits.

The stream keeps one state entry for each digest in RocksDB: how many rows had it, the largest
id among them and where that row lies (file and row number). The state has no watermark, so a
text that comes back years later still meets its first copies. Rows whose digest is held by
others are then compared byte by byte with the row that stays, fetched by its locator; rows that
only share the digest form classes of their own.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayspan.llm.textops import lower_ascii, scratch_path, store

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # no disk set aside for each small store
}
PER_SALT = 500  # rows of one digest that are compared with one copy of the text that stays


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _located(docs: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    text = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    where = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return docs.select(F.col(id_col).alias("id"), where.alias("at"), text.alias("body")).withColumn("digest", digest(F.col("body")))


def absorb(spark: SparkSession, path: str, state: str, id_col: str = "doc_id", text_col: str = "text", digest=sha256, files_per_batch: int | None = None) -> DataFrame:
    """Feed what is new below ``path`` into the keyed state at ``state`` and return the state:
    (digest, n, id, at). Called again with the same folder it reads only files it has not seen."""
    schema = spark.read.parquet(path).schema
    source = spark.readStream.schema(schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    pattern = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"  # the same path; only as a pattern may it be a single file
    rows = _located(source.parquet(pattern), id_col, text_col, digest).select("digest", F.struct("id", "at").alias("last"))
    with _settings(spark, ROCKSDB):
        query = (
            rows.groupBy("digest").agg(F.count("*").alias("n"), F.max("last").alias("last"))
            .writeStream.outputMode("update").format("noop").option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    held = spark.read.format("statestore").load(state)
    count, last = held.schema["value"].dataType.names
    kept = F.col(f"value.`{last}`")
    return held.select("key.digest", F.col(f"value.`{count}`").alias("n"), kept["id"].alias("id"), kept["at"].alias("at"))


def classes(spark: SparkSession, path: str, state: str | None = None, id_col: str = "doc_id", text_col: str = "text", digest=sha256, files_per_batch: int | None = None) -> DataFrame:
    """One row for every row of the Parquet table at ``path``: id, at (file, row), keep_id,
    group_size, kept, digest.

    Texts are equal when they are after lower-casing A-Z; null is the empty text. The row with
    the largest id stays; null ids come last and ties go to the later place in the files, so
    repeated rows keep exactly one. An empty table gives an empty result.
    """
    held = absorb(spark, path, state or scratch_path(spark, "dedup"), id_col, text_col, digest, files_per_batch)
    held = store(held.select("digest", "n", F.col("id").alias("keep_id"), F.col("at").alias("keep_at")), "dedup-state")
    docs = _located(spark.read.parquet(path), id_col, text_col, digest)
    # texts are shuffled once; those of digests with one row end here
    rows = store(docs.join(held, "digest").select(
        "digest", "id", "at", "n", "keep_id", (F.col("at") == F.col("keep_at")).alias("kept"), F.when(F.col("n") > 1, F.col("body")).alias("body"),
    ), "dedup-rows")
    salts = F.floor(F.col("n") / PER_SALT)
    heads = rows.filter("kept and n > 1").select(
        F.col("digest").alias("d"), F.explode(F.sequence(F.lit(0).cast("long"), salts)).alias("s"), F.col("body").alias("head")
    )
    copies = rows.filter("n > 1").withColumn("salt", F.pmod(F.xxhash64("at"), salts + 1))
    checked = copies.join(heads, (F.col("digest") == F.col("d")) & (F.col("salt") == F.col("s")))
    thin = ["digest", "id", "at", "n", "keep_id", "kept"]
    thin = store(rows.filter("n = 1").select(*thin, F.lit(True).alias("same")).union(checked.select(*thin, (F.col("body") == F.col("head")).alias("same"))), "dedup-thin")
    odd = thin.filter("not same")
    if odd.isEmpty():
        return thin.select("id", "at", "keep_id", F.col("n").alias("group_size"), "kept", "digest")
    return _apart(thin, odd, docs)


def _apart(thin: DataFrame, odd: DataFrame, docs: DataFrame) -> DataFrame:
    """The classes where different texts share a digest: these rows are grouped by the text."""
    clash = odd.select("digest").distinct()
    texts = docs.join(clash, "digest").select("digest", "id", "at", "body")
    groups = texts.groupBy("digest", "body").agg(F.count("*").alias("group_size"), F.max(F.struct("id", "at")).alias("last"))
    again = texts.join(groups, ["digest", "body"]).select(
        "id", "at", F.col("last.id").alias("keep_id"), "group_size", (F.col("at") == F.col("last.at")).alias("kept"), "digest"
    )
    return thin.join(clash, "digest", "left_anti").select("id", "at", "keep_id", F.col("n").alias("group_size"), "kept", "digest").unionByName(again)


def survivors(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without exact copies: one row of each class, all columns. The rows are written
    once to the shared folder, since a stream reads files."""
    path = scratch_path(spark, "dedup-input")
    docs.write.parquet(path)
    kept = classes(spark, path, None, id_col, text_col).filter("kept").select("at")
    stored = spark.read.parquet(path)
    where = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return stored.select(*stored.columns, where.alias("at")).join(kept, "at", "left_semi").select(*stored.columns)
