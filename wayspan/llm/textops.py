"""Column expressions and small helpers that the operators of this package share."""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayspan.session import checkpoint_dir

BLANKS = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"
LANES = 0x100000001  # the lowest bit of both 32-bit halves of a long


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` has a fast way for ASCII, where both agree."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def words(text: Column) -> Column:
    """Runs of anything but blank characters, as an array; no words: an empty array."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(F.octet_length(bare) > 0, F.split(bare, SPACES, -1)).otherwise(F.array().cast("array<string>"))


def hex16(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def majority_bits(sums: list[Column], total: Column) -> Column:
    """The long whose bit is set where a lane of ``sums`` is over half of ``total``; sum k holds
    the votes of bit k in its low and of bit k + 32 in its high half."""
    low = F.lit(0xFFFFFFFF)
    out = F.lit(0).cast("long")
    for k, s in enumerate(sums):
        out = out.bitwiseOR(F.when(s.bitwiseAND(low) * 2 > total, F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
        high = 1 << (k + 32)
        high = high - (1 << 64) if high >= 1 << 63 else high
        out = out.bitwiseOR(F.when(F.shiftrightunsigned(s, 32) * 2 > total, F.lit(high)).otherwise(F.lit(0)).cast("long"))
    return out


def lane_votes(value: Column, k: int) -> Column:
    """Bits k and k + 32 of a hash as two counters packed into one long (below 2**32 each)."""
    return F.shiftrightunsigned(value, k).bitwiseAND(F.lit(LANES))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, in the reliable checkpoint folder of the session."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Compute once into a Parquet table in the shared folder and read it from there.

    Spark drops the shuffle files of finished jobs when the driver collects its garbage; it is
    asked to here, so that a job of many steps needs the disk of its largest, not of all.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
