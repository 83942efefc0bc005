"""Session settings used by the tests, the bench and stand-alone jobs."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "wayspan", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with UTC time and adaptive execution; cluster settings win where present."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # no call-site capture per column expression: it dominates the time to build a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster; a scratch folder only where none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    scratch = os.environ.get("WAYSPAN_SCRATCH") or tempfile.mkdtemp(prefix="wayspan-")
    spark.conf.set("spark.checkpoint.dir", scratch)
    return scratch
