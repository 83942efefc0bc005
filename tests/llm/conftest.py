import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import DOCS, corpus  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    """The corpus as a table of several files, with columns whose names clash with the results'."""
    path = str(tmp_path_factory.mktemp("corpus") / "documents.parquet")
    df = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' AS fingerprint", "1 AS n", "'y' AS id", "2 AS row", "'z' AS language", "3 AS weight", "4 AS piece_ids")
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.filter("doc_id < 0")
