from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_rows import DOC, documents  # noqa: E402


@pytest.fixture(scope="session")
def docs_rows():
    return documents()


@pytest.fixture(scope="session")
def docs(spark, docs_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    spark.createDataFrame(docs_rows, DOC).coalesce(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    spark.createDataFrame([], DOC).write.parquet(path)
    return spark.read.parquet(path)
