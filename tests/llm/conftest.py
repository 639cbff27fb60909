import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

from llm_rows import ODD, SF, frame  # noqa: E402

@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] or "" for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
