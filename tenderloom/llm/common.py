"""What several operators of this subpackage share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tenderloom.session import work_folder

BATCH_ROWS = 256
SLICE_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Whole texts go to Python: a batch holds few rows, so that its bytes stay bounded by the longest texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def staged(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again: a lost executor repeats nothing before this point."""
    path = work_folder(df.sparkSession, purpose)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(texts: list[str], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``chars`` characters; a longer text is a run of its own."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > chars:
            yield first, i
            first, size = i, 0
        size += len(text)
    if texts:
        yield first, len(texts)


def texts_of(values: Iterable[str | None]) -> list[str]:
    return ["" if v is None else v for v in values]


def kept_in_worker(key: str, make: Callable[[], Any]) -> Any:
    """``make()``, once in each Python worker.

    Task code is sent by value, so its module globals are new in every task; this store outlives them.
    """
    store = sys.modules.setdefault("tenderloom_worker_store", types.ModuleType("tenderloom_worker_store"))
    if not hasattr(store, key):
        setattr(store, key, make())
    return getattr(store, key)
