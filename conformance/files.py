"""Driver tables written as CSV files and monthly ZIP archives, for the ingestion queries."""

from __future__ import annotations

import os
import sys
import zipfile
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Task code travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_monthly_csv(df: DataFrame, folder: str, laid_out: bool = False) -> None:
    """One sub-folder of CSV files per period; the period is in the path, not in the files.

    ``laid_out`` says that the rows lie by period already, few periods to a task: they are then not shuffled.
    """
    spread = df if laid_out else df.repartitionByRange("etl_period", "nro_sicop")
    writer = spread.write.partitionBy("etl_period").option("header", True)
    writer.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(folder)


def write_monthly_zips(df: DataFrame, folder: str, member: str, columns: list[str]) -> None:
    """One ZIP per task and period, written batch by batch to a folder all executors share.

    A retried task writes the same name again and replaces it whole.
    """
    if "://" in folder and not folder.startswith("file:"):
        raise ValueError(f"{folder}: ZIP archives for the checks are written to a shared file system only")
    local = urlparse(folder).path

    def zip_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        os.makedirs(local, exist_ok=True)
        period, part = None, None
        for batch in batches:
            periods = batch.column("etl_period").to_pylist()
            start = 0
            while start < len(periods):
                end = start
                while end < len(periods) and periods[end] == periods[start]:
                    end += 1
                if periods[start] != period:
                    if part:
                        part.close()
                    period = periods[start]
                    part = _ZipPart(local, period, task, member, columns)
                part.write(batch.slice(start, end - start).select(columns))
                start = end
        if part:
            part.close()
        yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int32())], names=["task"])

    spread = df.select(*columns, "etl_period").repartitionByRange("etl_period", "nro_sicop")
    ordered = spread.sortWithinPartitions("etl_period")
    ordered.mapInArrow(zip_rows, "task int").agg(F.count("*")).collect()


class _ZipPart:
    """A ZIP with one CSV member, visible under its name only when complete."""

    def __init__(self, folder, period, task, member, columns):
        self.path = f"{folder}/{period}-{task.partitionId():05d}.zip"
        self.partial = f"{self.path}.{task.taskAttemptId()}"
        self.zip = zipfile.ZipFile(self.partial, "w", zipfile.ZIP_DEFLATED)
        self.stream = self.zip.open(member, "w", force_zip64=True)
        self.csv = pacsv.CSVWriter(self.stream, pa.schema([(c, pa.string()) for c in columns]))

    def write(self, batch: pa.RecordBatch) -> None:
        self.csv.write_batch(batch)

    def close(self) -> None:
        self.csv.close()
        self.stream.close()
        self.zip.close()
        os.replace(self.partial, self.path)
