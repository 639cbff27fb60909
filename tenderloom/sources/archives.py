"""Monthly ZIP archives: CSV members as text rows.

A compressed member cannot be split, so one task reads it, but it opens the archive in place and streams the
member block by block: memory is bounded by the block, not by the archive.  Central directories, which are read first,
say how large the members are; archives are then dealt out by size, and one pass over an archive gives all its members.
"""

from __future__ import annotations

import codecs
import csv
import heapq
import sys
import zipfile
from collections.abc import Iterator, Sequence
from urllib.parse import unquote, urlparse

import pyarrow as pa
import pyarrow.csv as pacsv
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.sources.csv_files import PERIOD_IN_PATH, period_of, technical_columns, text_schema

# Task code travels with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A worker keeps about 50 times a block once it has read many, whatever the size of the member.
BLOCK_BYTES = 1 << 20
MAX_BLOCK_BYTES = 1 << 30
ENTRIES = pa.schema([("path", pa.string()), ("name", pa.string()), ("member", pa.string()), ("size", pa.int64())])
# Schemes that the reader opens in place; others are refused when the load is planned.
SCHEMES = ("", "file", "s3", "s3a", "gs", "gcs", "hdfs", "viewfs")


def _open(uri: str) -> pa.NativeFile:
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return pafs.LocalFileSystem().open_input_file(unquote(parts.path))
    filesystem, path = pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    return filesystem.open_input_file(path)


def _named(name: str) -> str:
    """What a member is called, wherever in the archive it lies."""
    return name.rsplit("/", 1)[-1].lower()


def _member_batches(
    uri: str, member: str, columns: Sequence[str], sep: str = ",", encoding: str = "UTF-8"
) -> Iterator[pa.RecordBatch]:
    """Configured columns of one member, as text; an archive without the member gives nothing."""
    with _open(uri) as raw, zipfile.ZipFile(raw) as archive:
        for name in archive.namelist():
            if _named(name) == member.lower():
                yield from _rows(archive, uri, name, columns, sep, encoding)


def _rows(archive: zipfile.ZipFile, uri: str, name: str, columns, sep: str, encoding: str) -> Iterator[pa.RecordBatch]:
    text = "utf-8-sig" if encoding.lower().replace("-", "") == "utf8" else encoding
    with archive.open(name) as stream:
        header = next(csv.reader(codecs.getreader(text)(stream), delimiter=sep), None)
    if header is None:
        return
    header = [h.strip().lower() for h in header]
    wanted = [c.lower() for c in columns]
    missing = sorted(set(wanted) - set(header))
    if missing:
        raise ValueError(f"{uri}!{name}: columns {missing} are not in the header")
    yield from _parse(lambda: archive.open(name), header, wanted, columns, sep, encoding)


def _parse(open_stream, header, wanted, columns, sep, encoding) -> Iterator[pa.RecordBatch]:
    """Blocks of rows.  A row that does not fit into a block is read again with larger ones, after the rows given."""
    block, given = BLOCK_BYTES, 0
    while True:
        skip = given
        try:
            with open_stream() as stream:
                for batch in _blocks(stream, header, wanted, sep, encoding, block):
                    fresh = batch.slice(min(skip, batch.num_rows))
                    skip -= batch.num_rows - fresh.num_rows
                    given += fresh.num_rows
                    if fresh.num_rows:
                        yield pa.RecordBatch.from_arrays(fresh.columns, names=list(columns))
            return
        except pa.ArrowInvalid as error:
            if "Empty CSV" in str(error):  # a member with a header and no rows
                return
            if "straddling" not in str(error) or block >= MAX_BLOCK_BYTES:
                raise
            block *= 4


def _blocks(stream, header, wanted, sep, encoding, block) -> Iterator[pa.RecordBatch]:
    return pacsv.open_csv(
        pa.PythonFile(stream, mode="r"),
        read_options=pacsv.ReadOptions(
            block_size=block, column_names=header, skip_rows=1, use_threads=False, encoding=encoding
        ),
        parse_options=pacsv.ParseOptions(newlines_in_values=True, delimiter=sep),
        convert_options=pacsv.ConvertOptions(
            column_types={c: pa.string() for c in header},
            include_columns=wanted,
            null_values=[""],
            strings_can_be_null=True,
            quoted_strings_can_be_null=False,
        ),
    )


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Path, length and modification time of the ZIP files under ``folder``; their content is not read."""
    scheme = urlparse(folder).scheme
    if scheme not in SCHEMES:
        raise ValueError(f"archives are opened in place, which {scheme}:// does not allow here; use one of {SCHEMES}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", "true")
    return files.load(folder).select("path", "length", F.col("modificationTime").alias("modified"))


def directory(archives: DataFrame, members: Sequence[str]) -> DataFrame:
    """path, name, member, size of each wanted member of the listed archives, from their central directories alone."""
    wanted = {m.lower(): m for m in members}

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for uri in batch.column("path").to_pylist():
                with _open(uri) as raw, zipfile.ZipFile(raw) as archive:
                    found += [
                        {"path": uri, "name": i.filename, "member": wanted[_named(i.filename)], "size": i.file_size}
                        for i in archive.infolist()
                        if _named(i.filename) in wanted
                    ]
            yield pa.RecordBatch.from_pylist(found, ENTRIES)

    return archives.select("path").mapInArrow(entries, "path string, name string, member string, size long")


def packed(entries: Sequence[tuple[str, str, str, int]], tasks: int) -> list[tuple[int, str, str, str]]:
    """(task, path, name, member) of each entry (path, name, member, size): tasks of nearly equal size.

    The members of an archive stay together, so that it is opened once, unless they are more than a task's share; then each
    member goes by itself, since a member cannot be split.  Largest first, each to the task with the least so far.
    """
    archives: dict[str, list] = {}
    for path, name, member, size in entries:
        archives.setdefault(path, []).append((name, member, size))
    total = sum(e[3] for e in entries)
    pieces = []
    for path, held in archives.items():
        size = sum(h[2] for h in held)
        parts = [held] if len(held) == 1 or size * tasks <= total or len(archives) >= tasks else [[h] for h in held]
        pieces += [(sum(h[2] for h in part), path, part) for part in parts]
    pieces.sort(key=lambda p: (-p[0], p[1], p[2][0][0]))
    loads = [(0, 0, task) for task in range(min(tasks, len(pieces)))]
    out = []
    for size, path, part in pieces:
        # The task with the fewest bytes, then with the fewest pieces: empty members spread out too.
        bytes_, n, task = heapq.heappop(loads)
        heapq.heappush(loads, (bytes_ + size, n + 1, task))
        out += [(task, path, name, member) for name, member, _ in part]
    return out


def read_entries(
    plan: DataFrame, columns: dict[str, Sequence[str]], sep: str = ",", encoding: str = "UTF-8"
) -> DataFrame:
    """member, archive and the values of the member's columns in order, from rows (task, path, name, member) of a plan.

    A task opens each of its archives once and reads all its members one after the other.
    """

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _unzipped([row for batch in batches for row in batch.to_pylist()], columns, sep, encoding)

    return plan.mapInArrow(unzip, text_schema(_numbered(columns)))


def _numbered(columns: dict[str, Sequence[str]]) -> list[str]:
    return ["member", "archive", *[f"c{i}" for i in range(max(len(c) for c in columns.values()))]]


def _unzipped(plan: list[dict], columns: dict[str, Sequence[str]], sep: str, encoding: str) -> Iterator[pa.RecordBatch]:
    wanted: dict[str, list[tuple[str, str]]] = {}
    for row in plan:
        wanted.setdefault(row["path"], []).append((row["name"], row["member"]))
    names = _numbered(columns)
    for uri, entries in wanted.items():
        with _open(uri) as raw, zipfile.ZipFile(raw) as archive:
            for name, member in entries:
                for rows in _rows(archive, uri, name, columns[member], sep, encoding):
                    fixed = [pa.repeat(pa.scalar(v, pa.string()), rows.num_rows) for v in (member, uri)]
                    empty = [pa.nulls(rows.num_rows, pa.string())] * (len(names) - 2 - rows.num_columns)
                    yield pa.RecordBatch.from_arrays([*fixed, *rows.columns, *empty], names=names)


def read_archives(
    spark: SparkSession, paths: Sequence[str], columns: dict[str, Sequence[str]], tasks: int | None = None, **options
) -> DataFrame:
    """Rows of all the members that ``columns`` names, of all these archives, in one pass over each (``read_entries``).

    ``tasks`` is the number of tasks to deal the members out to, by default the larger of the session's parallelism and
    the number of archives; the driver holds a line for each member.
    """
    n = len(paths)
    listed = spark.createDataFrame([(p, i) for i, p in enumerate(paths)], "path string, i int")
    slots = min(n, spark.sparkContext.defaultParallelism)
    found = directory(listed.repartitionById(slots, F.col("i") % slots), list(columns)).collect()
    plan = packed([tuple(r) for r in found], tasks or max(n, spark.sparkContext.defaultParallelism))
    rows = spark.createDataFrame(plan, "task int, path string, name string, member string")
    return read_entries(rows.repartitionById(1 + max([t for t, *_ in plan], default=0), "task"), columns, **options)


def read_members(
    archives: DataFrame,
    member: str,
    columns: Sequence[str],
    batch_id: str,
    period: str | None = None,
    period_pattern: str = PERIOD_IN_PATH,
    sep: str = ",",
    encoding: str = "UTF-8",
) -> DataFrame:
    """Rows of ``member`` in every listed archive, stamped like a CSV load."""
    out_columns = [*columns, "archive"]

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                for rows in _member_batches(uri, member, columns, sep, encoding):
                    archive = pa.repeat(pa.scalar(uri, pa.string()), rows.num_rows)
                    yield pa.RecordBatch.from_arrays([*rows.columns, archive], names=out_columns)

    rows = archives.select("path").mapInArrow(unzip, text_schema(out_columns))
    etl_period = F.lit(period) if period else period_of(F.col("archive"), period_pattern)
    return rows.select(*columns, *technical_columns(etl_period, F.lit(member), batch_id))


def scan_archives(
    spark: SparkSession,
    folder: str,
    member: str,
    columns: Sequence[str],
    batch_id: str,
    period: str | None = None,
    period_pattern: str = PERIOD_IN_PATH,
    **options,
) -> DataFrame:
    """Rows of ``member`` in every ZIP under ``folder``; ``options`` are the dialect (sep, encoding)."""
    archives = list_archives(spark, folder)
    return read_members(archives, member, columns, batch_id, period, period_pattern, **options)
