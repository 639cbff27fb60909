"""Parquet tables: staging history in, contract-shaped model tables out.

A staging table is a folder of loads, each partitioned by period, and a record of those that are complete.  A model is a folder of runs and a record of
which run each model table is published from; a run is published when all of it is written and checked, so
readers never see a part of one.  A run can share files with the one before: it then has a list of its files.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenderloom.functions.calendar import in_last_periods
from tenderloom.operators.joins import HOT_ROWS, spread_join, tasks_for
from tenderloom.schemas import AWARD_LINES, BID_LINES, STAGING, TENDER_LINES, Table
from tenderloom.sources.records import SharedState, subfolders

SUPPLIER_BUCKETS = 32
# About a third less to write, and to keep on disk, than the default.
CODEC = "zstd"


@dataclass(frozen=True)
class Layout:
    """How a fact is laid out in folders: by a whole number made of one column, which is not itself a column of the table."""

    folder: str
    column: str
    number: Callable[[Column], Column]


# In place of secondary indexes, folders and files by the columns that reports filter on.
LAYOUTS = {
    TENDER_LINES.name: Layout("mes_publicacion", "fecha_publicacion", lambda c: F.year(c) * 100 + F.month(c)),
    AWARD_LINES.name: Layout(
        "cubeta_proveedor", "cedula_proveedor", lambda c: F.pmod(F.xxhash64(c), F.lit(SUPPLIER_BUCKETS)).cast("int")
    ),
}
SORT_BY = {
    TENDER_LINES.name: ("fecha_publicacion", "cedula_institucion"),
    BID_LINES.name: ("cedula_proveedor",),
    AWARD_LINES.name: ("cedula_proveedor", "cedula_institucion"),
}


def load_folder(path: str, load_id: str) -> str:
    """Where one load of a staging table lies."""
    return f"{path.rstrip('/')}/load={load_id}"


def staging_loads(spark: SparkSession, path: str) -> SharedState:
    """The complete loads of a staging table: the folder (``load=...``) of each load id, recorded beside the table."""
    return SharedState(spark, f"{path.rstrip('/')}.loads")


def open_loads(spark: SparkSession, path: str) -> SharedState:
    """The record of loads, begun if there is none; loads that lie there without a record are then complete ones."""
    loads = staging_loads(spark, path)
    if not loads.exists():
        there = [f for f in subfolders(spark, path) if f.startswith("load=")]
        loads.change(lambda state: None if loads.exists() else {f.removeprefix("load="): f for f in there})
    return loads


def read_staging_table(spark: SparkSession, path: str, name: str, loads: Sequence[str] | None = None) -> DataFrame:
    """The complete loads of a staging table as of now, or the folders ``loads`` of them.

    A load that is being written, or was never finished, is not read.  A folder without a record of loads is read whole.
    The schema is declared, so a period stays text and nothing is inferred.
    """
    table, root = STAGING[name], path.rstrip("/")
    if loads is None:
        recorded = staging_loads(spark, path)
        loads = sorted(recorded.state().values()) if recorded.exists() else None
    if loads is None:
        return spark.read.schema(table.struct()).parquet(root).select(*table.names)
    if not loads:
        return spark.createDataFrame([], table.struct())
    rows = spark.read.schema(table.struct()).option("basePath", root)
    return rows.parquet(*[f"{root}/{folder}" for folder in loads]).select(*table.names)


def read_staging(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The eight staging tables under ``root``, one folder each."""
    return {name: read_staging_table(spark, f"{root}/{name}", name) for name in STAGING}


def write_staging(df: DataFrame, path: str, load_id: str | None = None, laid_out: bool = False) -> str:
    """Add rows to a staging folder as a load of its own; returns its id.  The same id replaces its load.

    Rows are dealt out by period, and the runtime splits a period that holds a large part of them over many
    tasks by the size of what was shuffled, without reading the input a second time.  Readers see the load when all of
    it is written; a load that replaces another goes to a folder of its own.  ``laid_out`` says that the rows lie by period
    already, few periods to a task: they are then not shuffled, and a task writes a file for each of its periods.
    """
    load_id = load_id or str(uuid.uuid4())
    loads = open_loads(df.sparkSession, path)
    folder = f"load={load_id}" if load_id not in loads.state() else f"load={load_id}.{uuid.uuid4().hex[:8]}"
    write_load(df if laid_out else df.hint("rebalance", "etl_period"), path, folder)
    loads.change(lambda state: {load_id: folder})
    return load_id


def write_load(df: DataFrame, path: str, folder: str) -> None:
    df.write.mode("overwrite").option("compression", CODEC).partitionBy("etl_period").parquet(f"{path.rstrip('/')}/{folder}")


def last_n_periods(df: DataFrame, as_of: dt.date, months: int = 7) -> DataFrame:
    """Rows of the last ``months`` monthly periods; prunes partitions of a staging table."""
    return df.where(in_last_periods(F.col("etl_period"), as_of, months))


def to_contract(df: DataFrame, table: Table) -> DataFrame:
    """Columns picked by name, in contract order and type; a missing column is an error."""
    missing = [c for c in table.names if c not in df.columns]
    if missing:
        raise ValueError(f"{table.name}: missing columns {missing}")
    return df.select(*[F.col(c.name).cast(c.type).alias(c.name) for c in table.columns])


def write_table(df: DataFrame, path: str, sort_by: Sequence[str] = ()) -> None:
    """Idempotent overwrite.

    ``sort_by`` orders the rows inside each file, so that a filter on its first column skips row
    groups and pages by their min/max statistics.  It needs no shuffle, and a value that holds a
    large part of the rows stays spread over the files.
    """
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def write_fact(df: DataFrame, path: str, name: str) -> None:
    """A model table in its layout, if it has one, and sorted inside its files.

    Rows are dealt out by folder; the runtime splits a folder that holds a large part of them over many tasks.  Files
    have Bloom filters of the column that the layout is made of.
    """
    layout, sort_by = LAYOUTS.get(name), SORT_BY.get(name, ())
    if layout is None:
        write_table(df, path, sort_by)
        return
    rows = df.withColumn(layout.folder, layout.number(F.col(layout.column))).hint("rebalance", layout.folder)
    writer = rows.sortWithinPartitions(layout.folder, *sort_by).write.mode("overwrite").partitionBy(layout.folder)
    writer = writer.option("compression", CODEC)
    writer.option(f"parquet.bloom.filter.enabled#{layout.column}", "true").parquet(path)


def read_table(spark: SparkSession, path: str, table: Table) -> DataFrame:
    return spark.read.schema(table.struct()).parquet(path).select(*table.names)


# --- published runs of a model --------------------------------------------------------------------


class OvertakenError(RuntimeError):
    """Another run of the same table was published since this one was begun."""


def run_folder(target: str, run: str, name: str) -> str:
    return f"{target.rstrip('/')}/run={run}/{name}"


def published(spark: SparkSession, target: str) -> SharedState:
    """Of each table the ``run`` that readers take and, if it shares files with earlier runs, ``files``: true."""
    return SharedState(spark, f"{target.rstrip('/')}/published")


def publish(spark: SparkSession, target: str, run: str, names: Sequence[str], laid_out: bool = False) -> None:
    """Make readers of these tables read this run, all at once; ``laid_out`` if ``write_fact`` wrote them."""
    layouts = {name: {"layout": LAYOUTS[name].folder} for name in names if laid_out and name in LAYOUTS}
    publish_versions(spark, target, {name: {"run": run, **layouts.get(name, {})} for name in names})


def publish_versions(
    spark: SparkSession, target: str, versions: dict[str, dict], based_on: dict[str, dict | None] | None = None
) -> None:
    """As ``publish``, for versions that ``replace_keys`` made of the versions ``based_on``: all or none.

    If one of those is no longer the published one, an ``OvertakenError`` says so, and nothing is published.
    """

    def decide(state):
        for name, version in (based_on or {}).items():
            if state.get(name) != version:
                raise OvertakenError(f"{target}: another run of {name} was published meanwhile")
        return versions

    published(spark, target).change(decide)


def read_published(spark: SparkSession, target: str, name: str) -> str:
    """The folder that a name is published from.  Earlier runs stay until someone deletes their folders."""
    return run_folder(target, _version(published(spark, target).state(), target, name)["run"], name)


def _version(state: dict, target: str, name: str) -> dict:
    if name not in state:
        raise ValueError(f"{target}: no run of {name} is published")
    return state[name]


# Where an incremental refresh notes the loads that it has taken in and the runs that it made.
LOADS = "staging loads"


def read_models(spark: SparkSession, target: str, *tables: Table) -> list[DataFrame]:
    """The published versions of several tables, as of one moment."""
    state = published(spark, target).state()
    return [read_version(spark, target, t.name, t.struct(), _version(state, target, t.name)) for t in tables]


def read_model(spark: SparkSession, target: str, table: Table) -> DataFrame:
    """The published version of a model table."""
    return read_models(spark, target, table)[0]


def read_where(spark: SparkSession, target: str, table: Table, value: Column) -> DataFrame:
    """The published rows whose layout column is ``value``, from the one folder that may hold them.

    Versions that an upsert or an incremental refresh has made have no such folders; they are read and filtered.
    """
    layout = LAYOUTS[table.name]
    version = _version(published(spark, target).state(), target, table.name)
    if version.get("layout") != layout.folder:
        rows = read_version(spark, target, table.name, table.struct(), version)
        return rows.where(layout.number(F.col(layout.column)) == layout.number(value))
    schema = table.struct().add(layout.folder, T.IntegerType())
    rows = spark.read.schema(schema).parquet(run_folder(target, version["run"], table.name))
    return rows.where(F.col(layout.folder) == layout.number(value)).select(*table.names)


# --- versions that share files --------------------------------------------------------------------

_RANGES = 200


def _files_folder(target: str, run: str, name: str) -> str:
    return run_folder(target, run, f"{name}.files")


def read_version(spark: SparkSession, target: str, name: str, schema: T.StructType, version: dict | None) -> DataFrame:
    """One version of a stored table; None is a table without rows."""
    if version is None:
        return spark.createDataFrame([], schema)
    if not version.get("files"):
        return spark.read.schema(schema).parquet(run_folder(target, version["run"], name)).select(*schema.names)
    listed = spark.read.parquet(_files_folder(target, version["run"], name)).select("path").collect()
    return _read_files(spark, target, schema, [r.path for r in listed])


def _read_files(spark: SparkSession, target: str, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
    """Rows of these files (their names are known to the driver, as those of any scan are)."""
    if not paths:
        return spark.createDataFrame([], schema)
    root = target.rstrip("/")
    files = spark.read.schema(schema).option("recursiveFileLookup", "true")
    return files.parquet(*[f"{root}/{p}" for p in paths])


def _file_ranges(files: DataFrame, keys: Sequence[str]) -> DataFrame:
    """path (below the model's folder), n_rows, and of each key column lo, hi and the number of nulls, per file."""
    stats = [F.count("*").alias("n_rows")]
    for i, key in enumerate(keys):
        stats += [F.min(key).alias(f"lo_{i}"), F.max(key).alias(f"hi_{i}"), F.count_if(F.col(key).isNull()).alias(f"nulls_{i}")]
    return files.groupBy(_file_path().alias("path")).agg(*stats)


def _listed(spark, target, name, schema, keys, version: dict | None) -> DataFrame | None:
    """The ranges of a version's files, read if they were kept for these keys and else worked out from the key columns."""
    if version is None:
        return None
    if version.get("files") and version.get("keys") == list(keys):
        return spark.read.parquet(_files_folder(target, version["run"], name))
    return _file_ranges(read_version(spark, target, name, schema, version), keys)


def _may_hold(ranges: DataFrame, wanted: DataFrame, key: str) -> list[str]:
    """Files whose range of the first key column meets one of at most ``_RANGES`` ranges that cover the wanted keys."""
    n = min(_RANGES, int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = wanted.select(key).distinct().repartitionByRange(n, key)
    covered = parts.groupBy(F.spark_partition_id()).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.count_if(F.col(key).isNull()).alias("nulls")
    )
    held = F.lit(False)
    for r in covered.collect():
        if r.lo is not None:
            held = held | ((F.col("lo_0") <= F.lit(r.hi)) & (F.col("hi_0") >= F.lit(r.lo)))
        if r.nulls:
            held = held | (F.col("nulls_0") > 0)
    return [r.path for r in ranges.where(F.coalesce(held, F.lit(False))).select("path").collect()]


_PLAIN = {"string": "", "int": 0, "bigint": 0}


def _null_safe(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The keys as columns that are never null: two nulls are then the same key in an ordinary join."""
    names, types = [], dict(df.dtypes)
    for i, key in enumerate(keys):
        plain = F.coalesce(key, F.lit(_PLAIN[types[key]]).cast(types[key]))
        df = df.withColumn(f"_key_{i}", plain).withColumn(f"_null_{i}", F.col(key).isNull())
        names += [f"_key_{i}", f"_null_{i}"]
    return df, names


def _file_path() -> Column:
    return F.regexp_extract("_metadata.file_path", r"(run=[^/]+/[^/]+/(?:[^/]+=[^/]*/)?[^/]+)$", 1)


def read_keys(
    spark: SparkSession,
    target: str,
    name: str,
    schema: T.StructType,
    version: dict | None,
    keys: DataFrame,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The rows under ``keys`` (distinct rows; two nulls are equal), from the files whose ranges may hold them."""
    ranges = _listed(spark, target, name, schema, keys.columns, version)
    if ranges is None:
        return spark.createDataFrame([], schema)
    rows = _read_files(spark, target, schema, _may_hold(ranges, keys, keys.columns[0]))
    wanted, names = _null_safe(keys, keys.columns)
    rows, _ = _null_safe(rows, keys.columns)
    return spread_join(rows, wanted.select(*names), names, "left_semi", hot_rows).select(*schema.names)


def replace_keys(
    spark: SparkSession,
    target: str,
    name: str,
    schema: T.StructType,
    version: dict | None,
    keys: DataFrame,
    rows: DataFrame,
    run: str,
    sort_by: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> tuple[dict | None, dict[str, int]]:
    """A version in which ``rows`` stand for all rows under ``keys``; the other rows stay, copies and all.

    The columns of ``keys`` (distinct rows, read several times) are the key, and two nulls are equal in it.  Files
    without such a key are taken over as they are: the ranges of their first key column rule most of them out,
    and a scan of the key columns of the rest finds those to be written anew.  Returns the version, which is not
    published yet, and the number of files kept, rewritten and added.
    """
    on = keys.columns
    ranges = _listed(spark, target, name, schema, on, version)
    touched: list[str] = []
    if ranges is not None:
        wanted, names = _null_safe(keys, on)
        wanted = wanted.select(*names)
        candidates = _read_files(spark, target, schema, _may_hold(ranges, keys, on[0]))
        if candidates.inputFiles():
            narrow = _null_safe(candidates.select(*on, _file_path().alias("path")), on)[0].select("path", *names)
            held = spread_join(narrow, wanted, names, "left_semi", hot_rows)
            touched = [r.path for r in held.select("path").distinct().collect()]
        old, _ = _null_safe(_read_files(spark, target, schema, touched), on)
        rows = spread_join(old, wanted, names, "left_anti", hot_rows).select(*schema.names).unionByName(rows.select(*schema.names))
    folder = run_folder(target, run, name)
    # By ranges of the first key column, so that later keys meet few files; rows of a large key are spread by their hash.
    ranges_by = [on[0], F.xxhash64(*schema.names)]
    tasks = tasks_for(rows)
    write_table(rows.repartitionByRange(*([tasks] if tasks else []), *ranges_by), folder, sort_by)
    added = _file_ranges(spark.read.schema(schema).parquet(folder), on)
    if ranges is not None:
        gone = spark.createDataFrame([(p,) for p in touched], "path string")
        added = ranges.join(F.broadcast(gone), "path", "left_anti").unionByName(added)
    files = _files_folder(target, run, name)
    added.coalesce(1).write.mode("overwrite").parquet(files)
    # A file without rows has no range and is not listed.
    kept = spark.read.parquet(files)
    new = kept.where(F.col("path").startswith(f"run={run}/")).count()
    report = {"kept": kept.count() - new, "rewritten": len(touched), "added": new}
    return {"run": run, "files": True, "keys": list(on)}, report


def upsert_table(spark: SparkSession, target: str, table: Table, incoming: DataFrame) -> str:
    """Rows of a published table replaced or joined by ``incoming``, stored and published as a new run.

    The incoming rows of a primary key take the place of all rows that have it, a null being equal to a null.  All other
    rows stay as they are, also those that share a key with one another: no winner is chosen, neither among them nor among
    incoming rows.  Applying the same rows again changes nothing.  The old run is read while the new one is written, and
    files without an incoming key belong to both.
    """
    old = _version(published(spark, target).state(), target, table.name)
    run = str(uuid.uuid4())
    new_rows = f"{run_folder(target, run, table.name)}.incoming"
    write_table(to_contract(incoming, table), new_rows)
    new = read_table(spark, new_rows, table)
    if new.isEmpty():
        return old["run"]
    keys = new.select(*table.primary_key).distinct()
    version, _ = replace_keys(spark, target, table.name, table.struct(), old, keys, new, run, SORT_BY.get(table.name, ()))
    publish_versions(spark, target, {table.name: version}, {table.name: old})
    return run
