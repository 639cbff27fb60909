"""Incremental load of CSV files and ZIP archives into the staging history.

A manifest says which files were planned for which load, by path, size and modification time.  A load lists its source,
leaves out what the manifest has, and plans the rest in batches of bounded size; a plan counts once it is entered in
the manifest's record, and of two loaders that plan at once the second looks again, so no file is planned twice.  A batch
is then claimed, written to folders of its own, one per staging table, and recorded there as complete, which is when
readers see it.  So a file is loaded once, whenever and from wherever it arrives: back-filled files with old time
stamps, files that come into a window later, files published again under their name, and several manifests or
``write_staging`` on one table all add their rows.

A loader that fails gives its claim back.  The claim of one that was killed ends with its lease, and the next load takes
the batch up under its id: whichever of the two finishes last, its rows are there once.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.functions.calendar import in_last_periods
from tenderloom.schemas import STAGING, TECHNICAL
from tenderloom.session import work_folder
from tenderloom.sources.archives import list_archives, read_archives
from tenderloom.sources.csv_files import (
    PERIOD_IN_PATH,
    csv_options,
    match_columns,
    period_of,
    stamp,
    technical_columns,
    text_schema,
)
from tenderloom.sources.records import SharedState
from tenderloom.sources.tables import open_loads, staging_loads, write_load

# One line per file and staging table that it feeds.
FILES = "path string, length long, modified timestamp, target string, load_id string"
DONE = "load_id string, folder string"
IDENTITY = ["path", "length", "modified"]
FILES_PER_BATCH = 1000
BYTES_PER_BATCH = 1 << 40
LEASE_SEC = 24 * 3600


def _record(spark: SparkSession, folder: str, kind: str, rows: list[tuple], schema: str) -> None:
    """Notes planned ``files`` in a folder of the manifest, or loads of the staging table ``folder`` as ``done``."""
    if kind == "done":
        staging_loads(spark, folder).change(lambda state: dict(rows))
    else:
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(folder)


def _plan_folder(manifest: str, plan: str) -> str:
    return f"{manifest.rstrip('/')}/files/plan={plan}"


def _planned(spark: SparkSession, manifest: str, state: dict) -> DataFrame:
    plans = [_plan_folder(manifest, key.removeprefix("plan ")) for key in state if key.startswith("plan ")]
    return spark.read.schema(FILES).parquet(*plans) if plans else spark.createDataFrame([], FILES)


def _batches(files: Sequence, targets: dict[str, list[str]], most_files: int, most_bytes: int) -> list[list]:
    """Files in order, cut so that a batch feeds the same tables with at most so many files and bytes, one file at least."""
    batches: list[list] = []
    size = 0
    for f in files:
        here = batches[-1] if batches else []
        same = here and targets[here[0].path] == targets[f.path]
        if not same or len(here) >= most_files or size + f.length > most_bytes:
            batches.append([])
            size = 0
        batches[-1].append(f)
        size += f.length
    return batches


def _plan(spark, wanted: DataFrame, targets: Sequence[str], manifest: str, most_files: int, most_bytes: int) -> None:
    """Plans the wanted files for the tables that do not have them yet.

    The files of a load are known to the driver by their listing; their rows never pass it.
    """
    record = SharedState(spark, f"{manifest.rstrip('/')}/record")
    def decide(state):
        # A planned file that has changed since is a new file.
        new = wanted.select(*IDENTITY, F.explode(F.lit(list(targets))).alias("target"))
        new = new.join(_planned(spark, manifest, state), [*IDENTITY, "target"], "left_anti")
        new = new.groupBy(*IDENTITY).agg(F.sort_array(F.collect_list("target")).alias("targets")).orderBy("path").collect()
        if not new:
            return None
        plan, rows, loads = str(uuid.uuid4()), [], []
        for files in _batches(new, {f.path: f.targets for f in new}, most_files, most_bytes):
            loads.append(str(uuid.uuid4()))
            rows += [(*(f[c] for c in IDENTITY), target, loads[-1]) for f in files for target in f.targets]
        _record(spark, _plan_folder(manifest, plan), "files", rows, FILES)
        return {f"plan {plan}": loads}

    record.change(decide)


def _append(
    spark: SparkSession,
    listed: DataFrame,
    wanted: DataFrame,
    targets: dict[str, str],
    manifest: str,
    write: Callable[[list[str], list[str], str], None],
    files_per_batch: int,
    bytes_per_batch: int,
    lease_sec: float,
) -> None:
    """Load the ``wanted`` files that are new, and those of batches that were planned but not done.

    ``targets`` has the folder of each staging table; ``write(paths, tables, folder)`` writes a batch there.
    """
    loads = {name: open_loads(spark, path) for name, path in targets.items()}
    _plan(spark, wanted, list(targets), manifest, files_per_batch, bytes_per_batch)
    record = SharedState(spark, f"{manifest.rstrip('/')}/record")
    done = {name: set(state.state()) for name, state in loads.items()}
    planned = _planned(spark, manifest, record.state()).where(F.col("target").isin(list(targets)))
    finished = [(name, load) for name, ids in done.items() for load in ids]
    finished = spark.createDataFrame(finished, "target string, load_id string")
    batches: dict[str, tuple[dict[str, None], set[str]]] = {}
    open_ = planned.join(finished, ["target", "load_id"], "left_anti").join(listed, IDENTITY, "left_semi")
    for r in open_.orderBy("path", "load_id", "target").collect():
        paths, tables = batches.setdefault(r.load_id, ({}, set()))
        paths[r.path] = None
        tables.add(r.target)
    for load_id, (paths, tables) in batches.items():
        with_claim = _claimed(record, load_id, lease_sec)
        if with_claim is None:
            continue  # another loader is at it
        try:
            if any(load_id not in loads[name].state() for name in tables):
                folder = f"load={load_id}.{with_claim[:8]}"
                write(list(paths), sorted(tables), folder)
                for name in sorted(tables):
                    _record(spark, targets[name], "done", [(load_id, folder)], DONE)
        finally:
            mine = f"claim {load_id}"
            record.change(lambda state: {mine: None} if state.get(mine, {}).get("by") == with_claim else None)


def _claimed(record: SharedState, load_id: str, lease_sec: float) -> str | None:
    """The claim that this loader now has on a batch, or None if another one's has not run out."""
    mine, key = uuid.uuid4().hex, f"claim {load_id}"

    def decide(state):
        held = state.get(key)
        free = held is None or time.time() - held["at"] >= lease_sec
        return {key: {"by": mine, "at": time.time()}} if free else None

    return mine if record.change(decide).get(key, {}).get("by") == mine else None


def _listed(spark: SparkSession, source: str) -> DataFrame:
    """Identities of the CSV files that ``source`` matches; their content is not read."""
    files = spark.read.format("binaryFile").load(source)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def append_staging(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    header: Sequence[str],
    columns: Sequence[str],
    batch_id: str | None = None,
    period: str | None = None,
    period_pattern: str = PERIOD_IN_PATH,
    files_per_batch: int = FILES_PER_BATCH,
    bytes_per_batch: int = BYTES_PER_BATCH,
    lease_sec: float = LEASE_SEC,
    **options,
) -> str:
    """Append the CSV files of ``source`` that ``checkpoint``, the manifest, lacks; returns the batch id.

    ``source`` may be a glob over sub-folders.  A batch has at most so many files and bytes, unless one file alone has
    more.  ``lease_sec`` is how long a claim of a loader that was killed keeps others from its batch.
    """
    batch_id = batch_id or str(uuid.uuid4())

    def write(paths: list[str], tables: list[str], folder: str) -> None:
        files = spark.read.schema(text_schema(header)).options(**csv_options(**options)).csv(paths)
        write_load(stamp(files.select(*match_columns(header, columns)), batch_id, period, period_pattern), target, folder)

    listed = _listed(spark, source)
    _append(spark, listed, listed, {"": target}, checkpoint, write, files_per_batch, bytes_per_batch, lease_sec)
    return batch_id


def append_archives(
    spark: SparkSession,
    folder: str,
    staging_root: str,
    checkpoint_root: str,
    members: dict[str, str],
    as_of: dt.date | None = None,
    months: int = 7,
    batch_id: str | None = None,
    period_pattern: str = PERIOD_IN_PATH,
    files_per_batch: int = FILES_PER_BATCH,
    bytes_per_batch: int = BYTES_PER_BATCH,
    lease_sec: float = LEASE_SEC,
    **options,
) -> str:
    """Append the monthly archives of ``folder`` that were not loaded before to their staging tables.

    ``members`` maps a CSV member to its staging table.  With ``as_of``, only archives of the ``months`` periods up
    to it are loaded and recorded; older and newer ones wait for a load whose window has them.  All tables
    of a load share one batch id, which is returned.  ``options`` are the dialect (sep, encoding).  An archive of a
    batch is read in one pass, whatever the number of its members; its rows go to a working folder and from there to
    the tables.
    """
    batch_id = batch_id or str(uuid.uuid4())
    technical = {c.name for c in TECHNICAL}
    columns = {m: [c for c in STAGING[t].names if c not in technical] for m, t in members.items()}
    listed = list_archives(spark, folder)
    wanted = listed
    if as_of is not None:
        wanted = listed.where(in_last_periods(period_of(F.col("path"), period_pattern), as_of, months))

    def write(paths: list[str], tables: list[str], load: str) -> None:
        chosen = {m: columns[m] for m, t in members.items() if t in tables}
        unzipped = work_folder(spark, "archives")
        read_archives(spark, paths, chosen, **options).write.partitionBy("member").parquet(unzipped)
        width = max(len(c) for c in chosen.values())
        rows = spark.read.schema(text_schema(["member", "archive", *[f"c{i}" for i in range(width)]])).parquet(unzipped)
        for name in tables:
            parts = None
            for member in (m for m, t in members.items() if t == name):
                named = [F.col(f"c{i}").alias(c) for i, c in enumerate(columns[member])]
                period = period_of(F.col("archive"), period_pattern)
                part = rows.where(F.col("member") == member).select(
                    *named, *technical_columns(period, F.lit(member), batch_id)
                )
                parts = part if parts is None else parts.unionByName(part)
            write_load(parts, f"{staging_root.rstrip('/')}/{name}", load)

    targets = {t: f"{staging_root.rstrip('/')}/{t}" for t in members.values()}
    _append(spark, listed, wanted, targets, checkpoint_root, write, files_per_batch, bytes_per_batch, lease_sec)
    return batch_id
