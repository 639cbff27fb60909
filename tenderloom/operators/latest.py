"""Latest version of a record, and the upsert built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.operators.joins import HOT_ROWS, fits_broadcast, hot_keys, null_safe_match, spread_over
from tenderloom.schemas import VERSION


def latest_by(df: DataFrame, keys: Sequence[str], version: Sequence[str] = VERSION) -> DataFrame:
    """One row per key: the highest version, NULL versions first.

    The remaining columns break ties, so the result does not depend on row order or partitioning.
    The rank filter becomes a partial limit before the shuffle: a task sends at most one row per
    key, however many copies of a key it holds.
    """
    rest = [c for c in df.columns if c not in keys and c not in version]
    order = [F.col(c).desc_nulls_first() for c in version] + [F.col(c).asc_nulls_first() for c in rest]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where("_rn = 1").drop("_rn")


def upsert_latest(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], version: Sequence[str] = VERSION
) -> DataFrame:
    """Existing rows replaced or joined by incoming ones; the latest version of each key stays."""
    return latest_by(existing.unionByName(incoming), keys, version)


def latest_join(
    left: DataFrame,
    left_keys: Sequence[str],
    right: DataFrame,
    right_keys: Sequence[str],
    on: Sequence[str],
    hot_rows: int = HOT_ROWS,
    version: Sequence[str] = VERSION,
    clustered: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """The left join of ``latest_by`` of both sides, each side's rows shuffled once; without the version columns.

    Every column of ``on`` must be a key or made of keys, on both sides: all versions of a record then share their join
    key.  Rows are dealt out by the join key, and the latest ones are chosen where the two sides meet.  Rows under a key
    that is hot (``hot_keys``, versions and both sides counted) would fill a task that way: they are reduced by record
    first and then spread.

    ``clustered`` names sides ("left", "right") that lie in buckets by columns of ``on``: Spark compares and joins them
    where they lie, and they are not shuffled at all.  ``partitions`` is the number of tasks to deal rows out to, that of the
    buckets if a side is clustered; without it, it is the session's.  Each task sorts its rows of both sides, so inputs that
    are large for the session's number spill without it.
    """
    on = list(on)

    def latest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return latest_by(df, [*keys, *[c for c in on if c not in keys]], version).drop(*version)

    if fits_broadcast(right):
        return latest(left, left_keys).join(latest(right, right_keys), on, "left")
    hot = hot_keys(left.select(*on).unionByName(right.select(*on)), on, hot_rows)
    names = [f"_hot_{i}" for i in range(len(on))]
    marks = F.broadcast(hot.select(*[F.col(c).alias(n) for c, n in zip(on, names)]))
    same_key = null_safe_match(on, names)
    dealt = [*on] if partitions is None else [partitions, *on]

    def met(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
        rows = df.join(marks, same_key, "left_anti")
        return latest(rows if side in clustered else rows.repartition(*dealt), keys)

    def reduced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return latest(df.join(marks, same_key, "left_semi"), keys)

    few = met(left, left_keys, "left").join(met(right, right_keys, "right"), on, "left")
    return few.unionByName(spread_over(reduced(left, left_keys), reduced(right, right_keys), on, "left", hot))
