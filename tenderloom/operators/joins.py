"""Equi-joins that stay balanced when one key holds a large part of the left side."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key is hot from this share of the rows on.  At most 1/HOT_SHARE keys can be, which bounds the
# list that is broadcast (a few MB), and their slots add up to at most 2/HOT_SHARE, which bounds the
# copies of a right side with one row per key.  A slot holds about HOT_SHARE of the rows: 10 million of 10^12.
HOT_SHARE = 1 / 100_000
# Below this many rows a key is never worth spreading.
HOT_ROWS = 1_000_000
# Keys are counted in groups first; an average group holds less than HOT_SHARE of the rows at any size.
_GROUPS = 1 << 17
# A task of a join sorts its rows of both sides; rows of so many bytes of files take it some 100 MB.
TASK_BYTES = 8 << 20


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate lets it broadcast ``df``; no, where a session does not give the estimate."""
    try:
        limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except AttributeError:  # a session without the JVM's objects: spreading is right for any size
        return False
    return int(str(size)) <= limit


def tasks_for(*frames: DataFrame) -> int | None:
    """The number of tasks to deal rows out to, by the files that they are read from; None where the session's is enough."""
    size = 0
    try:
        session = frames[0].sparkSession
        unknown = session._jsparkSession.sessionState().conf().defaultSizeInBytes()
        for df in frames:
            leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
            sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
            size += sum(n for n in sizes if n < unknown)
    except AttributeError:  # a session without the JVM's objects
        return None
    found = math.ceil(size / TASK_BYTES)
    return found if found > int(session.conf.get("spark.sql.shuffle.partitions")) else None


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys that hold at least HOT_SHARE of the rows, with the number of slots to spread them over.

    Groups of keys, by a hash, are counted first: a key can be hot only if its group is, and its rows alone are counted
    by key.  Both counts combine on the map side, so a hot key is one row per task in their shuffles, and a task sends
    at most ``_GROUPS`` rows when no key is hot.  One task adds up the groups, which are ``_GROUPS`` at most, so that ``df``
    is counted in one scan, and read again only where a group is large.  A NULL key is a key like any other here.
    """
    group = F.pmod(F.xxhash64(*keys), F.lit(_GROUPS)).alias("_group")
    narrow = df.select(*keys, group)
    groups = narrow.groupBy("_group").agg(F.count("*").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy())
    slot_rows = F.greatest(total * F.lit(HOT_SHARE), F.lit(float(hot_rows)))
    large = groups.withColumn("_slot_rows", slot_rows).where("_n >= _slot_rows").select("_group", "_slot_rows")
    counts = narrow.join(F.broadcast(large), "_group").groupBy(*keys).agg(
        F.count("*").alias("_n"), F.max("_slot_rows").alias("_slot_rows")
    )
    return counts.where("_n >= _slot_rows").select(
        *keys, F.ceil(F.col("_n") / F.col("_slot_rows")).cast("int").alias("_slots")
    )


def null_safe_match(keys: Sequence[str], names: Sequence[str]) -> Column:
    """Every key equals the column of that name, two NULLs being equal."""
    same_key = F.lit(True)
    for key, name in zip(keys, names):
        same_key = same_key & F.col(key).eqNullSafe(F.col(name))
    return same_key


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "left",
    hot_rows: int = HOT_ROWS,
    stats: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, on, how)`` for ``how`` in inner, left, left_semi, left_anti.

    A right side that Spark estimates as small enough is left to a broadcast join, which has no
    shuffle to skew.  Otherwise the left rows of a hot key are split over several slots by a hash of
    the row, and the right rows of that key are repeated once per slot.  Every left row sits in
    exactly one slot, so the result is the plain join's.  Equal left rows share a slot: reduce a side that
    repeats its rows before joining it.  Sides that are large for the session's number of tasks are dealt out to more
    (``tasks_for``), so that none has to spill.

    ``stats`` names a cheaper frame with the same keys on which to look for hot ones.  It only
    decides how rows are spread, never which rows come out.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    on = list(on)
    if fits_broadcast(right):
        return left.join(right, on, how)

    hot = hot_keys(left if stats is None else stats, on, hot_rows)
    return spread_over(left, right, on, how, hot, tasks_for(left, right))


def spread_over(
    left: DataFrame, right: DataFrame, on: list[str], how: str, found: DataFrame, partitions: int | None = None
) -> DataFrame:
    """``spread_join`` with the ``hot_keys`` that were found before, in ``partitions`` tasks if given."""
    names = [f"_hot_{i}" for i in range(len(on))]
    hot = F.broadcast(found.toDF(*names, "_slots"))
    # NULL-safe, so that rows with a NULL key are spread too, and so that Spark derives no extra
    # filter for the count: it then shares the shuffle that already produced ``left``.
    same_key = null_safe_match(on, names)

    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    slot = F.when(F.col("_slots") > 1, F.pmod(row_hash, F.col("_slots"))).otherwise(F.lit(0)).cast("int")
    spread = left.join(hot, same_key, "left").withColumn("_slot", slot).drop(*names, "_slots")
    slots = F.sequence(F.lit(0), F.coalesce(F.col("_slots"), F.lit(1)) - 1)
    repeated = right.join(hot, same_key, "left").withColumn("_slot", F.explode(slots))
    repeated, dealt = repeated.drop(*names, "_slots"), [*on, "_slot"]
    if partitions is not None:
        # The left rows follow; dealt out here, a semi or anti join would move below that and shuffle them twice.
        repeated = repeated.repartition(partitions, *dealt)
    return spread.join(repeated, dealt, how).drop("_slot")


def all_present(columns: Sequence[str]) -> Column:
    """No column is NULL; plain IS NOT NULL tests, which the scan can use."""
    test = F.col(columns[0]).isNotNull()
    for name in columns[1:]:
        test = test & F.col(name).isNotNull()
    return test
