"""Distinct tenders per group in a form that adds up: parts of the data are reduced once and merged for any question.

A distinct count of a whole cannot be had from the counts of its parts.  Two forms can be merged instead.  The exact
one numbers the tenders and keeps, per group and block of 32,768 numbers, those words of a bitmap that are not empty;
merging is a bitwise or.  A sparse group is thus no larger than its pairs, and words are merged in hash tables.  The sketch is
HyperLogLog, smaller and approximate, and has a name of its own: no exact question is ever answered by it.  Groups
can be any columns, such as buyer, supplier and month; a report merges them into the groups it asks for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.operators.joins import HOT_ROWS, spread_join
from tenderloom.session import work_folder

# Registers of a sketch are 2**SKETCH_BITS; the relative standard error of its estimate is 1.04 / sqrt of them.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def number_values(df: DataFrame, value: str, known: DataFrame | None = None) -> DataFrame:
    """``value``, number: each distinct value with a number of its own, from 0 without gaps; NULL has none.

    ``known`` are the numbers of earlier parts, which stay; new values go on from there.  Values are numbered within
    sorted ranges, side by side, and each range starts where the ones before it end.
    """
    values = df.select(value).where(F.col(value).isNotNull()).distinct()
    first = 0
    if known is not None:
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
        values = values.join(known.select(value), value, "left_anti")
    folder = work_folder(df.sparkSession, "numbers")
    ranged = values.repartitionByRange(value).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(folder)
    ranged = df.sparkSession.read.schema(ranged.schema).parquet(folder)
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # one row per range
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + first).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(value)) - 1
    new = ranged.withColumn("_place", place).join(F.broadcast(starts), "_range")
    new = new.select(value, (F.col("_start") + F.col("_place")).alias("number"))
    return new if known is None else known.select(value, "number").unionByName(new)


def distinct_parts(
    df: DataFrame, keys: Sequence[str], value: str, numbers: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """keys, block, bits: the numbers of a group's values as bitmaps.  A group of NULL values alone has no row.

    ``bits`` are the words of a bitmap that are not empty, (word, bits) each.
    """
    pairs = df.select(*keys, value).distinct()
    numbered = spread_join(pairs, numbers, [value], "inner", hot_rows)
    block, word = F.shiftright("number", 15).alias("block"), F.expr("cast((number >> 6) & 511 AS smallint)").alias("word")
    bit = F.expr("shiftleft(1L, cast(number & 63 AS int))")
    dealt = numbered.select(*keys, block, word, bit.alias("bits")).repartition(*keys, "block")
    return _packed(dealt.groupBy(*keys, "block", "word").agg(F.bit_or("bits").alias("bits")), keys)


def _packed(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    return words.groupBy(*keys, "block").agg(F.collect_list(F.struct("word", "bits")).alias("bits"))


def _merged_words(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    together = parts[0].select(*keys, "block", "bits")
    for more in parts[1:]:
        together = together.unionByName(more.select(*keys, "block", "bits"))
    words = together.select(*keys, "block", F.inline("bits"))
    return words.groupBy(*keys, "block", "word").agg(F.bit_or("bits").alias("bits"))


def merge_parts(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Parts as one, in the groups of ``keys``, which may be fewer columns than the parts have."""
    return _packed(_merged_words(parts, keys), keys)


def count_exactly(parts: Sequence[DataFrame], keys: Sequence[str], name: str = "carteles") -> DataFrame:
    """keys, ``name``: as ``count_distinct`` over all the rows that the parts were made of."""
    return _merged_words(parts, keys).groupBy(*keys).agg(F.sum(F.bit_count("bits").cast("long")).alias(name))


def sketch_parts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, sketch: one HyperLogLog sketch per group."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(value, SKETCH_BITS).alias("sketch"))


def estimate(parts: Sequence[DataFrame], keys: Sequence[str], name: str = "carteles_estimados") -> DataFrame:
    """keys, ``name``: estimated numbers of distinct values, with a relative standard error of ``SKETCH_ERROR``."""
    together = parts[0].select(*keys, "sketch")
    for more in parts[1:]:
        together = together.unionByName(more.select(*keys, "sketch"))
    merged = together.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*keys, F.hll_sketch_estimate("sketch").alias(name))
