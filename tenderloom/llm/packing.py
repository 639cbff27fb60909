"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A sequence is filled greedily with the longest piece that still fits.  Then its shortest piece is replaced by
two unpacked pieces if together they fill the widened gap more tightly.

How full a sequence gets depends on lengths alone, and there are at most ``capacity`` of them.  So the method
runs over the number of pieces of each length: one pattern of lengths is repeated as often as those numbers
allow, which makes the plan some thousands of patterns at any input size, from a table of at most ``capacity`` rows.
Pieces are then numbered within their length, in parallel, and every piece finds its place in the plan by
its number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import small_batches, staged, texts_of
from tenderloom.llm.tokens import WORDS_ONLY, encoder

CAPACITY = 2048
END_ID = 0
ROWS_PER_DEAL = 20_000
LEAST_DEALS = 64


class Pattern(NamedTuple):
    """``times`` sequences that hold pieces of these lengths, one after the other."""

    times: int
    lengths: list[int]


def best_two_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use up ``counts``, the number of pieces of each length from 1 to ``capacity``."""
    import numpy as np

    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length} does not fit into {capacity}")
        left[length] = n
    plan = []
    while left.any():
        free, rest, chosen = left.copy(), capacity, []
        while rest and (fits := np.flatnonzero(free[1 : rest + 1])).size:
            length = int(fits[-1]) + 1
            n = min(int(free[length]), rest // length)
            chosen += [length] * n
            free[length] -= n
            rest -= n * length
        if len(chosen) > 1 and rest:
            pair = _tighter_pair(free, chosen[-1], rest + chosen[-1])
            if pair:
                chosen[-1:] = pair
        used = np.bincount(chosen, minlength=capacity + 1)
        at = np.flatnonzero(used)
        times = int((left[at] // used[at]).min())
        left -= times * used
        plan.append(Pattern(times, chosen))
    return plan


def _tighter_pair(free, smallest: int, gap: int) -> list[int] | None:
    """Two free lengths of the largest sum above ``smallest`` and up to ``gap``; the longer one as long as can be."""
    import numpy as np

    for total in range(gap, smallest, -1):
        longer = np.arange(total - 1, (total + 1) // 2 - 1, -1)
        both = (free[longer] > 0) & (free[total - longer] > 0)
        if total % 2 == 0 and longer.size:
            both[-1] = free[total // 2] > 1
        if both.any():
            a = int(longer[both.argmax()])
            return [a, total - a]
    return None


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Token pieces of whole texts: doc_id, piece, start, length, ids_crc32, and ids if asked for.

    A document is its ids and ``end_id``; only one of more than ``capacity`` tokens is cut.  A null text counts
    as empty and gives the end id alone.  Other columns are not read; repeated rows give repeated pieces.
    """

    def pieces(batches) -> Iterator:
        import numpy as np
        import pandas as pd

        end = np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        encode = encoder(tokenizer, WORDS_ONLY).encode
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"], encode(texts_of(batch["text"]))):
                ids += end
                for k in range(0, len(ids), step):
                    part = ids[k : k + step]
                    row = (doc_id, k // step, k // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            out = pd.DataFrame(rows, columns=columns)
            yield out.astype({"doc_id": "Int64"})

    small_batches(docs.sparkSession)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInPandas(pieces, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, length and any others) with sequence_id and offset.

    Lengths run from 1 to ``capacity``.  Offsets in a sequence leave no gap.  Equal rows take different places.
    Rows are numbered within (length, deal), where the deal is a hash of the document: a length that a third of
    all pieces have is spread over all deals.
    """
    spark = pieces.sparkSession
    pieces = staged(pieces, "pieces")
    n = pieces.count()
    deals = max(LEAST_DEALS, -(-n // ROWS_PER_DEAL))
    dealt = pieces.withColumn("_deal", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(deals)))
    per_deal = dealt.groupBy("length", "_deal").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_deal").rowsBetween(Window.unboundedPreceding, -1)
    per_deal = per_deal.select("length", "_deal", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    lengths = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}

    own = Window.partitionBy("length", "_deal").orderBy("doc_id", "piece")
    ranked = dealt.withColumn("_rank", F.row_number().over(own) - 1)
    ranked = ranked.join(per_deal, ["length", "_deal"]).withColumn("_rank", F.col("_rank") + F.col("_before"))

    places = spark.createDataFrame(
        list(_places(best_two_fit(lengths, capacity))),
        "length long, _from long, _to long, _uses long, _sequence long, _offsets array<long>",
    )
    # At most `capacity` lengths and a few patterns each, whatever the input: small enough for every task.
    placed = ranked.join(
        F.broadcast(places), ["length"]
    ).where((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
    nth = F.col("_rank") - F.col("_from")
    return placed.select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(nth / F.col("_uses"))).alias("sequence_id"),
        F.element_at("_offsets", (nth % F.col("_uses")).cast("int") + 1).alias("offset"),
    )


def _places(plan: list[Pattern]) -> Iterator[tuple]:
    """For each length of each pattern: the numbers of the pieces that it takes, and where they go."""
    given: dict[int, int] = {}
    sequence = 0
    for times, lengths in plan:
        offsets: dict[int, list[int]] = {}
        at = 0
        for length in lengths:
            offsets.setdefault(length, []).append(at)
            at += length
        for length, starts in offsets.items():
            first = given.get(length, 0)
            given[length] = first + times * len(starts)
            yield length, first, given[length], len(starts), sequence, starts
        sequence += times


def packed_sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence from pieces packed with their ids: sequence_id, n_tokens, doc_ids, ids."""
    row = F.struct("offset", "doc_id", "length", "ids")
    rows = F.sort_array(F.collect_list(row))
    return packed.groupBy("sequence_id").agg(rows.alias("_rows")).select(
        "sequence_id",
        F.expr("aggregate(_rows, 0L, (n, r) -> n + r.length)").alias("n_tokens"),
        F.col("_rows.doc_id").alias("doc_ids"),
        F.expr("aggregate(_rows, X'', (b, r) -> concat(b, r.ids))").alias("ids"),
    )
