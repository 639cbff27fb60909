"""Exact top-k search: tiles of queries and shards, selection per tile, tree merging.

Vectors are packed into matrices: shards of candidates and blocks of queries.  Every pair of a block and a
shard is a tile, dealt out by both numbers; its matrix product is exact and only the k best of each query leave
it.  Lists of ``FAN_IN`` shards are merged at a time, until one is left per query.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 5
SCALE = 256
SHARD_ROWS = 1024
BLOCK_ROWS = 4096
SLICE_ROWS = 512
FAN_IN = 16
EXACT = float(1 << 53)
LONG_MAX = (1 << 63) - 1


def usable_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """id, dim and x (doubles) of the vectors that take part.

    Left out are vectors that are null, or hold a component that is null or not finite once scaled, and rows
    without vec_id, which no result could name.
    """
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), x.alias("x"))
    finite = F.forall("x", lambda v: F.coalesce(F.abs(v * scale) < F.lit(float("inf")), F.lit(False)))
    return rows.where("id IS NOT NULL AND x IS NOT NULL").where(finite).withColumn("dim", F.size("x"))


def _matrices(rows: DataFrame, number: Column, name: str) -> DataFrame:
    """The vectors of one number and dimension as one row, in ascending order of id."""
    packed = F.sort_array(F.collect_list(F.struct("id", "x")))
    rows = rows.withColumn(name, number).groupBy("dim", name).agg(packed.alias("_rows"))
    return rows.select("dim", name, F.col("_rows.id").alias(f"{name}_ids"), F.flatten("_rows.x").alias(f"{name}_x"))


def best_of_tile(queries, query_ids, shard, shard_ids, k: int):
    """(query position, shard position, score) of the k best of each query, best first, ties to the smaller id.

    Matrices hold integers as doubles; ``shard_ids`` ascend.  A score beyond a long's range is an OverflowError, unless it
    is a query's with itself, which is no candidate.
    """
    import numpy as np

    bound = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * max(1, queries.shape[1])
    if bound < EXACT:
        scores = queries @ shard.T
    else:
        whole = [[[int(v) for v in row] for row in m] for m in (queries, shard)]
        exact = [
            [0 if i == j else sum(a * b for a, b in zip(q, s)) for s, j in zip(whole[1], shard_ids)]
            for q, i in zip(whole[0], query_ids)
        ]
        if any(abs(x) > LONG_MAX for row in exact for x in row):
            raise OverflowError("a score does not fit a long")
        scores = np.array(exact, dtype=np.int64).reshape(len(queries), len(shard))
    own = query_ids[:, None] == shard_ids[None, :]
    if scores.dtype != np.int64:
        scores = scores.astype(np.int64)
    others = (~own).sum(axis=1)
    # Below every real score; a real one at the limit is kept apart by `own`.
    ranked = np.where(own, -LONG_MAX - 1, scores)
    n = min(k, ranked.shape[1])
    least = np.partition(ranked, ranked.shape[1] - n, axis=1)[:, ranked.shape[1] - n]
    q, s = np.nonzero((ranked >= least[:, None]) & ~own)
    order = np.lexsort((s, -ranked[q, s].astype(object) if bound >= EXACT else -ranked[q, s], q))
    q, s = q[order], s[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    keep = place < np.minimum(k, others)[q]
    return q[keep], s[keep], scores[q[keep], s[keep]]


def top_k(vectors: DataFrame, query_every: int = 50, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors of the highest integer inner product for each query.

    Queries are the vectors whose id is divisible by ``query_every``; every other row of the same dimension is a
    candidate.  Components count as floor(scale * x).  Ties go to the smaller vec_id.  A query without
    candidates gives no row.  If an id is repeated, all its rows are candidates of other queries, none of its own,
    and the smallest of its vectors is the query.
    """

    def tiles(batches) -> Iterator:
        import numpy as np
        import pandas as pd

        def matrix(ids, x, dim):
            return np.floor(scale * np.asarray(x, np.float64)).reshape(len(ids), dim)

        for batch in batches:
            for row in batch.itertuples(index=False):
                qi, si = np.asarray(row.block_ids, np.int64), np.asarray(row.shard_ids, np.int64)
                queries, shard = matrix(qi, row.block_x, row.dim), matrix(si, row.shard_x, row.dim)
                for first in range(0, len(qi), SLICE_ROWS):
                    part = slice(first, first + SLICE_ROWS)
                    q, s, score = best_of_tile(queries[part], qi[part], shard, si, k)
                    yield pd.DataFrame(
                        {"query_id": qi[part][q], "shard": row.shard, "vec_id": si[s], "score": score.astype(np.int64)}
                    )

    rows = usable_vectors(vectors, scale)
    queries = rows.where(F.col("id") % query_every == 0).groupBy("id", "dim").agg(F.min("x").alias("x"))
    queries = queries.groupBy("id").agg(F.min(F.struct("dim", "x")).alias("q")).select("id", "q.dim", "q.x")
    n_shards = max(1, -(-rows.count() // SHARD_ROWS))
    n_blocks = max(1, -(-queries.count() // BLOCK_ROWS))

    def numbers(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    shards = _matrices(rows, F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int"), "shard")
    blocks = _matrices(queries, F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"), "block")
    # Spark takes the copies of a matrix for one when it estimates sizes: never by broadcast, whatever it believes.
    copies = blocks.withColumn("shard", numbers(n_shards)).hint("merge")
    pairs = shards.withColumn("block", numbers(n_blocks)).join(copies, ["dim", "block", "shard"])
    best = pairs.mapInPandas(tiles, "query_id long, shard int, vec_id long, score long")
    while n_shards > 1:
        best = best.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int"))
        n_shards = -(-n_shards // FAN_IN)
        best = _ranked(best, k, "query_id", "shard").drop("rank")
    return _ranked(best, k, "query_id").select("query_id", "rank", "vec_id", "score")


def _ranked(lists: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
