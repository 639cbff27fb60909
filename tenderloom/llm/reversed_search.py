"""Ranked lexical search, reversed: the queries are indexed, the documents stream by.

The items that are searched for get an inverted index (term -> items with their number of occurrences), which every
task holds.  A first pass over the documents counts, in each, the terms that the index knows, and writes these counts;
from them come the numbers of documents, of terms, and of documents per term.  A second pass streams each document's counts
through the index, term by term, and updates one bounded heap per item.  A task ends with its heaps, which are merged
in two levels.

Items come in blocks of bounded size, one index and one pair of passes each, so that what is broadcast never grows with
the table of items.  No heap and no broadcast grows with the documents.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import staged, texts_of

K = 10
# Share of a document's relative length in its damping, in hundredths, and the unit of damped counts.
LENGTH_SHARE = 75
TF_UNIT, DAMPING = 1_000_000_000, 8
# About 15 MB of index: (term, item) pairs of one block.
BLOCK_POSTINGS = 400_000
CELLS = 2_000_000
CHUNK = 4_000_000
FAN_IN = 64
LONG = 1 << 62
# Bytes that part terms, and A-Z, which alone are lower-cased.
_PARTS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
TERM_BYTES = bytes(0x20 if c in _PARTS else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def terms_of(text: str, chunk: int = CHUNK) -> Iterator[list[bytes]]:
    """The terms of a whole text in order, in UTF-8, by lists from about ``chunk`` bytes each.

    Every byte of a character beyond ASCII belongs to a term.
    """
    data, low = text.encode().translate(TERM_BYTES), 0
    while low < len(data):
        high = data.find(b" ", low + chunk)
        high = len(data) if high < 0 else high
        yield data[low:high].split()
        low = high


# --- index of the items -----------------------------------------------------------------------------


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, times.  Rows of one id, null included, are one item, which has the terms of all of them."""

    def rows(batches) -> Iterator:
        import pandas as pd

        for batch in batches:
            for i, text in zip(batch["item_id"], texts_of(batch["text"])):
                for found in filter(None, terms_of(text)):
                    yield pd.DataFrame({"item_id": [i] * len(found), "term": [t.decode() for t in found]})

    # A decimal text keeps every id exact beside nulls.
    narrow = items.select(F.col("item_id").cast("long").cast("string"), F.col("text").cast("string"))
    found = narrow.mapInPandas(rows, "item_id string, term string")
    return found.groupBy(F.col("item_id").cast("long").alias("item_id"), "term").agg(F.count("*").alias("times"))


def in_blocks(postings: DataFrame, most: int = BLOCK_POSTINGS) -> list[DataFrame]:
    """The postings by blocks of whole items: at most twice ``most`` rows and those of the longest item."""
    per_item = postings.groupBy("item_id").agg(F.count("*").alias("n"))
    sums = per_item.agg(F.sum("n").alias("n"), F.max("n").alias("longest")).first()
    if not sums.n:
        return []
    blocks = -(-sums.n // most)
    while True:
        block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
        sizes = per_item.groupBy(block.alias("block")).agg(F.sum("n").alias("n")).collect()
        if max(r.n for r in sizes) <= 2 * most + sums.longest:
            return [postings.where(block == r.block) for r in sizes]
        blocks *= 2


def index_of(postings: DataFrame) -> tuple[list, dict[bytes, int], list[int], list[int], list[int]]:
    """The inverted index of one block, which fits the driver and every task by its bound.

    Items (ids); terms with their numbers; and postings, those of term t from ``first[t]`` up to ``first[t + 1]``: the
    item's place and the term's number of times in it.
    """
    rows = sorted(postings.collect(), key=lambda r: (r.term, r.item_id is not None, r.item_id or 0))
    items, terms, first = {}, {}, []
    for i, r in enumerate(rows):
        items.setdefault(r.item_id, len(items))
        if terms.setdefault(r.term.encode(), len(terms)) == len(first):
            first.append(i)
    return list(items), terms, [*first, len(rows)], [items[r.item_id] for r in rows], [r.times for r in rows]


# --- counts of the documents ------------------------------------------------------------------------


def term_counts(docs: DataFrame, index) -> DataFrame:
    """doc_id, n (all terms with repeats), terms and tf (terms of the ``index`` broadcast) of documents with a term."""

    def rows(batches) -> Iterator:
        import numpy as np
        import pandas as pd

        known = index.value[1].get
        for batch in batches:
            counted = []
            for doc, text in zip(batch["doc_id"], texts_of(batch["text"])):
                ids, size = [np.zeros(0, np.int32)], 0
                for found in terms_of(text):
                    size += len(found)
                    ids.append(np.array([t for t in map(known, found) if t is not None], np.int32))
                ids, counts = np.unique(np.concatenate(ids), return_counts=True)
                if size:
                    counted.append((doc, size, ids, counts.astype(np.int32)))
            if counted:
                yield pd.DataFrame(counted, columns=["doc_id", "n", "terms", "tf"])

    # Beside the text nothing but the id is read; a decimal text keeps every id exact beside nulls.
    narrow = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), F.col("text").cast("string"))
    counts = narrow.mapInPandas(rows, "doc_id string, n long, terms array<int>, tf array<int>")
    return counts.withColumn("doc_id", F.col("doc_id").cast("long"))


def damping(n, n_docs: int, n_terms: int, share: int = LENGTH_SHARE):
    """100 - share + (share * n * n_docs) div n_terms of each length, exact at any size."""
    import numpy as np

    if len(n) and share * int(n.max()) * n_docs >= LONG:
        n = n.astype(object)
    return (100 - share + share * n * n_docs // n_terms).astype(np.int64)


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


# --- heaps ------------------------------------------------------------------------------------------


class Heaps:
    """The k best documents of each item: high scores first, then small ids, null ids last."""

    def __init__(self, n_items: int, k: int):
        import numpy as np

        self.k, self.heaps = k, [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)

    def update(self, ids, scores) -> None:
        """Takes scores (documents, items) of documents in ascending order of ``ids``; a null id is None, and last."""
        import numpy as np

        docs, least = len(scores), self.least
        if docs > self.k:
            least = np.maximum(least, np.partition(scores, docs - self.k, axis=0)[docs - self.k])
        item, doc = np.nonzero((scores >= least).T)
        score = scores[doc, item]
        # Documents with the score of the last place may be many; those of small ids come first, the rest cannot stay.
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        keep = np.arange(len(item)) - np.searchsorted(item, item) < self.k
        for i, d, s in zip(item[keep].tolist(), doc[keep].tolist(), score[keep].tolist()):
            entry, heap = (s, ids[d] is not None, -(ids[d] or 0)), self.heaps[i]
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.k:
                self.least[i] = heap[0][0]


def scores_of(terms, tf, lengths, damped, index_arrays, n_items: int):
    """Scores (documents, items); ``terms`` and ``tf`` of all documents one after the other, ``lengths`` of each."""
    import numpy as np

    first, postings, times, weights = index_arrays
    doc = np.repeat(np.arange(len(lengths)), lengths)
    tf = tf.astype(np.int64)
    given = weights[terms] * (TF_UNIT * tf // (1000 * tf + DAMPING * damped[doc]))
    order = np.argsort(terms, kind="stable")
    terms, doc, given = terms[order], doc[order], given[order]
    scores = np.zeros((len(lengths), n_items), np.int64)
    starts = np.flatnonzero(np.diff(terms, prepend=-1))
    for low, high in zip(starts.tolist(), [*starts[1:].tolist(), len(terms)]):
        if low < high and weights[term := terms[low]]:
            here = slice(first[term], first[term + 1])
            scores[doc[low:high, None], postings[here]] += given[low:high, None] * times[here]
    return scores


def _searched(counts: DataFrame, index, weights, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """item_id, doc_id, score, task: what the heaps of each task hold after its documents."""

    def rows(batches) -> Iterator:
        import numpy as np
        import pandas as pd
        from pyspark import TaskContext

        items, _, *postings = index.value
        arrays = [np.array(x, np.int64) for x in (*postings, weights.value)]
        heaps, most = Heaps(len(items), k), max(1, CELLS // len(items))
        for batch in batches:
            ids = [None if i is None else int(i) for i in batch["doc_id"]]
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            for low in range(0, len(order), most):
                part = order[low : low + most]
                terms, tf = [batch["terms"].iloc[i] for i in part], [batch["tf"].iloc[i] for i in part]
                damped = damping(batch["n"].to_numpy()[part], n_docs, n_terms)
                lengths = [len(t) for t in terms]
                scores = scores_of(np.concatenate(terms), np.concatenate(tf), lengths, damped, arrays, len(items))
                heaps.update([ids[i] for i in part], scores)
        found = [(items[i], -e[2] if e[1] else None, e[0]) for i, h in enumerate(heaps.heaps) for e in h]
        out = pd.DataFrame(found, columns=["item_id", "doc_id", "score"], dtype=object)
        out = out.astype({"item_id": "Int64", "doc_id": "Int64", "score": "int64"})
        yield out.assign(task=TaskContext.get().partitionId())

    ids = counts.withColumn("doc_id", F.col("doc_id").cast("string"))
    return ids.mapInPandas(rows, "item_id long, doc_id long, score long, task int")


def _best(lists: DataFrame, k: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# --- search -----------------------------------------------------------------------------------------


def search(docs: DataFrame, items: DataFrame, k: int = K, most: int = BLOCK_POSTINGS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents with a score above 0 for each item, ties by ascending doc_id.

    A document's score sums weight(term) * damped(tf) over the item's terms, repeats included (``weight``,
    ``scores_of``).  Null, empty and termless texts take no part and count nowhere; an item without a term that
    some document holds gives no row.  Every row of ``docs`` is a document: repeated rows rank beside each other, and
    null ids come last among equal scores.  Rows of one item_id are one item.  Other columns are not read.
    """
    spark = docs.sparkSession
    found = None
    for postings in in_blocks(staged(item_terms(items), "items"), most):
        part = _search_block(spark, docs, postings, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


def _search_block(spark: SparkSession, docs: DataFrame, postings: DataFrame, k: int) -> DataFrame:
    index = index_of(postings)
    shared = spark.sparkContext.broadcast(index)
    counts = staged(term_counts(docs, shared), "counts")
    totals = counts.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    holding = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weights = [0] * len(index[1])
    for r in holding.collect():  # at most the terms of the block
        weights[r.term] = weight(totals.docs, r.df)
    heaps = _searched(counts, shared, spark.sparkContext.broadcast(weights), totals.docs, totals.terms, k)
    merged = _best(heaps.withColumn("group", F.floor(F.col("task") / FAN_IN)), k, "item_id", "group").drop("rank")
    return _best(merged, k, "item_id").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
