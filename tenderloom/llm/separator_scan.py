"""Token counts from flat token files without an index.

A token file is nothing but 16-bit little-endian ids.  ``END`` ends a document; ids from ``LABEL_FROM`` on are no tokens
but carry the document's number, ten bits each, with their place in it.  Any task can write such a file in
the order in which it reads documents.

Counting cuts files into blocks of fixed size.  In every block the ends are searched as a vector; documents that lie
within a block are counted there.  The first and last piece of a block are stitched: a prefix scan over the ends
of all blocks before gives each piece the place of its document in the file, and pieces of one place add up.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import small_batches, texts_of
from tenderloom.llm.tokens import WITH_SPACES, encoder

END = 0
LABEL_FROM = 0xE000
LABEL_WORDS = 7
BLOCK_BYTES = 1 << 16
ROWS_PER_FILE = 4_000
FILES = "path string, modificationTime timestamp, length bigint, content binary"
PIECES = "file string, block long, piece long, n_tokens long, label decimal(22,0), labelled boolean, ends boolean"


def label_words(doc_id: int | None) -> list[int]:
    """Seven ids that hold a 64-bit number; a missing one sets the bit above."""
    value = 1 << 64 if doc_id is None else doc_id & ((1 << 64) - 1)
    return [LABEL_FROM | k << 10 | value >> 10 * k & 0x3FF for k in range(LABEL_WORDS)]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Writes whole texts as token files: label, ids plus one (so that 0 is free), end.  A null text counts as empty.

    Spark's text writer puts the bytes down as they are, and its line separator is the end of a document.  The
    vocabulary must stay below ``LABEL_FROM`` - 1 ids.
    """

    def flat(batches) -> Iterator:
        import numpy as np
        import pandas as pd

        encode = encoder(tokenizer, WITH_SPACES).encode
        for batch in batches:
            rows = []
            known = batch["doc_id"].astype("Int64")
            for doc_id, ids in zip(known, encode(texts_of(batch["text"]))):
                tokens = np.frombuffer(ids, "<u4") + 1
                if tokens.max(initial=0) >= LABEL_FROM:
                    raise ValueError("the vocabulary is too large for 16-bit token files")
                label = np.array(label_words(None if doc_id is pd.NA else int(doc_id)), "<u2")
                rows.append(label.tobytes() + tokens.astype("<u2").tobytes())
            yield pd.DataFrame({"value": rows})

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = narrow.mapInPandas(flat, "value binary")
    writer = rows.select(F.col("value").cast("string")).write.option("lineSep", "\x00\x00")
    writer.option("maxRecordsPerFile", str(rows_per_file)).text(path)


def scan_block(data: bytes):
    """(n_tokens, label, labelled, ends) of the pieces of a block, cut after every end."""
    import numpy as np

    ids = np.frombuffer(data, "<u2")
    ends = np.flatnonzero(ids == END)
    bounds = np.concatenate([[0], ends + 1, [len(ids)]])
    is_label = ids >= LABEL_FROM
    before = np.concatenate([[0], np.cumsum(is_label)])
    n = np.diff(bounds) - np.diff(before[bounds])
    n[:-1] -= 1
    at = np.flatnonzero(is_label)
    piece = np.searchsorted(ends, at)
    word = ids[at].astype(np.int64)
    labels = [0] * len(n)
    for p, w in zip(piece.tolist(), word.tolist()):
        labels[p] += (w & 0x3FF) << 10 * (w >> 10 & 0x7)
    return n, labels, np.diff(before[bounds]) > 0, np.arange(len(n)) < len(n) - 1


def count_tokens(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """file, position, doc_id, n_tokens, closed of every document in the files below ``path``.

    ``position`` counts the documents of a file from 0.  Ids after the last end of a file are a document that is
    not closed; a file that stops at an end has none, and an empty file has no document.  ``n_tokens`` is without
    the end.  A file is read by one task, block by block: keep files well below 2 GB, as the writer here does.
    """

    def pieces(batches) -> Iterator:
        from decimal import Decimal

        import numpy as np
        import pandas as pd

        for batch in batches:
            parts = []
            for file, block, data in zip(batch["file"], batch["block"], batch["data"]):
                n, labels, labelled, ends = scan_block(data)
                parts.append(
                    pd.DataFrame(
                        {
                            "file": file,
                            "block": block,
                            "piece": np.arange(len(n)),
                            "n_tokens": n,
                            "label": [Decimal(v) for v in labels],
                            "labelled": labelled,
                            "ends": ends,
                        }
                    )
                )
            if parts:
                yield pd.concat(parts, ignore_index=True)

    if block_bytes % 2:
        raise ValueError("a block holds whole ids")
    small_batches(spark)
    files = spark.read.format("binaryFile").schema(FILES).load(path)
    numbers = F.sequence(F.lit(0), F.floor((F.col("length") - 1) / block_bytes).cast("int"))
    blocks = files.where("length > 0").select(F.col("path").alias("file"), "content", F.explode(numbers).alias("block"))
    data = F.col("content").substr(F.col("block") * block_bytes + 1, F.lit(block_bytes))
    found = blocks.select("file", F.col("block").cast("long").alias("block"), data.alias("data")).mapInPandas(pieces, PIECES)

    # The prefix scan: how many documents end in a file before each block.
    ends = found.groupBy("file", "block").agg(F.sum(F.col("ends").cast("long")).alias("_n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("file", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = found.join(ends, ["file", "block"]).withColumn("position", F.col("_before") + F.col("piece"))
    # The last piece of a block goes on as the first one of the next.
    stitched = placed.groupBy("file", "position").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("label").alias("label"),
        F.max("labelled").alias("labelled"),
        F.max("ends").alias("closed"),
    )
    stitched = stitched.where("n_tokens > 0 OR labelled OR closed")
    top = F.lit("18446744073709551616").cast("decimal(22,0)")
    half = F.lit("9223372036854775808").cast("decimal(22,0)")
    label = F.col("label").cast("decimal(22,0)")
    signed = F.when(label >= half, label - top).otherwise(label).cast("long")
    doc_id = F.when(F.col("labelled") & (label < top), signed)
    return stitched.select("file", "position", doc_id.alias("doc_id"), "n_tokens", "closed")
