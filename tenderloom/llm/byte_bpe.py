"""Byte-level BPE encoding and decoding by a table of ranks.

Texts are cut into overlapping chunks, which are split into pre-tokens independently.  Two neighbours are
stitched where their pre-token borders agree for the first time in the text that both have seen: what
follows a border does not depend on what came before it, except for white space that may still be part of a
longer run, so a border counts only between a visible character and whatever comes next.  The pieces are then
encoded one by one; every piece that comes again is looked up.  Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import kept_in_worker, slices, small_batches, staged, texts_of

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024
MAX_PIECE = 64
MAX_CACHE = 300_000


class Ranks:
    """Encodes pieces and decodes ids by a file of base64 bytes and ranks."""

    def __init__(self, path: str, pattern: str):
        import base64

        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.model = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.text_of = [str(i) for i in range(len(self.bytes_of))]
        self.splitter = regex.compile(pattern)
        self.known: dict[str, tuple[int, ...]] = {}

    def split(self, text: str) -> list[str]:
        return self.splitter.findall(text)

    def borders(self, text: str) -> list[int]:
        return [m.end() for m in self.splitter.finditer(text)]

    def encode_pieces(self, pieces: list[str]) -> list[int]:
        known, out = self.known, []
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = tuple(self.model.encode_ordinary(piece))
                if len(piece) <= MAX_PIECE:
                    if len(known) >= MAX_CACHE:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decimal(self, ids: list[int]) -> str:
        return ",".join(map(self.text_of.__getitem__, ids))


def ranks_of(path: str, pattern: str) -> Ranks:
    return kept_in_worker(f"ranks {path} {pattern}", lambda: Ranks(path, pattern))


def _chunk_borders(long_texts: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """row, chunk, head, tail: the pre-token borders of each chunk in what it shares with its neighbours."""
    # What a pattern sees beyond a border (a contraction, the rest of white space) may be cut off near the end.
    unsure = 8

    def borders(batches) -> Iterator:
        import pandas as pd

        split = ranks_of(path, pattern).borders
        for batch in batches:
            heads, tails = [], []
            for number, text in zip(batch["chunk"], batch["text"]):
                ends = split(text)
                heads.append([number * chunk + e for e in ends if e <= overlap])
                tails.append([number * chunk + e for e in ends if chunk < e <= chunk + overlap - unsure])
            yield pd.DataFrame({"row": batch["row"], "chunk": batch["chunk"], "head": heads, "tail": tails})

    numbers = F.sequence(F.lit(0), F.floor((F.length("text") - overlap - 1) / chunk).cast("int"))
    chunks = long_texts.select("row", "text", F.explode(numbers).alias("chunk")).select(
        "row", "chunk", F.col("text").substr(F.col("chunk") * chunk + 1, F.lit(chunk + overlap)).alias("text")
    )
    chunks = chunks.repartition(F.xxhash64("row", "chunk"))
    return chunks.mapInPandas(borders, "row long, chunk int, head array<int>, tail array<int>")


def _segments(long_texts: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """row, segment, text: long texts cut at stitched borders.

    If two neighbours share no border, the text from the last stitch on stays in one segment.
    """
    per_row = Window.partitionBy("row").orderBy("chunk")
    stitches = _chunk_borders(long_texts, path, pattern, chunk, overlap).select(
        "row", "chunk", F.array_min(F.array_intersect("tail", F.lead("head").over(per_row))).alias("cut")
    )
    first_missing = F.min(F.when(F.col("cut").isNull(), F.col("chunk")))
    rows = stitches.groupBy("row").agg(
        first_missing.alias("_missing"), F.sort_array(F.collect_list(F.struct("chunk", "cut"))).alias("_cuts")
    )
    cuts = rows.select(
        "row", F.transform(F.filter("_cuts", lambda c: c.chunk < F.col("_missing")), lambda c: c.cut).alias("cuts")
    )
    bounds = cuts.select(
        "row", F.posexplode(F.arrays_zip(F.concat(F.array(F.lit(0)), "cuts").alias("a"), F.concat("cuts", F.array(F.lit(None).cast("int"))).alias("b"))).alias("segment", "ab")
    )
    to = F.coalesce(F.col("ab.b"), F.length("text"))
    segments = long_texts.join(bounds, "row").select(
        "row", "segment", F.col("text").substr(F.col("ab.a") + 1, to - F.col("ab.a")).alias("text")
    )
    return segments.repartition(F.xxhash64("row", "segment"))


def encode_texts(
    docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit) of whole texts, each match of ``pattern`` encoded separately.

    A null text counts as empty and has no ids.  Repeated rows are encoded each.  Other columns are not read.
    """
    def encode(batches) -> Iterator:
        import numpy as np

        ranks = ranks_of(path, pattern)
        for batch in batches:
            texts = texts_of(batch.pop("text"))
            ids = []
            for first, last in slices(texts):
                ids += [np.array(ranks.encode_pieces(ranks.split(t)), "<u4").tobytes() for t in texts[first:last]]
            yield batch.assign(ids=ids)

    small_batches(docs.sparkSession)
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    is_long = F.length("text") > chunk + overlap
    short = narrow.where(~is_long).mapInPandas(encode, "doc_id long, ids binary")
    # Written once, so that the numbers given to rows don't change if a task runs again.
    long_texts = staged(narrow.where(is_long).withColumn("row", F.monotonically_increasing_id()), "long-texts")
    pieces = _segments(long_texts.select("row", "text"), path, pattern, chunk, overlap)
    pieces = pieces.mapInPandas(encode, "row long, segment int, ids binary")
    pieces = pieces.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("segment", "ids"))).alias("_ids"))
    joined = pieces.select("row", F.expr("aggregate(_ids, X'', (b, s) -> concat(b, s.ids))").alias("ids"))
    return short.unionByName(long_texts.select("row", "doc_id").join(joined, "row").select("doc_id", "ids"))


def decode_ids(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: decodes the ids and digests both sides."""

    def decode(batches) -> Iterator:
        import numpy as np
        import pandas as pd

        ranks = ranks_of(path, pattern)
        for batch in batches:
            rows = []
            for data in batch["ids"]:
                ids = np.frombuffer(data, "<u4").tolist()
                digests = (hashlib.sha256(x).hexdigest() for x in (ranks.decimal(ids).encode(), ranks.decode(ids)))
                rows.append((len(ids), *digests))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), out], axis=1)

    small_batches(encoded.sparkSession)
    return encoded.mapInPandas(decode, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
