"""Canonical length-limited Huffman files of token ids.

Documents in ascending order of doc_id are cut into blocks of whole documents.  Code lengths come from the
counts of all ids by package-merge, codes are canonical, so a code table is its lengths.  A block keeps the
bit offset of every ``CHECKPOINT``-th id: decoding reads a table with the next ``MAX_BITS`` bits and follows all
checkpoints of many blocks side by side, each block without the others.

A folder of this format holds ``codebook`` (id, bits) and ``blocks``, a folder for each part of the order:
part, block, first (ids before the block within its part), doc_ids, lengths, checkpoints, payload.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import small_batches, staged, texts_of
from tenderloom.llm.tokens import WITH_SPACES, encoder
from tenderloom.session import work_folder

BLOCK_IDS = 16_384
CHECKPOINT = 256
MAX_BITS = 20
END_ID = 2
RAW = "part int, block int, first long, doc_ids array<long>, lengths array<long>, ids binary"
CODED = "part int, block int, first long, doc_ids array<long>, lengths array<long>, checkpoints binary, payload binary"


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Bits of each id's code, the least in all with none above ``max_bits``."""
    import numpy as np

    ids = sorted(counts, key=lambda i: (counts[i], i))
    n = len(ids)
    if n <= 1:
        return dict.fromkeys(ids, 1)
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids have no codes of {max_bits} bits")
    leaves = np.array([counts[i] for i in ids], np.float64)
    packages = np.empty(0)
    leaf_before = []  # at each level: how many leaves are among the first k entries
    for _ in range(max_bits):
        merged = np.concatenate([leaves, packages])
        order = np.argsort(merged, kind="stable")
        leaf_before.append(np.concatenate([[0], np.cumsum(order < n)]))
        merged = merged[order]
        even = merged[: len(merged) // 2 * 2]
        packages = even[0::2] + even[1::2]
    bits, take = np.zeros(n, np.int64), 2 * n - 2
    for before in reversed(leaf_before):
        chosen = int(before[take])
        bits[:chosen] += 1
        take = 2 * (take - chosen)
    return {i: int(b) for i, b in zip(ids, bits)}


def code_table(bits: dict[int, int]):
    """(codes, lengths) by id: shorter codes first, then smaller ids."""
    import numpy as np

    size = max(bits, default=-1) + 1
    codes, lengths = np.zeros(size, np.uint64), np.zeros(size, np.int64)
    code, last = 0, 0
    for i in sorted(bits, key=lambda i: (bits[i], i)):
        code <<= bits[i] - last
        codes[i], lengths[i], last = code, bits[i], bits[i]
        code += 1
    return codes, lengths


def encode_block(ids, codes, lengths, every: int = CHECKPOINT) -> tuple[bytes, bytes]:
    """(checkpoints, payload) of one block of ids."""
    import numpy as np

    n = lengths[ids]
    ends = np.cumsum(n)
    starts = ends - n
    word, shift = starts >> 5, (64 - n - (starts & 31)).astype(np.uint64)
    value = codes[ids] << shift
    size = int(ends[-1] if len(ids) else 0) // 32 + 2
    # Codes don't overlap, so adding them up sets their bits; sums stay below 2**32, which doubles hold exactly.
    words = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), size)
    words += np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), size)
    return starts[::every].astype("<u8").tobytes(), words.astype(">u4").tobytes()


def decode_blocks(blocks: list[tuple[int, bytes, bytes]], table, max_bits: int, every: int = CHECKPOINT):
    """The ids of each block of (number of ids, checkpoints, payload), followed from all checkpoints at once."""
    import numpy as np

    base, at, left, payload = 0, [], [], []
    for n, checkpoints, data in blocks:
        offsets = np.frombuffer(checkpoints, "<u8").astype(np.int64)
        at.append(offsets + base * 32)
        left.append(np.minimum(every, n - every * np.arange(len(offsets))))
        payload.append(np.frombuffer(data, ">u4"))
        base += len(payload[-1])
    words = np.concatenate([*payload, np.zeros(2, ">u4")]).astype(np.uint64)
    pairs = (words[:-1] << np.uint64(32)) | words[1:]
    at, left = np.concatenate(at), np.concatenate(left)
    out = np.zeros((every, len(at)), np.uint32)
    # Full runs first, so that those that are over leave at the end.
    order = np.argsort(-left, kind="stable")
    at, left = at[order], left[order]
    drop = np.uint64(64 - max_bits)
    for k in range(int(left.max(initial=0))):
        lanes = int(np.searchsorted(-left, -k))
        pos = at[:lanes]
        window = (pairs[pos >> 5] << (pos & 31).astype(np.uint64)) >> drop
        entry = table[window]
        out[k, :lanes] = entry >> 8
        pos += entry & 0xFF
    flat = np.empty((len(order), every), np.uint32)
    flat[order] = out.T
    flat, first, result = flat.reshape(-1), 0, []
    for n, checkpoints, _ in blocks:
        result.append(flat[first : first + n])
        first += len(checkpoints) // 8 * every
    return result


def decode_table(bits: dict[int, int]):
    """(table, bits of a window): the id that a window begins with, times 256, and the bits of its code."""
    import numpy as np

    max_bits = max(bits.values(), default=1)
    codes, _ = code_table(bits)
    table = np.zeros(1 << max_bits, np.int64)
    for i, n in bits.items():
        first = int(codes[i]) << (max_bits - n)
        table[first : first + (1 << (max_bits - n))] = i << 8 | n
    return table, max_bits


def token_blocks(docs: DataFrame, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of uncoded ids in ascending order of doc_id, null ids first, equal ids by text.

    A null text counts as empty: its document is the end id alone.  Other columns are not read.
    """

    def blocks(batches) -> Iterator:
        import numpy as np
        import pandas as pd
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        encode = encoder(tokenizer, WITH_SPACES).encode
        block, first, doc_ids, ids = 0, 0, [], []

        def row():
            sizes = [len(x) // 4 for x in ids]
            return [part, block, first, doc_ids, sizes, b"".join(ids)], sum(sizes)

        size = 0
        for batch in batches:
            rows = []
            known = batch["doc_id"].astype("Int64")
            for doc_id, text_ids in zip((None if v is pd.NA else int(v) for v in known), encode(texts_of(batch["text"]))):
                doc_ids.append(doc_id)
                ids.append(text_ids + end)
                size += len(text_ids) // 4 + 1
                if size >= block_ids:
                    full, n = row()
                    rows.append(full)
                    block, first, doc_ids, ids, size = block + 1, first + n, [], [], 0
            yield pd.DataFrame(rows, columns=columns)
        if ids:
            yield pd.DataFrame([row()[0]], columns=columns)

    small_batches(docs.sparkSession)
    columns = ["part", "block", "first", "doc_ids", "lengths", "ids"]
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInPandas(blocks, RAW)


def id_counts(blocks: DataFrame) -> dict[int, int]:
    """How often each id occurs in all blocks; as many entries as the vocabulary has at most."""

    def count(batches) -> Iterator:
        import numpy as np
        import pandas as pd

        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch["ids"]:
                own = np.bincount(np.frombuffer(ids, "<u4"))
                if len(own) > len(total):
                    total = np.pad(total, (0, len(own) - len(total)))
                total[: len(own)] += own
        at = np.flatnonzero(total)
        yield pd.DataFrame({"id": at, "n": total[at]})

    counts = blocks.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in counts.collect()}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encodes whole texts and writes them to ``path`` in the format above."""
    spark = docs.sparkSession
    raw = staged(token_blocks(docs, tokenizer, end_id), "token-blocks", compression="zstd")
    bits = code_lengths(id_counts(raw))

    def code(batches) -> Iterator:
        import numpy as np
        import pandas as pd

        codes, lengths = code_table(bits)
        for batch in batches:
            coded = [encode_block(np.frombuffer(ids, "<u4"), codes, lengths) for ids in batch.pop("ids")]
            yield batch.assign(checkpoints=[c for c, _ in coded], payload=[p for _, p in coded])[columns]

    columns = ["part", "block", "first", "doc_ids", "lengths", "checkpoints", "payload"]
    spark.createDataFrame(sorted(bits.items()), "id long, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    coded = raw.mapInPandas(code, CODED).sortWithinPartitions("part", "block")
    coded.write.partitionBy("part").option("compression", "none").parquet(f"{path}/blocks")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    small_batches(spark)
    bits = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/codebook").collect()}  # as many as the vocabulary

    def decode(batches) -> Iterator:
        import numpy as np
        import pandas as pd

        decoding, max_bits = decode_table(bits)
        for batch in batches:
            for k in range(0, len(batch), 128):
                few = batch.iloc[k : k + 128]
                blocks = [(int(sum(n)), c, p) for n, c, p in zip(few["lengths"], few["checkpoints"], few["payload"])]
                rows = []
                for block, (part, first, doc_ids, lengths) in zip(
                    decode_blocks(blocks, decoding, max_bits),
                    zip(few["part"], few["first"], few["doc_ids"], few["lengths"]),
                ):
                    ends = np.cumsum(np.asarray(lengths, np.int64))
                    for doc_id, n, end in zip(doc_ids, lengths, ends):
                        rows.append((part, doc_id, first + end - n, n, block[end - n : end].astype("<u4").tobytes()))
                out = pd.DataFrame(rows, columns=["part", "doc_id", "first", "n_tokens", "ids"])
                yield out.astype({"doc_id": "Int64"})

    blocks = spark.read.schema(CODED).parquet(f"{path}/blocks")
    n = F.expr("aggregate(lengths, 0L, (s, x) -> s + x)")
    # One row for each part of the order, as many as the writer had partitions.
    parts = blocks.groupBy("part").agg(F.sum(n).alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    decoded = blocks.mapInPandas(decode, "part int, doc_id long, first long, n_tokens long, ids binary")
    return decoded.join(F.broadcast(parts), "part").select(
        "doc_id", (F.col("_before") + F.col("first")).alias("start"), "n_tokens", "ids"
    )


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Writes a new folder of the format and reads it again."""
    path = work_folder(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(docs.sparkSession, path)


def ids_crc32(ids) -> int:
    return zlib.crc32(ids)
