"""Fill-in-middle: texts cut in three and put together in another order, by displacement of bytes.

A batch of texts is one array of bytes.  A scan finds the bytes of all cuts.  Every byte of a part moves by the same
distance, so a difference array with an entry per part gives, by its cumulative sum, each byte's shift: one numpy
scatter builds all outputs of the batch, sentinels beside them.  Going back, the sentinels of an output tell its parts,
and a gather with the inverse shifts restores the texts.  Arrays beside the batch itself are made block by block, so
memory is a few times a batch, however long its texts are.

Cuts and forms are chosen by Spark from a hash of the document's id; a text and its output never leave their task.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
FORMED, SPM_OF_FORMED = 90, 20
SEED = "1"
BLOCK = 1 << 20
# Parts as prefix 0, middle 1 and suffix 2, in the order of each form's output, after their sentinels.
ORDERS = {PSM: ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), SPM: ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}


def draws(doc_id: Column, seed: str = SEED) -> list[Column]:
    """Four numbers below 2^32 from the sha256 of ``seed:doc_id``; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def planned(docs: DataFrame, formed: int = FORMED, spm: int = SPM_OF_FORMED, seed: str = SEED) -> DataFrame:
    """doc_id, text, n (code points), first, second (the cuts) and form of every row.

    A null text is an empty one.  A text that is empty, or holds a sentinel, stays plain, as do ``100 - formed`` in
    100 of the others.  Rows of one id are cut by the same draws.  Other columns of ``docs`` are not read.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    h = draws(F.col("doc_id"), seed)
    rows = rows.select("*", F.char_length("text").cast("long").alias("n"), *[x.alias(f"h{k}") for k, x in enumerate(h)])
    held = F.col("text").contains(PREFIX) | F.col("text").contains(SUFFIX) | F.col("text").contains(MIDDLE)
    form = (
        F.when((F.col("n") == 0) | held | (F.col("h2") % 100 >= formed), PLAIN)
        .when(F.col("h3") % 100 < spm, SPM)
        .otherwise(PSM)
    )
    x, y = (F.col(h) % (F.col("n") + 1) for h in ("h0", "h1"))
    return rows.select(
        "doc_id", "text", "n", F.least(x, y).alias("first"), F.greatest(x, y).alias("second"), form.alias("form")
    )


# --- arrays -----------------------------------------------------------------------------------------


def texts_array(column):
    """bytes and offsets (from 0) of an Arrow column of texts without nulls."""
    import numpy as np

    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32, column.offset + len(column) + 1)[column.offset :].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def arrow_texts(data, offsets):
    import numpy as np
    import pyarrow as pa

    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))


def cut_bytes(data, n_chars, cuts, block: int = BLOCK):
    """The byte of every cut; ``cuts`` (rows, 2) are code points of the row's text, ascending.

    Bytes that continue a code point start with the bits 10; all others begin one.
    """
    import numpy as np

    before = np.concatenate([[0], np.cumsum(n_chars)])[:-1]
    wanted = (before[:, None] + cuts).ravel()
    found, seen = np.full(len(wanted), len(data), np.int64), 0
    for low in range(0, len(data), block):
        begins = np.flatnonzero((data[low : low + block] & 0xC0) != 0x80)
        i, j = np.searchsorted(wanted, [seen, seen + len(begins)])
        found[i:j] = begins[wanted[i:j] - seen] + low
        seen += len(begins)
    return found.reshape(cuts.shape)


def shift_blocks(starts, shifts, size: int, block: int = BLOCK) -> Iterator:
    """(slice of positions, position + shift of each): ``shifts[k]`` holds from position ``starts[k]`` (ascending) on."""
    import numpy as np

    changes, carry = np.diff(shifts, prepend=0), 0
    for low in range(0, size, block):
        high = min(size, low + block)
        difference = np.zeros(high - low, np.int64)
        i, j = np.searchsorted(starts, [low, high])
        np.add.at(difference, starts[i:j] - low, changes[i:j])
        shift = np.cumsum(difference) + carry
        carry = int(shift[-1])
        yield slice(low, high), np.arange(low, high) + shift


def scatter(data, offsets, cuts, forms, block: int = BLOCK):
    """Output bytes and offsets; ``cuts`` are bytes of the batch, ``forms`` names of forms."""
    import numpy as np

    n = len(offsets) - 1
    begins, ends = np.stack([offsets[:-1], cuts[:, 0], cuts[:, 1]]), np.stack([cuts[:, 0], cuts[:, 1], offsets[1:]])
    plain = forms == PLAIN
    sizes = offsets[1:] - offsets[:-1] + np.where(plain, 0, 9)
    out_offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(out_offsets[-1]), np.uint8)
    targets = begins + (out_offsets[:-1] - offsets[:-1])
    for form, order in ORDERS.items():
        rows = np.flatnonzero(forms == form)
        at = out_offsets[rows]
        for sentinel, part in order:
            out[at[:, None] + np.arange(3)] = np.frombuffer(sentinel.encode(), np.uint8)
            targets[part, rows] = at + 3
            at = at + 3 + ends[part, rows] - begins[part, rows]
    starts, shifts = begins.T.reshape(3 * n), (targets - begins).T.reshape(3 * n)
    for here, there in shift_blocks(starts, shifts, len(data), block):
        out[there] = data[here]
    return out, out_offsets


def gather(out, out_offsets, forms, block: int = BLOCK):
    """Bytes and offsets of the texts that outputs of these forms were made of."""
    import numpy as np

    n = len(out_offsets) - 1
    formed = np.flatnonzero(forms != PLAIN)
    letter = np.isin(out[1:-1], np.frombuffer(b"PSM", np.uint8))
    hits = np.flatnonzero((out[:-2] == ord("<")) & letter & (out[2:] == ord(">")))
    owner = np.searchsorted(out_offsets, hits, side="right") - 1
    own = (forms[owner] != PLAIN) & (hits + 3 <= out_offsets[owner + 1])
    hits, owner = hits[own], owner[own]
    # The texts hold no sentinel and none arises where parts meet one, so there are three to each output.
    if not np.array_equal(owner, np.repeat(formed, 3)):
        raise ValueError("an output does not have the sentinels of its form")
    sources, sizes = np.zeros((3, n), np.int64), np.zeros((3, n), np.int64)
    sources[:] = out_offsets[:-1]
    sizes[0] = out_offsets[1:] - out_offsets[:-1]
    ends = np.empty((len(formed), 3), np.int64)
    hits = hits.reshape(-1, 3)
    ends[:, :2], ends[:, 2] = hits[:, 1:], out_offsets[formed + 1]
    for form, order in ORDERS.items():
        mine = forms[formed] == form
        for k, (sentinel, part) in enumerate(order):
            if np.any(out[hits[mine, k] + 1] != ord(sentinel[1])):
                raise ValueError("an output does not have the sentinels of its form")
            sources[part, formed[mine]] = hits[mine, k] + 3
            sizes[part, formed[mine]] = ends[mine, k] - hits[mine, k] - 3
    flat = sizes.T.reshape(3 * n)
    starts = np.concatenate([[0], np.cumsum(flat)])
    data = np.empty(int(starts[-1]), np.uint8)
    for here, there in shift_blocks(starts[:-1], sources.T.reshape(3 * n) - starts[:-1], len(data), block):
        data[here] = out[there]
    return data, starts[::3]


# --- on Spark ---------------------------------------------------------------------------------------


def _names(column):
    import numpy as np

    return np.array(column.to_pylist(), dtype=object)


def transformed(plan: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars (null if plain) and output, for rows as ``planned`` gives them."""

    def outputs(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            data, offsets = texts_array(batch.column("text"))
            n, first, second = (batch.column(c).to_numpy() for c in ("n", "first", "second"))
            forms = _names(batch.column("form"))
            cuts = cut_bytes(data, n, np.stack([first, second], axis=1))
            columns = [batch.column(c) for c in ("doc_id", "n", "form", "first", "second")]
            out = arrow_texts(*scatter(data, offsets, cuts, forms))
            yield pa.RecordBatch.from_arrays([*columns, out], names=["doc_id", "n", "form", "first", "second", "output"])

    done = plan.mapInArrow(outputs, "doc_id long, n long, form string, first long, second long, output string")
    formed = F.col("form") != PLAIN
    return done.select(
        "doc_id", "n", "form", F.when(formed, F.col("first")).alias("prefix_chars"),
        F.when(formed, F.col("second") - F.col("first")).alias("middle_chars"), "output",
    )


def restored(outputs: DataFrame) -> DataFrame:
    """The rows with ``text``, rebuilt from ``output`` and ``form`` alone."""

    def texts(batches) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            found = arrow_texts(*gather(*texts_array(batch.column("output")), _names(batch.column("form"))))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema.fields)
    return outputs.mapInArrow(texts, f"{schema}, text string")


def round_trip(docs: DataFrame) -> DataFrame:
    """Digests of every document's output and of the text rebuilt from it.

    doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256: one row per row of ``docs``, repeated
    rows included; null and empty texts are plain and empty.  Rows without doc_id are treated as ``planned`` says.
    """
    made = transformed(planned(docs)).withColumn("output_sha256", F.sha2("output", 256))
    back = restored(made).withColumn("restored_sha256", F.sha2("text", 256))
    return back.drop("output", "text")
