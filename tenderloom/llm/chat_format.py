"""Conversations as training text: a compiled template renders turns, and what it marks as generated is the loss mask.

Rows are dealt out by conversation and streamed in order, one turn behind, so that the template knows the last one; a
task holds one turn and one part of text, however long a conversation is.  A conversation of very many turns is cut into
slots of neighbouring turns, each knowing the number of turns before it, and its slots are rendered side by side.

Texts are written with escapes, so that the template's control strings alone mark turns.  ``read_turns`` gets the turns
and the generated texts back from the output alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderloom.llm.common import kept_in_worker
from tenderloom.llm.template import Program, Written, compile_template

CHAT = """
{%- control '<chat>', '<turn>', '<says>', '</turn>', '</chat>' -%}
{%- set newline = '\\n' -%}
{{ '<chat>' ~ newline }}
{%- for message in messages -%}
    {{ '<turn>' }}{{ message.role | escape }}{{ '<says>' }}
    {%- if message.role == 'assistant' -%}
        {%- generation -%}{{ message.text | escape }}{%- endgeneration -%}
    {%- else -%}
        {{ message.text | escape }}
    {%- endif -%}
    {{ '</turn>' ~ newline }}
{%- endfor -%}
{{ '</chat>' ~ newline -}}
"""
OPEN, TURN, SAYS, CLOSE, END = "<chat>\n", "<turn>", "<says>", "</turn>", "</chat>\n"
GENERATED = "assistant"
# A conversation is cut into slots above this many turns, or above this share of all turns, which bounds their list.
SLOT_TURNS, SLOT_SHARE = 1000, 1 / 10_000
PART_CHARS = 1_000_000
ROWS_AT_ONCE = 500

PARTS = "conv_id string, slot long, seq int, whole boolean, text string, spans array<struct<start: long, end: long>>"


def _slots(rows: DataFrame, slot_turns: int) -> DataFrame | None:
    """conv_id, first, width of conversations with very many turns, at most 1 / SLOT_SHARE of them; None without any."""
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.min("turn").alias("first"), F.max("turn").alias("last"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    most = max(slot_turns, total * SLOT_SHARE)
    span = (F.col("last").cast("decimal(38,0)") - F.col("first") + 1) / F.ceil(F.col("n") / most)
    width = F.coalesce(F.ceil(span), F.lit(1)).cast("decimal(38,0)")
    long_ = sizes.where(F.col("n") > most).select("conv_id", "first", width.alias("width"))
    return long_ if long_.limit(1).count() else None


def placed(conversations: DataFrame, slot_turns: int = SLOT_TURNS) -> DataFrame:
    """conv_id, turn, role, text, and slot, before (turns in earlier slots), ends (of the last slot).

    A null role or text is an empty one.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    whole = {"slot": F.lit(0).cast("long"), "before": F.lit(0).cast("long"), "ends": F.lit(True)}
    long_ = _slots(rows, slot_turns)
    if long_ is None:
        return rows.select("*", *[c.alias(name) for name, c in whole.items()])
    # Null turns come first, in a slot of their own; other slots are ranges of turn numbers.
    at = F.floor((F.col("turn").cast("decimal(38,0)") - F.col("first")) / F.col("width")).cast("long")
    cut = F.broadcast(long_.withColumnRenamed("conv_id", "_conv"))
    slot = F.when(F.col("width").isNotNull(), F.coalesce(at, F.lit(-1))).otherwise(F.lit(0)).cast("long")
    rows = rows.join(cut, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").withColumn("slot", slot)
    counts = rows.where("width IS NOT NULL").groupBy("conv_id", "slot").agg(F.count("*").alias("n"))
    order = Window.partitionBy("conv_id").orderBy("slot")
    earlier = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(
        F.col("conv_id").alias("_conv"), F.col("slot").alias("_slot"), earlier.alias("before"),
        F.lead("slot").over(order).isNull().alias("ends"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("slot") == F.col("_slot"))
    rows = rows.drop("_conv", "first", "width").join(F.broadcast(starts), same, "left")
    kept = ["conv_id", "turn", "role", "text", "slot"]
    return rows.select(*kept, *[F.coalesce(name, whole[name]).alias(name) for name in ("before", "ends")])


class _Slot:
    """One slot of a conversation as it is rendered: turns go in, parts of text come out."""

    def __init__(self, program: Program, conv_id, slot: int, before: int, ends: bool):
        self.program, self.key, self.index, self.ends = program, (conv_id, slot), before, ends
        self.starts, self.seq, self.held, self.out = before == 0, 0, None, Written()
        self.names = program.begin(self.out if self.starts else Written())

    def add(self, role: str, text: str) -> Iterator[tuple]:
        if self.held is not None:
            self._write(False)
            if self.out.length >= PART_CHARS:
                yield self._part(False)
        self.held = role, text

    def close(self) -> Iterator[tuple]:
        self._write(self.ends)
        if self.ends:
            self.program.end(self.names, self.out)
        yield self._part(self.starts and self.ends and self.seq == 0)

    def _write(self, last: bool) -> None:
        self.program.message(self.names, *self.held, self.index, last, self.out)
        self.index += 1

    def _part(self, whole: bool) -> tuple:
        spans = [{"start": a, "end": b} for a, b in self.out.spans]
        part = (*self.key, self.seq, whole, self.out.text(), spans)
        self.out, self.seq = Written(), self.seq + 1
        return part


def format_conversations(conversations: DataFrame, template: str = CHAT, slot_turns: int = SLOT_TURNS) -> DataFrame:
    """conv_id, slot, seq, whole, text, spans: the conversations as rendered by ``template``.

    A conversation is one row (``whole``), or several of whole turns each if it is long: its text is that of its rows
    by slot and seq.  ``spans`` are the generated code points of a row's text.  Turns come by turn (null first),
    role and text; repeated rows are turns of their own.  Rows with a null conv_id are one conversation.  A conversation is
    its rows: an empty table gives none.  Columns other than conv_id, turn, role and text are not read.
    """
    compile_template(template)  # an unfit template fails here, not in a task

    def render(batches) -> Iterator:
        import pandas as pd

        program = kept_in_worker(f"template {template}", lambda: compile_template(template))
        names, done, chars, slot = [c.split()[0] for c in PARTS.split(", ", 5)], [], 0, None

        def new_parts():
            nonlocal slot
            for batch in batches:
                for conv, s, before, ends, role, text in batch.itertuples(index=False, name=None):
                    if slot is None or slot.key != (conv, s):
                        if slot is not None:
                            yield from slot.close()
                        slot = _Slot(program, conv, s, before, ends)
                    yield from slot.add(role, text)
            if slot is not None:
                yield from slot.close()

        for part in new_parts():
            done.append(part)
            chars += len(part[4])
            if len(done) >= ROWS_AT_ONCE or chars > PART_CHARS:
                yield pd.DataFrame(done, columns=names)
                done, chars = [], 0
        if done:
            yield pd.DataFrame(done, columns=names)

    rows = placed(conversations, slot_turns).repartition("conv_id", "slot")
    rows = rows.sortWithinPartitions("conv_id", "slot", F.asc_nulls_first("turn"), "role", "text")
    # A decimal text keeps every id exact beside nulls.
    rows = rows.select(F.col("conv_id").cast("string").alias("conv_id"), "slot", "before", "ends", "role", "text")
    return rows.mapInPandas(render, PARTS).withColumn("conv_id", F.col("conv_id").cast("long"))


# --- reading back -----------------------------------------------------------------------------------


def read_turns(text: str, program: Program) -> list[tuple[str, str]]:
    """(role, text) of the turns of a row that ``CHAT`` has rendered; anything else raises a ValueError."""
    turns, at, begun, said = [], 0, None, None
    for found in program.marks.reader().finditer(text):
        mark = found[1]
        if mark is None:
            continue
        between = text[at : found.start()]
        if mark == TURN and begun is None:
            begun = found.end()
        elif mark == SAYS and begun is not None and said is None:
            role, said = between, found.end()
        elif mark == CLOSE and said is not None:
            turns.append((program.marks.unescape(role), program.marks.unescape(between)))
            begun = said = None
        elif mark not in (OPEN.strip(), END.strip()) or begun is not None:
            raise ValueError(f"{mark} out of place")
        at = found.end()
    if begun is not None:
        raise ValueError("a turn is not closed")
    return turns


def digests(parts: DataFrame, template: str = CHAT) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read back from formatted rows.

    Digests are of role, newline, text, newline of each turn, and of the text in the spans, unescaped.  Whole rows are
    digested where they are; the rows of a long conversation come together by slot and seq, in a stream, since a sha256
    can only be taken in order.
    """
    schema = "conv_id string, slot long, seq int, n_turns long, loss_chars long, formatted_chars long, turns binary, loss binary"

    def read(batches) -> Iterator:
        import pandas as pd

        program = kept_in_worker(f"template {template}", lambda: compile_template(template))
        for batch in batches:
            out = []
            for conv, slot, seq, whole, text, spans in batch.itertuples(index=False, name=None):
                found = read_turns(text, program)
                turns = "".join(f"{role}\n{said}\n" for role, said in found).encode()
                lost = "".join(program.marks.unescape(text[s["start"] : s["end"]]) for s in spans)
                loss = lost.encode()
                if whole:
                    turns, loss = hashlib.sha256(turns).digest(), hashlib.sha256(loss).digest()
                out.append((conv, slot, -1 if whole else seq, len(found), len(lost), len(text), turns, loss))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    def joined(batches) -> Iterator:
        import pandas as pd

        names, held = [c.split()[0] for c in final.split(", ")], None

        def closed():
            conv, n, chars, size, turns, loss = held
            return conv, n, turns.hexdigest(), chars, loss.hexdigest(), size

        for batch in batches:
            out = []
            for conv, _, seq, n, chars, size, turns, loss in batch.itertuples(index=False, name=None):
                if seq < 0:
                    out.append((conv, n, turns.hex(), chars, loss.hex(), size))
                    continue
                if held is not None and held[0] != conv:
                    out.append(closed())
                    held = None
                if held is None:
                    held = [conv, 0, 0, 0, hashlib.sha256(), hashlib.sha256()]
                for k, more in ((1, n), (2, chars), (3, size)):
                    held[k] += more
                held[4].update(turns)
                held[5].update(loss)
            if out:
                yield pd.DataFrame(out, columns=names)
        if held is not None:
            yield pd.DataFrame([closed()], columns=names)

    final = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ids = parts.withColumn("conv_id", F.col("conv_id").cast("string"))
    rows = ids.select("conv_id", "slot", "seq", "whole", "text", "spans").mapInPandas(read, schema)
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "slot", "seq")
    return rows.mapInPandas(joined, final).withColumn("conv_id", F.col("conv_id").cast("long"))
