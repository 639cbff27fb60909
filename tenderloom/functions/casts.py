"""Typed reading of text columns.

A value that cannot be read either stops the job (``on_error="raise"``, what a database load does)
or is reported (``on_error="flag"``: the column is NULL and its name is listed in
``rejected_columns``, so good and bad rows can be split after one pass).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderloom.functions.text import blank_to_null

REJECTED = "rejected_columns"


@dataclass(frozen=True)
class Parsed:
    """A typed column: ``value`` is NULL both for a NULL text and for an unreadable one."""

    name: str
    text: Column
    value: Column

    def unreadable(self) -> Column:
        return self.text.isNotNull() & self.value.isNull()

    def strict(self) -> Column:
        message = F.concat(F.lit(f"{self.name}: cannot read '"), self.text, F.lit("'"))
        stop = F.when(self.text.isNotNull(), F.raise_error(message))
        return F.coalesce(self.value, stop).alias(self.name)


def number(name: str, text: Column, type_: str) -> Parsed:
    """``''`` is NULL; anything else must be a number that fits ``type_``."""
    filled = blank_to_null(text)
    return Parsed(name, filled, filled.try_cast(type_))


def day_of_timestamp(name: str, text: Column) -> Parsed:
    """'yyyy-MM-dd HH:mm:ss' with optional trailing text -> midnight of that day.

    Only 19 characters are read.  The clock must be valid but is dropped.
    """
    filled = blank_to_null(F.substring(text, 1, 19))
    return Parsed(name, filled, filled.try_cast("timestamp_ntz").cast("date").cast("timestamp_ntz"))


def day_first_date(name: str, text: Column) -> Parsed:
    """'d/M/yyyy', padded or not, with optional trailing text after a space -> date."""
    filled = blank_to_null(text)
    return Parsed(name, filled, F.try_to_date(F.substring_index(F.ltrim(filled), " ", 1), "d/M/yyyy"))


def select_typed(df: DataFrame, columns: Sequence[Column | Parsed], on_error: str = "raise") -> DataFrame:
    """Project ``columns``, treating unreadable values by policy."""
    if on_error == "raise":
        return df.select(*[c.strict() if isinstance(c, Parsed) else c for c in columns])
    if on_error != "flag":
        raise ValueError(f"on_error must be 'raise' or 'flag', not {on_error!r}")
    parsed = [c for c in columns if isinstance(c, Parsed)]
    rejected = F.array_compact(F.array(*[F.when(p.unreadable(), F.lit(p.name)) for p in parsed]))
    return df.select(
        *[c.value.alias(c.name) if isinstance(c, Parsed) else c for c in columns],
        rejected.alias(REJECTED),
    )


def split_rejected(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with the list of columns that could not be read)."""
    clean = flagged.where(F.size(REJECTED) == 0).drop(REJECTED)
    return clean, flagged.where(F.size(REJECTED) > 0)
