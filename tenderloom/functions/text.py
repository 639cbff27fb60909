"""Text expressions: blank handling, geography, product codes, composite keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shape of a product code.
CODE_DIGITS = 16
CODE_PATTERN = "^[0-9]{16}$"
HIERARCHY = {"segmento": 2, "familia": 4, "clases": 6, "mercancias": 8}


def blank_to_null(text: Column) -> Column:
    """``''`` becomes NULL; a text of spaces is left alone."""
    return F.nullif(text, F.lit(""))


def geo_part(zone: Column, position: int) -> Column:
    """One level of a 'distrito, canton, provincia' text; a missing or blank level is NULL."""
    return blank_to_null(F.trim(F.split_part(zone, F.lit(","), F.lit(position))))


def geography(zone: Column) -> list[Column]:
    levels = ("distrito", "canton", "provincia")
    return [geo_part(zone, i).alias(level) for i, level in enumerate(levels, start=1)]


def composite_key(left: Column, right: Column) -> Column:
    """``left_right``; a NULL part counts as empty text and the separator always stays."""
    return F.concat(F.coalesce(left, F.lit("")), F.lit("_"), F.coalesce(right, F.lit("")))


def product_code(text: Column) -> Column:
    return F.substring(F.trim(text), 1, CODE_DIGITS)


def is_product_code(code: Column) -> Column:
    return code.rlike(CODE_PATTERN)


def hierarchy(code: Column) -> list[Column]:
    """Segment, family, class and commodity numbers, read from the text so leading zeros count."""
    return [F.substring(code, 1, digits).cast("int").alias(name) for name, digits in HIERARCHY.items()]


def commodity(code: Column) -> Column:
    """First 8 digits of a valid code.

    A valid code is never NULL; saying so keeps Spark from pushing a null filter into one of several
    branches that would otherwise share a shuffle.
    """
    return F.coalesce(F.substring(code, 1, HIERARCHY["mercancias"]), F.lit(""))
