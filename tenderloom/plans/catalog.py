"""Product catalog from every product code found in the staging history."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.functions.text import blank_to_null, commodity, hierarchy, is_product_code, product_code
from tenderloom.operators.joins import HOT_ROWS, spread_join
from tenderloom.operators.mode import most_frequent
from tenderloom.schemas import CATALOG
from tenderloom.sources.segments import segment_names
from tenderloom.sources.tables import to_contract


def raw_codes(
    tender_lines: DataFrame, bid_lines: DataFrame, award_lines: DataFrame, procedures: DataFrame
) -> DataFrame:
    """All code mentions of the four sources; only tender lines carry a description."""
    no_text = F.lit(None).cast("string").alias("descr")

    def codes(df: DataFrame, column: str, descr=no_text) -> DataFrame:
        return df.select(product_code(F.col(column)).alias("cod_producto"), descr)

    return (
        codes(tender_lines, "codigo_identificacion", F.trim("desc_linea").alias("descr"))
        .unionByName(codes(bid_lines, "codigo_producto_cl"))
        .unionByName(codes(award_lines, "codigo_producto"))
        .unionByName(codes(procedures, "prod_id"))
    )


def valid_codes(raw: DataFrame) -> DataFrame:
    """Mentions of codes of exactly 16 digits; a blank description is NULL."""
    return raw.where(is_product_code(F.col("cod_producto"))).select(
        "cod_producto", blank_to_null(F.col("descr")).alias("descr")
    )


def distinct_codes(valid: DataFrame) -> DataFrame:
    return valid.select("cod_producto").distinct()


def mention_counts(valid: DataFrame) -> DataFrame:
    """Mentions per code and description, with a NULL description for codes mentioned without one.

    This one aggregate feeds both names and the list of codes: it is the only pass over the staging
    history, and the two consumers share its shuffle.
    """
    return valid.groupBy("cod_producto", "descr").agg(F.count("*").alias("n"))


def merged_counts(*counts: DataFrame) -> DataFrame:
    """Mention counts of parts of the history added up; they equal the counts of the whole."""
    together = counts[0]
    for more in counts[1:]:
        together = together.unionByName(more)
    return together.groupBy("cod_producto", "descr").agg(F.sum("n").alias("n"))


def description_counts(valid: DataFrame) -> DataFrame:
    return mention_counts(valid.where(F.col("descr").isNotNull()))


def product_names(counts: DataFrame, collation: str | None = None) -> DataFrame:
    """Most frequent description of every 16-digit code; NULL where a code has none."""
    return most_frequent(counts, "cod_producto", "descr", collation=collation).withColumnRenamed("descr", "descripcion_producto")


def commodity_names(counts: DataFrame, collation: str | None = None) -> DataFrame:
    """Most frequent description of every 8-digit commodity, re-aggregated from the code counts."""
    summed = counts.groupBy(commodity(F.col("cod_producto")).alias("cod_mercancia"), "descr").agg(
        F.sum("n").alias("n")
    )
    return most_frequent(summed, "cod_mercancia", "descr", collation=collation).withColumnRenamed("descr", "nombre_mercancia")


def with_segment_name(df: DataFrame) -> DataFrame:
    """Adds ``nombre_segmento`` to rows with ``segmento``; NULL outside the 57 segments."""
    return df.join(F.broadcast(segment_names(df.sparkSession)), "segmento", "left")


def catalog_from_counts(counts: DataFrame, hot_rows: int = HOT_ROWS, collation: str | None = None) -> DataFrame:
    code = F.col("cod_producto")
    products = product_names(counts, collation).withColumn("cod_mercancia", commodity(code))
    # Commodities with many codes are found in the counts; asking for n keeps the shuffle shared.
    mentioned = counts.where("n > 0").select(commodity(code).alias("cod_mercancia"))
    named = spread_join(
        products, commodity_names(counts, collation), ["cod_mercancia"], "left", hot_rows, stats=mentioned
    )
    decoded = named.select(
        code,
        F.left("descripcion_producto", F.lit(CATALOG.lengths["descripcion_producto"])).alias(
            "descripcion_producto"
        ),
        *hierarchy(code),
        F.left("nombre_mercancia", F.lit(CATALOG.lengths["nombre_mercancia"])).alias("nombre_mercancia"),
    )
    return to_contract(with_segment_name(decoded), CATALOG)


def product_catalog(
    tender_lines: DataFrame,
    bid_lines: DataFrame,
    award_lines: DataFrame,
    procedures: DataFrame,
    hot_rows: int = HOT_ROWS,
    collation: str | None = None,
) -> DataFrame:
    """The catalog; ``collation`` orders descriptions that are equally frequent, binary text order if it is None."""
    valid = valid_codes(raw_codes(tender_lines, bid_lines, award_lines, procedures))
    return catalog_from_counts(mention_counts(valid), hot_rows, collation)
