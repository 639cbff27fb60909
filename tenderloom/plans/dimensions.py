"""Supplier and buyer dimensions: the last loaded row of every id, geography split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.functions.text import geography
from tenderloom.operators.latest import latest_by
from tenderloom.schemas import BUYERS, SUPPLIERS
from tenderloom.sources.tables import to_contract

# Dimensions follow the load time alone; the period plays no part.
LOADED = ("loaded_at",)


def newest_suppliers(suppliers: DataFrame) -> DataFrame:
    """The last loaded row of every supplier, with the columns of staging that the dimension needs."""
    needed = suppliers.select(
        "cedula_proveedor", "nombre_proveedor", "tipo_proveedor", "tamaÑo_proveedor", "zona_geo_prov", "loaded_at"
    )
    return latest_by(needed, ["cedula_proveedor"], LOADED)


def newest_buyers(buyers: DataFrame) -> DataFrame:
    needed = buyers.select("cedula", "nombre_institucion", "zona_geo_inst", "loaded_at")
    return latest_by(needed, ["cedula"], LOADED)


def latest_suppliers(suppliers: DataFrame) -> DataFrame:
    return newest_suppliers(suppliers).withColumnRenamed("tamaÑo_proveedor", "tamano")


def latest_buyers(buyers: DataFrame) -> DataFrame:
    return newest_buyers(buyers).withColumnRenamed("cedula", "cedula_institucion")


def supplier_dimension(suppliers: DataFrame) -> DataFrame:
    rows = latest_suppliers(suppliers)
    return to_contract(rows.select("*", *geography(F.col("zona_geo_prov"))), SUPPLIERS)


def buyer_dimension(buyers: DataFrame) -> DataFrame:
    rows = latest_buyers(buyers)
    return to_contract(rows.select("*", *geography(F.col("zona_geo_inst"))), BUYERS)
