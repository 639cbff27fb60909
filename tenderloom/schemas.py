"""Table contracts: eight all-text staging tables, three dimensions, three line-level facts.

A contract is plain data (names, types, lengths, keys, checks).  Sinks cast to it by name and the
quality operators read their rules from it, so a rule is written once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = "decimal(18,4)"
RATE = "decimal(18,6)"
STAMP = "timestamp_ntz"

SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    STAMP: T.TimestampNTZType(),
    MONEY: T.DecimalType(18, 4),
    RATE: T.DecimalType(18, 6),
}

VERSION = ("etl_period", "loaded_at")


@dataclass(frozen=True)
class Column:
    name: str
    type: str = "string"
    length: int | None = None
    required: bool = False


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    table: str
    ref_columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{'+'.join(self.columns)} -> {self.table}"


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    # check name -> columns that must each be NULL or >= 0
    nonnegative: tuple[tuple[str, tuple[str, ...]], ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def required(self) -> list[str]:
        """NOT NULL columns; a primary key column is one too."""
        return [c.name for c in self.columns if c.required or c.name in self.primary_key]

    @property
    def lengths(self) -> dict[str, int]:
        return {c.name: c.length for c in self.columns if c.length is not None}

    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, SPARK_TYPES[c.type], True) for c in self.columns]
        )


def _text(name: str, length: int | None = None, required: bool = False) -> Column:
    return Column(name, "string", length, required)


TECHNICAL = (
    _text("etl_period", 6),
    _text("source_file", 100),
    Column("loaded_at", STAMP),
    _text("batch_id", 36),
)


def _staging(name: str, *payload: str) -> Table:
    return Table(name, tuple(_text(c) for c in payload) + TECHNICAL)


# --- fixed values: table and column names, lengths, keys and checks of the data model -----------

STAGING: dict[str, Table] = {
    t.name: t
    for t in (
        _staging("stg_instituciones", "cedula", "nombre_institucion", "zona_geo_inst", "fecha_ingreso"),
        _staging(
            "stg_proveedores",
            "cedula_proveedor",
            "nombre_proveedor",
            "tipo_proveedor",
            "tamaÑo_proveedor",
            "fecha_constitucion",
            "zona_geo_prov",
            "fecha_registro",
        ),
        _staging(
            "stg_carteles",
            "nro_sicop",
            "cedula_institucion",
            "fecha_publicacion",
            "nro_procedimiento",
            "tipo_procedimiento",
            "modalidad_procedimiento",
            "cartel_stat",
            "cartel_nm",
            "fechah_apertura",
            "clas_obj",
            "monto_est",
        ),
        _staging(
            "stg_lineas_carteles",
            "nro_sicop",
            "numero_linea",
            "numero_partida",
            "cantidad_solicitada",
            "precio_unitario_estimado",
            "tipo_moneda",
            "tipo_cambio_crc",
            "codigo_identificacion",
            "monto_reservado",
            "desc_linea",
        ),
        _staging(
            "stg_ofertas",
            "nro_sicop",
            "nro_oferta",
            "cedula_proveedor",
            "fecha_presenta_oferta",
            "tipo_oferta",
        ),
        _staging(
            "stg_lineas_ofertadas",
            "nro_sicop",
            "nro_oferta",
            "nro_linea",
            "codigo_producto_cl",
            "cantidad_ofertada",
            "precio_unitario_ofertado",
            "tipo_moneda",
            "tipo_cambio_crc",
        ),
        _staging(
            "stg_procedimientos_adjudicacion",
            "nro_sicop",
            "cedula",
            "numero_procedimiento",
            "descr_procedimiento",
            "linea",
            "prod_id",
            "fecha_adjud_firme",
            "monto_adju_linea",
        ),
        _staging(
            "stg_lineas_adjudicadas",
            "nro_sicop",
            "nro_oferta",
            "nro_linea",
            "codigo_producto",
            "cedula_proveedor",
            "cantidad_adjudicada",
            "precio_unitario_adjudicado",
            "iva",
            "otros_impuestos",
            "acarreos",
            "tipo_moneda",
            "tipo_cambio_crc",
        ),
    )
}

# CSV member of a monthly archive -> staging table (only the names the source documents).
SOURCE_FILES: dict[str, str] = {
    "Proveedores.csv": "stg_proveedores",
    "InstitucionesRegistradas.csv": "stg_instituciones",
    "DetalleCarteles.csv": "stg_carteles",
    "DetalleLineaCartel.csv": "stg_lineas_carteles",
    "LineasOfertadas.csv": "stg_lineas_ofertadas",
}

SUPPLIERS = Table(
    "dim_proveedores",
    (
        _text("cedula_proveedor", 30),
        _text("nombre_proveedor", 255, required=True),
        _text("tipo_proveedor", 100),
        _text("tamano", 100),
        _text("provincia", 50),
        _text("canton", 50),
        _text("distrito", 50),
    ),
    primary_key=("cedula_proveedor",),
)

BUYERS = Table(
    "dim_instituciones",
    (
        _text("cedula_institucion", 30),
        _text("nombre_institucion", 255, required=True),
        _text("provincia", 100),
        _text("canton", 100),
        _text("distrito", 100),
    ),
    primary_key=("cedula_institucion",),
)

CATALOG = Table(
    "dim_catalogo_codigo_identificacion_producto",
    (
        Column("cod_producto", "bigint"),
        _text("descripcion_producto", 500),
        Column("segmento", "int"),
        _text("nombre_segmento", 255),
        Column("familia", "int"),
        Column("clases", "int"),
        Column("mercancias", "int"),
        _text("nombre_mercancia", 255),
    ),
    primary_key=("cod_producto",),
)

_TO_PRODUCT = ForeignKey(("cod_producto",), CATALOG.name, ("cod_producto",))
_TO_BUYER = ForeignKey(("cedula_institucion",), BUYERS.name, ("cedula_institucion",))
_TO_SUPPLIER = ForeignKey(("cedula_proveedor",), SUPPLIERS.name, ("cedula_proveedor",))

TENDER_LINES = Table(
    "lineas_carteles",
    (
        _text("nro_sicop", 100, required=True),
        _text("nro_procedimiento", 100),
        _text("nro_sicop_nro_linea", 160),
        _text("nombre_cartel", 500),
        _text("status_cartel", 100),
        _text("clasificacion_cartel", 150),
        Column("monto_estimado_cartel_crc", MONEY),
        Column("nro_linea", "int", required=True),
        Column("nro_partida", "int"),
        Column("cod_producto", "bigint"),
        Column("cantidad", MONEY),
        Column("precio_unitario_estimado", MONEY),
        Column("monto_total_linea_estimado", MONEY),
        _text("tipo_moneda", 30),
        Column("tipo_cambio_crc", RATE),
        _text("cedula_institucion", 30),
        _text("tipo_procedimiento", 150),
        _text("modalidad_procedimiento", 150),
        Column("fecha_publicacion", STAMP),
        Column("fecha_apertura", STAMP),
    ),
    primary_key=("nro_sicop", "nro_linea"),
    unique=("nro_sicop_nro_linea",),
    foreign_keys=(_TO_PRODUCT, _TO_BUYER),
    nonnegative=(
        ("ck_lineas_carteles_cantidad", ("cantidad",)),
        (
            "ck_lineas_carteles_montos",
            ("precio_unitario_estimado", "monto_total_linea_estimado", "monto_estimado_cartel_crc"),
        ),
    ),
)

BID_LINES = Table(
    "lineas_ofertas",
    (
        _text("nro_oferta_nro_linea", 160),
        _text("cedula_proveedor", 30),
        Column("fecha_oferta_presentada", STAMP),
        _text("tipo_oferta", 100),
        _text("nro_oferta", 100, required=True),
        Column("cod_producto", "bigint"),
        _text("nro_sicop", 100, required=True),
        Column("nro_linea", "int", required=True),
        _text("nro_sicop_nro_linea", 160),
        Column("cantidad_ofertada", MONEY),
        Column("precio_unitario_ofertado", MONEY),
        _text("tipo_moneda", 30),
        Column("tipo_cambio_crc", RATE),
    ),
    primary_key=("nro_sicop", "nro_oferta", "nro_linea"),
    unique=("nro_oferta_nro_linea",),
    foreign_keys=(_TO_SUPPLIER, _TO_PRODUCT),
    nonnegative=(
        ("ck_lineas_ofertas_cantidad", ("cantidad_ofertada",)),
        ("ck_lineas_ofertas_precio", ("precio_unitario_ofertado",)),
    ),
)

AWARD_LINES = Table(
    "lineas_adjudicadas",
    (
        _text("nro_sicop_nro_linea", 160),
        _text("nro_sicop", 100, required=True),
        _text("nro_oferta", 100, required=True),
        _text("nro_procedimiento", 100),
        Column("nro_linea", "int", required=True),
        _text("descr_procedimiento", 500),
        Column("cantidad_adjudicada", MONEY),
        Column("precio_unitario_adjudicado", MONEY),
        Column("monto_adjudicado_linea", MONEY),
        _text("cedula_institucion", 30),
        Column("fecha_adjud_firme", "date"),
        _text("cedula_proveedor", 30, required=True),
        Column("cod_producto", "bigint"),
        _text("moneda_adjudicada", 30),
        Column("tipo_cambio_crc", RATE),
    ),
    primary_key=("nro_sicop", "nro_oferta", "nro_linea"),
    foreign_keys=(
        ForeignKey(
            ("nro_sicop", "nro_oferta", "nro_linea"),
            BID_LINES.name,
            ("nro_sicop", "nro_oferta", "nro_linea"),
        ),
        _TO_BUYER,
        _TO_SUPPLIER,
        _TO_PRODUCT,
    ),
    nonnegative=(
        ("ck_lineas_adjudicadas_cantidad", ("cantidad_adjudicada",)),
        ("ck_lineas_adjudicadas_montos", ("precio_unitario_adjudicado", "monto_adjudicado_linea")),
    ),
)

# Build order follows the direction of the foreign keys.
MODEL: dict[str, Table] = {
    t.name: t for t in (SUPPLIERS, BUYERS, CATALOG, TENDER_LINES, BID_LINES, AWARD_LINES)
}
