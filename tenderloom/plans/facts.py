"""Line-level facts: latest version of lines and headers, joined and typed.

Every input is narrowed to the columns the fact needs before its versions are compared, so the
shuffles carry nothing else.  Versions are removed before the join, which keeps both sides small.
Lines are shuffled once, by the header key, and their versions compared there.  That would put all lines
of a large tender into one task: such keys are looked for in the staged rows, by a scan of the key
columns only, and their lines shuffled by their own key and then spread.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderloom.functions.casts import (
    REJECTED,
    day_first_date,
    day_of_timestamp,
    number,
    select_typed,
)
from tenderloom.functions.text import composite_key, product_code
from tenderloom.operators.joins import HOT_ROWS
from tenderloom.operators.latest import latest_by, latest_join
from tenderloom.schemas import AWARD_LINES, BID_LINES, MONEY, RATE, TENDER_LINES, VERSION, Table
from tenderloom.sources.tables import to_contract


@dataclass(frozen=True)
class _Record:
    """What the facts need of a staging table: the key of its records, and their attributes."""

    keys: tuple[str, ...]
    attributes: tuple[str, ...]

    def narrow(self, df: DataFrame) -> DataFrame:
        return df.select(*self.keys, *self.attributes, *VERSION)

    def latest(self, df: DataFrame) -> DataFrame:
        return latest_by(self.narrow(df), self.keys)


def _finish(typed: DataFrame, table: Table) -> DataFrame:
    if REJECTED not in typed.columns:
        return to_contract(typed, table)
    return typed.select(*table.names, REJECTED)


# --- latest versions --------------------------------------------------------------------------


_TENDER = _Record(
    ("nro_sicop",),
    (
        "nro_procedimiento",
        "cartel_nm",
        "cartel_stat",
        "clas_obj",
        "monto_est",
        "cedula_institucion",
        "tipo_procedimiento",
        "modalidad_procedimiento",
        "fecha_publicacion",
        "fechah_apertura",
    ),
)
_TENDER_LINE = _Record(
    ("nro_sicop", "numero_linea", "codigo_identificacion"),
    (
        "numero_partida",
        "cantidad_solicitada",
        "precio_unitario_estimado",
        "monto_reservado",
        "tipo_moneda",
        "tipo_cambio_crc",
    ),
)
_BID = _Record(
    ("nro_oferta",),
    (
        "cedula_proveedor",
        "fecha_presenta_oferta",
        "tipo_oferta",
    ),
)
_BID_LINE = _Record(
    ("nro_oferta", "nro_linea", "codigo_producto_cl"),
    (
        "nro_sicop",
        "cantidad_ofertada",
        "precio_unitario_ofertado",
        "tipo_moneda",
        "tipo_cambio_crc",
    ),
)
_AWARD_LINE = _Record(
    ("nro_sicop", "nro_oferta", "nro_linea", "codigo_producto"),
    (
        "cedula_proveedor",
        "cantidad_adjudicada",
        "precio_unitario_adjudicado",
        "tipo_moneda",
        "tipo_cambio_crc",
    ),
)
_PROCEDURE = _Record(
    ("nro_sicop", "linea", "prod_id"),
    (
        "cedula",
        "numero_procedimiento",
        "descr_procedimiento",
        "fecha_adjud_firme",
        "monto_adju_linea",
    ),
)


def latest_tenders(tenders: DataFrame) -> DataFrame:
    return _TENDER.latest(tenders)


def latest_tender_lines(lines: DataFrame) -> DataFrame:
    return _TENDER_LINE.latest(lines)


def latest_bids(bids: DataFrame) -> DataFrame:
    return _BID.latest(bids)


def latest_bid_lines(lines: DataFrame) -> DataFrame:
    return _BID_LINE.latest(lines)


def latest_award_lines(lines: DataFrame) -> DataFrame:
    return _AWARD_LINE.latest(lines)


def latest_procedures(procedures: DataFrame) -> DataFrame:
    return _PROCEDURE.latest(procedures)


# --- facts --------------------------------------------------------------------------------------


def tender_line_fact(
    lines: DataFrame,
    tenders: DataFrame,
    on_error: str = "raise",
    hot_rows: int = HOT_ROWS,
    clustered: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Published tender lines with the attributes of their tender; lines without one stay.

    ``clustered`` says that the lines lie in buckets by ``nro_sicop``, and ``partitions`` how many if not as many as the
    session's shuffle partitions.
    """
    line, tender = _TENDER_LINE.narrow(lines), _TENDER.narrow(tenders)
    c = F.col
    typed = select_typed(
        latest_join(
            line, _TENDER_LINE.keys, tender, _TENDER.keys, ["nro_sicop"], hot_rows,
            clustered=("left",) * clustered, partitions=partitions,
        ),
        [
            c("nro_sicop"),
            c("nro_procedimiento"),
            composite_key(c("nro_sicop"), c("numero_linea")).alias("nro_sicop_nro_linea"),
            F.left("cartel_nm", F.lit(TENDER_LINES.lengths["nombre_cartel"])).alias("nombre_cartel"),
            c("cartel_stat").alias("status_cartel"),
            c("clas_obj").alias("clasificacion_cartel"),
            number("monto_estimado_cartel_crc", c("monto_est"), MONEY),
            number("nro_linea", c("numero_linea"), "int"),
            number("nro_partida", c("numero_partida"), "int"),
            number("cod_producto", product_code(c("codigo_identificacion")), "bigint"),
            number("cantidad", c("cantidad_solicitada"), MONEY),
            number("precio_unitario_estimado", c("precio_unitario_estimado"), MONEY),
            # The line total is the reserved amount, not quantity times price.
            number("monto_total_linea_estimado", c("monto_reservado"), MONEY),
            c("tipo_moneda"),
            number("tipo_cambio_crc", c("tipo_cambio_crc"), RATE),
            c("cedula_institucion"),
            c("tipo_procedimiento"),
            c("modalidad_procedimiento"),
            day_of_timestamp("fecha_publicacion", c("fecha_publicacion")),
            day_of_timestamp("fecha_apertura", c("fechah_apertura")),
        ],
        on_error,
    )
    return _finish(typed, TENDER_LINES)


def bid_line_fact(
    lines: DataFrame,
    bids: DataFrame,
    on_error: str = "raise",
    hot_rows: int = HOT_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Bid lines with supplier, date and type of their bid; ``partitions`` as in ``latest_join``."""
    line, bid = _BID_LINE.narrow(lines), _BID.narrow(bids)
    c = F.col
    typed = select_typed(
        latest_join(line, _BID_LINE.keys, bid, _BID.keys, ["nro_oferta"], hot_rows, partitions=partitions),
        [
            composite_key(c("nro_oferta"), c("nro_linea")).alias("nro_oferta_nro_linea"),
            c("cedula_proveedor"),
            day_of_timestamp("fecha_oferta_presentada", c("fecha_presenta_oferta")),
            c("tipo_oferta"),
            c("nro_oferta"),
            # Unlike the other sources, the whole trimmed code counts here.
            number("cod_producto", F.trim("codigo_producto_cl"), "bigint"),
            c("nro_sicop"),
            number("nro_linea", c("nro_linea"), "int"),
            composite_key(c("nro_sicop"), c("nro_linea")).alias("nro_sicop_nro_linea"),
            number("cantidad_ofertada", c("cantidad_ofertada"), MONEY),
            number("precio_unitario_ofertado", c("precio_unitario_ofertado"), MONEY),
            c("tipo_moneda"),
            number("tipo_cambio_crc", c("tipo_cambio_crc"), RATE),
        ],
        on_error,
    )
    return _finish(typed, BID_LINES)


def award_line_fact(
    lines: DataFrame,
    procedures: DataFrame,
    on_error: str = "raise",
    hot_rows: int = HOT_ROWS,
    clustered: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Award lines with the amount, buyer, date and code of the award procedure.

    A procedure line that matches several bids gives its full amount to each of them.  ``clustered`` says that both
    tables lie in as many buckets by ``nro_sicop``, and ``partitions`` how many if not as many as the session's shuffle
    partitions.
    """
    # The code is made of a key column on both sides, so all versions of a record have the same.
    line = _AWARD_LINE.narrow(lines).withColumn("_code", product_code(F.col("codigo_producto")))
    procedure = (
        _PROCEDURE.narrow(procedures).withColumnRenamed("linea", "nro_linea").withColumn("_code", F.trim("prod_id"))
    )
    on = ["nro_sicop", "nro_linea", "_code"]
    c = F.col
    typed = select_typed(
        latest_join(
            line, _AWARD_LINE.keys, procedure, ["nro_sicop", "nro_linea", "prod_id"], on, hot_rows,
            clustered=("left", "right") * clustered, partitions=partitions,
        ),
        [
            composite_key(c("nro_sicop"), c("nro_linea")).alias("nro_sicop_nro_linea"),
            c("nro_sicop"),
            c("nro_oferta"),
            c("numero_procedimiento").alias("nro_procedimiento"),
            number("nro_linea", c("nro_linea"), "int"),
            F.left("descr_procedimiento", F.lit(AWARD_LINES.lengths["descr_procedimiento"])).alias(
                "descr_procedimiento"
            ),
            number("cantidad_adjudicada", c("cantidad_adjudicada"), MONEY),
            number("precio_unitario_adjudicado", c("precio_unitario_adjudicado"), MONEY),
            number("monto_adjudicado_linea", c("monto_adju_linea"), MONEY),
            c("cedula").alias("cedula_institucion"),
            day_first_date("fecha_adjud_firme", c("fecha_adjud_firme")),
            c("cedula_proveedor"),
            number("cod_producto", F.trim("prod_id"), "bigint"),
            c("tipo_moneda").alias("moneda_adjudicada"),
            number("tipo_cambio_crc", c("tipo_cambio_crc"), RATE),
        ],
        on_error,
    )
    return _finish(typed, AWARD_LINES)
