"""The driver's tables in the shape of the staging history and of the model.

Edge cases (blank amounts, padded, short, long and non-numeric codes, re-published versions,
missing headers, bids under another number) are planted by natural attributes of the rows, and
every row of the tables is used.  ``oracle.py`` states the same mapping in SQL.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderloom.schemas import STAGING
from tenderloom.session import FREE_SHUFFLES, work_folder

BATCH = "00000000-0000-4000-8000-000000000001"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(name: str) -> Column:
    return F.col(name).cast("string")


def _money(name: str) -> Column:
    return F.col(name).cast("decimal(18,4)").cast("string")


def _rate(value: Column) -> Column:
    return value.cast("decimal(18,6)").cast("string")


def _day(stamp: Column) -> Column:
    return F.date_format(stamp, "yyyy-MM-dd")


def _technical(loaded_at: Column, source_file: str, period: Column | None = None) -> list[Column]:
    return [
        F.date_format(period if period is not None else loaded_at, "yyyyMM").alias("etl_period"),
        F.lit(source_file).alias("source_file"),
        loaded_at.alias("loaded_at"),
        F.lit(BATCH).alias("batch_id"),
    ]


def _staged(df: DataFrame, name: str) -> DataFrame:
    return df.select(*STAGING[name].names)


def _later(stamp: Column, days: int) -> Column:
    return stamp + F.expr(f"INTERVAL {days} DAYS")


def product_code() -> Column:
    return F.concat(
        F.lpad((F.col("l_partkey") % 90 + 10).cast("string"), 2, "0"),
        F.lit("010101"),
        F.lpad(_s("l_partkey"), 8, "0"),
    )


def award_number() -> Column:
    return F.concat(_s("l_orderkey"), F.lit("_"), _s("l_suppkey"))


def _with_versions(df: DataFrame, republished: Column) -> DataFrame:
    """Version 0 of every row, and version 1 of the re-published ones, from one scan."""
    versions = F.when(republished, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("version", F.explode(versions))


def joined_lines(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Lines with the buyer of their order, whose number is text, and the name of their part.

    ``partitions`` deals them out by tender to so many tasks.
    """
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(_s("o_orderkey").alias("nro_sicop"), "o_custkey")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    # The order last: rows then lie by the tender, as ``stored_lines`` keeps them.
    named = lines.join(parts, "l_partkey").withColumn("nro_sicop", _s("l_orderkey")).drop("l_orderkey")
    if partitions is not None:
        named, orders = named.repartition(partitions, "nro_sicop"), orders.repartition(partitions, "nro_sicop")
    return named.join(orders, "nro_sicop")


# A task sorts the versions of its lines for both sides of a join at once; lines of so many bytes of Parquet take it about
# 0.3 GB.
LINE_BYTES = 2 << 20


def line_partitions(spark: SparkSession, sf_dir: str) -> int | None:
    """The number of tasks that lines are dealt out to, by the size of their table; None where the session's is enough."""
    files = spark.read.format("binaryFile").load(f"{sf_dir}/lineitem.parquet").select("length")
    found = math.ceil(sum(r.length for r in files.collect()) / LINE_BYTES)
    return found if found > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


# Views of the joined lines, and the columns that they take beside those that every one of them takes.
LINE_VIEWS = {
    "stg_lineas_carteles": ("l_linestatus", "p_name"),
    "stg_lineas_ofertadas": (),
    "stg_procedimientos_adjudicacion": ("o_custkey", "p_name"),
    "stg_lineas_adjudicadas": ("l_linestatus",),
}
_LINE_COLUMNS = (
    "nro_sicop", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_shipdate",
)


def _view_columns(names: Sequence[str]) -> list[str]:
    """The columns of ``joined_lines`` that these views take; views of other tables take none."""
    return list(dict.fromkeys([*_LINE_COLUMNS, *[c for n in names for c in LINE_VIEWS.get(n, ())]]))


def stored_lines(spark: SparkSession, sf_dir: str, names: Sequence[str] = tuple(LINE_VIEWS)) -> DataFrame:
    """``joined_lines``, joined once and written, for queries that take several views of them or read one twice.

    They lie in buckets by tender, so that what is grouped or joined by tender later is not shuffled again.  All rows are
    written, with the columns that the views ``names`` take.
    """
    spark.conf.set(FREE_SHUFFLES, "true")
    # Tables in buckets by the tender are joined where they lie by the tender and more columns, too.
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    partitions = line_partitions(spark, sf_dir)
    folder, lines = work_folder(spark, "lines"), joined_lines(spark, sf_dir, partitions).select(*_view_columns(names))
    name, buckets = f"lines_{uuid.uuid4().hex}", partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = lines.write.format("parquet").bucketBy(buckets, "nro_sicop").option("path", folder)
    writer.option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def lines_by_month(spark: SparkSession, sf_dir: str, names: Sequence[str] = tuple(LINE_VIEWS)) -> DataFrame:
    """``joined_lines``, joined once and written by month of shipment, for queries that write views of them by period.

    Versions of a line are a month apart, so a view of a month is of two or three periods.  All rows are written, with the
    columns that the views ``names`` take.
    """
    spark.conf.set(FREE_SHUFFLES, "true")
    folder, lines = work_folder(spark, "lines"), joined_lines(spark, sf_dir, line_partitions(spark, sf_dir))
    rows = lines.select(*_view_columns(names)).withColumn("_month", F.date_format("l_shipdate", "yyyyMM")).hint("rebalance", "_month")
    rows.write.option("compression", "zstd").partitionBy("_month").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder).drop("_month")


def line_history(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Lines with code, order and version; returned lines are published again a month later, dearer."""
    rows = _with_versions(joined_lines(spark, sf_dir) if lines is None else lines, F.col("l_returnflag") == "R")
    second = F.col("version") == 1
    return rows.select(
        "*",
        product_code().alias("code"),
        F.concat("nro_sicop", F.lit("_"), _s("l_suppkey")).alias("bid"),
        (F.col("l_extendedprice").cast("decimal(18,4)") + F.col("version")).cast("decimal(18,4)").cast("string").alias("price"),
        F.when(second, _later(F.col("l_shipdate"), 31)).otherwise(F.col("l_shipdate")).alias("stamp"),
    )


def _code(*cases: tuple[int, Column]) -> Column:
    """The code, altered for lines of some quantities."""
    chosen = F
    for quantity, value in cases:
        chosen = chosen.when(F.col("l_quantity") == float(quantity), value)
    return chosen.otherwise(F.col("code"))


def stg_lineas_carteles(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    c = F.col
    rows = line_history(spark, sf_dir, lines).select(
        c("nro_sicop"),
        _s("l_linenumber").alias("numero_linea"),
        F.when(c("l_tax") == 0.0, "").otherwise(_s("l_linenumber")).alias("numero_partida"),
        F.when(c("l_discount") == 0.0, "").otherwise(_money("l_quantity")).alias("cantidad_solicitada"),
        c("price").alias("precio_unitario_estimado"),
        F.when(c("l_linestatus") == "F", "CRC").otherwise("USD").alias("tipo_moneda"),
        F.when(c("l_linestatus") == "F", "").otherwise(_rate(c("l_tax") + 500)).alias("tipo_cambio_crc"),
        _code(
            (1, F.concat(F.lit("  "), c("code"), F.lit(" "))),
            (2, F.concat(c("code"), F.lit("0042"))),
            (3, F.lit("")),
            (4, F.substring("code", 1, 15)),
        ).alias("codigo_identificacion"),
        F.when(c("l_tax") == 0.08, "").otherwise(_money("l_extendedprice")).alias("monto_reservado"),
        F.when(c("l_tax") == 0.01, "   ")
        .otherwise(F.concat(F.lit(" "), c("p_name"), F.lit(" "), c("l_returnflag")))
        .alias("desc_linea"),
        *_technical(c("stamp"), "DetalleLineaCartel.csv"),
    )
    return _staged(rows, "stg_lineas_carteles")


def stg_carteles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tender headers; some are numbered differently, so their lines find no header."""
    c = F.col
    orders = _with_versions(table(spark, sf_dir, "orders"), c("o_orderstatus") == "P")
    other = (c("o_orderstatus") == "O") & (c("o_orderpriority") == "3-MEDIUM")
    stamp = F.when(c("version") == 1, _later(c("o_orderdate"), 31)).otherwise(c("o_orderdate"))
    rows = orders.select(
        F.when(other, F.concat(F.lit("X"), _s("o_orderkey"))).otherwise(_s("o_orderkey")).alias("nro_sicop"),
        _s("o_custkey").alias("cedula_institucion"),
        F.concat(_day(c("o_orderdate")), F.lit(" 13:14:15.678")).alias("fecha_publicacion"),
        F.concat(F.lit("LN-"), _s("o_orderkey")).alias("nro_procedimiento"),
        c("o_orderpriority").alias("tipo_procedimiento"),
        c("o_orderstatus").alias("modalidad_procedimiento"),
        F.when(c("version") == 1, "Modificado").otherwise("Publicado").alias("cartel_stat"),
        F.when(c("o_orderpriority") == "1-URGENT", F.repeat(F.lit("compra urgente "), 40))
        .otherwise(F.concat(F.lit("Compra "), _s("o_orderkey")))
        .alias("cartel_nm"),
        F.when(c("o_orderpriority") == "5-LOW", "")
        .otherwise(F.concat(_day(_later(c("o_orderdate"), 15)), F.lit(" 10:00:00")))
        .alias("fechah_apertura"),
        c("o_orderpriority").alias("clas_obj"),
        F.when(c("o_orderpriority") == "4-NOT SPECIFIED", "").otherwise(_money("o_totalprice")).alias("monto_est"),
        *_technical(stamp, "DetalleCarteles.csv"),
    )
    return _staged(rows, "stg_carteles")


def stg_ofertas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line is one sighting of its bid header; the latest shipped one wins."""
    c = F.col
    rows = table(spark, sf_dir, "lineitem").select(
        _s("l_orderkey").alias("nro_sicop"),
        award_number().alias("nro_oferta"),
        _s("l_suppkey").alias("cedula_proveedor"),
        F.concat(_day(c("l_shipdate")), F.lit(" 08:30:00 (hora local)")).alias("fecha_presenta_oferta"),
        c("l_returnflag").alias("tipo_oferta"),
        *_technical(c("l_shipdate"), "Ofertas.csv"),
    )
    return _staged(rows, "stg_ofertas")


def stg_lineas_ofertadas(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Bid lines; lines with the highest tax are filed under another bid number."""
    c = F.col
    rows = line_history(spark, sf_dir, lines).select(
        c("nro_sicop"),
        F.when(c("l_tax") == 0.08, F.concat(F.lit("R"), c("bid"))).otherwise(c("bid")).alias("nro_oferta"),
        _s("l_linenumber").alias("nro_linea"),
        _code(
            (1, F.concat(F.lit(" "), c("code"), F.lit("  "))),
            (3, F.lit("")),
            (4, F.substring("code", 1, 15)),
        ).alias("codigo_producto_cl"),
        _money("l_quantity").alias("cantidad_ofertada"),
        F.when(c("l_discount") == 0.0, "").otherwise(c("price")).alias("precio_unitario_ofertado"),
        F.lit("CRC").alias("tipo_moneda"),
        F.lit("1").alias("tipo_cambio_crc"),
        *_technical(c("stamp"), "LineasOfertadas.csv"),
    )
    return _staged(rows, "stg_lineas_ofertadas")


def stg_lineas_adjudicadas(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    c = F.col
    rows = line_history(spark, sf_dir, lines).select(
        c("nro_sicop"),
        c("bid").alias("nro_oferta"),
        _s("l_linenumber").alias("nro_linea"),
        _code(
            (1, F.concat(F.lit(" "), c("code"))),
            (2, F.concat(c("code"), F.lit("0042"))),
            (5, F.concat(F.lit("X"), F.substring("code", 2, 15))),
        ).alias("codigo_producto"),
        _s("l_suppkey").alias("cedula_proveedor"),
        F.when(c("l_discount") == 0.1, "").otherwise(_money("l_quantity")).alias("cantidad_adjudicada"),
        c("price").alias("precio_unitario_adjudicado"),
        _money("l_tax").alias("iva"),
        F.lit("").alias("otros_impuestos"),
        F.lit("").alias("acarreos"),
        F.when(c("l_linestatus") == "F", "CRC").otherwise("USD").alias("tipo_moneda"),
        F.when(c("l_linestatus") == "F", "").otherwise(_rate(c("l_tax") + 500)).alias("tipo_cambio_crc"),
        *_technical(c("stamp"), "LineasAdjudicadas.csv"),
    )
    return _staged(rows, "stg_lineas_adjudicadas")


def stg_procedimientos_adjudicacion(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    """Award procedures; lines that were never awarded carry no product code and match nothing."""
    c = F.col
    rows = line_history(spark, sf_dir, lines).select(
        c("nro_sicop"),
        _s("o_custkey").alias("cedula"),
        F.concat(F.lit("LN-"), c("nro_sicop")).alias("numero_procedimiento"),
        F.concat(F.lit("Adjudicacion "), c("p_name")).alias("descr_procedimiento"),
        _s("l_linenumber").alias("linea"),
        F.when(c("l_returnflag") == "N", "")
        .otherwise(_code((1, F.concat(c("code"), F.lit(" ")))))
        .alias("prod_id"),
        F.when(c("l_tax") == 0.0, "")
        .when(c("l_tax") == 0.01, F.date_format(c("l_shipdate"), "d/M/yyyy"))
        .otherwise(F.date_format(c("l_shipdate"), "dd/MM/yyyy"))
        .alias("fecha_adjud_firme"),
        F.when(c("l_discount") == 0.0, "").otherwise(c("price")).alias("monto_adju_linea"),
        *_technical(c("stamp"), "ProcedimientoAdjudicacion.csv"),
    )
    return _staged(rows, "stg_procedimientos_adjudicacion")


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return nations.join(regions, "n_regionkey").select("n_nationkey", "n_name", "r_name")


def stg_instituciones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as buyers; a name per nation is shared by one market segment.

    Re-registered buyers come back later in an older period, with their name in capitals.
    """
    c = F.col
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    again = c("c_mktsegment").isin("FURNITURE", "MACHINERY")
    rows = _with_versions(customers.join(_places(spark, sf_dir), "n_nationkey"), again)
    second = c("version") == 1
    name = F.when(c("c_mktsegment") == "AUTOMOBILE", F.concat(F.lit("Institucion "), c("n_name"))).otherwise(
        c("c_name")
    )
    loaded = F.when(second, F.lit("2024-03-01 00:00:00")).otherwise("2024-02-01 00:00:00").cast("timestamp_ntz")
    period = F.when(second, F.lit("2024-01-01 00:00:00")).otherwise("2024-02-01 00:00:00").cast("timestamp_ntz")
    rows = rows.select(
        _s("c_custkey").alias("cedula"),
        F.when(second, F.upper(name)).otherwise(name).alias("nombre_institucion"),
        F.when(c("c_mktsegment") == "BUILDING", "")
        .when(c("c_mktsegment") == "MACHINERY", F.concat(c("n_name"), F.lit(","), c("r_name")))
        .when(c("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit(" , ,"), c("r_name")))
        .otherwise(F.concat(c("c_name"), F.lit(", "), c("n_name"), F.lit(", "), c("r_name")))
        .alias("zona_geo_inst"),
        F.lit("2020-01-01").alias("fecha_ingreso"),
        *_technical(loaded, "InstitucionesRegistradas.csv", period),
    )
    return _staged(rows, "stg_instituciones")


def stg_proveedores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers; those in debt are registered a second time, without geography."""
    c = F.col
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    rows = _with_versions(suppliers.join(_places(spark, sf_dir), "n_nationkey"), c("s_acctbal") < 0)
    second = c("version") == 1
    loaded = F.when(second, F.lit("2024-03-01 00:00:00")).otherwise("2024-02-01 00:00:00").cast("timestamp_ntz")
    zone = F.concat(c("s_name"), F.lit(", "), c("n_name"), F.lit(", "), c("r_name"))
    rows = rows.select(
        _s("s_suppkey").alias("cedula_proveedor"),
        F.when(second, F.upper("s_name")).otherwise(c("s_name")).alias("nombre_proveedor"),
        F.lit("Juridico").alias("tipo_proveedor"),
        F.when(c("s_acctbal") > 5000, "GRANDE").otherwise("PYME").alias("tamaÑo_proveedor"),
        F.lit("2010-01-01").alias("fecha_constitucion"),
        F.when(~second, zone).alias("zona_geo_prov"),
        F.lit("2020-01-01").alias("fecha_registro"),
        *_technical(loaded, "Proveedores.csv"),
    )
    return _staged(rows, "stg_proveedores")


STAGING_VIEWS = {
    "stg_instituciones": stg_instituciones,
    "stg_proveedores": stg_proveedores,
    "stg_carteles": stg_carteles,
    "stg_lineas_carteles": stg_lineas_carteles,
    "stg_ofertas": stg_ofertas,
    "stg_lineas_ofertadas": stg_lineas_ofertadas,
    "stg_procedimientos_adjudicacion": stg_procedimientos_adjudicacion,
    "stg_lineas_adjudicadas": stg_lineas_adjudicadas,
}

def staging(
    spark: SparkSession, sf_dir: str, names: Sequence[str] = tuple(STAGING_VIEWS), by_month: bool = False
) -> dict[str, DataFrame]:
    """Staging tables that are read several times: their lines are joined once, and lie by tender or ``by_month``."""
    lines = (lines_by_month if by_month else stored_lines)(spark, sf_dir, names) if set(names) & set(LINE_VIEWS) else None
    return {n: STAGING_VIEWS[n](spark, sf_dir, *([lines] if n in LINE_VIEWS else [])) for n in names}


def event_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a header history with many versions per key."""
    c = F.col
    rows = table(spark, sf_dir, "events").select(
        F.concat(_s("user_id"), F.lit("-"), c("event_type")).alias("nro_sicop"),
        c("props").alias("cartel_nm"),
        _money("value").alias("monto_est"),
        F.date_format("ts", "yyyyMM").alias("etl_period"),
        c("ts").alias("loaded_at"),
    )
    return rows


# --- model-shaped views, straight from the driver tables -------------------------------------------


def award_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return table(spark, sf_dir, "lineitem").join(orders, "l_orderkey").select(
        _s("l_orderkey").alias("nro_sicop"),
        award_number().alias("nro_oferta"),
        F.col("l_linenumber").alias("nro_linea"),
        F.col("l_extendedprice").cast("decimal(18,4)").alias("monto_adjudicado_linea"),
        _s("o_custkey").alias("cedula_institucion"),
        _s("l_suppkey").alias("cedula_proveedor"),
    )


def tender_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return table(spark, sf_dir, "lineitem").join(orders, "l_orderkey").select(
        _s("l_orderkey").alias("nro_sicop"),
        F.col("l_linenumber").alias("nro_linea"),
        _s("o_custkey").alias("cedula_institucion"),
        F.col("o_orderdate").alias("fecha_publicacion"),
    )


def buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _s("c_custkey").alias("cedula_institucion"), F.col("c_name").alias("nombre_institucion")
    )


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        _s("s_suppkey").alias("cedula_proveedor"), F.col("s_name").alias("nombre_proveedor")
    )


# --- facts that break their contracts ---------------------------------------------------------------

# Per fact: column, the rows that are changed, and the new value.  The expressions are SQL of both engines; the
# lines of some numbers get a negative amount, an over-long text, or a reference that leads nowhere.
PLANTED = {
    "lineas_carteles": (
        ("cantidad", "nro_linea = 2", "-cantidad"),
        ("precio_unitario_estimado", "nro_linea = 3", "-precio_unitario_estimado"),
        ("monto_total_linea_estimado", "nro_linea = 4", "-monto_total_linea_estimado"),
        ("monto_estimado_cartel_crc", "nro_linea = 5", "-monto_estimado_cartel_crc"),
        ("nombre_cartel", "nro_linea = 6", "repeat(nombre_cartel || ' ', 60)"),
        ("cedula_institucion", "nro_linea = 7", "'N' || cedula_institucion"),
    ),
    "lineas_ofertas": (
        ("cantidad_ofertada", "nro_linea = 2", "-cantidad_ofertada"),
        ("precio_unitario_ofertado", "nro_linea = 3", "-precio_unitario_ofertado"),
        ("tipo_moneda", "nro_linea = 4", "repeat(tipo_moneda, 11)"),
        ("cedula_proveedor", "nro_linea = 5", "'N' || cedula_proveedor"),
    ),
    "lineas_adjudicadas": (
        ("cantidad_adjudicada", "nro_linea = 2", "-cantidad_adjudicada"),
        ("precio_unitario_adjudicado", "nro_linea = 3", "-precio_unitario_adjudicado"),
        ("monto_adjudicado_linea", "nro_linea = 4", "-monto_adjudicado_linea"),
        ("descr_procedimiento", "nro_linea = 5", "repeat(descr_procedimiento || ' ', 40)"),
        ("cedula_institucion", "nro_linea = 6", "'N' || cedula_institucion"),
        ("cedula_proveedor", "nro_linea = 7", "'N' || cedula_proveedor"),
    ),
}


def planted(df: DataFrame, name: str) -> DataFrame:
    """A fact with the changes of ``PLANTED``."""
    new = {column: F.expr(f"CASE WHEN {where} THEN {value} ELSE {column} END") for column, where, value in PLANTED[name]}
    return df.select(*[new[c].cast(t).alias(c) if c in new else F.col(c) for c, t in df.dtypes])
