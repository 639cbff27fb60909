"""The registered queries: library operators on the driver's tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformance import files
from conformance import fixtures as fx
from tenderloom.functions import casts, text
from tenderloom.operators import quality
from tenderloom.operators.latest import latest_by, upsert_latest
from tenderloom.plans import catalog, dimensions, distinct_tenders, facts, refresh, reports
from tenderloom.plans.incremental import incremental_refresh
from tenderloom.schemas import (
    AWARD_LINES,
    BID_LINES,
    BUYERS,
    CATALOG,
    MONEY,
    RATE,
    STAGING,
    SUPPLIERS,
    TENDER_LINES,
    Column,
    Table,
)
from tenderloom.session import work_folder
from tenderloom.sources.archives import scan_archives
from tenderloom.sources.csv_files import scan_csv, stamp
from tenderloom.sources.tables import (
    last_n_periods,
    publish,
    read_model,
    read_staging_table,
    read_table,
    run_folder,
    upsert_table,
    write_staging,
    write_table,
)
from tenderloom.streaming.staging_stream import append_archives, append_staging

Query = Callable[[SparkSession, str], DataFrame]

LINE_KEYS = ("nro_sicop", "numero_linea", "codigo_identificacion", "etl_period")


# --- reports --------------------------------------------------------------------------------------


def supplier_buyer_ranking(spark, sf_dir):
    return reports.supplier_buyer_ranking(
        fx.award_lines(spark, sf_dir), fx.buyers(spark, sf_dir), fx.suppliers(spark, sf_dir)
    )


def awards_by_buyer_for_supplier(spark, sf_dir):
    return reports.awards_by_buyer_for_supplier(fx.award_lines(spark, sf_dir), fx.buyers(spark, sf_dir), "7")


def top_buyers_by_month(spark, sf_dir):
    return reports.top_buyers_by_month(fx.tender_lines(spark, sf_dir), fx.buyers(spark, sf_dir), 1996, 1)


def model_supplier_buyer_ranking(spark, sf_dir):
    """The ranking over facts and dimensions built from staging and written."""
    return reports.supplier_buyer_ranking(
        _written(spark, build_award_lines(spark, sf_dir), AWARD_LINES),
        _written(spark, build_buyer_dim(spark, sf_dir), BUYERS),
        _written(spark, build_supplier_dim(spark, sf_dir), SUPPLIERS),
    )


def _refreshed(spark, sf_dir) -> str:
    """The folder of a model after a full refresh."""
    target = work_folder(spark, "model")
    partitions = fx.line_partitions(spark, sf_dir)
    refresh.full_refresh(spark, fx.staging(spark, sf_dir), target, clustered=True, partitions=partitions)
    return target


def model_awards_by_buyer(spark, sf_dir):
    """The question of awards_by_buyer_for_supplier, asked of a refreshed model."""
    return reports.model_awards_by_buyer(spark, _refreshed(spark, sf_dir), "7")


def model_top_buyers(spark, sf_dir):
    """The question of top_buyers_by_month, asked of a refreshed model."""
    return reports.model_top_buyers(spark, _refreshed(spark, sf_dir), 1996, 1)


def upsert_stored(spark, sf_dir):
    """Buyers as first registered, published; those that came back later are upserted, the second time in vain."""
    target = work_folder(spark, "model")
    staged = fx.stg_instituciones(spark, sf_dir)
    first = dimensions.buyer_dimension(staged.where("loaded_at < timestamp_ntz'2024-03-01'"))
    write_table(first, run_folder(target, "first", BUYERS.name))
    publish(spark, target, "first", [BUYERS.name])
    for _ in range(2):
        newer = dimensions.buyer_dimension(staged.where("loaded_at >= timestamp_ntz'2024-03-01'"))
        upsert_table(spark, target, BUYERS, newer)
    return read_model(spark, target, BUYERS)


def upsert_fact(spark, sf_dir):
    """Bid lines with copied and null keys, published; those presented in 1996 come back with twice the quantity, twice."""
    target = work_folder(spark, "model")
    no_key = F.when(F.col("nro_linea") != 6, F.col("nro_oferta"))
    write_table(
        build_bid_lines(spark, sf_dir).withColumn("nro_oferta", no_key), run_folder(target, "first", BID_LINES.name)
    )
    publish(spark, target, "first", [BID_LINES.name])
    of_1996 = F.year("fecha_oferta_presentada") == 1996
    for _ in range(2):
        first = read_table(spark, run_folder(target, "first", BID_LINES.name), BID_LINES).where(of_1996)
        twice = (F.col("cantidad_ofertada") * 2).cast(MONEY)
        upsert_table(spark, target, BID_LINES, first.withColumn("cantidad_ofertada", twice))
    return read_model(spark, target, BID_LINES)


def _award_parts(spark, sf_dir) -> list[DataFrame]:
    """Award lines in three parts by amount, so that tenders lie in several of them."""
    awards, amount = fx.award_lines(spark, sf_dir), F.col("monto_adjudicado_linea")
    return [awards.where(amount < 20000), awards.where((amount >= 20000) & (amount < 50000)), awards.where(amount >= 50000)]


def merged_tenders_by_supplier(spark, sf_dir):
    """Distinct tenders per supplier, from bitmaps per buyer and supplier made part by part."""
    keys, numbers, parts = ["cedula_institucion", "cedula_proveedor"], None, []
    for part in _award_parts(spark, sf_dir):
        numbers = distinct_tenders.number_values(part, "nro_sicop", numbers)
        parts.append(distinct_tenders.distinct_parts(part, keys, "nro_sicop", numbers))
    return distinct_tenders.count_exactly(parts, ["cedula_proveedor"])


def sketched_tenders_by_supplier(spark, sf_dir):
    """Suppliers, and whether the estimate from merged sketches lies within four standard errors of the exact count."""
    keys = ["cedula_institucion", "cedula_proveedor"]
    sketches = [distinct_tenders.sketch_parts(part, keys, "nro_sicop") for part in _award_parts(spark, sf_dir)]
    estimated = distinct_tenders.estimate(sketches, ["cedula_proveedor"])
    exact = fx.award_lines(spark, sf_dir).groupBy("cedula_proveedor").agg(F.count_distinct("nro_sicop").alias("carteles"))
    off = F.abs(F.col("carteles_estimados") - F.col("carteles"))
    close = off <= 1 + 4 * distinct_tenders.SKETCH_ERROR * F.col("carteles")
    return estimated.join(exact, "cedula_proveedor").select("cedula_proveedor", "carteles", close.alias("within_error"))


# --- functions ------------------------------------------------------------------------------------


def scalar_text(spark, sf_dir):
    return fx.stg_lineas_carteles(spark, sf_dir).select(
        *LINE_KEYS,
        F.trim("desc_linea").alias("trimmed"),
        text.product_code(F.col("codigo_identificacion")).alias("code"),
        text.blank_to_null(F.trim("desc_linea")).alias("descr"),
        F.left("desc_linea", F.lit(5)).alias("first_chars"),
    )


def composite_key(spark, sf_dir):
    price = text.blank_to_null(F.col("precio_unitario_ofertado"))
    return fx.stg_lineas_ofertadas(spark, sf_dir).select(
        "nro_oferta",
        "nro_linea",
        text.composite_key(F.col("nro_oferta"), F.col("nro_linea")).alias("nro_oferta_nro_linea"),
        text.composite_key(F.col("nro_sicop"), price).alias("key_with_gaps"),
    )


def geo_split(spark, sf_dir):
    buyers = fx.stg_instituciones(spark, sf_dir).select("cedula", *text.geography(F.col("zona_geo_inst")))
    suppliers = fx.stg_proveedores(spark, sf_dir).select(
        F.col("cedula_proveedor").alias("cedula"), *text.geography(F.col("zona_geo_prov"))
    )
    return buyers.unionByName(suppliers)


def typed_cast(spark, sf_dir):
    return casts.select_typed(
        fx.stg_lineas_carteles(spark, sf_dir),
        [
            *[F.col(c) for c in LINE_KEYS],
            casts.number("nro_linea", F.col("numero_linea"), "int"),
            casts.number("nro_partida", F.col("numero_partida"), "int"),
            casts.number("cantidad", F.col("cantidad_solicitada"), MONEY),
            casts.number("cambio", F.col("tipo_cambio_crc"), RATE),
            casts.number("cod_producto", text.product_code(F.col("codigo_identificacion")), "bigint"),
        ],
    )


def rejected_casts(spark, sf_dir):
    """Quarantine: codes that are not numbers, or too long for one."""
    keys = ("nro_sicop", "nro_oferta", "nro_linea", "codigo_producto", "etl_period")
    flagged = casts.select_typed(
        fx.stg_lineas_adjudicadas(spark, sf_dir),
        [*[F.col(c) for c in keys], casts.number("cod_producto", F.trim("codigo_producto"), "bigint")],
        on_error="flag",
    )
    return casts.split_rejected(flagged)[1].drop(casts.REJECTED)


def parse_dates(spark, sf_dir):
    headers = casts.select_typed(
        fx.stg_carteles(spark, sf_dir),
        [
            F.col("nro_sicop").alias("id"),
            F.col("etl_period"),
            casts.day_of_timestamp("first_day", F.col("fecha_publicacion")),
            casts.day_of_timestamp("second_day", F.col("fechah_apertura")),
        ],
    )
    procedures = casts.select_typed(
        fx.stg_procedimientos_adjudicacion(spark, sf_dir),
        [
            text.composite_key(F.col("nro_sicop"), F.col("linea")).alias("id"),
            F.col("etl_period"),
            F.lit(None).cast("timestamp_ntz").alias("first_day"),
            casts.day_first_date("second_day", F.col("fecha_adjud_firme")),
        ],
    )
    return headers.unionByName(procedures.withColumn("second_day", F.col("second_day").cast("timestamp_ntz")))


# --- codes and catalog ----------------------------------------------------------------------------


def _lines(spark, sf_dir, lines, *names):
    """The lines that a caller shares between facts, or lines for the views of one fact: these are read twice."""
    return fx.stored_lines(spark, sf_dir, names or tuple(fx.LINE_VIEWS)) if lines is None else lines


def _sources(spark, sf_dir, lines=None):
    lines = _lines(spark, sf_dir, lines)
    return (
        fx.stg_lineas_carteles(spark, sf_dir, lines),
        fx.stg_lineas_ofertadas(spark, sf_dir, lines),
        fx.stg_lineas_adjudicadas(spark, sf_dir, lines),
        fx.stg_procedimientos_adjudicacion(spark, sf_dir, lines),
    )


def _valid(spark, sf_dir):
    return catalog.valid_codes(catalog.raw_codes(*_sources(spark, sf_dir)))


def product_codes_union(spark, sf_dir):
    raw = catalog.raw_codes(*_sources(spark, sf_dir))
    return raw.groupBy("cod_producto", "descr").agg(F.count("*").alias("n"))


def valid_product_codes(spark, sf_dir):
    return _valid(spark, sf_dir)


def distinct_product_codes(spark, sf_dir):
    return catalog.distinct_codes(_valid(spark, sf_dir))


def description_counts(spark, sf_dir):
    return catalog.description_counts(_valid(spark, sf_dir))


def product_mode(spark, sf_dir):
    return catalog.product_names(catalog.description_counts(_valid(spark, sf_dir)))


def commodity_mode(spark, sf_dir):
    return catalog.commodity_names(catalog.description_counts(_valid(spark, sf_dir)))


def product_hierarchy(spark, sf_dir):
    codes = catalog.distinct_codes(_valid(spark, sf_dir))
    return codes.select("cod_producto", *text.hierarchy(F.col("cod_producto")))


def segment_lookup(spark, sf_dir):
    segment = F.substring("cod_producto", 1, 2).cast("int").alias("segmento")
    named = catalog.with_segment_name(_valid(spark, sf_dir).select(segment))
    return named.groupBy("segmento", "nombre_segmento").agg(F.count("*").alias("n_rows"))


def build_product_catalog(spark, sf_dir, lines=None):
    return catalog.product_catalog(*_sources(spark, sf_dir, lines))


# --- latest versions, dimensions, facts -----------------------------------------------------------


def latest_header(spark, sf_dir):
    return latest_by(fx.event_headers(spark, sf_dir), ["nro_sicop"])


def latest_tender(spark, sf_dir):
    return facts.latest_tenders(fx.stg_carteles(spark, sf_dir))


def latest_bid(spark, sf_dir):
    return facts.latest_bids(fx.stg_ofertas(spark, sf_dir))


def latest_line(spark, sf_dir):
    return facts.latest_tender_lines(fx.stg_lineas_carteles(spark, sf_dir))


def latest_bid_line(spark, sf_dir):
    return facts.latest_bid_lines(fx.stg_lineas_ofertadas(spark, sf_dir))


def latest_award_line(spark, sf_dir):
    return facts.latest_award_lines(fx.stg_lineas_adjudicadas(spark, sf_dir))


def latest_procedure(spark, sf_dir):
    return facts.latest_procedures(fx.stg_procedimientos_adjudicacion(spark, sf_dir))


def latest_supplier_dim(spark, sf_dir):
    return dimensions.latest_suppliers(fx.stg_proveedores(spark, sf_dir))


def latest_buyer_dim(spark, sf_dir):
    return dimensions.latest_buyers(fx.stg_instituciones(spark, sf_dir))


def upsert(spark, sf_dir):
    """Lines of up to the end of 1998 as the table, later ones as the increment."""
    columns = [*LINE_KEYS[:3], "precio_unitario_estimado", "tipo_moneda", "desc_linea", "etl_period", "loaded_at"]
    lines = fx.stg_lineas_carteles(spark, sf_dir).select(*columns)
    existing = latest_by(lines.where(F.col("etl_period") <= "199812"), LINE_KEYS[:3])
    return upsert_latest(existing, lines.where(F.col("etl_period") > "199812"), LINE_KEYS[:3])


def build_supplier_dim(spark, sf_dir):
    return dimensions.supplier_dimension(fx.stg_proveedores(spark, sf_dir))


def build_buyer_dim(spark, sf_dir):
    return dimensions.buyer_dimension(fx.stg_instituciones(spark, sf_dir))


def build_tender_lines(spark, sf_dir, lines=None):
    lines = _lines(spark, sf_dir, lines, "stg_lineas_carteles")
    return facts.tender_line_fact(
        fx.stg_lineas_carteles(spark, sf_dir, lines), fx.stg_carteles(spark, sf_dir), clustered=True,
        partitions=fx.line_partitions(spark, sf_dir),
    )


def build_bid_lines(spark, sf_dir, lines=None):
    lines = _lines(spark, sf_dir, lines, "stg_lineas_ofertadas")
    return facts.bid_line_fact(
        fx.stg_lineas_ofertadas(spark, sf_dir, lines), fx.stg_ofertas(spark, sf_dir),
        partitions=fx.line_partitions(spark, sf_dir),
    )


def build_award_lines(spark, sf_dir, lines=None):
    lines = _lines(spark, sf_dir, lines)
    return facts.award_line_fact(
        fx.stg_lineas_adjudicadas(spark, sf_dir, lines), fx.stg_procedimientos_adjudicacion(spark, sf_dir, lines),
        clustered=True, partitions=fx.line_partitions(spark, sf_dir),
    )


def _incremental(spark, sf_dir, table: Table, *sources: str) -> DataFrame:
    """A model table after three incremental refreshes: the newest periods come first, then the oldest, then the rest."""
    staging, target = work_folder(spark, "staging"), work_folder(spark, "model")
    views = fx.staging(spark, sf_dir, sources, by_month=True)
    period = F.coalesce("etl_period", F.lit(""))
    for part in (period > "199706", period <= "199412", (period > "199412") & (period <= "199706")):
        for name in sources:
            write_staging(views[name].where(part), f"{staging}/{name}", laid_out=name in fx.LINE_VIEWS)
        incremental_refresh(spark, staging, target, [table])
    return read_model(spark, target, table)


def incremental_tender_lines(spark, sf_dir):
    return _incremental(spark, sf_dir, TENDER_LINES, "stg_lineas_carteles", "stg_carteles")


def incremental_bid_lines(spark, sf_dir):
    return _incremental(spark, sf_dir, BID_LINES, "stg_lineas_ofertadas", "stg_ofertas")


def incremental_award_lines(spark, sf_dir):
    return _incremental(spark, sf_dir, AWARD_LINES, "stg_lineas_adjudicadas", "stg_procedimientos_adjudicacion")


def incremental_catalog(spark, sf_dir):
    """The catalog from mention counts that are added up load by load."""
    return _incremental(
        spark, sf_dir, CATALOG, "stg_lineas_carteles", "stg_lineas_ofertadas", "stg_lineas_adjudicadas",
        "stg_procedimientos_adjudicacion",
    )


# --- quality --------------------------------------------------------------------------------------


def _written(spark, df, table: Table, columns: list[str] | None = None) -> DataFrame:
    """Checks and reports read a table more than once, so it, or ``columns`` of it, is written first, as a refresh does."""
    folder = work_folder(spark, table.name)
    if columns is None:
        write_table(df, folder)
        return read_table(spark, folder, table)
    rows = df.select(*columns)
    write_table(rows, folder)
    return spark.read.schema(rows.schema).parquet(folder)


def pk_violations(spark, sf_dir):
    lines = _written(spark, build_tender_lines(spark, sf_dir), TENDER_LINES)
    return quality.pk_violations(lines, TENDER_LINES)


def unique_violations(spark, sf_dir):
    return quality.unique_violations(_written(spark, build_bid_lines(spark, sf_dir), BID_LINES), BID_LINES)


def _also_required(table: Table, column: str) -> Table:
    columns = tuple(Column(c.name, c.type, c.length, c.required or c.name == column) for c in table.columns)
    return Table(table.name, columns, table.primary_key)


def not_null_violations(spark, sf_dir):
    """Contract columns, plus one per table that does hold NULLs: the buyer and the opening date."""
    keep, lines = ("nro_sicop", "nro_linea"), fx.stored_lines(spark, sf_dir)
    awards = quality.not_null_violations(
        build_award_lines(spark, sf_dir, lines), _also_required(AWARD_LINES, "cedula_institucion"), keep
    )
    tenders = quality.not_null_violations(
        build_tender_lines(spark, sf_dir, lines), _also_required(TENDER_LINES, "fecha_apertura"), keep
    )
    return awards.unionByName(tenders)


def _reference_columns(table: Table) -> list[str]:
    """Line numbers and the columns that references start from or lead to."""
    used = {"nro_sicop", "nro_linea", *table.primary_key, *[c for fk in table.foreign_keys for c in fk.columns]}
    return [c for c in table.names if c in used]


def _planted_facts(spark, sf_dir, keys_only: bool = False) -> dict[str, DataFrame]:
    """The three facts with broken rows of every kind, and the dimensions they refer to, all written.

    ``keys_only`` writes the columns that references are checked by, of all rows.
    """
    facts_ = {
        TENDER_LINES: build_tender_lines, BID_LINES: build_bid_lines, AWARD_LINES: build_award_lines,
    }
    lines = fx.stored_lines(spark, sf_dir)
    tables = {t: fx.planted(build(spark, sf_dir, lines), t.name) for t, build in facts_.items()}
    tables[BUYERS], tables[SUPPLIERS] = build_buyer_dim(spark, sf_dir), build_supplier_dim(spark, sf_dir)
    tables[CATALOG] = build_product_catalog(spark, sf_dir, lines)
    return {t.name: _written(spark, df, t, _reference_columns(t) if keys_only else None) for t, df in tables.items()}


def _per_fact(spark, sf_dir, report) -> DataFrame:
    """A report over each planted fact, with the name of the fact."""
    parts, lines = [], fx.stored_lines(spark, sf_dir)
    for table in (TENDER_LINES, BID_LINES, AWARD_LINES):
        build = {TENDER_LINES: build_tender_lines, BID_LINES: build_bid_lines, AWARD_LINES: build_award_lines}[table]
        found = report(fx.planted(build(spark, sf_dir, lines), table.name), table, ("nro_sicop", "nro_linea"))
        parts.append(found.select(F.lit(table.name).alias("table_name"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def length_violations(spark, sf_dir):
    return _per_fact(spark, sf_dir, quality.length_violations)


def check_nonnegative(spark, sf_dir):
    return _per_fact(spark, sf_dir, quality.check_violations)


def fk_orphans(spark, sf_dir):
    """Lines without their product, buyer or supplier, by every reference of one column that the facts declare."""
    tables, parts = _planted_facts(spark, sf_dir, keys_only=True), []
    for table in (TENDER_LINES, BID_LINES, AWARD_LINES):
        for fk in table.foreign_keys:
            if len(fk.columns) > 1:
                continue
            rows = tables[table.name].select("nro_sicop", "nro_linea", *fk.columns)
            orphans = quality.orphan_rows(rows, fk.columns, tables[fk.table], fk.ref_columns)
            found = orphans.select(
                F.lit(table.name).alias("table_name"), F.lit(fk.name).alias("reference"), "nro_sicop", "nro_linea",
                F.col(fk.columns[0]).cast("string").alias("missing"),
            )
            # Written one by one, so that the shuffle files of a reference are gone before the next is matched.
            folder = work_folder(spark, "orphans")
            write_table(found, folder)
            parts.append(spark.read.schema(found.schema).parquet(folder))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found


def fk_orphans_composite(spark, sf_dir):
    """Award lines without their bid line."""
    key = ["nro_sicop", "nro_oferta", "nro_linea"]
    stored = fx.stored_lines(spark, sf_dir)
    lines = _written(spark, build_award_lines(spark, sf_dir, stored), AWARD_LINES, [*key, "cod_producto"])
    bids = _written(spark, build_bid_lines(spark, sf_dir, stored), BID_LINES, key)
    return quality.orphan_rows(lines, key, bids, key)


def contract_report(spark, sf_dir):
    """Every rule of the three facts, counted on the planted ones: one line per rule that is broken."""
    tables = _planted_facts(spark, sf_dir)
    parts = [
        quality.violation_counts(tables[t.name], t, tables, with_rows=True, one_by_one=True)
        for t in (TENDER_LINES, BID_LINES, AWARD_LINES)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _split(spark, sf_dir) -> list[tuple[Table, DataFrame, DataFrame]]:
    tables = _planted_facts(spark, sf_dir)
    return [(t, *quality.split_by_contract(tables[t.name], t, tables)) for t in (TENDER_LINES, BID_LINES, AWARD_LINES)]


def _lines_of(parts, *more) -> DataFrame:
    found = None
    for table, df in parts:
        rows = df.select(F.lit(table.name).alias("table_name"), "nro_sicop", "nro_linea", "cod_producto", *more)
        found = rows if found is None else found.unionByName(rows)
    return found


def quarantine_clean(spark, sf_dir):
    """Planted fact lines that keep every rule of their contract."""
    return _lines_of((t, clean) for t, clean, _ in _split(spark, sf_dir))


def quarantine_rejects(spark, sf_dir):
    """Planted fact lines that break a rule, with the number of different kinds of rules."""
    kinds = F.size("broken_rules").alias("n_kinds")
    return _lines_of(((t, rejected) for t, _, rejected in _split(spark, sf_dir)), kinds)


def quarantine_reasons(spark, sf_dir):
    """Planted fact lines that break a rule, with every rule they break, its columns and its limit."""
    reasons = F.array_join("reasons", "; ").alias("reasons")
    return _lines_of(((t, rejected) for t, _, rejected in _split(spark, sf_dir)), reasons)


def full_refresh_summary(spark, sf_dir):
    staging, partitions = fx.staging(spark, sf_dir), fx.line_partitions(spark, sf_dir)
    return refresh.full_refresh(spark, staging, work_folder(spark, "model"), clustered=True, partitions=partitions)


# --- ingestion ------------------------------------------------------------------------------------


def _payload(name: str) -> list[str]:
    return STAGING[name].names[:-4]


def last_periods(spark, sf_dir):
    """Staging written partitioned by period, then the last seven periods up to December 1998."""
    folder = work_folder(spark, "staging")
    write_staging(fx.stg_lineas_carteles(spark, sf_dir), folder)
    staged = read_staging_table(spark, folder, "stg_lineas_carteles")
    return last_n_periods(staged, dt.date(1998, 12, 31)).select(*_payload("stg_lineas_carteles"), "etl_period")


def _csv(spark, sf_dir, name) -> str:
    folder, by_month = work_folder(spark, "csv"), name in fx.LINE_VIEWS
    rows = fx.staging(spark, sf_dir, [name], by_month=True)[name].select(*_payload(name), "etl_period")
    files.write_monthly_csv(rows, folder, laid_out=by_month)
    return folder


def csv_staging_scan(spark, sf_dir):
    folder = _csv(spark, sf_dir, "stg_lineas_carteles")
    columns = ["nro_sicop", "numero_linea", "codigo_identificacion", "desc_linea", "monto_reservado"]
    return scan_csv(spark, f"{folder}/*", columns)


def stamp_metadata(spark, sf_dir):
    folder = _csv(spark, sf_dir, "stg_carteles")
    rows = scan_csv(spark, f"{folder}/*", _payload("stg_carteles"))
    stamped = stamp(rows, fx.BATCH, period_pattern=r"etl_period=(\d{6})")
    return stamped.select(*_payload("stg_carteles"), "etl_period", "batch_id")


def staging_append_stream(spark, sf_dir):
    source, target = _csv(spark, sf_dir, "stg_carteles"), work_folder(spark, "staging")
    columns = _payload("stg_carteles")
    append_staging(
        spark,
        f"{source}/*",
        target,
        work_folder(spark, "offsets"),
        columns,
        columns,
        batch_id=fx.BATCH,
        period_pattern=r"etl_period=(\d{6})",
    )
    staged = read_staging_table(spark, target, "stg_carteles")
    return staged.select(*columns, "etl_period", "batch_id")


def archive_ingest(spark, sf_dir):
    folder, columns = work_folder(spark, "zip"), _payload("stg_lineas_ofertadas")
    files.write_monthly_zips(fx.stg_lineas_ofertadas(spark, sf_dir), folder, "LineasOfertadas.csv", columns)
    rows = scan_archives(
        spark, folder, "LineasOfertadas.csv", columns, fx.BATCH, period_pattern=r"/(\d{6})-\d{5}\.zip"
    )
    return rows.select(*columns, "etl_period", "batch_id")


def archive_append_stream(spark, sf_dir):
    """The archives of the seven months up to December 1998, loaded incrementally."""
    table, member, folder = "stg_lineas_ofertadas", "LineasOfertadas.csv", work_folder(spark, "zip")
    columns, staging = _payload(table), work_folder(spark, "staging")
    files.write_monthly_zips(fx.stg_lineas_ofertadas(spark, sf_dir), folder, member, columns)
    append_archives(
        spark,
        folder,
        staging,
        work_folder(spark, "offsets"),
        {member: table},
        as_of=dt.date(1998, 12, 31),
        batch_id=fx.BATCH,
        period_pattern=r"/(\d{6})-\d{5}\.zip",
    )
    return read_staging_table(spark, f"{staging}/{table}", table).select(*columns, "etl_period", "batch_id")


def staging_append_twice(spark, sf_dir):
    """Tender headers of even and odd months from two sources with a manifest each, and all of them written once more."""
    target, name = work_folder(spark, "staging"), "stg_carteles"
    columns, rows = _payload(name), fx.stg_carteles(spark, sf_dir)
    for odd in (0, 1):
        source = work_folder(spark, "csv")
        files.write_monthly_csv(rows.where(F.col("etl_period").cast("int") % 2 == odd).select(*columns, "etl_period"), source)
        for _ in range(2):  # the second load finds nothing new
            append_staging(
                spark, f"{source}/*", target, f"{target}-manifest-{odd}", columns, columns,
                batch_id=fx.BATCH, period_pattern=r"etl_period=(\d{6})", files_per_batch=50,
            )
    write_staging(rows, target)
    return read_staging_table(spark, target, name).select(*columns, "etl_period", "batch_id")


def archive_window_moves(spark, sf_dir):
    """One manifest, three windows: December 1998 back, then June 1998 back (nothing new), then all months."""
    table, member, folder = "stg_lineas_ofertadas", "LineasOfertadas.csv", work_folder(spark, "zip")
    columns, staging, manifest = _payload(table), work_folder(spark, "staging"), work_folder(spark, "manifest")
    files.write_monthly_zips(fx.stg_lineas_ofertadas(spark, sf_dir), folder, member, columns)
    for as_of, months in ((dt.date(1998, 12, 31), 7), (dt.date(1998, 12, 31), 3), (dt.date(1998, 6, 30), 12), (None, 0)):
        append_archives(
            spark, folder, staging, manifest, {member: table}, as_of=as_of, months=months,
            batch_id=fx.BATCH, period_pattern=r"/(\d{6})-\d{5}\.zip",
        )
    return read_staging_table(spark, f"{staging}/{table}", table).select(*columns, "etl_period", "batch_id")


QUERIES: dict[str, Query] = {
    "supplier_buyer_ranking": supplier_buyer_ranking,
    "awards_by_buyer_for_supplier": awards_by_buyer_for_supplier,
    "top_buyers_by_month": top_buyers_by_month,
    "model_supplier_buyer_ranking": model_supplier_buyer_ranking,
    "model_awards_by_buyer": model_awards_by_buyer,
    "model_top_buyers": model_top_buyers,
    "scalar_text": scalar_text,
    "composite_key": composite_key,
    "geo_split": geo_split,
    "typed_cast": typed_cast,
    "rejected_casts": rejected_casts,
    "parse_dates": parse_dates,
    "product_hierarchy": product_hierarchy,
    "segment_lookup": segment_lookup,
    "latest_header": latest_header,
    "latest_tender": latest_tender,
    "latest_bid": latest_bid,
    "latest_line": latest_line,
    "latest_bid_line": latest_bid_line,
    "latest_award_line": latest_award_line,
    "latest_procedure": latest_procedure,
    "latest_supplier_dim": latest_supplier_dim,
    "latest_buyer_dim": latest_buyer_dim,
    "upsert_latest": upsert,
    "merged_tenders_by_supplier": merged_tenders_by_supplier,
    "sketched_tenders_by_supplier": sketched_tenders_by_supplier,
    "upsert_stored": upsert_stored,
    "upsert_fact": upsert_fact,
    "product_codes_union": product_codes_union,
    "valid_product_codes": valid_product_codes,
    "distinct_product_codes": distinct_product_codes,
    "description_counts": description_counts,
    "product_mode": product_mode,
    "commodity_mode": commodity_mode,
    "build_supplier_dim": build_supplier_dim,
    "build_buyer_dim": build_buyer_dim,
    "build_product_catalog": build_product_catalog,
    "build_tender_lines": build_tender_lines,
    "build_bid_lines": build_bid_lines,
    "build_award_lines": build_award_lines,
    "incremental_tender_lines": incremental_tender_lines,
    "incremental_bid_lines": incremental_bid_lines,
    "incremental_award_lines": incremental_award_lines,
    "incremental_catalog": incremental_catalog,
    "pk_violations": pk_violations,
    "unique_violations": unique_violations,
    "not_null_violations": not_null_violations,
    "length_violations": length_violations,
    "check_nonnegative": check_nonnegative,
    "fk_orphans": fk_orphans,
    "fk_orphans_composite": fk_orphans_composite,
    "contract_report": contract_report,
    "quarantine_clean": quarantine_clean,
    "quarantine_rejects": quarantine_rejects,
    "quarantine_reasons": quarantine_reasons,
    "last_n_periods": last_periods,
    "csv_staging_scan": csv_staging_scan,
    "stamp_metadata": stamp_metadata,
    "staging_append_stream": staging_append_stream,
    "archive_ingest": archive_ingest,
    "archive_append_stream": archive_append_stream,
    "staging_append_twice": staging_append_twice,
    "archive_window_moves": archive_window_moves,
    "full_refresh_summary": full_refresh_summary,
}
