"""Dimensions, catalog, facts and reports on hand-made rows; expected values follow the data rules."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tenderloom.functions.casts import split_rejected
from tenderloom.plans import catalog, dimensions, facts, reports
from tenderloom.schemas import AWARD_LINES, BID_LINES, BUYERS, CATALOG, SUPPLIERS, TENDER_LINES

TEN, ELEVEN = dt.datetime(2026, 3, 1, 10), dt.datetime(2026, 3, 1, 11)
DAY = dt.datetime(2026, 1, 5)
CODE = "4321150101234567"
NEW = {"etl_period": "202602", "loaded_at": TEN}


def same_schema(df, table):
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in table.struct()]


# --- dimensions -----------------------------------------------------------------------------------


def test_supplier_dimension(staged):
    rows = [
        {"cedula_proveedor": "1", "nombre_proveedor": "late", "tamaÑo_proveedor": "PYME", "zona_geo_prov": "D, C, P",
         "etl_period": "202601", "loaded_at": ELEVEN},
        {"cedula_proveedor": "1", "nombre_proveedor": "early", "etl_period": "202602", "loaded_at": TEN},
        {"cedula_proveedor": "2", "nombre_proveedor": "other", "zona_geo_prov": "D2", "loaded_at": TEN},
    ]
    df = dimensions.supplier_dimension(staged("stg_proveedores", rows))
    same_schema(df, SUPPLIERS)
    got = {r.cedula_proveedor: r for r in df.collect()}
    assert (got["1"].nombre_proveedor, got["1"].tamano) == ("late", "PYME")
    assert (got["1"].distrito, got["1"].canton, got["1"].provincia) == ("D", "C", "P")
    assert (got["2"].distrito, got["2"].canton, got["2"].provincia) == ("D2", None, None)


def test_buyer_dimension(staged):
    rows = [
        {"cedula": "1", "nombre_institucion": "old", "zona_geo_inst": "D,C,P", "loaded_at": TEN},
        {"cedula": "1", "nombre_institucion": "new", "zona_geo_inst": "", "loaded_at": None},
    ]
    df = dimensions.buyer_dimension(staged("stg_instituciones", rows))
    same_schema(df, BUYERS)
    assert df.collect()[0].asDict() == {
        "cedula_institucion": "1", "nombre_institucion": "new", "provincia": None, "canton": None, "distrito": None,
    }


# --- catalog --------------------------------------------------------------------------------------


def build_catalog(staged, mentions, bids=(), awards=(), procedures=(), hot_rows=10**6):
    return catalog.product_catalog(
        staged("stg_lineas_carteles", [{"codigo_identificacion": c, "desc_linea": d} for c, d in mentions]),
        staged("stg_lineas_ofertadas", [{"codigo_producto_cl": c} for c in bids]),
        staged("stg_lineas_adjudicadas", [{"codigo_producto": c} for c in awards]),
        staged("stg_procedimientos_adjudicacion", [{"prod_id": c} for c in procedures]),
        hot_rows,
    )


def test_catalog_names_and_hierarchy(staged):
    df = build_catalog(staged, [(CODE, "b"), (CODE, "a"), (CODE, " b "), (CODE, "a")])
    same_schema(df, CATALOG)
    row = df.collect()[0]
    assert row.cod_producto == int(CODE)
    assert row.descripcion_producto == "a"  # tie: first in text order
    assert (row.segmento, row.familia, row.clases, row.mercancias) == (43, 4321, 432115, 43211501)
    assert row.nombre_segmento == "Tecnología de información, telecomunicaciones y radiodifusión"
    assert row.nombre_mercancia == "a"


def test_commodity_name_comes_from_summed_counts(staged, no_broadcast):
    x = [CODE[:8] + f"{i:08d}" for i in range(3)]
    mentions = [(x[0], "p")] * 3 + [(x[1], "q")] * 2 + [(x[2], "q")] * 2
    for hot_rows in (1, 10**6):
        rows = build_catalog(staged, mentions, hot_rows=hot_rows).collect()
        assert {r.descripcion_producto for r in rows} == {"p", "q"}
        assert {r.nombre_mercancia for r in rows} == {"q"}
        assert len(rows) == 3


def test_codes_of_all_sources_and_only_valid_ones(staged):
    rows = build_catalog(
        staged,
        [("0112345678901234", "x"), ("123456789012345", "short"), ("A123456789012345", "letter"), ("", "blank"), (None, "null")],
        bids=[" 9912345678901234 "],
        awards=["10000000000000010042"],
        procedures=["1100000000000002", "X"],
    ).collect()
    got = {r.cod_producto: r for r in rows}
    assert set(got) == {112345678901234, 9912345678901234, 1000000000000001, 1100000000000002}
    assert got[112345678901234].segmento == 1  # the leading zero counts before the cast
    assert got[9912345678901234].nombre_segmento is None
    assert got[9912345678901234].descripcion_producto is None
    assert got[1000000000000001].nombre_segmento == "Animales vivos, accesorios y suministros"


def test_blank_description_is_not_counted_but_the_code_stays(staged):
    rows = build_catalog(staged, [(CODE, "   "), (CODE, "   "), (CODE, "x")]).collect()
    assert [r.descripcion_producto for r in rows] == ["x"]
    rows = build_catalog(staged, [(CODE, "   ")]).collect()
    assert [(r.cod_producto, r.descripcion_producto, r.nombre_mercancia) for r in rows] == [(int(CODE), None, None)]


def test_descriptions_are_cut(staged):
    row = build_catalog(staged, [(CODE, "x" * 600)]).collect()[0]
    assert (len(row.descripcion_producto), len(row.nombre_mercancia)) == (500, 255)


def test_reloaded_months_count_again(staged):
    valid = catalog.valid_codes(
        catalog.raw_codes(
            staged("stg_lineas_carteles", [{"codigo_identificacion": CODE, "desc_linea": "x"}] * 2),
            staged("stg_lineas_ofertadas", []),
            staged("stg_lineas_adjudicadas", []),
            staged("stg_procedimientos_adjudicacion", []),
        )
    )
    assert [r.n for r in catalog.description_counts(valid).collect()] == [2]


def test_catalog_scans_staging_once(spark, staged, no_broadcast, plan_of, tmp_path):
    def stored(name, rows):
        staged(name, rows).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    df = build_catalog(stored, [(CODE, "x"), ("1" * 16, "y")], bids=[CODE], awards=[CODE], procedures=[CODE])
    executed = plan_of(df, run=True)
    assert "ReusedExchange [cod_producto" in executed
    # The executed part of the plan, nested plans left out, reads each source once.
    assert executed.split("== Initial Plan ==")[0].count("[codigo_identificacion#") == 1


def test_segment_names_are_broadcast(staged, plan_of):
    assert "BroadcastHashJoin [segmento" in plan_of(build_catalog(staged, [(CODE, "x")]))


# --- facts ----------------------------------------------------------------------------------------


def line(**values):
    return {"nro_sicop": "S1", "numero_linea": "1", "codigo_identificacion": CODE, **NEW, **values}


def tender_lines(staged, lines, tenders=(), **options):
    return facts.tender_line_fact(
        staged("stg_lineas_carteles", lines), staged("stg_carteles", list(tenders)), **options
    )


def test_tender_line(staged):
    df = tender_lines(
        staged,
        [line(numero_partida="2", cantidad_solicitada="3", precio_unitario_estimado="1.00005", monto_reservado="",
              tipo_moneda="USD", tipo_cambio_crc="512.5", codigo_identificacion=f" {CODE}0042 ")],
        [{"nro_sicop": "S1", "nro_procedimiento": "P1", "cartel_nm": "n" * 600, "cartel_stat": "st", "clas_obj": "cl",
          "monto_est": "10", "cedula_institucion": "B1", "tipo_procedimiento": "t", "modalidad_procedimiento": "m",
          "fecha_publicacion": "2026-01-05 13:14:15.678", "fechah_apertura": "", **NEW}],
    )
    same_schema(df, TENDER_LINES)
    assert df.collect()[0].asDict() == {
        "nro_sicop": "S1",
        "nro_procedimiento": "P1",
        "nro_sicop_nro_linea": "S1_1",
        "nombre_cartel": "n" * 500,
        "status_cartel": "st",
        "clasificacion_cartel": "cl",
        "monto_estimado_cartel_crc": Decimal("10.0000"),
        "nro_linea": 1,
        "nro_partida": 2,
        "cod_producto": int(CODE),
        "cantidad": Decimal("3.0000"),
        "precio_unitario_estimado": Decimal("1.0001"),
        "monto_total_linea_estimado": None,
        "tipo_moneda": "USD",
        "tipo_cambio_crc": Decimal("512.500000"),
        "cedula_institucion": "B1",
        "tipo_procedimiento": "t",
        "modalidad_procedimiento": "m",
        "fecha_publicacion": DAY,
        "fecha_apertura": None,
    }


def test_line_without_header_and_null_key_stay(staged, no_broadcast):
    lines = [line(nro_sicop="S9"), line(nro_sicop=None)]
    for hot_rows in (1, 10**6):
        df = tender_lines(staged, lines, [{"nro_sicop": None, "cartel_stat": "x"}, {"nro_sicop": "S1"}], hot_rows=hot_rows)
        got = {r.nro_sicop: (r.status_cartel, r.nro_sicop_nro_linea) for r in df.collect()}
        assert got == {"S9": (None, "S9_1"), None: (None, "_1")}


def test_one_line_with_two_codes_stays_twice(staged):
    df = tender_lines(staged, [line(), line(codigo_identificacion="1" * 16)])
    assert sorted(r.cod_producto for r in df.collect()) == [1111111111111111, int(CODE)]


def test_line_numbers_are_compared_as_text_and_typed_later(staged):
    df = tender_lines(staged, [line(), line(numero_linea="01")])
    assert sorted((r.nro_linea, r.nro_sicop_nro_linea) for r in df.collect()) == [(1, "S1_01"), (1, "S1_1")]


def test_exact_reload_gives_one_row_and_latest_wins(staged):
    lines = [line(monto_reservado="1"), line(monto_reservado="1"), line(monto_reservado="2", etl_period="202603")]
    assert [r.monto_total_linea_estimado for r in tender_lines(staged, lines).collect()] == [Decimal("2.0000")]


def test_unreadable_amount_stops_or_is_split_off(staged):
    lines = [line(), line(numero_linea="2", monto_reservado=" "), line(numero_linea="x", cantidad_solicitada="y")]
    with pytest.raises(Exception, match="cannot read"):
        tender_lines(staged, lines).collect()
    clean, rejected = split_rejected(tender_lines(staged, lines, on_error="flag"))
    same_schema(clean, TENDER_LINES)
    assert [r.nro_linea for r in clean.collect()] == [1]
    assert sorted(tuple(r.rejected_columns) for r in rejected.collect()) == [
        ("monto_total_linea_estimado",),
        ("nro_linea", "cantidad"),
    ]


def test_bid_line(staged):
    lines = [{"nro_sicop": "S1", "nro_oferta": "O1", "nro_linea": "3", "codigo_producto_cl": f" {CODE} ",
              "cantidad_ofertada": "2", "precio_unitario_ofertado": "", "tipo_moneda": "CRC", "tipo_cambio_crc": "", **NEW}]
    bids = [
        {"nro_oferta": "O1", "cedula_proveedor": "P1", "fecha_presenta_oferta": "2026-01-05 10:00:00 CST", "tipo_oferta": "B",
         "etl_period": "202601", "loaded_at": TEN},
        {"nro_oferta": "O1", "cedula_proveedor": "P0", "etl_period": "202512", "loaded_at": ELEVEN},
    ]
    df = facts.bid_line_fact(staged("stg_lineas_ofertadas", lines), staged("stg_ofertas", bids))
    same_schema(df, BID_LINES)
    assert df.collect()[0].asDict() == {
        "nro_oferta_nro_linea": "O1_3",
        "cedula_proveedor": "P1",
        "fecha_oferta_presentada": DAY,
        "tipo_oferta": "B",
        "nro_oferta": "O1",
        "cod_producto": int(CODE),
        "nro_sicop": "S1",
        "nro_linea": 3,
        "nro_sicop_nro_linea": "S1_3",
        "cantidad_ofertada": Decimal("2.0000"),
        "precio_unitario_ofertado": None,
        "tipo_moneda": "CRC",
        "tipo_cambio_crc": None,
    }


def test_bid_codes_are_not_cut(staged):
    lines = staged("stg_lineas_ofertadas", [{"nro_oferta": "O1", "nro_linea": "1", "codigo_producto_cl": CODE + "0042"}])
    bids = staged("stg_ofertas", [])
    with pytest.raises(Exception, match="cod_producto: cannot read"):
        facts.bid_line_fact(lines, bids).collect()
    _, rejected = split_rejected(facts.bid_line_fact(lines, bids, on_error="flag"))
    assert [r.rejected_columns for r in rejected.collect()] == [["cod_producto"]]


def award(**values):
    return {"nro_sicop": "S1", "nro_oferta": "O1", "nro_linea": "1", "codigo_producto": CODE, "cedula_proveedor": "P1",
            "cantidad_adjudicada": "1", "precio_unitario_adjudicado": "2", "tipo_moneda": "CRC", **NEW, **values}


def procedure(**values):
    return {"nro_sicop": "S1", "linea": "1", "prod_id": CODE, "cedula": "B1", "numero_procedimiento": "N1",
            "descr_procedimiento": "d", "fecha_adjud_firme": "5/1/2026", "monto_adju_linea": "100.5", **NEW, **values}


def award_lines(staged, lines, procedures, **options):
    return facts.award_line_fact(
        staged("stg_lineas_adjudicadas", lines), staged("stg_procedimientos_adjudicacion", procedures), **options
    )


def test_award_line_takes_amount_buyer_and_date_from_the_procedure(staged):
    df = award_lines(staged, [award(codigo_producto=f" {CODE}0042")], [procedure(prod_id=f"{CODE} ")])
    same_schema(df, AWARD_LINES)
    assert df.collect()[0].asDict() == {
        "nro_sicop_nro_linea": "S1_1",
        "nro_sicop": "S1",
        "nro_oferta": "O1",
        "nro_procedimiento": "N1",
        "nro_linea": 1,
        "descr_procedimiento": "d",
        "cantidad_adjudicada": Decimal("1.0000"),
        "precio_unitario_adjudicado": Decimal("2.0000"),
        "monto_adjudicado_linea": Decimal("100.5000"),
        "cedula_institucion": "B1",
        "fecha_adjud_firme": DAY.date(),
        "cedula_proveedor": "P1",
        "cod_producto": int(CODE),
        "moneda_adjudicada": "CRC",
        "tipo_cambio_crc": None,
    }


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_award_matching(staged, no_broadcast, hot_rows):
    cases = [
        ([award()], [procedure(linea="2")], [None]),
        ([award()], [procedure(prod_id=CODE + "0042")], [None]),  # a longer prod_id never matches
        ([award(), award(nro_oferta="O2")], [procedure()], [100.5, 100.5]),  # full amount on both
        ([award()], [procedure(), procedure(prod_id=f"{CODE} ", monto_adju_linea="7")], [7.0, 100.5]),
        ([award(codigo_producto=None)], [procedure(prod_id=None)], [None]),
    ]
    for lines, procedures, amounts in cases:
        rows = award_lines(staged, lines, procedures, hot_rows=hot_rows).collect()
        got = sorted((None if r.monto_adjudicado_linea is None else float(r.monto_adjudicado_linea) for r in rows), key=str)
        assert got == sorted(amounts, key=str)
        assert all((r.cedula_institucion is None) == (r.monto_adjudicado_linea is None) for r in rows)


# --- reports --------------------------------------------------------------------------------------


@pytest.fixture
def small_model(spark):
    awards = spark.createDataFrame(
        [("S1", "B1", "P1", "10"), ("S1", "B1", "P1", "5"), ("S2", "B2", "P1", "1"), ("S3", "B3", "P1", None),
         ("S4", None, "P1", "99"), ("S5", "B9", "P1", "99"), ("S6", "B1", "P2", "2")],
        "nro_sicop string, cedula_institucion string, cedula_proveedor string, m string",
    ).withColumn("monto_adjudicado_linea", F.col("m").cast("decimal(18,4)"))
    buyers = spark.createDataFrame(
        [("B1", "Same"), ("B2", "Same"), ("B3", "Other")], "cedula_institucion string, nombre_institucion string"
    )
    suppliers = spark.createDataFrame([("P1", "Uno"), ("P2", "Dos")], "cedula_proveedor string, nombre_proveedor string")
    return awards, buyers, suppliers


def test_awards_by_buyer(small_model):
    awards, buyers, _ = small_model
    rows = reports.awards_by_buyer_for_supplier(awards, buyers, "P1").collect()
    # A NULL total comes first; buyers of one name are merged; unknown buyers drop out.
    assert [tuple(r) for r in rows] == [("Other", 1, None), ("Same", 2, Decimal("16.0000"))]


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_supplier_buyer_ranking(small_model, no_broadcast, hot_rows):
    rows = reports.supplier_buyer_ranking(*small_model, hot_rows=hot_rows).collect()
    assert [tuple(r) for r in rows] == [
        ("P1", "Uno", "Other", 1, None),
        ("P1", "Uno", "Same", 2, Decimal("16.0000")),
        ("P2", "Dos", "Same", 1, Decimal("2.0000")),
    ]


def test_top_buyers(spark):
    buyers = spark.createDataFrame(
        [(f"B{i}", f"Buyer {i:02d}") for i in range(21)], "cedula_institucion string, nombre_institucion string"
    )
    rows = [(f"S{i}-{j}", f"B{i}", DAY) for i in range(21) for j in range(3 if i == 20 else 1)]
    rows += [("S20-0", "B20", DAY), ("late", "B0", dt.datetime(2026, 2, 1)), ("none", "B0", None)]
    lines = spark.createDataFrame(rows, "nro_sicop string, cedula_institucion string, fecha_publicacion timestamp_ntz")
    got = [tuple(r) for r in reports.top_buyers_by_month(lines, buyers, 2026, 1).collect()]
    assert got == [("Buyer 20", 3)] + [(f"Buyer {i:02d}", 1) for i in range(19)]


def test_report_filters_reach_the_scan(spark, small_model, plan_of, tmp_path):
    awards, buyers, _ = small_model
    awards.write.parquet(str(tmp_path / "awards"))
    plan = plan_of(reports.awards_by_buyer_for_supplier(spark.read.parquet(str(tmp_path / "awards")), buyers, "P1"))
    assert "EqualTo(cedula_proveedor,P1)" in plan
    lines = spark.range(1).select(
        F.col("id").cast("string").alias("nro_sicop"), F.lit("B1").alias("cedula_institucion"),
        F.lit("2026-01-05").cast("timestamp_ntz").alias("fecha_publicacion"), F.lit(1).alias("unused"),
    )
    lines.write.parquet(str(tmp_path / "lines"))
    plan = plan_of(reports.top_buyers_by_month(spark.read.parquet(str(tmp_path / "lines")), buyers, 2026, 1))
    assert "GreaterThanOrEqual(fecha_publicacion,2026-01-01" in plan and "LessThan(fecha_publicacion,2026-02-01" in plan
    assert "TakeOrderedAndProject" in plan and "unused" not in plan


def test_distinct_count_is_reduced_per_tender_before_the_group(small_model, plan_of):
    awards, buyers, suppliers = small_model
    plan = plan_of(reports.supplier_buyer_ranking(awards, buyers, suppliers))
    assert "hashpartitioning(cedula_proveedor" in plan and ", nro_sicop#" in plan.split("hashpartitioning(cedula_proveedor", 2)[-1]
