import pytest

from conformance import fixtures as fx
from tenderloom.operators.quality import ConstraintError
from tenderloom.plans.refresh import full_refresh, read_rejected
from tenderloom.schemas import BID_LINES, BUYERS, MODEL
from tenderloom.sources.tables import publish, read_model, read_published, run_folder, upsert_table, write_table

SF = "/root/testdata/sf0.001"
CODE = "4321150101234567"


def clean_staging(staged):
    version = {"etl_period": "202601"}
    return {
        "stg_proveedores": staged("stg_proveedores", [{"cedula_proveedor": "P1", "nombre_proveedor": "p", **version}]),
        "stg_instituciones": staged("stg_instituciones", [{"cedula": "B1", "nombre_institucion": "b", **version}]),
        "stg_carteles": staged("stg_carteles", [{"nro_sicop": "S1", "cedula_institucion": "B1", **version}]),
        "stg_lineas_carteles": staged(
            "stg_lineas_carteles",
            [{"nro_sicop": "S1", "numero_linea": "1", "codigo_identificacion": CODE, **version}],
        ),
        "stg_ofertas": staged("stg_ofertas", [{"nro_sicop": "S1", "nro_oferta": "O1", "cedula_proveedor": "P1", **version}]),
        "stg_lineas_ofertadas": staged(
            "stg_lineas_ofertadas",
            [{"nro_sicop": "S1", "nro_oferta": "O1", "nro_linea": "1", "codigo_producto_cl": CODE, **version}],
        ),
        "stg_procedimientos_adjudicacion": staged(
            "stg_procedimientos_adjudicacion",
            [{"nro_sicop": "S1", "cedula": "B1", "linea": "1", "prod_id": CODE, "monto_adju_linea": "5", **version}],
        ),
        "stg_lineas_adjudicadas": staged(
            "stg_lineas_adjudicadas",
            [{"nro_sicop": "S1", "nro_oferta": "O1", "nro_linea": "1", "codigo_producto": CODE,
              "cedula_proveedor": "P1", **version}],
        ),
    }


def test_strict_refresh(spark, staged, tmp_path):
    staging = clean_staging(staged)
    report = full_refresh(spark, staging, str(tmp_path / "model"), policy="strict").collect()
    assert {(r.table_name, r.rule, r.n_rows) for r in report} == {(name, "rows", 1) for name in MODEL}
    staging["stg_proveedores"] = staging["stg_proveedores"].where("false")
    with pytest.raises(ConstraintError, match="cedula_proveedor -> dim_proveedores: 1"):
        full_refresh(spark, staging, str(tmp_path / "broken"), policy="strict")
    with pytest.raises(ValueError):
        full_refresh(spark, staging, str(tmp_path / "x"), policy="ignore")


def contents(spark, target):
    return {name: sorted(map(str, read_model(spark, target, table).collect())) for name, table in MODEL.items()}


def test_a_failed_refresh_changes_nothing_for_readers(spark, staged, tmp_path):
    target, staging = str(tmp_path / "model"), clean_staging(staged)
    with pytest.raises(ValueError, match="no run of"):
        read_model(spark, target, BUYERS)
    full_refresh(spark, staging, target)
    before = contents(spark, target)
    broken = dict(staging)
    broken["stg_instituciones"] = staged("stg_instituciones", [{"cedula": "B9", "nombre_institucion": "z", "etl_period": "202602"}])
    broken["stg_lineas_ofertadas"] = staged(
        "stg_lineas_ofertadas",
        [{"nro_sicop": "S1", "nro_oferta": "O1", "nro_linea": "1", "cantidad_ofertada": "12,5", "etl_period": "202602"}],
    )
    with pytest.raises(Exception, match="cannot read"):
        full_refresh(spark, broken, target)
    assert contents(spark, target) == before
    broken["stg_lineas_ofertadas"] = staging["stg_lineas_ofertadas"]
    with pytest.raises(ConstraintError):
        full_refresh(spark, broken, target, policy="strict")
    assert contents(spark, target) == before
    full_refresh(spark, broken, target)
    assert "B9" in str(contents(spark, target)[BUYERS.name])


def test_quarantine(spark, staged, tmp_path):
    target, staging = str(tmp_path / "model"), clean_staging(staged)
    version = {"etl_period": "202601"}
    lines = [
        {"nro_sicop": "S1", "numero_linea": "1", "codigo_identificacion": CODE, **version},
        {"nro_sicop": "S1", "numero_linea": "2", "codigo_identificacion": CODE, "cantidad_solicitada": "12,5", **version},
        {"nro_sicop": "S1", "numero_linea": "3", "codigo_identificacion": CODE, "cantidad_solicitada": "-1", **version},
        {"nro_sicop": "S1", "numero_linea": "4", "codigo_identificacion": "123", **version},
    ]
    staging["stg_lineas_carteles"] = staged("stg_lineas_carteles", lines)
    report = {(r.table_name, r.rule, r.target): r.n_rows for r in full_refresh(spark, staging, target, policy="quarantine").collect()}
    name = "lineas_carteles"
    assert report[name, "rows", name] == 1
    assert {k[2]: n for k, n in report.items() if k[:2] == (name, "rejected")} == {
        "unreadable cantidad": 1, "check ck_lineas_carteles_cantidad": 1, "cod_producto -> dim_catalogo_codigo_identificacion_producto": 1,
    }
    rejected = read_rejected(spark, target, name)
    assert sorted(r.nro_linea for r in rejected.collect()) == [2, 3, 4]
    assert read_model(spark, target, MODEL[name]).count() == 1
    assert {r.rule for r in full_refresh(spark, staging, target, policy="quarantine").collect()} == {"rows", "rejected"}


def test_upsert_is_stored_and_repeatable(spark, staged, tmp_path):
    target = str(tmp_path / "model")
    full_refresh(spark, clean_staging(staged), target)
    rows = [("B1", "new name", None, None, None), ("B2", "second", "p", "c", "d")]
    incoming = spark.createDataFrame(rows, BUYERS.struct())
    for _ in range(2):
        upsert_table(spark, target, BUYERS, incoming)
        assert sorted(tuple(r)[:2] for r in read_model(spark, target, BUYERS).collect()) == [("B1", "new name"), ("B2", "second")]


def test_refresh_twice_gives_the_same_tables(spark, tmp_path):
    staging = fx.staging(spark, SF)
    first = full_refresh(spark, staging, str(tmp_path / "a")).collect()
    # Other row order, other partitions.
    again = {n: df.repartition(3) for n, df in staging.items()}
    second = full_refresh(spark, again, str(tmp_path / "b")).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))
    for name, table in MODEL.items():
        a, b = read_model(spark, f"{tmp_path}/a", table), read_model(spark, f"{tmp_path}/b", table)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def test_reloading_the_history_changes_no_fact(spark):
    """Every row staged a second time: versions collapse, so dimensions and facts stay as they are."""
    from tenderloom.plans.refresh import build_model

    staging = fx.staging(spark, SF)
    once = build_model(staging)
    twice = build_model({n: df.unionByName(df) for n, df in staging.items()})
    for name in MODEL:
        assert once[name].exceptAll(twice[name]).isEmpty(), name
        assert once[name].count() == twice[name].count(), name


def test_left_joins_keep_every_line(spark):
    """Tender and bid lines join a unique header, so the deduplicated line count is kept."""
    from tenderloom.plans import facts

    lines, tenders = fx.stg_lineas_carteles(spark, SF), fx.stg_carteles(spark, SF)
    assert facts.tender_line_fact(lines, tenders).count() == facts.latest_tender_lines(lines).count()


def test_spread_facts_equal_plain_ones(spark, no_broadcast):
    """Every key treated as hot against none: same facts and catalog."""
    from tenderloom.plans import catalog, facts

    st = fx.staging(spark, SF)
    lines, bid_lines = st["stg_lineas_carteles"], st["stg_lineas_ofertadas"]
    awards, procedures = st["stg_lineas_adjudicadas"], st["stg_procedimientos_adjudicacion"]
    builds = (
        lambda n: facts.tender_line_fact(lines, st["stg_carteles"], hot_rows=n),
        lambda n: facts.bid_line_fact(bid_lines, st["stg_ofertas"], hot_rows=n),
        lambda n: facts.award_line_fact(awards, procedures, hot_rows=n),
        lambda n: catalog.product_catalog(lines, bid_lines, awards, procedures, hot_rows=n),
    )
    for build in builds:
        spread, plain = build(1), build(10**6)
        assert spread.exceptAll(plain).isEmpty() and spread.count() == plain.count()


def stored(spark, target, rows, run="first"):
    """Bid lines (offer, line, supplier) published as a run of several files."""
    struct = BID_LINES.struct()
    records = [tuple({"nro_sicop": "S", "nro_oferta": o, "nro_linea": n, "cedula_proveedor": p}.get(c) for c in BID_LINES.names) for o, n, p in rows]
    df = spark.createDataFrame(records, struct)
    write_table(df.repartitionByRange(4, "nro_oferta", "cedula_proveedor"), run_folder(target, run, BID_LINES.name))
    publish(spark, target, run, [BID_LINES.name])
    return lambda more: spark.createDataFrame(
        [tuple({"nro_sicop": "S", "nro_oferta": o, "nro_linea": n, "cedula_proveedor": p}.get(c) for c in BID_LINES.names) for o, n, p in more],
        struct,
    )


def bid_rows(spark, target):
    rows = read_model(spark, target, BID_LINES).collect()
    return sorted(((r.nro_oferta, r.nro_linea, r.cedula_proveedor) for r in rows), key=str)


@pytest.mark.parametrize("spread", [False, True])
def test_upsert_leaves_untouched_copies_and_null_keys(spark, tmp_path, request, spread):
    if spread:
        request.getfixturevalue("no_broadcast")
    target = str(tmp_path / "model")
    old = [("a", 1, "x"), ("a", 1, "y"), (None, 1, "n1"), (None, 1, "n2"), ("b", 1, "z")]
    rows = stored(spark, target, old)
    upsert_table(spark, target, BID_LINES, rows([("c", 1, "w")]))
    assert bid_rows(spark, target) == sorted([*old, ("c", 1, "w")], key=str)
    # Several incoming rows of a key stand for all its old ones, and a null key is a key.
    new = [("a", 1, "p"), ("a", 1, "q"), ("a", 1, "q"), (None, 1, "m"), ("b", 2, "v")]
    for _ in range(2):
        upsert_table(spark, target, BID_LINES, rows(new))
        assert bid_rows(spark, target) == sorted([*new, ("b", 1, "z"), ("c", 1, "w")], key=str)
    before = read_published(spark, target, BID_LINES.name)
    upsert_table(spark, target, BID_LINES, rows([]))
    assert read_published(spark, target, BID_LINES.name) == before


def test_upsert_rewrites_only_files_that_hold_a_key(spark, tmp_path):
    target = str(tmp_path / "model")
    rows = stored(spark, target, [(f"o{k:03d}", 1, "p") for k in range(200)])
    files = set(read_model(spark, target, BID_LINES).inputFiles())
    assert len(files) == 4
    upsert_table(spark, target, BID_LINES, rows([("o007", 1, "new"), ("o008", 2, "new"), ("zzz", 1, "new")]))
    after = set(read_model(spark, target, BID_LINES).inputFiles())
    assert len(files & after) == 3 and all("run=first" not in f for f in after - files)
    assert read_model(spark, target, BID_LINES).count() == 202
    # The next version starts from the listed files and keeps those of both runs.
    upsert_table(spark, target, BID_LINES, rows([("o199", 1, "newer")]))
    last = set(read_model(spark, target, BID_LINES).inputFiles())
    assert len(last & files) == 2 and read_model(spark, target, BID_LINES).count() == 202
    assert {r for r in bid_rows(spark, target) if r[2] != "p"} == {
        ("o007", 1, "new"), ("o008", 2, "new"), ("zzz", 1, "new"), ("o199", 1, "newer"),
    }


def test_upsert_scans_no_file_outside_the_key_ranges(spark, tmp_path):
    from tenderloom.sources import tables

    target = str(tmp_path / "model")
    rows = stored(spark, target, [(f"o{k:03d}", 1, "p") for k in range(200)] + [(None, 1, "p")])
    ranges = tables._listed(spark, target, BID_LINES.name, BID_LINES.struct(), ["nro_oferta"], {"run": "first"})
    assert ranges.agg({"n_rows": "sum"}).first()[0] == 201
    keys = rows([("o001", 1, ""), ("o199", 1, "")]).select("nro_oferta")
    assert len(tables._may_hold(ranges, keys, "nro_oferta")) == 2
    assert len(tables._may_hold(ranges, rows([(None, 1, "")]).select("nro_oferta"), "nro_oferta")) == 1
    assert tables._may_hold(ranges, rows([("p", 1, "")]).select("nro_oferta"), "nro_oferta") == []


def test_a_version_of_a_run_that_is_no_longer_published_is_refused(spark, tmp_path, monkeypatch):
    from tenderloom.sources import tables

    target = str(tmp_path / "model")
    rows = stored(spark, target, [("a", 1, "x")])
    replace = tables.replace_keys

    def overtaken(*args, **kwargs):
        made = replace(*args, **kwargs)
        monkeypatch.undo()
        upsert_table(spark, target, BID_LINES, rows([("b", 1, "fast")]))
        return made

    monkeypatch.setattr(tables, "replace_keys", overtaken)
    with pytest.raises(tables.OvertakenError):
        upsert_table(spark, target, BID_LINES, rows([("c", 1, "slow")]))
    assert bid_rows(spark, target) == [("a", 1, "x"), ("b", 1, "fast")]


def test_reading_creates_nothing(spark, tmp_path):
    with pytest.raises(ValueError, match="no run of"):
        read_model(spark, str(tmp_path / "typo"), BUYERS)
    assert list(tmp_path.iterdir()) == []


def test_shared_state_of_many_writers(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from tenderloom.sources.records import SharedState

    path = str(tmp_path / "state")
    assert SharedState(spark, path).state() == {} and not SharedState(spark, path).exists()

    def add(worker):
        for k in range(15):
            SharedState(spark, path).change(lambda s: {"sum": s.get("sum", 0) + 1, f"w{worker}": k, "gone": None})

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(add, range(8)))
    assert SharedState(spark, path).state() == {"sum": 120, **{f"w{w}": 14 for w in range(8)}}
    assert SharedState(spark, path).change(lambda s: None)["sum"] == 120
    assert len(list((tmp_path / "state").iterdir())) == 120


def test_shared_state_through_a_store_that_only_spark_reaches(spark, tmp_path):
    from tenderloom.sources.records import SharedState

    state = SharedState(spark, str(tmp_path / "state"))
    state._local = None
    for k in range(3):
        state.change(lambda s: {"n": s.get("n", 0) + 1, "text": "é"})
    assert not state._create(2, "{}") and state.state() == {"n": 3, "text": "é"}


def test_reports_on_a_model_open_only_the_files_they_need(spark, tmp_path, plan_of):
    from pyspark.sql import functions as F

    from tenderloom.plans import reports
    from tenderloom.schemas import AWARD_LINES, TENDER_LINES
    from tenderloom.sources.tables import read_models, read_where

    target = str(tmp_path / "model")
    full_refresh(spark, fx.staging(spark, SF), target)
    awards, tenders, buyers = read_models(spark, target, AWARD_LINES, TENDER_LINES, BUYERS)
    month = F.lit("1996-01-01").cast("timestamp_ntz")
    mine, published_then = read_where(spark, target, AWARD_LINES, F.lit("7")), read_where(spark, target, TENDER_LINES, month)
    assert "PartitionFilters: [isnotnull(mes_publicacion" in plan_of(published_then) and "199601" in plan_of(published_then)
    assert "PartitionFilters: [isnotnull(cubeta_proveedor" in plan_of(mine)

    def files(df):
        return df.select(F.input_file_name().alias("f")).distinct().count()

    assert files(mine) * 5 < files(awards) and files(published_then) * 20 < files(tenders)
    # The supplier's lines are all there, whoever else shares the folder.
    assert mine.where("cedula_proveedor = '7'").count() == awards.where("cedula_proveedor = '7'").count() > 0

    def rows(df):
        return sorted(map(str, df.collect()))

    def same_answers():
        awards, tenders = read_models(spark, target, AWARD_LINES, TENDER_LINES)
        assert rows(reports.model_awards_by_buyer(spark, target, "7")) == rows(reports.awards_by_buyer_for_supplier(awards, buyers, "7"))
        assert rows(reports.model_top_buyers(spark, target, 1996, 1)) == rows(reports.top_buyers_by_month(tenders, buyers, 1996, 1))
        return len(awards.columns)

    assert same_answers() == len(AWARD_LINES.names)
    # An upsert takes the laid out files over; its answers come from a filter.
    upsert_table(spark, target, AWARD_LINES, awards.where("cedula_proveedor = '7'").withColumn("monto_adjudicado_linea", F.lit(1).cast("decimal(18,4)")))
    same_answers()
    assert spark.createDataFrame([], AWARD_LINES.struct()).columns == read_model(spark, target, AWARD_LINES).columns
