"""Every registered query against its SQL on the smallest tables."""

import sys

import pytest

from conftest import ROOT

sys.path.insert(0, str(ROOT / "tools"))

import check_oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from conformance.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.duckdb_session(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert check_oracle.compare(spark, con, name, SF) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "cedula_proveedor",
        "nombre_proveedor",
        "nombre_institucion",
        "carteles_ganados",
        "monto_total_adjudicado",
    ]
    assert df.count() == 1444


def test_catalog_and_lookup_sizes(spark):
    from tenderloom.sources.segments import SEGMENTS, segment_names

    assert len(SEGMENTS) == len(dict(SEGMENTS)) == 57
    assert segment_names(spark).count() == 57
