import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tenderloom.schemas import STAGING  # noqa: E402
from tenderloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", shuffle_partitions=4, app="tests")
    session.conf.set("spark.sql.maxMetadataStringLength", "2000")  # whole filters in plan texts
    yield session
    session.stop()


@pytest.fixture
def staged(spark):
    """staged(table, rows): a staging DataFrame; columns left out are NULL."""

    def build(name, rows):
        table = STAGING[name]
        records = []
        for row in rows:
            unknown = set(row) - set(table.names)
            assert not unknown, unknown
            records.append(tuple(row.get(c) for c in table.names))
        return spark.createDataFrame(records, table.struct())

    return build


@pytest.fixture
def no_broadcast(spark):
    """Joins shuffle, as they would on tables too large to broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.fixture
def plan_of():
    """Text of the physical plan, as executed when ``run`` is set."""

    def text(df, run=False):
        if run:
            df.collect()
        return df._jdf.queryExecution().executedPlan().toString()

    return text
