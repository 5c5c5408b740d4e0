"""Every query against its SQL, on the smallest tables."""

import os

import pytest

from compare import differences, duck
from lexforge.operators import joins, nesting, ranking
from lexforge.queries import ALL, base

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(ALL))
def test_query(spark, con, name):
    query = ALL[name]
    df = query.run(spark, SF)
    if query.sql:
        assert differences(df, con, query.sql) == ""
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", [n for n in ALL if ALL[n].sql])
def test_query_as_on_large_tables(spark, con, name, monkeypatch):
    """The same with every bound so low that no table is small: no broadcast, no plain window, lists in parts."""
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(joins, "HOT_ROWS", 100)
    monkeypatch.setattr(ranking, "WINDOW_ROWS", 0)
    monkeypatch.setattr(nesting, "PART_ROWS", 500)
    sql = ALL[name].sql.replace(str(base.PART_ROWS), "500")
    assert differences(ALL[name].run(spark, SF), con, sql) == ""


def test_plans_stay_in_the_jvm(spark):
    for name, query in ALL.items():
        plan = query.run(spark, SF)._jdf.queryExecution().toString()
        for unwanted in ("Python", "ArrowEval", "NestedLoop", "CartesianProduct"):
            assert unwanted not in plan, (name, unwanted)
