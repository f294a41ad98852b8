import pytest

import __spark_entry__ as entry_points
from florin.plans.registry import QUERIES as REPORT_QUERIES
from oracle import assert_same, connect

SF_DIR = "/root/testdata/sf0.001"
ORACLES = entry_points.oracle_sql()
QUERIES = entry_points.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(REPORT_QUERIES) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(REPORT_QUERIES))
def test_query(spark, duck, name):
    assert_same(QUERIES[name](spark, SF_DIR), duck, ORACLES[name])


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns[-1] == "fecha_reporte" and frame.count() == 5
