"""Every query with an SQL twin, at the smallest scale."""

import pytest
from check_oracles import compare, duck

from reviewmill.plans.oracles import ORACLES
from reviewmill.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_matches_sql(spark, connection, name):
    verdict, detail = compare(QUERIES[name](spark, FOLDER), connection, ORACLES[name])
    assert verdict in ("ok", "near"), detail


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
