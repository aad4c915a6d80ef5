"""Every registered query against its SQL on the same tables."""

import os

import pytest

from tallyhouse.catalog.oracles import ORACLES
from tallyhouse.catalog.queries import QUERIES
from tests.compare import connect, differences

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def sql():
    con = connect(FOLDER)
    yield con
    con.close()


def test_all_queries_have_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, FOLDER)
    assert differences(df, sql, ORACLES[name]) == []
