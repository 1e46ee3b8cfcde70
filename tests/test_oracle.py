"""Every registered query against its SQL, on the smallest given tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from silostar.workload.oracle import ORACLE
from silostar.workload.queries import QUERIES
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="given tables not present")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


def test_every_query_of_the_warehouse_has_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, name):
    assert differences(entry.queries()[name](spark, FOLDER), database, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
