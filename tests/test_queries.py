"""Every registered query on the smallest tables, next to its SQL where it has one."""

import os

import pytest

import __spark_entry__ as entry
import oracle

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    sql = entry.oracle_sql().get(name)
    if sql is not None:
        assert oracle.differences(got, duck.execute(sql).df()) == []


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 5198
