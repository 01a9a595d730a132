"""Every registered query against its SQL over the smallest driver tables."""

import os

import pytest

import oracle
from juncture import queries
from juncture import queries_evidence, queries_stored, queries_tables  # noqa: F401 - register their queries

pytestmark = pytest.mark.skipif(not os.path.isdir(oracle.SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, con, name):
    oracle.assert_same(spark, con, queries.QUERIES[name], queries.SQL[name])


def test_every_query_has_sql():
    assert set(queries.QUERIES) == set(queries.SQL)


def test_entry(spark):
    import __spark_entry__

    if os.path.isdir("/root/testdata/sf0.001"):
        assert __spark_entry__.entry(spark).count() == 10
