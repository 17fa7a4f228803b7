"""Every registered query against its check SQL on the smallest tables."""

import pytest

from tests.compare import connect, difference, duck_rows, spark_rows
from timelane.plans import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES, CHECKS = catalog.queries(), catalog.checks()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_check(spark, duck, name):
    assert difference(spark_rows(QUERIES[name](spark, FOLDER)), duck_rows(duck, CHECKS[name])) is None


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
