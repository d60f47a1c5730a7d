"""Every query with an oracle, on the smallest tables."""

import pytest

from oracle import connect, duck_rows, spark_rows
from strata.queries import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(registry()))
def test_query(spark, duck, name):
    run, sql = registry()[name]
    columns, rows = spark_rows(run(spark, FOLDER))
    if sql is None:
        assert rows
        return
    expected_columns, expected = duck_rows(duck, sql)
    assert columns == expected_columns
    assert rows == expected
