"""Every registered query against its SQL counterpart."""

import pytest
from compare import SF, duck, duck_rows, spark_rows

from tallyloom.plans.oracles import ORACLES
from tallyloom.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF))
    wanted_columns, wanted = duck_rows(con, ORACLES[name])
    assert columns == wanted_columns
    assert rows == wanted
