import pytest

import siftline.queries as Q
from tests.oracle import database, rows_of_spark, rows_of_sql

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", list(Q.QUERIES))
def test_query_equals_sql(spark, con, name):
    q = Q.QUERIES[name]
    columns, got = rows_of_spark(q.run(spark, SF))
    assert got
    if q.sql is not None:
        want = rows_of_sql(con, q.sql, columns)
        extra, lost = got - want, want - got
        assert not extra and not lost, (name, list(extra.items())[:3], list(lost.items())[:3])
