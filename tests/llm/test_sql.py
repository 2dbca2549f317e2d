import pytest

from siftline.llm.queries import ORACLES, QUERIES
from tests.oracle import database, rows_of_spark, rows_of_sql

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op11_word_tries", "op12_superminhash", "op13_dual_tree"])
def test_query_equals_sql(spark, name):
    columns, got = rows_of_spark(QUERIES[name](spark, SF))
    assert got and got == rows_of_sql(database(SF), ORACLES[name], columns)
