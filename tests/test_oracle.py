import pytest
from duck import same

from waymark.catalog import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equal_to_duckdb(spark, name):
    same(QUERIES[name](spark, SF), ORACLE_SQL[name], SF)
