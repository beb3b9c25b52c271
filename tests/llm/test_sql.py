import pytest

from compare import compare, connect
from landstrata.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_rows_equal_the_sql(spark, name, size):
    tables = f"/root/testdata/{size}"
    assert compare(spark, connect(tables), tables, queries.QUERIES[name], queries.SQL[name]) is None
