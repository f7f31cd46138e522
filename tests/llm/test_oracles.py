import oracle
import pytest

from featurepipe.llm import queries


@pytest.fixture(scope="module")
def duck(sf):
    return oracle.connect(sf)


def test_each_oracle_has_its_query():
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    columns, rows = oracle.spark_rows(queries.QUERIES[name](spark, sf))
    expected_columns, expected = oracle.duck_rows(duck, queries.ORACLES[name])
    assert columns == expected_columns
    assert len(rows) == len(expected) > 0
    assert rows == expected
    assert [type(v) for v in rows[0]] == [type(v) for v in expected[0]]
