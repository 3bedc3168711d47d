import pytest

from tests.oracle import same
from voltweave.plans import queries


@pytest.mark.parametrize("name", sorted(queries.Q))
def test_query_equals_its_sql(spark, name):
    same(spark, queries.Q[name], queries.O[name])
