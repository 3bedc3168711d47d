import pytest

from tests.oracle import same
from voltweave.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, name):
    same(spark, registry.QUERIES[name], registry.ORACLES[name])


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11))
