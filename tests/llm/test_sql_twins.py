"""Registered queries against their DuckDB twins, on the smallest tables."""

import pytest
from compare import difference

from salesmart.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_equals_its_twin(spark, small, duck, name):
    assert difference(queries.QUERIES[name](spark, small), duck, oracle.ORACLE[name]) is None


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1)) and len(numbers) >= 11
