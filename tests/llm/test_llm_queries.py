"""Registered queries: names, and oracle parity where SQL expresses them."""

import pytest
from llm_cases import SF
from oracle_compare import compare, duck

import __spark_entry__ as entry
from txlake.llm import queries


def test_all_are_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_oracle(spark, name):
    result = compare(queries.QUERIES[name](spark, SF), queries.oracle_sql()[name], duck(SF))
    assert result["match"], result
