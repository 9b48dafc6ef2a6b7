"""Queries against their SQL."""

import pytest

from tests.compare import compare, connect
from vitrine.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_rows_match(spark, data, name):
    _, problem = compare(spark, connect(data), data, QUERIES[name], ORACLES[name])
    assert problem is None
