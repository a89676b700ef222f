"""The queries with a check, against DuckDB."""

import pytest
from compare import differences, duck

from tallyhouse.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(name, spark, sf_dir):
    assert differences(QUERIES[name](spark, sf_dir), duck(sf_dir), ORACLES[name]) is None
