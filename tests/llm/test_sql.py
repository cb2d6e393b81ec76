"""Queries of the operators against their SQL, where SQL can express them."""

import pytest
from compare import compare, connect

from churnkit.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(spark, connect(FOLDER), name, QUERIES[name], ORACLES[name], FOLDER) == []
