"""The operators' queries against their SQL, and the contract's columns."""

from __future__ import annotations

import os

import pytest
from compare import compare, connect

from gradin.llm import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLES[name]) is None


def test_one_query_per_operator():
    assert [sum(q.startswith(f"op{n}_") for q in QUERIES) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in QUERIES
