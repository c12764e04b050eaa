"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os

import pytest
from compare import compare, connect

from gradin.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


TYPED = [n for n in sorted(ORACLES) if n.startswith(("silver_", "cast_", "fact_", "to_numeric"))]


@pytest.mark.parametrize("name", TYPED)
def test_typed_tables_match_sql_without_ansi(spark, con, name):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
