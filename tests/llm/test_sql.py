"""Queries of this folder that SQL can express, beside their SQL."""

import os

import oracle_check
import pytest
from folioflow.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    ok, message, _ = oracle_check.compare(spark, oracle_check.connect(SF_DIR), queries.QUERIES[name], queries.ORACLE[name], SF_DIR)
    assert ok, message
