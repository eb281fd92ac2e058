"""Every query of the catalogue against its SQL counterpart."""

import os

import pytest

import __spark_entry__ as entry
import oracle_check
from folioflow.plans.oracle import ORACLE
from folioflow.plans.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def test_every_counterpart_has_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, message, _ = oracle_check.compare(spark, con, QUERIES[name], ORACLE.get(name), SF_DIR)
    assert ok, message


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["page_id", "identifier", "path_to_file", "file_hash", "size"]
    assert df.count() > 0


def test_whole_runs_transform_changed_moved_and_unchanged_rows_of_all_bodies(spark):
    rows = QUERIES["full_pipeline_bodies"](spark, SF_DIR).collect()
    again = [r for r in rows if r.processed_on == "2024-07-01"]
    assert len({r.body for r in again}) == 4
    assert any(r.partition_date == "2025-01" for r in again) and {"stored", "unchanged"} <= {r.scrape_status for r in again}
