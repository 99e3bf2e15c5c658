"""Every registered query against its SQL twin on the smallest tables.

The derived freight tables are stored once and read from there; the SQL twin
derives them by itself.
"""

import duckdb
import pytest

from haulmark.catalog import load_all
from haulmark.sources.testbed import SOURCES, TestBed
from tests.conftest import SF_DIR
from tools.compare import compare

QUERIES, CHECKS = load_all()
#: The same folder under another name, so that other tests see the tables derived.
STORED = f"{SF_DIR}/."


@pytest.fixture(scope="module", autouse=True)
def stored(spark, tmp_path_factory):
    TestBed(spark, STORED).store(str(tmp_path_factory.mktemp("bed")))


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for source in SOURCES:
        con.execute(f"create view {source} as select * from '{SF_DIR}/{source}.parquet'")
    return con


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_check(spark, con, name):
    outcome = compare(QUERIES[name](spark, STORED), con, CHECKS[name])
    assert outcome.startswith("ok") and "TYPES" not in outcome, outcome
