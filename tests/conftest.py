import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from haulmark.session import local_session  # noqa: E402

SF_DIR = os.environ.get("HAULMARK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "haulmark-tests", 4, str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def bed(spark):
    from haulmark.sources.testbed import TestBed

    return TestBed(spark, SF_DIR)
