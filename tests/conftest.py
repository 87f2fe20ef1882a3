import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from millrace.session import local_session

    session = local_session(8, "millrace-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from millrace.catalog.registry import Tables

    return Tables(spark, SMALL)
