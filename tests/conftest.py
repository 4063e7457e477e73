import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from holdfast.runtime import local_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="session")
def stored(spark, sf_dir):
    from holdfast.plans import catalog

    return catalog.trained(spark, sf_dir).stored
